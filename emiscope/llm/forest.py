"""Near-duplicate vectors by a forest of random-projection trees.

Equal vectors of a label are one class from the start. Each tree splits the classes of a label
again and again by the median of their projections on a random direction; those close to the
median go to both sides. Classes are compared within leaves only, and pairs of all trees are
merged, so a pair is missed only if every tree parts it.

The upper splits of a tree are fitted on a bounded sample of each label and applied to every
class, which deals the classes out over tasks. Where more classes meet than a leaf takes, the
task goes on splitting on the classes themselves. A group of vectors that are all within the
threshold stays in one leaf, however large: its pairs are all links.

Vectors that ``vectors.usable`` leaves out and rows without a label link with nothing. Of rows
with a repeated id the one with the smallest label and vector counts. Vectors of unequal length
never link. Rows without an id are left out; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emiscope.llm import vectors as V
from emiscope.llm.components import components
from emiscope.session import write_through

LEAST_COSINE = 0.98
TREES = 10
LEAF = 1024
#: A class within this share of a node, on either side of the median, goes to both children.
SPILL = 0.06
#: Bound of the classes of each label that the upper splits are fitted on.
SAMPLE = 4096
#: Sampled classes that an upper leaf holds at least.
SAMPLED_LEAF = 512
SEED = 20_011
SPLIT = np.dtype([("tree", "<i4"), ("node", "<i8"), ("low", "<f8"), ("middle", "<f8"), ("high", "<f8")])


def _direction(tree: int, label: int, node: int, size: int) -> np.ndarray:
    """The random direction of a node, the same wherever it is asked for."""
    return np.random.default_rng([SEED, tree, label & 0xFFFFFFFF, node, size]).standard_normal(size)


def _split(projected: np.ndarray) -> tuple[float, float, float]:
    """Median of the projections, and the bounds of those that go to both sides."""
    low, middle, high = np.quantile(projected, [0.5 - SPILL, 0.5, 0.5 + SPILL])
    return float(low), float(middle), float(high)


def _sides(projected: np.ndarray, low: float, middle: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    return (projected <= middle) | (projected < high), (projected > middle) | (projected > low)


def fit_upper(unit: np.ndarray, tree: int, label: int) -> dict[int, tuple[float, float, float]]:
    """Splits by node number: the root is 1, children of ``k`` are ``2k`` and ``2k + 1``."""
    splits: dict[int, tuple[float, float, float]] = {}
    waiting = [(1, np.arange(len(unit)))]
    while waiting:
        node, members = waiting.pop()
        if len(members) < 2 * SAMPLED_LEAF:
            continue
        projected = unit[members] @ _direction(tree, label, node, unit.shape[1])
        splits[node] = _split(projected)
        left, right = _sides(projected, *splits[node])
        if left.all() or right.all():
            del splits[node]
            continue
        waiting += [(2 * node, members[left]), (2 * node + 1, members[right])]
    return splits


def _descend(unit: np.ndarray, tree: int, label: int, splits: dict) -> Iterator[tuple[int, np.ndarray]]:
    """Upper leaves with the rows that reach them."""
    waiting = [(1, np.arange(len(unit)))]
    while waiting:
        node, members = waiting.pop()
        if node not in splits or not len(members):
            if len(members):
                yield node, members
            continue
        left, right = _sides(unit[members] @ _direction(tree, label, node, unit.shape[1]), *splits[node])
        waiting += [(2 * node, members[left]), (2 * node + 1, members[right])]


def _tight(unit: np.ndarray, least: float) -> bool:
    """Whether all rows are so near their mean that each two of them link."""
    mean = unit.mean(axis=0)
    half = np.cos(np.arccos(least) / 2)
    return bool((unit @ mean >= half * np.linalg.norm(mean)).all())


def _leaves(unit: np.ndarray, tree: int, label: int, node: int, least: float) -> Iterator[np.ndarray]:
    """Lower leaves of at most ``LEAF`` rows, but for rows that no split parts or that all link."""
    waiting = [(node, np.arange(len(unit)), 0)]
    while waiting:
        node, members, tried = waiting.pop()
        if len(members) <= LEAF or tried == 3 or _tight(unit[members], least):
            yield members
            continue
        projected = unit[members] @ _direction(tree, label, node, unit.shape[1])
        left, right = _sides(projected, *_split(projected))
        if left.sum() > 0.8 * len(members) or right.sum() > 0.8 * len(members):
            waiting.append((node * 2 + 1, members, tried + 1))
        else:
            waiting += [(2 * node, members[left], 0), (2 * node + 1, members[right], 0)]


def _unit(frame: pd.DataFrame, kind: str) -> np.ndarray:
    rows = V.matrix(frame["vector"], kind)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that no norm overflows or vanishes
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _pairs(least: float, kind: str):
    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        """Linked pairs of one upper leaf, each once."""
        label, _, tree, node = key
        order = np.argsort(frame["class_id"].to_numpy())
        frame = frame.iloc[order]
        ids, unit = frame["class_id"].to_numpy(), _unit(frame, kind)
        codes = [np.zeros(0, np.int64)]
        for members in _leaves(unit, int(tree), int(label), int(node), least):
            for start in range(0, len(members), 256):
                rows = members[start : start + 256]
                a, b = np.nonzero(unit[rows] @ unit[members].T >= least)
                later = rows[a] < members[b]
                codes.append(rows[a[later]] * len(ids) + members[b[later]])
        pairs = np.unique(np.concatenate(codes))
        return pd.DataFrame({"a": ids[pairs // len(ids)], "b": ids[pairs % len(ids)]})

    return compare


def link_vectors(embeddings: DataFrame, least: float = LEAST_COSINE, trees: int = TREES) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``embeddings`` with an id."""
    kind = V.kind_of(embeddings)
    all_ids = embeddings.select(F.col("vec_id").cast("long")).where("vec_id is not null").distinct()
    rows = V.usable(embeddings.where("label is not null")).withColumn("size", F.octet_length("vector"))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector", "size")).alias("r")).select("vec_id", "r.*")
    rows = write_through(rows, "vectors")
    classes = rows.groupBy("label", "vector", "size").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"))
    classes = write_through(classes, "vector_classes")
    member = write_through(
        rows.join(classes.select("label", "vector", "class_id", "copies"), ["label", "vector"]).select("vec_id", "class_id", "copies"),
        "vector_members",
    )
    groups = classes.select("label", "size", "class_id", "vector")

    def fitted(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        label, size = (int(k) for k in key)
        unit = _unit(frame, kind)
        made = [(t, n, *s) for t in range(trees) for n, s in fit_upper(unit, t, label).items()]
        return pd.DataFrame({"label": [label], "size": [size], "splits": [np.array(made, SPLIT).tobytes()]})

    # A hash threshold bounds each label's sample to about SAMPLE rows before any group is gathered.
    sizes = groups.groupBy("label", "size").agg(F.count("*").alias("n"))
    marked = groups.join(F.broadcast(sizes) if sizes.count() < 100_000 else sizes, ["label", "size"])
    sample = marked.where(F.pmod(F.xxhash64("class_id"), F.lit(1 << 40)) < F.lit(float(SAMPLE) * (1 << 40)) / F.col("n"))
    upper = sample.groupBy("label", "size").applyInPandas(fitted, "label long, size long, splits binary")
    upper = write_through(upper, "splits")

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (label, size), group in frame.groupby(["label", "size"]):
                unit = _unit(group, kind)
                by_tree: dict[int, dict] = {}
                for tree, node, *bounds in np.frombuffer(group["splits"].iloc[0] or b"", SPLIT).tolist():
                    by_tree.setdefault(tree, {})[node] = tuple(bounds)
                for tree in range(trees):
                    for node, members in _descend(unit, tree, int(label), by_tree.get(tree, {})):
                        part = group.iloc[members]
                        yield pd.DataFrame(
                            {"label": label, "size": size, "tree": tree, "node": node, "class_id": part["class_id"], "vector": part["vector"]}
                        )

    leaves = groups.join(upper, ["label", "size"], "left").mapInPandas(
        deal, "label long, size long, tree int, node long, class_id long, vector binary"
    )
    pairs = leaves.groupBy("label", "size", "tree", "node").applyInPandas(_pairs(least, kind), "a long, b long")
    links = write_through(pairs.distinct(), "vector_links")
    copies = classes.select(F.col("class_id").alias("other"), F.col("copies").alias("n"))
    both = links.select(F.col("a").alias("class_id"), F.col("b").alias("other")).unionAll(
        links.select(F.col("b").alias("class_id"), F.col("a").alias("other"))
    )
    linked = write_through(both.join(copies, "other").groupBy("class_id").agg(F.sum("n").alias("n")), "link_counts")
    found = components(links)
    return (
        all_ids.join(member, "vec_id", "left")
        .join(linked, "class_id", "left")
        .join(found, F.col("class_id") == found.vertex, "left")
        .select(
            "vec_id",
            F.coalesce(F.col("copies") - 1 + F.coalesce("n", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "class_id", "vec_id").alias("component_id"),
            (F.col("vec_id") == F.coalesce("component", "class_id", "vec_id")).alias("kept"),
        )
    )
