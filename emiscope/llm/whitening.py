"""Whitening of integer grid vectors, each different one once.

Every component ``c`` becomes ``x = floor(64 * c) + 1000000``. Rows with the same vector ``x``
form one group; the fit list is the groups, each weighing one or as many as its rows. Sums per
dimension are exact. The covariance is gathered as centred products of blocks of vectors, its
entries summed by Spark; only that matrix comes to the driver, for its eigenvectors. Each
different vector is then whitened once and joined back to its rows.

Left out are rows whose vector is null or empty, or holds a component that is null, not finite or
too large for ``x`` to be exact in a double (beyond 2**53); and, where lengths differ, all but the
commonest length (of equally common ones the longer). A zero vector and a null id stay. A component without variance beyond rounding has a null
``whitened`` and takes no part in ``identity_error``. A ``deviation`` beyond a long is null. Rows
repeat as often as in the input. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emiscope.session import write_through

SCALE, SHIFT = 64.0, 1_000_000
LARGEST = float(1 << 53)
COMPONENTS = 16
#: Eigenvalues below this share of the largest are rounding.
LEAST_SHARE = 1e-12
BLOCK_ROWS = 4096
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _packed(x: np.ndarray) -> bytes:
    narrow = x.astype("<i4")
    return narrow.tobytes() if (narrow == x).all() else x.astype("<i8").tobytes()


def _unpacked(packed: list[bytes], dims: int) -> np.ndarray:
    """Rows of longs; a vector is packed in four bytes a component where all fit."""
    out = np.empty((len(packed), dims), np.int64)
    narrow = np.array([len(p) == 4 * dims for p in packed], bool)
    for wide, kind in ((narrow, "<i4"), (~narrow, "<i8")):
        at = np.flatnonzero(wide)
        if len(at):
            out[at] = np.frombuffer(b"".join(packed[k] for k in at), kind).reshape(len(at), dims)
    return out


def grid_rows(embeddings: DataFrame) -> DataFrame:
    """``vec_id, dims, x`` (packed) of the rows that take part."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            kept, dims, packed = [], [], []
            for k, values in enumerate(frame["embedding"]):
                if values is None or len(values) == 0:
                    continue
                # A null component arrives as NaN or None.
                vector = np.array([np.nan if v is None else v for v in values] if values.dtype == object else values, np.float64)
                if (np.abs(vector) <= (LARGEST - 2 * SHIFT) / SCALE).all():  # false for NaN
                    kept.append(k)
                    dims.append(len(vector))
                    packed.append(_packed(np.floor(SCALE * vector).astype(np.int64) + SHIFT))
            yield pd.DataFrame({"vec_id": frame["vec_id"].iloc[kept], "dims": dims, "x": packed})

    source = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return source.mapInPandas(run, "vec_id long, dims int, x binary")


@dataclass
class Whitening:
    dims: int
    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    vectors: np.ndarray  # dims x components
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``: the whole part of the mean in integers, the rest in doubles."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def solid(self) -> np.ndarray:
        """Which components have variance."""
        return self.eigenvalues > max(self.eigenvalues[0], 0.0) * LEAST_SHARE if len(self.eigenvalues) else np.zeros(0, bool)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        solid = self.solid()
        scale = np.sqrt(np.where(solid, self.eigenvalues, 1.0))
        return np.where(solid, self.centred(x) @ self.vectors / scale, np.nan)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of ``(n * x - S) ** 2``."""
        largest = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums)))
        if self.dims * (2 * largest) ** 2 < 1 << 63:
            return ((x * self.n - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        off = x.astype(object) * self.n - np.array(self.sums, object)
        return [int(v) if v < 1 << 63 else None for v in (off * off).sum(axis=1)]


def _blocks(frames: Iterator[pd.DataFrame], dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for frame in frames:
        for at in range(0, len(frame), BLOCK_ROWS):
            part = frame.iloc[at : at + BLOCK_ROWS]
            yield _unpacked(part["x"].tolist(), dims), part["weight"].to_numpy(np.int64)


def _sums(groups: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The fit list's weight and its exact sum per dimension."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [0] * dims
        for x, weight in _blocks(frames, dims):
            # Two halves of each long, so that no partial sum overflows: weights of a block stay below 2**31.
            low, high = weight @ (x & 0xFFFFFFFF) if weight.sum() < 1 << 31 else None, weight @ (x >> 32)
            if low is None:
                low, high = weight.astype(object) @ (x & 0xFFFFFFFF).astype(object), weight.astype(object) @ (x >> 32).astype(object)
            total = [t + int(a) + (int(b) << 32) for t, a, b in zip(total, low, high)]
        yield pd.DataFrame({"dim": range(dims), "total": [str(t) for t in total]})

    parts = groups.select("x", "weight").mapInPandas(run, "dim int, total string")
    sums = parts.groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("dim").collect()
    return groups.agg(F.sum("weight")).first()[0], [int(r["total"]) for r in sums]


def _summed_products(parts: DataFrame, dims: int) -> np.ndarray:
    """The symmetric matrix of ``i, j, value`` rows, summed over all of them; ``i <= j``."""
    product = np.zeros((dims, dims))
    for row in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toLocalIterator():
        product[row["i"], row["j"]] = product[row["j"], row["i"]] = row["value"]
    return product


def _triangle(product: np.ndarray) -> pd.DataFrame:
    i, j = np.triu_indices(len(product))
    return pd.DataFrame({"i": i.astype(np.int32), "j": j.astype(np.int32), "value": product[i, j]})


def groups_of(rows: DataFrame, weights: str = "one") -> DataFrame:
    """``x, weight``: each different vector once, weighing ``one`` or the ``counts`` of its rows."""
    if weights not in ("one", "counts"):
        raise ValueError("weights are 'one' or 'counts'")
    weight = F.count(F.lit(1)) if weights == "counts" else F.lit(1).cast("long")
    return write_through(rows.groupBy("x").agg(weight.alias("weight")), "vector_groups")


def fit(groups: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """Mean, covariance and its first eigenvectors of the weighted groups; there must be some."""
    n, sums = _sums(groups, dims)
    model = Whitening(dims, n, sums, np.zeros(0), np.zeros((dims, 0)), 0.0)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        product = np.zeros((dims, dims))
        for x, weight in _blocks(frames, dims):
            off = model.centred(x)
            product += (off * weight[:, None]).T @ off
        yield _triangle(product)

    parts = groups.select("x", "weight").mapInPandas(run, "i int, j int, value double")
    covariance = _summed_products(parts, dims) / n
    values, vectors = np.linalg.eigh(covariance)
    most = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[most], vectors[:, most]
    ahead = vectors[np.abs(vectors).argmax(axis=0), range(len(most))]
    return Whitening(dims, n, sums, values, vectors * np.where(ahead < 0, -1.0, 1.0), float(np.trace(covariance)))


def apply_to_groups(groups: DataFrame, model: Whitening) -> DataFrame:
    """``x, weight, deviation, whitened`` (NaN where a component has no variance) of each group."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), BLOCK_ROWS):
                part = frame.iloc[at : at + BLOCK_ROWS]
                x = _unpacked(part["x"].tolist(), model.dims)
                deviation = pd.array(model.deviations(x), dtype="Int64")
                yield pd.DataFrame({"x": part["x"].array, "weight": part["weight"].array, "deviation": deviation, "whitened": list(model.whitened(x))})

    source = groups.select("x", "weight")
    return write_through(source.mapInPandas(run, "x binary, weight long, deviation long, whitened array<double>"), "whitened_groups")


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """Largest entry, by size, of the covariance of the whitened fit list less the identity."""
    solid = np.flatnonzero(model.solid())
    if not len(solid):
        return 0.0

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        product = np.zeros((len(solid) + 1, len(solid) + 1))
        for frame in frames:
            if len(frame):
                y = np.column_stack([np.stack(frame["whitened"].to_list())[:, solid], np.ones(len(frame))])
                product += (y * frame["weight"].to_numpy()[:, None]).T @ y
        yield _triangle(product)

    parts = whitened.select("weight", "whitened").mapInPandas(run, "i int, j int, value double")
    product = _summed_products(parts, len(solid) + 1)
    mean = product[-1, :-1] / model.n
    return float(np.abs(product[:-1, :-1] / model.n - np.outer(mean, mean) - np.eye(len(solid))).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS, weights: str = "one") -> DataFrame:
    """One row per remaining row of ``embeddings`` and component, as ``SCHEMA`` has it.

    A vector that very many rows share makes one hot key in the last join; its rows are on the
    side that adaptive execution splits.
    """
    rows = write_through(grid_rows(embeddings), "grid_rows")
    lengths = rows.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths is None:
        return embeddings.sparkSession.createDataFrame([], SCHEMA)
    dims = lengths["dims"]
    rows = rows.where(F.col("dims") == dims)
    groups = groups_of(rows, weights)
    model = fit(groups, dims, components)
    whitened = apply_to_groups(groups, model)
    error = identity_error(whitened, model)
    trace = model.trace if model.trace > 0 else 1.0
    shares = F.array(*(F.lit(float(max(e, 0.0) / trace)) for e in model.eigenvalues))
    listed = rows.select("vec_id", "x").join(whitened.select("x", "deviation", "whitened"), "x").select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "value")
    )
    value: Column = F.when(~F.isnan("value"), F.col("value"))
    return listed.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        value.alias("whitened"),
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
