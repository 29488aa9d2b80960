"""Similarity self-join of documents on word shingles, by prefix filtering.

A document's set holds its distinct shingles of five words (lower-cased A-Z, split on ASCII
white space); with one to four words, the whole sequence is its only shingle. Two documents
link when ``100 * |intersection| >= percent * |union|``.

1. A pass over the texts counts shingles in a fixed table of counters. Its counts order the
   shingles of every set, rare ones first; any order gives the same links, a rare-first order
   gives few candidates.
2. Sets with the required overlap share one of their first ``n - ceil(percent n / 100) + 1``
   shingles. Each is one posting; postings of a shingle met once are left out.
3. Equal sets are one class from the start, known by a digest. In each shingle's postings a
   class first pairs only with the smallest class of similar size. That is linear in the
   postings, and joins most of a large group of near copies.
4. Classes that share a shingle and are still in different components then pair in full.
   Length and positional filters are part of that join, so no link can be missed.
5. The suffix filter bounds the overlap by counts of the sets' shingles in 64 hash ranges.
   What passes is verified on the whole sets, once per pair.

All this goes by a number of each row. ``link_documents`` leaves null ids out, since
nothing can name their rows; an id has one row, links by any of its texts, and is as large as
its largest set. ``keep_one`` takes every row for a document of its own. Null and empty texts
have no shingles and no links. Other columns are ignored. Shingles are compared by 64-bit hashes.

A shingle that many classes share without any link between them meets them pair by pair in step
4, as far as the filters let it; adaptive execution splits such a shingle's rows over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emiscope.llm import textbytes
from emiscope.llm.components import components
from emiscope.llm.tables import by_row, free_name, map_pieces, rows_of
from emiscope.session import write_through

WIDTH = 5
PERCENT = 80
COUNTER_BITS = 22
BLOCK_BITS = 12
HISTOGRAM = 64
FULL = 65535
#: Counters of so many tasks are added up by one task of the next round.
FAN_IN = 64
MOST_COUNT = (1 << 32) - 1
COUNTS = "block int, task long, at binary, counts binary"
_MULTIPLIERS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 1], np.uint64)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each lower-cased text."""
    found = textbytes.words(texts)
    hashes, first = found.hashes(), found.first
    count = len(hashes) - WIDTH + 1
    rolled = np.zeros(max(count, 0), np.uint64)
    for k in range(WIDTH):
        rolled += hashes[k : k + len(rolled)] * _MULTIPLIERS[k]
    rolled = textbytes.mix(rolled)
    sets = []
    for d in range(len(texts)):
        start, n = first[d], first[d + 1] - first[d]
        if n >= WIDTH:
            sets.append(np.unique(rolled[start : start + n - WIDTH + 1]))
        else:
            words = hashes[start : start + n].tobytes()
            sets.append(np.array([xxhash.xxh64_intdigest(words, seed=int(n))] if n else [], np.uint64))
    return sets


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    rows = ((i, (t or "").encode().lower()) for i, t in rows_of(frames, "row", "text"))
    for group in textbytes.batches(rows, 1):
        yield [i for i, _ in group], shingle_sets([t for _, t in group])


def _ranges(shingles: np.ndarray) -> np.ndarray:
    """The suffix filter's counts: how many shingles fall in each of 64 hash ranges."""
    counts = np.bincount((shingles >> np.uint64(58)).astype(np.int64), minlength=HISTOGRAM)
    return np.minimum(counts, FULL).astype(np.uint16)


def _packed(counts: np.ndarray) -> tuple[bytes | None, bytes]:
    """A block's counters: those above zero with their places, or all of them if that is shorter."""
    at = np.flatnonzero(counts)
    if 6 * len(at) < 4 * len(counts):
        return at.astype(np.uint16).tobytes(), counts[at].astype(np.uint32).tobytes()
    return None, counts.astype(np.uint32).tobytes()


def _total(frame: pd.DataFrame) -> np.ndarray:
    total = np.zeros(1 << BLOCK_BITS, np.uint64)
    for at, counts in zip(frame["at"], frame["counts"]):
        total[slice(None) if at is None else np.frombuffer(at, np.uint16)] += np.frombuffer(counts, np.uint32)
    return np.minimum(total, MOST_COUNT)


def _summaries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Size and digest of each set, then this task's counters in blocks."""
    counters = np.zeros(1 << COUNTER_BITS, np.uint32)
    empty = {c: None for c in ("row", "n", "digest", "ranges", "block", "task", "at", "counts")}
    for rows, sets in _sets(frames):
        for s in sets:
            counters[(s >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)] += 1
        yield pd.DataFrame(
            empty
            | {
                "row": rows,
                "n": [len(s) for s in sets],
                "digest": [xxhash.xxh128_digest(s.tobytes()) for s in sets],
                "ranges": [_ranges(s).tobytes() for s in sets],
            }
        )
    blocks = counters.reshape(-1, 1 << BLOCK_BITS)
    used = np.flatnonzero(blocks.any(axis=1))
    task = TaskContext.get().partitionId()
    for some in np.array_split(used, 1 + len(used) // 64):
        at, counts = zip(*(_packed(blocks[b]) for b in some)) if len(some) else ((), ())
        yield pd.DataFrame(empty | {"block": some, "task": np.full(len(some), task), "at": at, "counts": counts})


def _added(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    at, counts = _packed(_total(frame))
    return pd.DataFrame({"block": [key[0]], "task": [key[1]], "at": [at], "counts": [counts]})


def _level(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    levels = np.minimum(np.log2(_total(frame) + 1.0) * 6, 255).astype(np.uint8)
    return pd.DataFrame({"block": [key[0]], "levels": [levels.tobytes()]})


def _levels(blocks: DataFrame) -> np.ndarray:
    """Logarithmic counts, one byte per counter: a fixed 4 MB whatever the number of documents.

    The tasks' counters are added in rounds of ``FAN_IN``, so no group holds more than that many blocks.
    """
    tasks = (blocks.agg(F.max("task")).first()[0] or 0) + 1
    while tasks > FAN_IN:
        groups = blocks.groupBy("block", F.floor(F.col("task") / FAN_IN).alias("task"))
        blocks = write_through(groups.applyInPandas(_added, COUNTS), "added_counts")
        tasks = -(-tasks // FAN_IN)
    levels = np.zeros((1 << (COUNTER_BITS - BLOCK_BITS), 1 << BLOCK_BITS), np.uint8)
    for row in blocks.groupBy("block").applyInPandas(_level, "block int, levels binary").toLocalIterator():
        levels[row["block"]] = np.frombuffer(row["levels"], np.uint8)
    return levels.reshape(-1)


def _postings(levels, percent: int):
    def emit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = levels.value
        for rows, sets in _sets(frames):
            parts = []
            for row, s in zip(rows, sets):
                n = len(s)
                if n:
                    level = table[(s >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
                    front = s[np.argsort(level, kind="stable")[: n + percent * n // -100 + 1]]
                    parts.append((np.full(len(front), row), front.view(np.int64), np.full(len(front), n), np.arange(len(front))))
            if parts:
                row, h, n, at = (np.concatenate(x) for x in zip(*parts))
                yield pd.DataFrame({"h": h, "row": row, "n": n, "at": at})

    return emit


def _full_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows, sets in _sets(frames):
        yield pd.DataFrame({"row": rows, "set": [s.tobytes() for s in sets]})


def _similar(percent: int):
    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = []
            for x, y in zip(frame["set_a"], frame["set_b"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield frame.loc[keep, ["a", "b"]]

    return verify


def _may_overlap(percent: int):
    def prune(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x = np.frombuffer(b"".join(frame["ranges_a"]), np.uint16).reshape(-1, HISTOGRAM)
                y = np.frombuffer(b"".join(frame["ranges_b"]), np.uint16).reshape(-1, HISTOGRAM)
                common = np.minimum(x, y).sum(axis=1, dtype=np.int64)
                both = x.sum(axis=1, dtype=np.int64) + y.sum(axis=1, dtype=np.int64)
                full = (np.maximum(x, y) == FULL).any(axis=1)
                yield frame.loc[full | (100 * common >= percent * (both - common)), ["a", "b"]]

    return prune


def _joined(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
    for side in "ab":
        pairs = pairs.join(values.select(F.col("row").alias(side), F.col(column).alias(f"{column}_{side}")), side)
    return pairs


def _verified(pairs: DataFrame, docs: DataFrame, member: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that link. Texts are read again, for documents in pairs only."""
    pairs = write_through(pairs.distinct(), "candidates")
    pairs = map_pieces(_joined(pairs, member, "ranges"), _may_overlap(percent), "a long, b long")
    pairs = write_through(pairs, "likely_pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    sets = map_pieces(docs.join(ids, "row", "left_semi"), _full_sets, "row long, set binary")
    sets = write_through(sets, "shingle_sets")
    return write_through(map_pieces(_joined(pairs, sets, "set"), _similar(percent), "a long, b long"), "links")


def _within(n_a: Column, n_b: Column, percent: int) -> Column:
    return (n_a * 100 >= n_b * percent) & (n_b * 100 >= n_a * percent)


def link_rows(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``row, n, part`` per row of ``docs`` (``row, text``); the part is the smallest row reachable by links.

    ``row`` must be unique and ``docs`` the same at each of several reads.
    """
    spark = docs.sparkSession
    made = write_through(
        map_pieces(docs, _summaries, f"row long, n long, digest binary, ranges binary, {COUNTS}"), "shingle_counts"
    )
    sized = made.where("block is null").select("row", "n", "digest", "ranges")
    classes = write_through(sized.where("n > 0").groupBy("digest").agg(F.min("row").alias("class_id")), "class_ids")
    member = write_through(
        sized.join(classes, "digest", "left").select("row", "n", "ranges", F.coalesce("class_id", "row").alias("class_id")),
        "classes",
    )
    levels = spark.sparkContext.broadcast(_levels(made.where("block is not null").select("block", "task", "at", "counts")))
    postings = map_pieces(docs, _postings(levels, percent), "h long, row long, n int, at int")

    met = write_through(postings.groupBy("h").count().where("count > 1").select("h"), "met_again")
    shared = write_through(postings.join(met, "h", "left_semi"), "postings")
    levels.destroy()
    heads = member.where("row = class_id").select("row")
    shared = write_through(shared.join(heads, "row", "left_semi"), "class_postings")

    # A band holds sizes within a quarter of one another, so its smallest class is a fair partner.
    banded = shared.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))))
    pivots = write_through(banded.groupBy("h", "band").agg(F.min("row").alias("a"), F.count("*").alias("k")).where("k > 1"), "pivots")
    stars = banded.join(pivots.select("h", "band", "a"), ["h", "band"]).where("a < row").select("a", F.col("row").alias("b"))
    first = _verified(stars, docs, member, percent)

    found = components(first)
    placed = write_through(
        shared.join(found, shared.row == found.vertex, "left").select(
            "h", "row", "n", "at", F.coalesce("component", "row").alias("part")
        ),
        "placed_postings",
    )
    # ``reach`` is the most shingles that any set of the part has from this one on.
    parts = placed.groupBy("h", "part").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max(F.col("n") - F.col("at")).alias("reach")
    )
    mixed = placed.groupBy("h").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x < y").select("h")
    parts = write_through(parts.join(mixed, "h", "left_semi"), "parts")
    one, two = parts.alias("one"), parts.alias("two")
    facing = one.join(
        two,
        (F.col("one.h") == F.col("two.h"))
        & (F.col("one.part") < F.col("two.part"))
        & (F.col("one.low") * percent <= F.col("two.high") * 100)
        & (F.col("two.low") * percent <= F.col("one.high") * 100)
        & (
            F.least("one.reach", "two.reach") * (100 + percent)
            >= (F.col("one.low") + F.col("two.low")) * percent
        ),
    ).select(F.col("one.h").alias("h"), F.col("one.part").alias("part"), F.col("two.part").alias("other"))
    facing = write_through(facing, "facing_parts")
    left, right = placed.alias("l"), placed.alias("r")
    near = facing.join(left, ["h", "part"]).select(
        "h", "other", F.col("row").alias("a"), F.col("n").alias("n_a"), F.col("at").alias("at_a")
    )
    near = near.join(
        right,
        (near.h == F.col("r.h"))
        & (near.other == F.col("r.part"))
        & _within(F.col("n_a"), F.col("r.n"), percent)
        & (
            (F.least(F.col("n_a") - F.col("at_a"), F.col("r.n") - F.col("r.at")) * (100 + percent))
            >= (F.col("n_a") + F.col("r.n")) * percent
        ),
    ).select(F.least("a", "r.row").alias("a"), F.greatest("a", "r.row").alias("b"))
    second = _verified(near, docs, member, percent)

    final = components(first.unionByName(second))
    return member.join(final, member.class_id == final.vertex, "left").select(
        "row", "n", F.coalesce("component", "class_id").alias("part")
    )


def link_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per document; the component is the smallest id reachable by links."""
    docs = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    docs = by_row(docs, "row")
    parts = docs.select("row", "doc_id").join(link_rows(docs.select("row", "text"), percent), "row")
    parts = write_through(parts.select("doc_id", "n", "part"), "row_parts")
    each = parts.groupBy("doc_id").agg(F.max("n").alias("n_shingles"), F.min("part").alias("part"), F.max("part").alias("last"))
    each = write_through(each, "document_parts")
    # Parts that share an id are one, as that document links with all of both.
    several = each.where("part < last").select("doc_id", F.col("part").alias("a"))
    if not several.isEmpty():
        same = components(parts.join(several, "doc_id").select("a", F.col("part").alias("b")))
        each = each.join(same, each.part == same.vertex, "left").select(
            "doc_id", "n_shingles", F.coalesce("component", "part").alias("part")
        )
    smallest = each.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    return each.join(smallest, "part").select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` but for all but one of each group of linked texts, all columns as they are.

    Every row is judged for itself. The one with the smallest ``doc_id`` stays, a row without
    an id only where none has one; of rows with equal ids any one. Texts without shingles stay.
    """
    row = free_name(docs, "row")
    rows = by_row(docs, row)
    found = link_rows(rows.select(F.col(row).alias("row"), "text"), percent).where("n > 0").select("row", "part")
    found = rows.select(F.col(row).alias("row"), F.col("doc_id").cast("long")).join(found, "row")
    found = write_through(found, "row_parts")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    stays = found.groupBy("part").agg(F.min(order)["row"].alias("row"))
    gone = write_through(found.select("row").join(stays, "row", "left_anti"), "near_duplicates")
    return rows.join(gone.withColumnRenamed("row", row), row, "left_anti").select(*docs.columns)
