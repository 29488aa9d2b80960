"""Packed id matrices by best-fit-decreasing, one row per window.

Each task takes its documents in blocks of a fixed number of ids. Documents longer than a
window are cut into whole windows and a rest, without loss. The segments of a block are placed
longest first into the fullest window that takes them. A segment tree over the capacities
0 to ``window`` counts the windows of each, so the least sufficient capacity is found in a
logarithmic number of steps.

A document is its ids and then ``END``; null text is empty; rows with equal or null ids are
documents of their own. Other columns are ignored. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emiscope.llm.packing import END, WINDOW
from emiscope.llm.tables import map_pieces, rows_of
from emiscope.llm.textbytes import batches
from emiscope.llm.token_ids import BLOCK_BYTES, token_ids
from emiscope.session import fresh_path

BLOCK_IDS = 1 << 21
PAD = 0


class Capacities:
    """Windows by free capacity; ``take(n)`` gives one with the least capacity of at least ``n``."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        self._add(capacity, 1)

    def _add(self, capacity: int, by: int) -> None:
        node = capacity + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Window and its capacity, or None."""
        node = least + self.size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.size
        self._add(capacity, -1)
        return self.windows[capacity].pop(), capacity


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[int]]:
    """Indices of segments per window, in the order they were placed."""
    free = Capacities(window)
    packed: list[list[int]] = []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        found = free.take(lengths[k])
        if found is None:
            packed.append([])
            found = len(packed) - 1, window
        at, capacity = found
        packed[at].append(k)
        if capacity > lengths[k]:
            free.put(capacity - lengths[k], at)
    return packed


def _block(segments: list[tuple], window: int, first: int) -> pd.DataFrame:
    rows = []
    for n, members in enumerate(best_fit_decreasing([len(s[2]) // 4 for s in segments], window)):
        sizes = [len(segments[k][2]) // 4 for k in members]
        ends = np.cumsum([0, *sizes])
        ids = b"".join(segments[k][2] for k in members) + PAD.to_bytes(4, "little") * (window - int(ends[-1]))
        positions = np.concatenate([*(np.arange(s) for s in sizes), np.zeros(window - int(ends[-1]), int)])
        rows.append(
            (first + n, [segments[k][0] for k in members], [segments[k][1] for k in members], ids, ends.tolist(), positions.astype("<u4").tobytes())
        )
    return pd.DataFrame(rows, columns=["sequence_id", "doc_ids", "starts", "ids", "cu_seqlens", "positions"])


def packed_matrices(docs: DataFrame, path: str, window: int = WINDOW, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per window: ``sequence_id, doc_ids, starts, ids, cu_seqlens, positions``.

    ``ids`` is one row of the id matrix, ``window`` little-endian unsigned 32-bit values;
    ``positions`` starts again at 0 with each segment and is 0 in the padding. ``cu_seqlens``
    runs from 0 to the number of ids before the padding.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, first = token_ids(path), TaskContext.get().partitionId() << 32
        end = END.to_bytes(4, "little")
        segments: list[tuple] = []
        held = 0
        rows = ((i, t or "") for i, t in rows_of(frames, "doc_id", "text"))
        for group in batches(rows, 1, BLOCK_BYTES):
            for (doc, _), ids in zip(group, tokens.encode([t for _, t in group])):
                ids += end
                for start in range(0, len(ids) // 4, window):
                    segments.append((None if pd.isna(doc) else int(doc), start, ids[4 * start : 4 * (start + window)]))
                held += len(ids) // 4
            if held >= block_ids:
                yield (made := _block(segments, window, first))
                first, segments, held = first + len(made), [], 0
        if segments:
            yield _block(segments, window, first)

    return map_pieces(
        docs.select(F.col("doc_id").cast("long"), "text"), run, "sequence_id long, doc_ids array<long>, starts array<long>, ids binary, cu_seqlens array<int>, positions binary"
    )


def write_matrices(matrices: DataFrame, path: str) -> None:
    """Parquet files of packed rows; each is whole, so a reader may take them in any order."""
    matrices.write.mode("errorifexists").parquet(path)


def written_matrices(docs: DataFrame, path: str) -> DataFrame:
    """The matrices of ``docs``, written to a new folder of the shared ones and read again."""
    made, target = packed_matrices(docs, path), fresh_path(docs.sparkSession, "matrices")
    write_matrices(made, target)
    return docs.sparkSession.read.schema(made.schema).parquet(target)


def segments(matrices: DataFrame) -> DataFrame:
    """One row per segment with its place, and digests of the row that holds it."""
    each = matrices.select(
        "sequence_id",
        F.posexplode("doc_ids").alias("k", "doc_id"),
        "starts",
        "cu_seqlens",
        F.crc32("ids").alias("row_crc32"),
        F.crc32("positions").alias("positions_crc32"),
        F.col("ids"),
    )
    begin, until = F.element_at("cu_seqlens", F.col("k") + 1), F.element_at("cu_seqlens", F.col("k") + 2)
    return each.select(
        "doc_id",
        F.element_at("starts", F.col("k") + 1).alias("start"),
        (until - begin).cast("long").alias("length"),
        F.crc32(F.expr("substring(ids, 4 * element_at(cu_seqlens, k + 1) + 1, 4 * (element_at(cu_seqlens, k + 2) - element_at(cu_seqlens, k + 1)))")).alias("ids_crc32"),
        "sequence_id",
        begin.cast("long").alias("offset"),
        "row_crc32",
        "positions_crc32",
    )
