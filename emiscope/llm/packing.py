"""Bounded-space online packing of token ids into fixed windows.

Every task reads its documents in order and keeps a fixed number of windows open. A piece goes
to the open window that it leaves fullest. If it fits in none, the fullest window is filled
with the piece's first ids and emitted, and the rest goes on; documents longer than a window
give whole windows first. What is still open when a task ends is packed again by groups of
tasks, until one group is left; its last window alone is padded.

A document is its ids and then ``END``. Null text is empty. Rows with equal or null ids are
documents of their own. Other columns are ignored. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emiscope.llm.tables import PIECE_ROWS, map_pieces, rows_of
from emiscope.llm.textbytes import batches
from emiscope.llm.token_ids import BLOCK_BYTES, token_ids
from emiscope.session import write_through

WINDOW = 2048
OPEN_WINDOWS = 16
FAN_IN = 64
END = 1
COLUMNS = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "place"]
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, place long"


class OpenWindows:
    """The open windows of one task and the pieces of emitted ones."""

    def __init__(self, first_sequence: int, window: int, most: int):
        self.sequence, self.window, self.most = first_sequence, window, most
        self.open: list[tuple[int, list[tuple]]] = []
        self.done: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            length = len(ids) // 4
            self.done.append((doc, start, length, ids, total, self.sequence, offset, None))
            offset += length
        self.sequence += 1

    def add(self, doc: int | None, start: int, ids: bytes, total: int) -> None:
        while ids:
            size = len(ids) // 4
            if size >= self.window:
                self._emit([(doc, start, ids[: 4 * self.window], total)])
                start, ids = start + self.window, ids[4 * self.window :]
                continue
            fits = [(fill, k) for k, (fill, _) in enumerate(self.open) if fill + size <= self.window]
            if fits:
                fill, k = max(fits)
                pieces = self.open[k][1]
                pieces.append((doc, start, ids, total))
                self.open[k] = (fill + size, pieces)
                if fill + size == self.window:
                    self._emit(self.open.pop(k)[1])
                return
            if len(self.open) < self.most:
                self.open.append((size, [(doc, start, ids, total)]))
                return
            k = max(range(len(self.open)), key=lambda k: self.open[k][0])
            fill, pieces = self.open.pop(k)
            gap = self.window - fill
            self._emit([*pieces, (doc, start, ids[: 4 * gap], total)])
            start, ids = start + gap, ids[4 * gap :]

    def take(self) -> pd.DataFrame:
        rows, self.done = self.done, []
        return pd.DataFrame(rows, columns=COLUMNS)

    def left(self, place: int) -> pd.DataFrame:
        """Pieces of windows still open."""
        rows = [(d, s, len(i) // 4, i, n, None, None, place) for _, pieces in self.open for d, s, i, n in pieces]
        return pd.DataFrame(rows, columns=COLUMNS)


def _first_round(path: str, window: int, most: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, task = token_ids(path), TaskContext.get().partitionId()
        windows = OpenWindows(task << 32, window, most)
        rows = ((i, t or "") for i, t in rows_of(frames, "doc_id", "text"))
        end = END.to_bytes(4, "little")
        for group in batches(rows, 1, BLOCK_BYTES):
            for (doc, _), ids in zip(group, tokens.encode([t for _, t in group])):
                ids += end
                windows.add(None if pd.isna(doc) else int(doc), 0, ids, len(ids) // 4)
                if len(windows.done) >= PIECE_ROWS:
                    yield windows.take()
        yield windows.take()
        yield windows.left(task)

    return run


def _merge(step: int, window: int, most: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        windows = OpenWindows(step << 56 | int(key[0]) << 32, window, most)
        frame = frame.sort_values(["place", "doc_id", "start", "ids"])
        for doc, start, ids, total in zip(frame["doc_id"], frame["start"], frame["ids"], frame["doc_tokens"]):
            windows.add(None if pd.isna(doc) else int(doc), int(start), bytes(ids), int(total))
        if most == 1:
            for _, pieces in windows.open:
                windows._emit(pieces)
            windows.open = []
        return pd.concat([windows.take(), windows.left(int(key[0]))])

    return run


def pack_documents(docs: DataFrame, path: str, window: int = WINDOW, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit. ``sequence_id`` is unique, not dense.
    """
    source = docs.select(F.col("doc_id").cast("long"), "text")
    pieces = write_through(map_pieces(source, _first_round(path, window, open_windows), SCHEMA), "pieces")
    done = [pieces.where("sequence_id is not null")]
    left = pieces.where("sequence_id is null")
    step = 1
    while True:
        groups = left.select(F.floor(F.col("place") / FAN_IN).alias("g")).distinct().limit(2).count()
        if groups == 0:
            break
        # The last group keeps a single window open, so that no other is padded.
        merged = left.groupBy(F.floor(F.col("place") / FAN_IN).alias("g")).applyInPandas(
            _merge(step, window, open_windows if groups > 1 else 1), SCHEMA
        )
        merged = write_through(merged, "merged_pieces")
        done.append(merged.where("sequence_id is not null"))
        if groups == 1:
            break
        left, step = merged.where("sequence_id is null"), step + 1
    packed = done[0]
    for more in done[1:]:
        packed = packed.unionByName(more)
    return packed.drop("place")


def digests(packed: DataFrame) -> DataFrame:
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
