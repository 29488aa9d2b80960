"""Spelling variants: each word points to a far commoner word one edit away.

Words are maximal runs of Latin letters, lower-cased in A-Z, with one letter deleted from the
occurrences that a hash of document and run picks. Two words are near if one insertion,
deletion or replacement of a code point makes one into the other. A word's form is its near
word with most occurrences, if it has ``DOMINANCE`` times as many; following forms leads to
its root.

Neighbourhoods are guided by Bloom filters. The vocabulary fills blocked filters, one for each
word length and cut into segments of bounded size, which are broadcast. Every word generates its
edits by updating its hash, without writing them out: all deletions, and the replacements by
a later letter (the other edits of a pair are found from its other word). Edits that a filter
knows are written out and shuffled to an exact join with the vocabulary, which drops what the
filters took for known by mistake. So the filters decide what moves, never the result.

A broadcast holds at most ``ROUND_BYTES``; a vocabulary with larger filters is probed in rounds.
A word has at most as many near words as there are edits of it over the alphabet seen, so no
group of near words grows with the corpus.

Null texts hold no words. A null id counts as the empty text in the hash. Rows with equal ids are
rows of their own. Other columns are ignored. No words give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emiscope.llm.textbytes import mix, powers
from emiscope.session import write_through

LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT = 7, 2
DELETED_OF = 31
DOMINANCE = 10
#: Words of this length and longer share one shard of the filters.
LONG = 64
#: A block is one cache line of eight lanes; a key sets one bit in each.
LANES, BITS_PER_KEY = 8, 16
SEGMENT_BLOCKS = 1024
SEGMENT_BYTES = SEGMENT_BLOCKS * LANES * 8
ROUND_BYTES = 64 << 20
#: Edits tested at once, and words handled together.
PROBES, WORDS = 1 << 18, 2048
#: Words that a task probes; their edits are some hundred times as many.
TASK_WORDS = 1 << 15


def occurrences(docs: DataFrame, least_length: int = LEAST_LENGTH, deleted_of: int = DELETED_OF) -> DataFrame:
    """``word``: one row per occurrence of a word of at least ``least_length`` letters."""
    # Shorter runs cannot give words that are long enough.
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    found = found.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    mark = found.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("mark"))
    at = F.pmod("mark", F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = mark.select(F.when(F.col("mark") % deleted_of == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= least_length)


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words with at least ``least_count`` occurrences, written."""
    counted = occurrences(docs, least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return write_through(counted.where(F.col("n") >= least_count), "vocabulary")


def _codes(words: list[bytes]) -> np.ndarray:
    """Letters of words of equal length; every letter is one byte of Latin-1."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def _terms(codes: np.ndarray) -> np.ndarray:
    """Each letter's share in the hash of its word."""
    power, _ = powers(codes.shape[1] + 1)
    return (codes.astype(np.uint64) + np.uint64(1)) * power[: codes.shape[1]]


def _by_length(frame: pd.DataFrame) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words of one length at a time, in bounded lots, with their places in the frame."""
    words = [w.encode("latin-1") for w in frame["word"]]
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        step = int(max(1, min(WORDS, PROBES // length)))
        for k in range(0, len(at), step):
            lot = at[k : k + step]
            yield [words[i] for i in lot], lot


@dataclass(frozen=True)
class Shard:
    """The filter of one word length: its size, and the segments at hand."""

    segments: int
    blocks: int  # of each segment

    @staticmethod
    def for_words(count: int) -> Shard:
        blocks = max(1, -(-count * BITS_PER_KEY // (LANES * 64)))
        segments = -(-blocks // SEGMENT_BLOCKS)
        return Shard(segments, -(-blocks // segments))

    def place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Segment and block of each hash."""
        mixed = mix(hashes)
        segment = (mixed >> np.uint64(32)) % np.uint64(self.segments)
        block = (mixed & np.uint64(0xFFFFFFFF)) % np.uint64(self.blocks)
        return segment.astype(np.int64), block.astype(np.int64)


_BIT_SALT = np.uint64(0xD6E8FEB86659FD93)


def _bits(hashes: np.ndarray) -> np.ndarray:
    """Six bits for each lane choose its bit."""
    return mix(hashes + _BIT_SALT)


def _lane_mask(bits: np.ndarray, lane: int) -> np.ndarray:
    return np.uint64(1) << ((bits >> np.uint64(6 * lane)) & np.uint64(63))


def _shard_of(length: int) -> int:
    return min(length, LONG)


def _segment_filters(shards: dict[int, Shard]):
    """One segment of a shard's filter from the hashes of its words."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        length, segment = int(key[0]), int(key[1])
        shard = shards[length]
        hashes = frame["hash"].to_numpy(np.int64).view(np.uint64)
        _, block = shard.place(hashes)
        bits = _bits(hashes)
        table = np.zeros(shard.blocks * LANES, np.uint64)
        for lane in range(LANES):
            np.bitwise_or.at(table, block * LANES + lane, _lane_mask(bits, lane))
        return pd.DataFrame({"shard": [length], "segment": [segment], "table": [table.tobytes()]})

    return run


def filter_segments(vocab: DataFrame, shards: dict[int, Shard]) -> DataFrame:
    """``shard, segment, table`` of all filters, written. Only hashes are shuffled."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for words, _ in _by_length(frame):
                hashes = _terms(_codes(words)).sum(axis=1, dtype=np.uint64)
                length = _shard_of(len(words[0]))
                segment, _ = shards[length].place(hashes)
                yield pd.DataFrame({"shard": np.full(len(words), length), "segment": segment, "hash": hashes.view(np.int64)})

    keyed = vocab.select("word").mapInPandas(run, "shard int, segment long, hash long")
    made = keyed.groupBy("shard", "segment").applyInPandas(_segment_filters(shards), "shard int, segment long, table binary")
    return write_through(made, "filter_segments")


@dataclass
class Filters:
    """The segments of one round. ``first[shard]``: its first segment here."""

    shards: dict[int, Shard]
    first: dict[int, int]
    tables: dict[int, np.ndarray]

    def known(self, length: int, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes that the filter of words of ``length`` takes for words."""
        key = _shard_of(length)
        if key not in self.tables:
            return np.zeros(0, np.int64)
        shard, table = self.shards[key], self.tables[key]
        segment, block = shard.place(hashes)
        cell = ((segment - self.first[key]) * shard.blocks + block) * LANES
        at = np.flatnonzero((cell >= 0) & (cell < len(table)))
        cell, bits = cell[at], _bits(hashes[at])
        for lane in range(LANES):
            hit = (table[cell + lane] & _lane_mask(bits, lane)) != 0
            at, cell, bits = at[hit], cell[hit], bits[hit]
        return at

    def deletions(self, words: list[bytes], codes: np.ndarray, terms: np.ndarray) -> Iterator[tuple[int, bytes]]:
        length = codes.shape[1]
        if length < 2 or _shard_of(length - 1) not in self.tables:
            return
        before = np.cumsum(terms, axis=1, dtype=np.uint64)
        total = before[:, -1:]
        # The letters after the deleted one move one place down.
        made = before - terms + (total - before) * powers(2)[1][1]
        again = np.zeros(codes.shape, bool)
        again[:, 1:] = codes[:, 1:] == codes[:, :-1]  # the same word as without the letter before
        row, place = np.nonzero(~again)
        for k in self.known(length - 1, made[row, place]):
            w, i = row[k], place[k]
            yield int(w), words[w][:i] + words[w][i + 1 :]

    def replacements(self, words: list[bytes], codes: np.ndarray, terms: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """Edits that put a later letter of the alphabet in one place."""
        length = codes.shape[1]
        if _shard_of(length) not in self.tables:
            return
        power, _ = powers(length + 1)
        total = terms.sum(axis=1, dtype=np.uint64)
        wide = int(max(1, PROBES // (len(words) * len(alphabet))))
        for start in range(0, length, wide):
            part = codes[:, start : start + wide]
            row, place, letter = np.nonzero(alphabet[None, None, :] > part[:, :, None])
            step = alphabet[letter].astype(np.uint64) - part[row, place].astype(np.uint64)
            for k in self.known(length, total[row] + step * power[start + place]):
                w, i = row[k], start + place[k]
                yield int(w), words[w][:i] + bytes([alphabet[letter[k]]]) + words[w][i + 1 :]


def _rounds(shards: dict[int, Shard], most_bytes: int) -> list[dict[int, tuple[int, int]]]:
    """For each round the range of segments of each shard that it holds."""
    rounds: list[dict[int, tuple[int, int]]] = [{}]
    room = most_bytes
    for length, shard in sorted(shards.items()):
        size = shard.blocks * LANES * 8
        at = 0
        while at < shard.segments:
            if room < size and rounds[-1]:
                rounds.append({})
                room = most_bytes
            step = min(shard.segments - at, max(1, room // size))
            rounds[-1][length] = (at, at + step)
            at, room = at + step, room - step * size
    return rounds


def _loaded(segments: DataFrame, shards: dict[int, Shard], held: dict[int, tuple[int, int]]) -> Filters:
    """One round's filters on the driver: at most ``ROUND_BYTES``. A segment without words is empty."""
    wanted = F.lit(False)
    for length, (low, high) in held.items():
        wanted = wanted | ((F.col("shard") == length) & (F.col("segment") >= low) & (F.col("segment") < high))
    tables = {k: np.zeros((high - low) * shards[k].blocks * LANES, np.uint64) for k, (low, high) in held.items()}
    for row in segments.where(wanted).toLocalIterator():
        size = shards[row["shard"]].blocks * LANES
        at = (row["segment"] - held[row["shard"]][0]) * size
        tables[row["shard"]][at : at + size] = np.frombuffer(row["table"], np.uint64)
    return Filters(shards, {k: low for k, (low, _) in held.items()}, tables)


def near_pairs(vocab: DataFrame, most_bytes: int = ROUND_BYTES) -> DataFrame:
    """``word, n, near, near_n``: each near pair of ``vocab`` (``word, n``, written) once, written."""
    spark = vocab.sparkSession
    length = F.least(F.char_length("word"), F.lit(LONG))
    counts = vocab.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("words")).collect()
    shards = {r["length"]: Shard.for_words(r["words"]) for r in counts}
    # At most 90 letters, each one byte of Latin-1.
    letters = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct().collect()
    alphabet = np.array(sorted({r["letter"].encode("latin-1")[0] for r in letters if r["letter"]}), np.uint8)
    segments = filter_segments(vocab, shards)
    tasks = max(1, -(-sum(r["words"] for r in counts) // TASK_WORDS))
    found = []
    for held in _rounds(shards, most_bytes) if shards else []:
        shared = spark.sparkContext.broadcast(_loaded(segments, shards, held))

        def run(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            filters = shared.value
            for frame in frames:
                counted = frame["n"].to_numpy()
                for words, lot in _by_length(frame):
                    codes = _codes(words)
                    terms = _terms(codes)
                    edits = [*filters.deletions(words, codes, terms), *filters.replacements(words, codes, terms, alphabet)]
                    if edits:
                        at = np.array([k for k, _ in edits])
                        yield pd.DataFrame(
                            {
                                "word": [words[k].decode("latin-1") for k in at],
                                "n": counted[lot[at]],
                                "edit": [e.decode("latin-1") for _, e in edits],
                            }
                        )

        edits = vocab.select("word", "n").repartition(tasks, "word").mapInPandas(run, "word string, n long, edit string")
        exact = edits.join(vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n")), F.col("edit") == F.col("near"))
        found.append(write_through(exact.select("word", "n", "near", "near_n"), "near_pairs"))
        shared.destroy()
    pairs = found[0] if found else spark.createDataFrame([], "word string, n long, near string, near_n long")
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form`` rows; every chain ends, as counts rise along it.

    Each round follows twice as many steps, and a chain has no more steps than counts of a
    long can rise ``DOMINANCE``-fold.
    """
    reached = write_through(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("word").alias("at"), F.col("root").alias("further"))
        joined = reached.join(ahead, reached.root == ahead["at"], "left")
        moved = write_through(
            joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots"
        )
        reached = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return reached


def group_variants(docs: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the vocabulary."""
    vocab = vocabulary(docs)
    pairs = near_pairs(vocab)
    both: Column = F.array(
        F.struct(F.col("word"), F.col("n"), F.col("near"), F.col("near_n")),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    # Of equally common near words the first in code-point order, which is the order of UTF-8 bytes.
    nearest = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near"))).alias("nearest")
    seen = pairs.select(F.inline(both)).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), nearest)
    far = -F.col("nearest.rank") >= dominance * F.col("n")
    seen = write_through(
        seen.select("word", "n_near", F.when(far, F.col("nearest.near")).alias("form"), F.when(far, -F.col("nearest.rank")).alias("form_n")), "neighbours"
    )
    ends = roots(seen.where("form is not null"))
    return (
        vocab.join(seen, "word", "left")
        .join(ends, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
    )
