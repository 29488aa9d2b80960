"""Byte-level BPE encoding and decoding by a segment tree over adjacent pair ranks.

A word is a row of symbols. Leaf ``i`` of its tree holds ``rank * size + i`` for the pair of
symbol ``i`` with its right neighbour, so the root is the leftmost pair of lowest rank. A merge
changes three leaves: the pair's own, the one to its left, and that of the symbol that went.
Each is updated along its path to the root. It ends when the root holds no rank.

Words of up to 64 symbols are merged many at a time, one numpy step per merge of the longest;
longer ones one by one, in ``n log n``. Results of short pieces are kept in a bounded cache.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emiscope.llm.tables import map_pieces, rows_of
from emiscope.llm.textbytes import batches

CACHE_ENTRIES = 250_000
CACHED_CHARS = 64
NONE = np.int64(1) << 62
#: Fixed by the vocabulary: contractions, letters, numbers, other marks, white space.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[str, int]:
    """The published byte-to-letter rule: visible Latin-1 bytes stand for themselves, others for U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class BytePairs:
    """A vocabulary file of byte-level BPE (the tokenizers library's JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, letters = spec["model"]["vocab"], _byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        texts = [b""] * size
        for token, i in vocab.items():
            texts[i] = bytes(letters[c] for c in token) if token not in self.special else token.encode()
        for token, i in self.special.items():
            texts[i] = token.encode()
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(texts), np.uint8)
        self.of_byte = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.of_byte[b] = vocab[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.pairs = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        table = sorted((a << 32 | b, rank, to) for (a, b), (rank, to) in self.pairs.items())
        self.keys, self.ranks, self.merged = (np.array(x, np.int64) for x in zip(*table))
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pieces: dict[str, bytes] = {}
        self.first: dict[str, bytes | None] = {}
        self.later: dict[str, bytes | None] = {}

    # merging

    def _look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (a >= 0) & (b >= 0)
        return np.where(hit, self.ranks[at], NONE), self.merged[at]

    def _merge_many(self, words: list[bytes], size: int) -> list[bytes]:
        """Ids of words of at most ``size`` bytes, a power of two, as little-endian 32-bit."""
        n = len(words)
        raw = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), np.uint8).reshape(n, size)
        length = np.array([len(w) for w in words])
        symbol = np.full((n, size + 2), -1, np.int64)  # one spare column at each end stands for "no neighbour"
        symbol[:, 1:-1] = np.where(np.arange(size) < length[:, None], self.of_byte[raw], -1)
        right = np.tile(np.arange(1, size + 3), (n, 1))
        left = np.tile(np.arange(-1, size + 1), (n, 1))
        tree = np.full((n, 2 * size), NONE)
        rank, _ = self._look_up(symbol[:, 1:-1].ravel(), symbol[:, 2:].ravel())
        rank = rank.reshape(n, size)
        tree[:, size:] = np.where(rank < NONE, rank * size + np.arange(size), NONE)
        for k in range(size.bit_length() - 2, -1, -1):
            level = tree[:, 2 << k : 4 << k]
            tree[:, 1 << k : 2 << k] = np.minimum(level[:, ::2], level[:, 1::2])

        def put(rows: np.ndarray, leaf: np.ndarray, value: np.ndarray | np.int64) -> None:
            node = leaf + size
            tree[rows, node] = value
            while size > 1 and node[0] > 1:
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        rows = np.flatnonzero(tree[:, 1] < NONE) if size > 1 else np.array([], int)
        while len(rows):
            at = tree[rows, 1] % size + 1
            gone = right[rows, at]
            _, to = self._look_up(symbol[rows, at], symbol[rows, gone])
            after, before = right[rows, gone], left[rows, at]
            symbol[rows, at], symbol[rows, gone] = to, -1
            right[rows, at], left[rows, np.minimum(after, size + 1)] = after, at
            follower = symbol[rows, np.minimum(after, size + 1)]
            rank, _ = self._look_up(to, follower)
            put(rows, gone - 1, NONE)
            put(rows, at - 1, np.where(rank < NONE, rank * size + at - 1, NONE))
            inner = before > 0
            if inner.any():
                r, b = rows[inner], before[inner]
                rank, _ = self._look_up(symbol[r, b], to[inner])
                put(r, b - 1, np.where(rank < NONE, rank * size + b - 1, NONE))
            rows = rows[tree[rows, 1] < NONE]
        kept = symbol[:, 1:-1] >= 0
        ids = symbol[:, 1:-1][kept].astype("<u4").tobytes()
        ends = np.cumsum(kept.sum(axis=1)).tolist()
        return [ids[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]

    def merge_one(self, word: bytes) -> bytes:
        """Ids of one word of any length."""
        n = len(word)
        size = 1 << max(1, (n - 1).bit_length())
        symbol = [int(self.of_byte[b]) for b in word]
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        none, pairs = int(NONE), self.pairs

        def leaf(i: int) -> int:
            j = right[i]
            found = pairs.get((symbol[i], symbol[j])) if j < n else None
            return found[0] * size + i if found else none

        tree = [none] * size + [leaf(i) for i in range(n)] + [none] * (size - n)
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(i: int, value: int) -> None:
            node = i + size
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    break
                tree[node] = least

        while tree[1] != none:
            at = tree[1] % size
            gone = right[at]
            symbol[at] = pairs[symbol[at], symbol[gone]][1]
            symbol[gone] = -1
            right[at] = right[gone]
            if right[at] < n:
                left[right[at]] = at
            put(gone, none)
            put(at, leaf(at))
            if left[at] >= 0:
                put(left[at], leaf(left[at]))
        return np.array([s for s in symbol if s >= 0], "<u4").tobytes()

    # texts

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces that are not kept yet; short ones are kept."""
        made: dict[str, bytes] = {}
        sized: dict[int, list[str]] = {}
        for piece in pieces:
            n = len(piece.encode())
            if n > CACHED_CHARS:
                made[piece] = self.merge_one(piece.encode())
            else:
                sized.setdefault(1 << max(1, (n - 1).bit_length()), []).append(piece)
        for size, group in sized.items():
            for k in range(0, len(group), 1 << 14):
                part = group[k : k + (1 << 14)]
                self.pieces.update(zip(part, self._merge_many([p.encode() for p in part], size)))
        return made

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        split = [PIECES.findall(t) for t in texts]
        known = self.pieces
        long = self._learn({p for s in split for p in set(s) if p not in known})
        if long:
            return [b"".join([known[p] if p in known else long[p] for p in s]) for s in split]
        return [b"".join(map(known.__getitem__, s)) for s in split]

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without special tokens.

        A piece never spans a single space followed by a mark, so texts are cut there and equal
        cuts are looked up. A cut that is empty or has white space at an end may depend on its
        neighbours: such a text (None in the cache) goes piece by piece.
        """
        if len(self.pieces) + len(self.later) + len(self.first) > CACHE_ENTRIES:
            self.pieces.clear()
            self.first.clear()
            self.later.clear()
        cuts = [t.split(" ") for t in texts]
        self._keep(self.first, {c[0] for c in cuts}.difference(self.first), "")
        later: set[str] = set()
        for c in cuts:
            later.update(c[1:])
        self._keep(self.later, later.difference(self.later), " ")
        out: list[bytes | None] = []
        for c in cuts:
            found = [self.first.get(c[0]), *map(self.later.get, c[1:])]
            out.append(None if None in found else b"".join(found))
        slow = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(slow, self._by_pieces([texts[k] for k in slow])):
            out[k] = ids
        return out

    def _keep(self, cache: dict[str, bytes | None], cuts: set[str], lead: str) -> None:
        fit = [c for c in cuts if len(c) <= CACHED_CHARS]
        apart = [c for c in fit if c and not c[0].isspace() and not c[-1].isspace()]
        cache.update(dict.fromkeys(fit))
        cache.update(zip(apart, self._by_pieces([lead + c for c in apart])))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        plain: list[str] = []
        plan: list[list[int | None]] = []
        for text in texts:
            parts = self.split_special.split(text) if self.split_special and any(s in text for s in self.special) else [text]
            plan.append([self.special.get(p) if k % 2 else None for k, p in enumerate(parts)])
            plain.extend(p for k, p in enumerate(parts) if k % 2 == 0)
        ids = iter(self._plain(plain))
        return [
            b"".join(next(ids) if special is None else special.to_bytes(4, "little") for special in row) for row in plan
        ]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        at = np.frombuffer(ids, "<u4")
        length = self.lengths[at]
        start = np.cumsum(length) - length
        index = np.repeat(self.offsets[at] - start, length) + np.arange(int(length.sum()))
        return self.flat[index].tobytes().decode("utf-8", "replace")


_loaded: dict[str, BytePairs] = {}


def vocabulary(path: str) -> BytePairs:
    """One vocabulary per worker process, read from the file at ``path`` on each machine."""
    if path not in _loaded:
        _loaded[path] = BytePairs(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``<id>, ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` text per row of ``docs``.

    Null text is empty: no ids, empty decoded text. Null and repeated ids are kept as they are; no
    row depends on another, so nothing is shuffled. Other columns are ignored.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = vocabulary(path)
        rows = ((i, t or "") for i, t in rows_of(frames, "key", "text"))
        for group in batches(rows, 1):
            ids = bpe.encode([t for _, t in group])
            yield pd.DataFrame({id_column: [i for i, _ in group], "ids": ids, "decoded": [bpe.decode(x) for x in ids]})

    source = docs.select(F.col(id_column).alias("key"), F.col(text_column).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return map_pieces(source, run, f"`{id_column}` {kind}, ids binary, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """Count and digests of what ``encode_documents`` returns."""
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
