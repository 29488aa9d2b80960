"""Token ids of whole texts with a vocabulary file of the tokenizers library, looked up by word.

The vocabulary used here drops white space, lowers case and splits a text into contractions,
runs of letters, single numbers and runs of other marks, each encoded for itself. Latin-1 text
is split so for a whole block at once, over its bytes; there nothing composes and case is one
letter to one. Other text, and the names of special tokens, go to the library in cuts at
spaces. Words met before are found in one Arrow dictionary per worker, which is bounded and
keeps those used most; new ones are encoded by the library's model.
"""

from __future__ import annotations

import sys
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from emiscope.llm.tables import held

#: Words a worker keeps between blocks, none of more bytes than ``KEPT_BYTES``.
KEPT_WORDS = 250_000
KEPT_BYTES = 64
#: Bytes of text split at once.
BLOCK_BYTES = 1 << 21
#: Cuts given to the library at once.
LIBRARY_CUTS = 4096

SPACE, LETTER, NUMBER, MARK = range(4)


def _kind(letter: str) -> int:
    if letter in "\t\n\v\f\r \x85\xa0":
        return SPACE
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(letter)[0], MARK)


LATIN = [chr(b) for b in range(256)]
KINDS = bytes(map(_kind, LATIN))
LOWER = "".join(LATIN).lower().encode("latin-1")
#: The published byte-to-letter rule: visible Latin-1 bytes stand for themselves, others for U+0100 on.
BYTE_LETTERS = np.arange(256, dtype="<u4")
_OTHERS = [b for b in range(256) if b not in (*range(33, 127), *range(161, 173), *range(174, 256))]
BYTE_LETTERS[_OTHERS] = np.arange(256, 256 + len(_OTHERS))
BYTE_LETTERS[ord("\n")] = ord("\n")  # stands between words, never in one
#: Before a cut for the library; no word of a block holds it.
APART = b" "


def split_words(data: bytes) -> tuple[pa.Array, np.ndarray]:
    """Words of lower-case Latin-1 text that has a space at its start and two at its end, and where each begins."""
    letters = np.frombuffer(data, np.uint8)
    kinds = np.frombuffer(data.translate(KINDS), np.uint8)
    edge = np.empty(len(kinds), bool)
    edge[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:])
    edge |= kinds == NUMBER
    quotes = np.flatnonzero(letters == ord("'"))
    quotes = quotes[edge[quotes]]
    first, second = letters[quotes + 1], letters[quotes + 2]
    size = np.isin(first, list(b"stmd")).astype(np.int64)
    for a, b in (b"re", b"ve", b"ll"):
        size[(first == a) & (second == b)] = 2
    quotes, size = quotes[size > 0], size[size > 0]
    edge[quotes + 1], edge[quotes + 1 + size] = False, True
    at = np.flatnonzero(edge)
    length = np.diff(at, append=len(kinds))
    inside = kinds[at] != SPACE
    ends = np.zeros(np.count_nonzero(inside) + 1, np.int32)
    np.cumsum(length[inside], out=ends[1:])
    kept = letters[kinds != SPACE]
    words = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(kept)])
    return words, at[inside]


class TokenIds:
    """Ids as little-endian unsigned 32-bit bytes, equal to ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str, kept_words: int = KEPT_WORDS, block_bytes: int = BLOCK_BYTES):
        assert sys.byteorder == "little" and array("I").itemsize == 4
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.most, self.block_bytes = kept_words, block_bytes
        self.words = pa.array([], pa.binary())
        self.ids = pa.array([], pa.large_binary())
        self.uses = np.zeros(0, np.int64)

    def _learn(self, words: pa.Array) -> pa.Array:
        """Ids of each word."""
        listed = words.to_pylist()
        cuts = {w: None for w in listed if w.startswith(APART)}
        plain = b"\n".join([w for w in listed if w not in cuts]).decode("latin-1")
        spelled = BYTE_LETTERS[np.frombuffer(plain.encode(), np.uint8)].tobytes().decode("utf-32-le").split("\n") if plain else []
        tokenize = self.model.tokenize
        made = iter([array("I", [t.id for t in tokenize(w)]).tobytes() for w in spelled])
        texts = [w[1:].decode() for w in cuts]
        encoded = []
        for k in range(0, len(texts), LIBRARY_CUTS):
            found = self.tokenizer.encode_batch_fast(texts[k : k + LIBRARY_CUTS], add_special_tokens=False)
            encoded += [array("I", e.ids).tobytes() for e in found]
        cuts = dict(zip(cuts, encoded))
        return pa.array([cuts[w] if w in cuts else next(made) for w in listed], pa.large_binary())

    def _look_up(self, words: pa.Array) -> pa.Array:
        """Ids of each of ``words``, the new ones of which are kept."""
        known = len(self.words)
        coded = pa.chunked_array([self.words, words]).dictionary_encode().chunks[-1]
        codes, every = coded.indices, coded.dictionary
        ids = pa.concat_arrays([self.ids, self._learn(every.slice(known))])
        uses = np.bincount(codes.to_numpy(), minlength=len(every))
        uses[:known] += self.uses
        found = ids.take(codes)
        fit = np.flatnonzero(pc.binary_length(every).to_numpy() <= KEPT_BYTES)
        if len(fit) > self.most:
            order = np.argsort(-uses[fit], kind="stable")
            fit = np.sort(fit[order[: self.most // 2]])
            uses >>= 1
        if len(fit) < len(every):
            every, ids, uses = every.take(pa.array(fit)), ids.take(pa.array(fit)), uses[fit]
        self.words, self.ids, self.uses = every, ids, uses
        return found

    def _block(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces of Latin-1 text."""
        starts = np.cumsum([1, *(len(p) + 1 for p in pieces)])
        words, at = split_words(b" ".join([b"", *pieces, b" "]).translate(LOWER))
        if not len(words):
            return [b""] * len(pieces)
        return _joined(self._look_up(words), np.searchsorted(at, starts))

    def _apart(self, cut: str) -> bool:
        """Whether a cut is for the library."""
        try:
            cut.encode("latin-1")
        except UnicodeEncodeError:
            return True
        return any(s in cut for s in self.special)

    def _pieces(self, text: str) -> Iterator[bytes]:
        """The text cut at white space: Latin-1, or after ``APART`` a cut for the library in UTF-8."""
        if self._apart(text):
            for apart, cuts in groupby(text.replace("\n", " ").split(" "), self._apart):
                if apart:
                    yield from (APART + cut.encode() for cut in cuts)
                else:
                    yield from self._cut(" ".join(cuts).encode("latin-1"))
        else:
            yield from self._cut(text.encode("latin-1"))

    def _cut(self, plain: bytes) -> Iterator[bytes]:
        """Pieces of at most ``block_bytes``, unless a word is longer; none begins with a space."""
        begin = 0
        while len(plain) - begin > self.block_bytes:
            end = plain.rfind(b" ", begin, begin + self.block_bytes)
            end = end if end >= 0 else plain.find(b" ", begin + self.block_bytes)
            if end < 0:
                break
            yield plain[begin:end].lstrip(b" ")
            begin = end + 1
        yield plain[begin:].lstrip(b" ")

    def _some(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each of ``pieces``."""
        cuts = [p for p in pieces if p.startswith(APART)]
        plain = iter(self._block([p for p in pieces if not p.startswith(APART)]))
        if not cuts:
            return list(plain)
        apart = iter(self._look_up(pa.array(cuts, pa.binary())).to_pylist())
        return [next(apart) if p.startswith(APART) else next(plain) for p in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        made: list[list[bytes]] = [[] for _ in texts]
        group: list[bytes] = []
        owners: list[int] = []
        size = 0

        def put() -> None:
            for k, ids in zip(owners, self._some(group)):
                made[k].append(ids)

        for k, text in enumerate(texts):
            for piece in self._pieces(text):
                if group and size + len(piece) > self.block_bytes:
                    put()
                    group, owners, size = [], [], 0
                group.append(piece)
                owners.append(k)
                size += len(piece) + 1
        put()
        return [b"".join(parts) for parts in made]


def _joined(ids: pa.Array, first: np.ndarray) -> list[bytes]:
    """Bytes of the entries ``first[k]`` to ``first[k + 1]`` of ``ids``, for each ``k``."""
    _, offsets, data = ids.buffers()
    ends = np.frombuffer(offsets, np.int64)[ids.offset : ids.offset + len(ids) + 1][first].tolist()
    data = memoryview(data) if data is not None else memoryview(b"")
    return [data[a:b].tobytes() for a, b in zip(ends, ends[1:])]


def token_ids(path: str) -> TokenIds:
    """One vocabulary per worker process, read from the file at ``path`` on each machine."""
    return held(("token_ids", path), lambda: TokenIds(path))
