"""Toxicity by the votes of the nearest labelled examples under exact TF-IDF cosine.

Terms are lower-cased words and their beginnings of four to six bytes, so that new endings of
a known stem still meet it. The examples are a bounded sample, as many toxic documents as
others. Their terms are the vocabulary, with document frequencies over all documents; terms of
more than a given share of the documents are stop terms. A weight is ``1 + log(count)`` times
``log((documents + 1) / (frequency + 1))``, and vectors have unit length. One of the ``VARIANTS``
also raises the weight of telling terms: toxic examples hold them so much more often than others
that, by a Chernoff bound, chance would give fewer than one such term among all.

The inverted index keeps, for each term, the largest weight in every block of examples. A query
scores the blocks of highest bound first, then those that could still hold a nearer example;
blocks below the last neighbour's cosine are never read. The neighbours vote with their cosine as
weight, and a logistic curve turns the toxic share of the votes into a chance.

The curve, the variant and the number of neighbours come from the examples themselves: each is
scored by the others, and the least log loss decides. An example counts as often as its label is
commoner in the labelled rows than among examples. No label outside the rows to learn from has a
part in it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emiscope.llm import textbytes
from emiscope.llm.ngram_join import shingle_sets
from emiscope.llm.tables import bounded_sample, fold_of, labelled, map_pieces, rows_of
from emiscope.session import write_through

#: Bounds of the sample: examples of either label, bytes of one text, bytes of all.
EXAMPLES = 1500
LONGEST_EXAMPLE = 1 << 20
EXAMPLE_BYTES = 1 << 25
#: Terms of more than such a share of all documents are stop terms, and telling terms weigh so many
#: times as much, where more than once never being stop terms. The examples decide which.
VARIANTS = ((0.05, 1.0), (0.1, 1.0), (0.2, 1.0), (0.05, 20.0))
LEAST_TOXIC = 3
#: Numbers of neighbours; the examples decide which.
NEIGHBOURS = (10, 25, 50, 100, 200)
BLOCK = 64
STEMS = (4, 5, 6)
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
EVIDENCE = 3
#: Votes are never more of one mind than this.
LEAST_SHARE = 0.005
CACHED_QUERIES = 50_000


def term_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and 64-bit hashes of all terms of a batch, one entry per occurrence."""
    words = textbytes.words([t.lower().encode() for t in texts], textbytes.MARKS)
    of_word = np.repeat(np.arange(len(texts)), np.diff(words.first))
    of_text, hashes = [of_word], [words.hashes()]
    for n in STEMS:
        longer = words.end - words.start > n
        start = words.start[longer]
        of_text.append(of_word[longer])
        hashes.append(textbytes.mix(words.spans(start, start + n) + np.uint64(n)))
    return np.concatenate(of_text), np.concatenate(hashes)


def _groups(frames: Iterator[pd.DataFrame], *more: str) -> Iterator[tuple[list[tuple], np.ndarray, np.ndarray]]:
    rows = ((t or "", i, *rest) for i, t, *rest in rows_of(frames, "doc_id", "text", *more))
    for group in textbytes.batches(rows, 0):
        yield group, *term_hashes([g[0] for g in group])


def _terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for _, _, hashes in _groups(frames):
        yield pd.DataFrame({"term": np.unique(hashes).view(np.int64)})


class Vocabulary:
    """Sorted term hashes with their weights; gives sparse vectors of texts."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray | None = None):
        self.terms = terms
        self.idf = np.ones(len(terms)) if idf is None else idf

    def counts(self, of_text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text numbers, term numbers and counts, by text and term."""
        if not len(self.terms):
            return (np.zeros(0, np.int64),) * 3
        different, inverse = np.unique(hashes, return_inverse=True)  # sorted ones are found faster
        at = np.minimum(np.searchsorted(self.terms, different), len(self.terms) - 1)
        at, hit = at[inverse], (self.terms[at] == different)[inverse]
        pairs, counts = np.unique(of_text[hit] * len(self.terms) + at[hit], return_counts=True)
        return pairs // len(self.terms), pairs % len(self.terms), counts

    def vectors(self, n: int, of_text: np.ndarray, hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Terms and unit-length TF-IDF weights of each of ``n`` texts; both empty without terms."""
        return self.weighted(n, *self.counts(of_text, hashes))

    def weighted(self, n: int, texts: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        weights = (1 + np.log(counts)) * self.idf[terms]
        norms = np.sqrt(np.bincount(texts, weights**2, n))
        weights = weights / norms[texts]
        cuts = np.searchsorted(texts, np.arange(n + 1))
        return [(terms[a:b], weights[a:b]) for a, b in zip(cuts, cuts[1:])]


def _spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the spans one after the other, and the length of each."""
    sizes = end - start
    return np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum()), sizes


class Index:
    """Inverted index with block maxima over example vectors; see ``nearest``."""

    def __init__(self, size: int, examples: list[tuple[np.ndarray, np.ndarray]], rank: np.ndarray | None = None):
        self.n, self.blocks = len(examples), -(-len(examples) // BLOCK)
        self.rank = np.arange(self.n) if rank is None else rank
        terms = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in examples)]).astype(np.int64)
        order = np.argsort(terms, kind="stable")
        self.cuts = np.append(0, np.cumsum(np.bincount(terms, minlength=size)))
        self.example = np.repeat(np.arange(self.n, dtype=np.int32), [len(t) for t, _ in examples])[order]
        self.weight = np.concatenate([np.zeros(0), *(w for _, w in examples)])[order]
        self._derive()

    def __getstate__(self) -> dict:
        """Entries alone: every executor keeps a copy on its disk."""
        return {name: getattr(self, name) for name in ("n", "blocks", "rank", "cuts", "example", "weight")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._derive()

    def _derive(self) -> None:
        held = np.diff(self.cuts)
        block = self.example // BLOCK
        change = np.ones(len(block), bool)
        np.not_equal(block[1:], block[:-1], out=change[1:])
        change[self.cuts[:-1][held > 0]] = True
        first = np.flatnonzero(change).astype(np.int32)
        self.block = block[first]
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0, np.float32)
        self.block_cuts = np.searchsorted(first, self.cuts.astype(np.int32))
        self.first = np.append(first, np.int32(len(block)))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The ``k`` examples of largest cosine (12 places) above 0, ties to the smaller rank, by default the number."""
        cosines, found = self.nearest_arrays(terms, weights, k)
        return list(zip(cosines.tolist(), found.tolist()))

    def nearest_arrays(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        entry, sizes = _spans(self.block_cuts[terms], self.block_cuts[terms + 1])
        weight, block = np.repeat(weights, sizes), self.block[entry]
        bound = np.bincount(block, weight * self.most[entry], self.blocks)

        def dots(blocks: np.ndarray) -> np.ndarray:
            visited = np.zeros(self.blocks, bool)
            visited[blocks] = True
            some = visited[block]
            of, by = entry[some], weight[some]
            span, sizes = _spans(self.first[of], self.first[of + 1])
            return np.bincount(self.example[span], self.weight[span] * np.repeat(by, sizes), self.n)

        order = np.argsort(-bound, kind="stable")[: np.count_nonzero(bound)]
        head = 2 * k // BLOCK + 1
        found = dots(order[:head])
        least = np.partition(found, -k)[-k] if self.n > k else 0.0
        # Rounding may make a sum of products exceed its bound by very little.
        rest = order[head:][bound[order[head:]] >= least - 1e-9]
        if len(rest):
            found += dots(rest)
        found = np.round(found, 12)
        met = np.flatnonzero(found > 0)
        if len(met) > k:
            met = met[found[met] >= np.partition(found[met], -k)[-k]]
        met = met[np.lexsort((self.rank[met], -found[met]))][:k]
        return found[met], met


@dataclass
class Model:
    """``ids`` and ``toxic`` by example number. ``slope`` and ``shift`` make the curve."""

    vocabulary: Vocabulary
    index: Index
    ids: np.ndarray
    toxic: np.ndarray
    share_without: float
    neighbours: int = NEIGHBOURS[-1]
    slope: float = 1.0
    shift: float = 0.0

    def odds(self, cosines: np.ndarray, at: np.ndarray) -> float:
        """Log odds of the votes."""
        share = np.clip(cosines @ self.toxic[at] / cosines.sum(), LEAST_SHARE, 1 - LEAST_SHARE)
        return float(np.log(share / (1 - share)))

    def judged(self, terms: np.ndarray, weights: np.ndarray, own: int) -> list[float] | None:
        """The votes of the other examples on the one with the id ``own``, for each of ``NEIGHBOURS``."""
        cosines, at = self.index.nearest_arrays(terms, weights, NEIGHBOURS[-1] + 1)
        others = self.ids[at] != own
        cosines, at = cosines[others], at[others]
        return [self.odds(cosines[:k], at[:k]) for k in NEIGHBOURS] if len(at) else None

    def score(self, terms: np.ndarray, weights: np.ndarray) -> tuple[float, list[int], list[float]]:
        cosines, at = self.index.nearest_arrays(terms, weights, self.neighbours)
        if not len(at):
            return self.share_without, [], []
        odds = self.odds(cosines, at)
        score = float(chance(self.slope * odds + self.shift))
        agree = self.toxic[at] == (score >= THRESHOLD)
        return score, self.ids[at[agree][:EVIDENCE]].tolist(), cosines[agree][:EVIDENCE].tolist()


def chance(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def curve(odds: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Slope and shift of the logistic curve by Newton steps, and its log loss.

    The slope is held near 1 as by one document, the shift near 0 as by a hundredth.
    """
    x = np.stack([odds, np.ones(len(odds))])
    at, middle, hold = np.array([1.0, 0.0]), np.array([1.0, 0.0]), np.array([1.0, 0.01])

    def loss(at: np.ndarray) -> float:
        z = at @ x
        return float(weight @ (np.logaddexp(0, z) - toxic * z) + hold @ (at - middle) ** 2 / 2)

    for _ in range(100):
        p = chance(at @ x)
        slope = x @ (weight * (p - toxic)) + hold * (at - middle)
        bend = (x * (weight * p * (1 - p))) @ x.T + np.diag(hold)
        step = np.linalg.solve(bend, slope)
        while loss(at - step) > loss(at) and np.abs(step).max() > 1e-12:
            step = step / 2
        at = at - step
        if np.abs(step).max() < 1e-9:
            break
    z = at @ x
    return float(at[0]), float(at[1]), float(weight @ (np.logaddexp(0, z) - toxic * z))


def _frequencies(vocabulary):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = vocabulary.value
        found, documents = np.zeros(len(terms.terms), np.int64), 0
        for group, of_text, hashes in _groups(frames):
            documents += len(group)
            found += np.bincount(terms.counts(of_text, hashes)[1], minlength=len(found))
        yield pd.DataFrame({"term": np.append(np.flatnonzero(found), -1), "n": np.append(found[found > 0], documents)})

    return run


def _examples(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """``doc_id, label, text``, one row per id; of several texts of an id the greatest counts."""
    sample = bounded_sample(marks.where("label = 1"), "doc_id", EXAMPLES)
    sample = sample.unionByName(bounded_sample(marks.where("label = 0"), "doc_id", EXAMPLES))
    known = texts.where(F.octet_length(F.coalesce("text", F.lit(""))) <= LONGEST_EXAMPLE).join(F.broadcast(sample), "doc_id")
    known = write_through(known.groupBy("doc_id", "label").agg(F.max(F.coalesce("text", F.lit(""))).alias("text")), "toxicity_texts")
    # One task, but for two numbers of at most 2 * EXAMPLES rows.
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    sizes = known.select("doc_id", F.sum(F.octet_length("text")).over(order).alias("bytes"))
    return known.join(F.broadcast(sizes.where(F.col("bytes") <= EXAMPLE_BYTES).select("doc_id")), "doc_id", "left_semi")


#: Terms and counts of an example, and the ends of its shingle hashes, which near copies mostly share.
HELD = "least long, most long, doc_id long, label int, terms binary, counts binary"


def _held(vocabulary):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group, of_text, hashes in _groups(frames, "label"):
            texts, terms, counts = vocabulary.value.counts(of_text, hashes)
            cuts = np.searchsorted(texts, np.arange(1, len(group)))
            sets = shingle_sets([g[0].lower().encode() for g in group])
            ends = np.array([(s[0], s[-1]) if len(s) else (0, 0) for s in sets], np.uint64).view(np.int64).reshape(-1, 2)
            yield pd.DataFrame(
                {
                    "least": ends[:, 0],
                    "most": ends[:, 1],
                    "doc_id": [g[1] for g in group],
                    "label": [g[2] for g in group],
                    "terms": [t.astype(np.int32).tobytes() for t in np.split(terms, cuts)],
                    "counts": [c.astype(np.int32).tobytes() for c in np.split(counts, cuts)],
                }
            )

    return run


def _odds(model):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group, of_text, hashes in _groups(frames, "label"):
            vectors = model.value.vocabulary.vectors(len(group), of_text, hashes)
            odds = [model.value.judged(*v, own=g[1]) for g, v in zip(group, vectors)]
            yield pd.DataFrame({"doc_id": [g[1] for g in group], "label": [g[2] for g in group], "odds": odds})

    return run


def telling_terms(rows: pd.DataFrame, size: int) -> np.ndarray:
    """Marks of the telling ones among ``size`` terms; near copies among the examples count once."""
    rows = rows.sort_values("doc_id").drop_duplicates("least").drop_duplicates("most")
    held, toxic = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for terms, label in zip(rows["terms"], rows["label"]):
        at = np.frombuffer(terms, np.int32)
        held[at] += 1
        toxic[at] += label
    share = np.clip(rows["label"].mean() if len(rows) else 0.5, 1e-6, 1 - 1e-6)
    tested = max(np.count_nonzero(held >= LEAST_TOXIC), 1)
    others = held - toxic
    # Chance gives this many toxic ones of ``held`` with a probability of at most exp(-evidence).
    evidence = toxic * np.log(np.maximum(toxic, 1) / (np.maximum(held, 1) * share))
    evidence += others * np.log(np.maximum(others, 1) / (np.maximum(held, 1) * (1 - share)))
    return (toxic >= LEAST_TOXIC) & (toxic > held * share) & (evidence >= np.log(tested))


def _model(every: Vocabulary, frequency: np.ndarray, documents: int, stop: float, extra: np.ndarray, rows: pd.DataFrame) -> Model:
    """Vocabulary without stop terms and index; examples with like common terms share blocks.

    ``extra`` multiplies the weights of terms; those above 1 are no stop terms.
    """
    kept = (frequency <= max(stop * documents, 1)) | (extra > 1)
    place = np.cumsum(kept) - 1
    idf = np.log((documents + 1) / (frequency[kept] + 1)) * extra[kept]
    vocabulary = Vocabulary(every.terms[kept], np.maximum(idf, 1e-9))
    first = np.where(extra[kept] > 1, 0, idf)
    held, keys = [], []
    for terms, counts in zip(rows["terms"], rows["counts"]):
        terms, counts = np.frombuffer(terms, np.int32), np.frombuffer(counts, np.int32)
        terms, counts = place[terms[kept[terms]]], counts[kept[terms]]
        held.append((terms, counts))
        keys.append(tuple(terms[np.argsort(first[terms], kind="stable")[:4]].tolist()))
    order = [k for k in sorted(range(len(held)), key=lambda k: (keys[k], k)) if len(held[k][0])]
    vectors = [vocabulary.weighted(1, np.zeros(len(held[k][0]), np.int64), *held[k])[0] for k in order]
    ids, toxic = rows["doc_id"].to_numpy(np.int64), rows["label"].to_numpy(float)
    return Model(vocabulary, Index(int(kept.sum()), vectors, ids[order]), ids[order], toxic[order], 0.0)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Document frequencies over all of ``docs``, the index of examples, and the curve.

    Without labelled documents all scores are 0. Documents without a term of any example get the
    share of toxic ones among examples without neighbours, to which one of the overall share is added.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    marks = write_through(labelled(labels, "toxic", FOLDS, HELD_OUT), "toxicity_labels")
    total = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    known = write_through(_examples(texts, marks), "toxicity_examples")
    found = map_pieces(known, _terms, "term long").distinct().toPandas()  # bounded like the sample
    every = Vocabulary(np.sort(found["term"].to_numpy(np.int64).view(np.uint64)))
    shared = spark.sparkContext.broadcast(every)
    counted = map_pieces(texts, _frequencies(shared), "term int, n long")
    counted = counted.groupBy("term").agg(F.sum("n").alias("n")).toPandas()  # one row per term of the vocabulary
    documents = int(counted.loc[counted["term"] < 0, "n"].sum())
    counted = counted[counted["term"] >= 0]
    frequency = np.zeros(len(every.terms), np.int64)
    frequency[counted["term"].to_numpy()] = counted["n"]
    rows = map_pieces(known, _held(shared), HELD).toPandas().sort_values("doc_id")
    shared.destroy()
    if not len(rows):
        return Model(Vocabulary(every.terms[:0]), Index(0, []), np.zeros(0, np.int64), np.zeros(0), 0.0)
    number = rows["label"].value_counts()
    best, least = None, np.inf
    telling = telling_terms(rows, len(every.terms))
    for stop, emphasis in VARIANTS:
        model = _model(every, frequency, documents, stop, np.where(telling, emphasis, 1.0), rows)
        shared = spark.sparkContext.broadcast(model)
        judged = map_pieces(known, _odds(shared), "doc_id long, label int, odds array<double>").toPandas().sort_values("doc_id")
        shared.destroy()
        toxic = judged["label"].to_numpy(float)
        weight = judged["label"].map({k: total[k] / number[k] for k in number.index}).to_numpy()
        weight *= len(weight) / weight.sum()
        overall = float(weight @ toxic / weight.sum())
        some = judged["odds"].notna().to_numpy()
        model.share_without = float((weight[~some] @ toxic[~some] + overall) / (weight[~some].sum() + 1))
        p = np.clip(model.share_without, 1e-9, 1 - 1e-9)
        rest = -weight[~some] @ (toxic[~some] * np.log(p) + (1 - toxic[~some]) * np.log(1 - p))
        for k, odds in zip(NEIGHBOURS, np.array(judged["odds"][some].tolist()).reshape(-1, len(NEIGHBOURS)).T):
            slope, shift, loss = curve(odds, toxic[some], weight[some])
            if loss + rest < least - 1e-9:
                best, least = replace(model, neighbours=k, slope=slope, shift=shift), loss + rest
    return best


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted, nearest, cosines`` per row of ``docs``.

    The score is the chance of being toxic; ``nearest`` are the ids of the first voters whose
    label is the predicted one. Null and empty texts hold no term. Repeated rows give equal rows; a null id is in no
    fold. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        votes: dict[bytes, tuple] = {}
        for group, of_text, hashes in _groups(frames):
            vectors = model.vocabulary.vectors(len(group), of_text, hashes)
            keys = [terms.tobytes() + weights.tobytes() for terms, weights in vectors]
            digests = [hashlib.blake2b(key, digest_size=16).digest() for key in keys]
            new = {d: v for d, v in zip(digests, vectors) if d not in votes}
            if len(votes) + len(new) > CACHED_QUERIES:
                votes, new = {}, dict(zip(digests, vectors))
            votes.update((d, model.score(*v)) for d, v in new.items())
            rows = []
            for (_, doc), digest in zip(group, digests):
                doc = None if pd.isna(doc) else int(doc)
                score, nearest, cosines = votes[digest]
                rows.append((doc, doc is not None and fold_of(doc, FOLDS) == HELD_OUT, score, int(score >= THRESHOLD), nearest, cosines))
            frame = pd.DataFrame(rows, columns=["doc_id", "held_out", "score", "predicted", "nearest", "cosines"])
            yield frame.astype({"doc_id": "Int64"})

    source = docs.select(F.col("doc_id").cast("long"), "text")
    return map_pieces(
        source, run, "doc_id long, held_out boolean, score double, predicted int, nearest array<long>, cosines array<double>"
    )
