"""Supervised subword embeddings that tell good documents from bad ones.

A document is the mean of learned vectors, one per hash bucket, of its words, of the pairs of
neighbouring words, and of the byte n-grams inside words (a word's edges count as a byte). A
softmax over two outputs reads that mean. Vectors and outputs are trained together by
stochastic gradient descent in numpy, on a bounded sample of labelled documents.

As mean and output are linear up to the softmax, scoring needs one number per bucket: a few
passes of numpy over the bytes of a text, and no state that grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emiscope.llm import textbytes
from emiscope.llm.tables import PIECE_ROWS, bounded_sample, fold_of, labelled, map_pieces, rows_of

BUCKET_BITS = 16
WIDTH = 8
GRAMS = (3, 4)
#: Bound of the training sample, for each of the two labels.
SAMPLE = 1500
EPOCHS = 12
RATE = 0.5
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
SAME = np.uint64(0x5BF03635)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _gram_buckets(data: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of byte n-grams, and which of them have white space only at their ends."""
    count = max(len(data) - n + 1, 0)
    white = textbytes.WHITE[data]
    # Any white space at an edge counts as one and the same byte.
    data = np.where(white, 32, data).astype(np.uint64)
    total = np.full(count, n, np.uint64)
    inner = np.zeros(count, bool)
    for k in range(n):
        total *= np.uint64(1_000_003)
        total += data[k : k + count]
        if 0 < k < n - 1:
            inner |= white[k : k + count]
    return _bucket(textbytes.mix(total)), ~inner


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Kinds of features of a batch, each as text numbers in order and buckets."""
    words = textbytes.words(texts)
    hashes = words.hashes()
    of_word = np.repeat(np.arange(len(texts)), np.diff(words.first))
    yield of_word, _bucket(hashes)
    pairs = textbytes.mix(hashes[:-1] * np.uint64(3) + hashes[1:])
    pairs[hashes[:-1] == hashes[1:]] = textbytes.mix(np.array([SAME]))[0]
    kept = of_word[:-1] == of_word[1:]
    yield of_word[:-1][kept], _bucket(pairs[kept])
    ends = textbytes.bounds(texts)[1:]
    for n in GRAMS:
        buckets, kept = _gram_buckets(words.data, n)
        at = np.flatnonzero(kept)
        yield np.searchsorted(ends, at + 1, side="right"), buckets[at]  # a gram's second byte is inside its word


@dataclass
class Model:
    weight: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for of_text, buckets in features(texts):
            total += np.bincount(of_text, self.weight[buckets], len(texts))
            count += np.bincount(of_text, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.bias, -60, 60)))


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for doc, text, label in rows_of(frames, "doc_id", "text", "label"):
        buckets, counts = np.unique(np.concatenate([b for _, b in features([(text or "").encode()])]), return_counts=True)
        yield pd.DataFrame(
            {
                "doc_id": [doc],
                "label": [label],
                "buckets": [buckets.astype(np.uint16).tobytes()],
                "counts": [counts.astype(np.float32).tobytes()],
            }
        )


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], prior: float, seed: int = 11) -> Model:
    """Model from (label, buckets, counts); ``prior`` is the share of label 1 among all labelled rows."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BUCKET_BITS, WIDTH)).astype(np.float32)
    outputs = np.zeros((2, WIDTH), np.float32)
    steps, step = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for k in random.permutation(len(rows)):
            label, buckets, counts = rows[k]
            if not len(buckets):
                continue
            rate = RATE * (1 - step / steps)
            step += 1
            share = counts / counts.sum()
            mean = share @ vectors[buckets]
            odds = outputs @ mean
            error = np.exp(odds - odds.max())
            error /= error.sum()
            error[label] -= 1
            back = error @ outputs
            outputs -= rate * np.outer(error, mean)
            # The mean divides by the number of features; steps in its direction of unit length undo that.
            vectors[buckets] -= (rate / np.linalg.norm(share)) * np.outer(share, back)
    weight = vectors @ (outputs[1] - outputs[0])
    ones = sum(label for label, _, _ in rows)
    sampled = (ones + 0.5) / (len(rows) + 1)
    shift = np.log(prior / (1 - prior)) - np.log(sampled / (1 - sampled))
    return Model(weight.astype(np.float64), float(shift))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from at most ``SAMPLE`` documents per label, none of the held-out fold.

    Without labelled documents every score is one half.
    """
    known = labelled(labels, "quality", FOLDS, HELD_OUT)
    share = known.agg(F.sum("label").alias("ones"), F.count("*").alias("all")).first()
    prior = ((share["ones"] or 0) + 0.5) / (share["all"] + 1)
    each = [bounded_sample(known.where(F.col("label") == y), "doc_id", SAMPLE) for y in (0, 1)]
    sample = F.broadcast(each[0].unionByName(each[1]))
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(sample, "doc_id")
    made = map_pieces(texts, _counts, "doc_id long, label int, buckets binary, counts binary").toPandas()
    made = made.sort_values(["doc_id", "buckets"])
    rows = [
        (int(label), np.frombuffer(b, np.uint16).astype(np.int64), np.frombuffer(c, np.float32))
        for label, b, c in zip(made["label"], made["buckets"], made["counts"])
    ]
    return train(rows, prior) if rows else Model(np.zeros(1 << BUCKET_BITS), 0.0)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    The score is the chance of label 1. Null and empty texts have no features; their score is the
    share of label 1. Rows do not depend on one another, so repeated rows give equal rows; a null
    id is in no fold. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((i, (t or "").encode()) for i, t in rows_of(frames, "doc_id", "text"))
        for group in textbytes.batches(rows, 1):
            scores = shared.value.scores([t for _, t in group])
            ids = [None if pd.isna(i) else int(i) for i, _ in group]
            yield pd.DataFrame(
                {
                    "doc_id": ids,
                    "held_out": [i is not None and fold_of(i, FOLDS) == HELD_OUT for i in ids],
                    "score": scores,
                    "predicted": (scores >= THRESHOLD).astype(np.int32),
                }
            ).astype({"doc_id": "Int64"})

    source = docs.select(F.col("doc_id").cast("long"), "text")
    return map_pieces(source, run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``THRESHOLD``, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE_ROWS):
                piece = batch.slice(at, PIECE_ROWS)
                texts = [(t or "").encode() for t in piece.column("text").to_pylist()]
                yield piece.filter(pa.array(shared.value.scores(texts) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
