"""Language identification by fusing evidence under Bayes' rule.

For each language the log posterior is the sum of

* the text's likelihood: byte trigrams of its lower-cased words, counted over all labelled
  documents, additively smoothed, divided by ``TEMPER`` as neighbouring trigrams overlap;
* the declared markup language: how often pages that read like the language declare it;
* the address suffix (the host's last label): how often pages of the language have it;
* the host prior: the share of the language on the host, smoothed towards its domain (the last
  two labels), and that towards the share among all rows. A row's own share is taken off its
  host first, so that it is no evidence for itself.

The last three come from grouped sums of the posteriors under the text alone. A missing
declaration or address adds nothing. Without a letter the language is ``und`` and its
probability that of the likeliest language by the other evidence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emiscope.llm import textbytes
from emiscope.llm.tables import map_pieces, rows_of
from emiscope.session import write_through

BUCKET_BITS = 15
BLOCKS = 64
SMOOTHING = 0.5
TEMPER = 4.0
MOST_LANGUAGES = 256
HOST_WEIGHT, DOMAIN_WEIGHT, EVIDENCE_WEIGHT = 8.0, 20.0, 2.0
UNKNOWN = "und"


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and buckets of the trigrams inside words, each word with a mark at both ends."""
    lowered = [t.lower().encode() for t in texts]
    data = np.frombuffer(b" ".join([b"", *lowered, b""]), np.uint8)
    marks = textbytes.MARKS[data]
    marks[(data >= 48) & (data <= 57)] = True
    letters = np.where(marks, 0, data).astype(np.uint64)
    count = max(len(data) - 2, 0)
    joined = letters[:count] << np.uint64(16) | letters[1 : count + 1] << np.uint64(8) | letters[2 : count + 2]
    at = np.flatnonzero(~marks[1 : count + 1])
    of_text = np.searchsorted(textbytes.bounds(lowered)[1:], at + 1, side="right")
    return of_text, (textbytes.mix(joined[at]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    log_likelihood: np.ndarray  # buckets x languages

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tempered log likelihood per text and language, and the number of trigrams."""
        of_text, buckets = _trigrams(texts)
        total = np.stack([np.bincount(of_text, w[buckets], len(texts)) for w in self.log_likelihood.T], axis=1)
        return total / TEMPER, np.bincount(of_text, minlength=len(texts))


def _trigram_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """This task's counts of each language, of the buckets that it met."""
    counts: dict[str, np.ndarray] = {}
    rows = ((t or "", lang) for t, lang in rows_of(frames, "text", "lang"))
    for group in textbytes.batches(rows, 0):
        langs = np.array([lang for _, lang in group])
        of_text, buckets = _trigrams([t for t, _ in group])
        for lang in np.unique(langs):
            table = counts.setdefault(str(lang), np.zeros(1 << BUCKET_BITS, np.int64))
            table += np.bincount(buckets[langs[of_text] == lang], minlength=len(table))
    for lang, table in counts.items():
        met = np.flatnonzero(table)
        yield pd.DataFrame({"lang": lang, "bucket": met, "n": table[met]})


def fit(docs: DataFrame, most: int = MOST_LANGUAGES) -> Model:
    """Trigram likelihoods from ``text`` and ``lang`` of all documents that have both.

    The ``most`` commonest values of ``lang`` are the languages (of equally common ones the first
    by name), as each takes 256 KB in the driver and every worker; junk values beyond are none.
    """
    known = docs.select("text", F.lower(F.trim("lang")).alias("lang")).where("text is not null and lang <> ''")
    rows = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most).collect()
    languages = sorted(row["lang"] for row in rows)
    if not languages:
        return Model([], np.zeros((1 << BUCKET_BITS, 0)))
    made = map_pieces(known.where(F.col("lang").isin(languages)), _trigram_counts, "lang string, bucket int, n long")
    counts = np.full((1 << BUCKET_BITS, len(languages)), SMOOTHING)
    place = {lang: k for k, lang in enumerate(languages)}
    # At most as many rows as there are buckets, for each language.
    summed = made.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    blocks = summed.groupBy("lang", (F.col("bucket") % BLOCKS).alias("block")).agg(
        F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("counts")
    )
    for row in blocks.toLocalIterator():
        counts[row["buckets"], place[row["lang"]]] += row["counts"]
    return Model(languages, np.log(counts / counts.sum(axis=0)))


def _softmax(values: np.ndarray) -> np.ndarray:
    raised = np.exp(values - values.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def _sum(values: Column | str) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def identify(rows: DataFrame, model: Model) -> DataFrame:
    """``key, lang, probability, text_lang`` per row of ``rows`` (``key, text, declared, host``).

    ``probability`` is the posterior of ``lang``; ``text_lang`` the likeliest by the text alone.
    Keys need not be unique. Without a language to choose from all rows are ``und`` with
    probability 0.
    """
    n = len(model.languages)
    if not n:
        return rows.select("key", F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("probability"), F.lit(UNKNOWN).alias("text_lang"))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        each = ((t or "", *rest) for t, *rest in rows_of(frames, "text", "key", "declared", "host"))
        for group in textbytes.batches(each, 0):
            likelihood, letters = shared.value.read([g[0] for g in group])
            yield pd.DataFrame(
                {
                    "key": [g[1] for g in group],
                    "declared": [g[2] for g in group],
                    "host": [g[3] for g in group],
                    "likelihood": list(likelihood),
                    "share": list(_softmax(likelihood)),
                    "letters": letters,
                }
            )

    kind = rows.schema["key"].dataType.simpleString()
    source = rows.select(
        "key", "text", F.lower(F.substring_index(F.trim("declared"), "-", 1)).alias("declared"), F.lower(F.trim("host")).alias("host")
    )
    schema = f"key {kind}, declared string, host string, likelihood array<double>, share array<double>, letters long"
    read_rows = map_pieces(source, read, schema).select(
        "key",
        F.when(F.col("declared") != "", F.col("declared")).alias("declared"),
        F.when(F.col("host") != "", F.col("host")).alias("host"),
        "likelihood",
        "share",
        "letters",
    )
    read_rows = write_through(
        read_rows.withColumn("domain", F.substring_index("host", ".", -2)).withColumn(
            "suffix", F.when(F.col("host").contains("."), F.substring_index("host", ".", -1))
        ),
        "read_rows",
    )
    shared.destroy()

    def shares(*by: str) -> DataFrame:
        """Sums of the text posteriors of each group, by language."""
        seen = read_rows.where(F.col("letters") > 0)
        for column in by:
            seen = seen.where(F.col(column).isNotNull())
        sums = F.array(*(F.sum(F.col("share")[k]) for k in range(n)))
        return seen.groupBy(*by).agg(sums.alias("sums")) if by else seen.agg(sums.alias("sums"))

    total = [x or 0.0 for x in (shares().first()["sums"] or [0.0] * n)]
    overall = [(x + 1.0) / (sum(total) + n) for x in total]
    everywhere = F.array(*map(F.lit, overall))

    # What all languages of a row share stands in an array beside theirs, not inside a lambda,
    # which would work it out once per language.
    def each(value: Column) -> Column:
        return F.array_repeat(value, n)

    def smoothed(sums: Column, parent: Column, weight: float) -> Column:
        over = F.zip_with(sums, parent, lambda s, p: s + weight * p)
        return F.zip_with(over, each(_sum(sums) + weight), lambda x, size: x / size)

    def given_language(column: str) -> DataFrame:
        """log P(value | language), smoothed towards the value's share in all rows."""
        sums = shares(column)
        size = _sum("sums") / F.lit(max(sum(total), 1e-9))
        over = F.zip_with("sums", each(size), lambda s, p: s + EVIDENCE_WEIGHT * p)
        per = F.zip_with(over, F.array(*map(F.lit, total)), lambda x, t: F.log(x / (t + EVIDENCE_WEIGHT)))
        return write_through(sums.select(column, per.alias(f"{column}_evidence")), f"{column}_evidence")

    domains = shares("domain").select("domain", smoothed(F.col("sums"), everywhere, DOMAIN_WEIGHT).alias("domain_prior"))
    hosts = write_through(shares("host").withColumnRenamed("sums", "host_sums"), "host_sums")
    joined = read_rows
    for table, on in ((given_language("declared"), "declared"), (given_language("suffix"), "suffix"), (write_through(domains, "domains"), "domain"), (hosts, "host")):
        joined = joined.join(table, on, "left")
    nothing = F.array(*[F.lit(0.0)] * n)
    lettered = F.col("letters") > 0
    own = F.when(lettered, F.col("share")).otherwise(nothing)
    others = F.when(F.col("host_sums").isNull(), nothing).otherwise(
        F.zip_with("host_sums", own, lambda s, x: F.greatest(s - x, F.lit(0.0)))
    )
    prior = smoothed(F.col("others"), F.coalesce("domain_prior", everywhere), HOST_WEIGHT)
    posterior = F.zip_with("likelihood", prior, lambda a, p: a + F.log(p))
    for part in ("declared_evidence", "suffix_evidence"):
        posterior = F.zip_with(posterior, F.coalesce(part, nothing), lambda a, b: a + b)
    names = F.array(*map(F.lit, model.languages))
    best = F.array_max("posterior")
    odds = F.zip_with("posterior", each(best), lambda x, m: F.exp(x - m))
    return (
        joined.withColumn("others", others)
        .withColumn("posterior", posterior)
        .select(
            "key",
            F.when(lettered, F.element_at(names, F.array_position("posterior", best).cast("int"))).otherwise(UNKNOWN).alias("lang"),
            (1.0 / _sum(odds)).alias("probability"),
            F.when(lettered, F.element_at(names, F.array_position("share", F.array_max("share")).cast("int"))).otherwise(UNKNOWN).alias("text_lang"),
        )
    )


def page_rows(pages: DataFrame) -> DataFrame:
    """``key, text, declared, host`` of web pages: text without markup, the root's language, the address's host."""
    plain = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return pages.select(
        F.col("page_id").alias("key"),
        F.regexp_replace(plain, r"<[^>]*>|&#?\w+;", " ").alias("text"),
        F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1).alias("declared"),
        F.regexp_extract("url", r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1).alias("host"),
    )


def document_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The same of documents, whose source stands for the host and whose ``lang`` is what they declare."""
    return docs.select(F.col(key).alias("key"), "text", F.col("lang").alias("declared"), F.col("source").alias("host"))
