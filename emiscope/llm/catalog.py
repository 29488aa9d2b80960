"""Registered queries of the training-data operators, with their oracles where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emiscope.llm import (
    block_labeller, bpe, forest, graph_search, language, matrices, ngram_join, packing, quality, sharding, spelling, toxicity, whitening,
)
from emiscope.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return graph_search.search(embeddings, graph_search.build_index(embeddings), F.col("vec_id") % 20 == 0)


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.digests(packing.pack_documents(table(spark, sf_dir, "documents"), path))


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.fit(table(spark, sf_dir, "documents"))
    found = language.identify(language.page_rows(table(spark, sf_dir, "pages")), model)
    return found.withColumnRenamed("key", "page_id")


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digests(bpe.encode_documents(table(spark, sf_dir, "documents"), path))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op7_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return matrices.segments(matrices.written_matrices(table(spark, sf_dir, "documents"), path))


@query
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(table(spark, sf_dir, "documents"))


@query
def op9_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.link_vectors(table(spark, sf_dir, "embeddings"))


@query
def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = block_labeller.extract(pages, block_labeller.fit(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_blocks", "n_kept")


@query
def op11_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


ORACLES["op8_ngram_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS v, doc_id AS r FROM documents
  UNION
  SELECT reach.v, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT v, min(r) AS component_id FROM reach GROUP BY v) m ON m.v = d.doc_id
"""


def _sql_crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, folded over them; a byte's table entry is the sum of its bits' entries."""
    entry, bits = 0xEDB88320, {}
    for bit in reversed(range(8)):
        bits[bit] = entry
        entry = entry >> 1 ^ (0xEDB88320 if entry & 1 else 0)
    step = "acc >> 8"
    for bit, value in sorted(bits.items()):
        step = f"xor({step}, ((xor(acc, b) >> {bit}) & 1) * {value})"
    numbers = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {numbers}), lambda acc, b: {step}), 4294967295)"


def _sql_network(source: str) -> str:
    """The rounds of the Feistel network over ``p`` of ``source``, which has ``r, n, a, b`` too."""
    made = f"(SELECT r, n, a, b, p // b AS x, p % b AS y FROM {source})"
    for k, (k1, k2, k3) in enumerate(sharding.round_keys(sharding.SEED)):
        changed, other, side = ("x", "y", "a") if k % 2 == 0 else ("y", "x", "b")
        first = f"(SELECT *, ({other} % {sharding.PRIME} * {k1} + {k2}) % {sharding.PRIME} AS t FROM {made})"
        cubed = f"(SELECT *, t * t % {sharding.PRIME} * t % {sharding.PRIME} AS c FROM {first})"
        moved = f"({changed} + (c * {k3} + {other}) % {sharding.PRIME}) % {side} AS {changed}"
        made = f"(SELECT r, n, a, b, {moved}, {other} FROM {cubed})"
    return f"SELECT r, n, a, b, x * b + y AS p FROM {made}"


ORACLES["op11_feistel"] = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, (octet_length(encode(coalesce(text, ''))) + 16)::BIGINT AS size,
         {_sql_crc32("coalesce(text, '')")} AS text_crc32
  FROM documents),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS r FROM sized),
counted AS (SELECT count(*) AS n, ceil(sqrt(count(*)))::BIGINT AS a FROM sized),
whole AS (SELECT r, n, a, (n + a - 1) // a AS b, r AS p FROM numbered, counted),
walk AS (
  {_sql_network("whole")}
  UNION ALL
  {_sql_network("walk WHERE p >= n")})
SELECT doc_id, size, text_crc32, 'rows' AS law, (p % 40)::INTEGER AS shard, p // 40 AS slot, NULL::INTEGER AS grown_shard
FROM numbered JOIN walk USING (r) WHERE p < n
"""

ORACLES["op12_variants"] = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]{{7,}}')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
repeats AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS named, run, count(*) AS n FROM runs GROUP BY ALL),
marked AS (SELECT run, n, {_sql_crc32("named")} AS h FROM repeats),
cut AS (
  SELECT n, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM marked),
vocab AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
holes AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM vocab)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT h.word, v.word, v.n FROM holes h JOIN vocab v ON h.rest = v.word
  UNION SELECT v.word, h.word, h.n FROM holes h JOIN vocab v ON h.rest = v.word),
nearest AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place FROM near),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * v.n THEN near END AS form,
         CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n
  FROM vocab v LEFT JOIN nearest p ON p.word = v.word AND place = 1),
chain AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT chain.word, f.form FROM chain JOIN formed f ON f.word = chain.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed e ON e.word = c.root AND e.form IS NULL
"""
