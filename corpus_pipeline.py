"""From raw documents to packed token windows, one dealt operator per stage.

Every stage takes all that its predecessor kept and judges each row for itself, whether its id
is null or repeated. Extra columns are carried along up to packing. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emiscope.llm import language, ngram_join, packing, quality
from emiscope.llm.tables import by_row, free_name, table
from emiscope.session import write_through

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document goes when the fused evidence gives no language even this chance.
LEAST_PROBABILITY = 0.5
#: Whole texts are written in small row groups, as a task holds one in memory.
ROW_GROUPS = {"parquet.block.size": str(16 << 20)}


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a language that is likelier than not, go."""
    row = free_name(docs, "row")
    rows = by_row(docs, row)
    found = language.identify(language.document_rows(rows, row), language.fit(rows))
    rejected = found.where((F.col("lang") == language.UNKNOWN) | (F.col("probability") < LEAST_PROBABILITY))
    rejected = write_through(rejected.select(F.col("key").alias(row)), "rejected")
    return rows.join(rejected, row, "left_anti").select(*docs.columns)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for bad ones go."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by shingle similarity one document stays, the one with the smallest id.

    Documents without shingles link with nothing and stay. Ids that come last are null ones.
    """
    return ngram_join.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in windows of 2048, one row per piece."""
    return packing.digests(packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("quality", classify_quality),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]

#: The classifiers and the packing of token ids have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_through(stage(spark, docs, sf_dir), name, **ROW_GROUPS)
    return docs
