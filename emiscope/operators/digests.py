"""Order-free digests of rows, to tell whether two tables hold the same rows.

A digest has the number of rows, the sum of their hashes, and the exclusive or of other hashes
of them. It does not depend on order or partitions, digests of parts merge into that of the
whole, and a row that is altered, swapped for another, or there twice instead of another changes
it. Hashes are 64 bits each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("records_count", "content_sum", "content_xor")
DIGEST_SCHEMA = "run_id STRING, partition_id STRING, records_count BIGINT, content_sum DECIMAL(38,0), content_xor BIGINT"


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    """A hash passes over NULL, so which columns are NULL is hashed as well."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *columns)


def content_digests(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``keys`` and the measures of each group's rows, over ``columns`` in the given order."""
    sums = F.sum(_row_hash(columns, 0).cast("decimal(20,0)")).cast("decimal(38,0)")
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records_count"), sums.alias("content_sum"), F.bit_xor(_row_hash(columns, 1)).alias("content_xor")
    )


def merged(digests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Digests of parts, such as batches, to those of the groups that ``keys`` name."""
    return digests.groupBy(*keys).agg(
        F.sum("records_count").alias("records_count"),
        F.sum("content_sum").cast("decimal(38,0)").alias("content_sum"),
        F.bit_xor("content_xor").alias("content_xor"),
    )


def reconcile_content(declared: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Declared against actual digests, from both sides.

    ``mismatch`` says that the rows differ, ``altered`` that they differ though they are as many.
    A side without a group has none of its rows.
    """
    theirs = actual.select(*keys, *[F.col(m).alias(f"_{m}") for m in MEASURES])
    both = declared.select(*keys, *MEASURES).join(theirs, list(keys), "full_outer")
    count = F.coalesce("_records_count", F.lit(0).cast("bigint"))
    same_count = F.coalesce("records_count", F.lit(0).cast("bigint")) == count
    same = same_count & F.col("content_sum").eqNullSafe(F.col("_content_sum")) & F.col("content_xor").eqNullSafe(F.col("_content_xor"))
    return both.select(*keys, "records_count", count.alias("actual_count"), (~same).alias("mismatch"), (same_count & ~same).alias("altered"))
