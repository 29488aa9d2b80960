"""Tables laid out along a space-filling curve over some of their numbers, with bounds per file.

Each number becomes its rank among all values, as a stored quantile sketch has it, so that skewed
values fill the curve evenly. The bits of the ranks are interleaved to one key, rows are written in
ranges of it, and a small table keeps the least and greatest values of every file. A read with
ranges of several columns picks files by that table before it scans; the rows are then filtered
by their values, so the layout decides what is read and never what is found. Versions appear
whole, by a commit log.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emiscope.operators.sketches import merged_sketch, value_sketches
from emiscope.sources import commits

#: Bits of each column's rank, found in two steps of half of them.
BITS = 8
_STEP = 1 << BITS // 2


def _cuts(sketch: DataFrame) -> list[float]:
    """The values between the ranks, as the one-row table of a sketch has them; none without values."""
    ranks = [F.kll_sketch_get_quantile_double("sketch", F.lit(i / (1 << BITS))) for i in range(1, 1 << BITS)]
    found = sketch.where("rows > 0").select(F.array(*ranks)).first()
    return sorted(found[0]) if found else []


def _ranked(column: str, cuts: list[float]) -> Column:
    """How many cuts the value has reached; values without a rank come first."""
    value = F.col(column).cast("double")
    if not cuts:
        return F.lit(0).cast("bigint")

    def passed(some: Column) -> Column:
        return F.size(F.filter(some, lambda cut: cut <= value))

    every, coarse = F.array(*map(F.lit, cuts)), F.array(*map(F.lit, cuts[_STEP - 1 :: _STEP]))
    skipped = passed(coarse) * _STEP
    rank = (skipped + passed(F.slice(every, skipped + 1, _STEP))).cast("bigint")
    return F.when(value.isNotNull() & ~F.isnan(value), rank).otherwise(F.lit(0).cast("bigint"))


def curve_key(ranks: Sequence[Column]) -> Column:
    """The bits of the ranks in turn, the highest first."""
    bits = [
        F.shiftleft(F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("bigint")), b * len(ranks) + len(ranks) - 1 - k)
        for b in range(BITS) for k, rank in enumerate(ranks)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int) -> int:
    """The next version of ``path``: about ``files`` files along the curve over ``columns`` (at most seven)."""
    if not 1 <= len(columns) * BITS <= 56:
        raise ValueError("one to seven columns make a curve")
    spark = df.sparkSession
    key = curve_key([_ranked(c, _cuts(merged_sketch(value_sketches(df, c)))) for c in columns])
    data = commits.data_folder(path)
    placed = df.select(F.struct(*df.columns).alias("row"), key.alias("key")).repartitionByRange(files, "key")
    placed.sortWithinPartitions("key").select("row.*").write.parquet(data)
    rows = spark.read.schema(df.schema).parquet(data)
    ends = [e for k, c in enumerate(columns) for e in (F.min(c).alias(f"low_{k}"), F.max(c).alias(f"high_{k}"))]
    bounds = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends)
    bounds.write.parquet(f"{data}_bounds")
    return commits.commit(spark, path, {"data": data, "columns": list(columns), "schema": df.schema.jsonValue()})


def chosen_files(spark: SparkSession, path: str, ranges: dict[str, tuple], version: int | None = None) -> DataFrame:
    """``file, rows`` of the files that may hold rows within all ``ranges`` (both ends included, None is open).

    Only the ranges of curve columns choose.
    """
    said = commits.entry(spark, path, version)
    bounds = spark.read.parquet(f"{said['data']}_bounds")
    for k, column in enumerate(said["columns"]):
        low, high = ranges.get(column, (None, None))
        if low is not None:
            bounds = bounds.where(F.col(f"high_{k}") >= F.lit(low))
        if high is not None:
            bounds = bounds.where(F.col(f"low_{k}") <= F.lit(high))
    return bounds.select("file", "rows")


def read_range(spark: SparkSession, path: str, ranges: dict[str, tuple], version: int | None = None) -> DataFrame:
    """Rows within all ``ranges``, from the files that may hold them. NULL is in no range."""
    if version is None:
        version = commits.versions(spark, path)[-1] if commits.versions(spark, path) else None
    schema = StructType.fromJson(commits.entry(spark, path, version)["schema"])
    # Names of the chosen files alone come to the driver, as a scan's own file list does.
    files = [r["file"] for r in chosen_files(spark, path, ranges, version).toLocalIterator()]
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for column, (low, high) in ranges.items():
        if low is not None:
            rows = rows.where(F.col(column) >= F.lit(low))
        if high is not None:
            rows = rows.where(F.col(column) <= F.lit(high))
    return rows
