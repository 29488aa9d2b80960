"""Sinks. Each call is one write; several outputs of one job read a stored result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emiscope.schemas import DISCOVERY_COLUMNS
from emiscope.sources import commits

# Cells keep outer blanks and line ends, and empty text stays apart from NULL.
CSV_CELLS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# Bounds CSV files, as a file whose cells hold line ends is read by one task.
CSV_FILE_ROWS = 200_000


def gathered(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of one output directory together; Spark splits a directory that is too big."""
    return df.hint("rebalance", *[F.col(k) for k in keys])


def append_json(df: DataFrame, path: str, *partition_keys: str) -> None:
    df.write.mode("append").format("json").partitionBy(*partition_keys).save(path)


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Semicolon CSV with header and doubled quotes.

    ``single_file`` sends all rows through one task; only the caller knows that they fit.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite").options(**CSV_CELLS).option("sep", ";")
    (writer if single_file else writer.option("maxRecordsPerFile", CSV_FILE_ROWS)).csv(path)


def write_snapshot(df: DataFrame, path: str, full_refresh: bool) -> None:
    """Parquet by ``snapshot_date``: a refresh replaces the whole dataset, else rows are added."""
    writer = df.write.partitionBy("snapshot_date").option("partitionOverwriteMode", "static")
    writer.mode("overwrite" if full_refresh else "append").parquet(path)


def replace_snapshot(df: DataFrame, path: str) -> None:
    """Repeatable write: only the snapshot dates in ``df`` are replaced."""
    writer = df.write.partitionBy("snapshot_date").option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").parquet(path)


def write_batches(
    numbered: DataFrame, path: str, keys: list[str], rows_per_file: int | None = None
) -> None:
    """JSON lines per key, each row with the number of its ``batch``.

    The number is a column, so that files may hold many small batches.
    ``rows_per_file`` bounds the files as well. Only the directories that get rows
    are replaced, so other runs and partitions stay.
    """
    writer = gathered(numbered, *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(*keys).json(path)


def empty_directories(keys: DataFrame, path: str) -> None:
    """Leave ``<column>=<value>/...`` below ``path`` without rows for each row of ``keys``.

    One write replaces them all, with files that hold a blank line, which JSON readers pass over.
    """
    blank = gathered(keys.withColumn("value", F.lit("")), *keys.columns)
    writer = blank.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys.columns).text(path)


def drop_directories(spark: SparkSession, keys: DataFrame, path: str) -> None:
    """Remove ``<column>=<value>/...`` below ``path`` for each row of ``keys``, of which there must be few."""
    jvm = spark.sparkContext._jvm
    for row in keys.toLocalIterator():
        place = jvm.org.apache.hadoop.fs.Path("/".join([path, *(f"{c}={row[c]}" for c in keys.columns)]))
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def write_parts(df: DataFrame, path: str, part: str = "part_number") -> None:
    """Typed rows in part order: files hold whole runs of parts."""
    df.repartitionByRange(F.col(part)).sortWithinPartitions(part).write.mode("overwrite").parquet(path)


def write_csv_parts(
    df: DataFrame, path: str, part: str = "part_number", directory_per_part: bool = False
) -> None:
    """Header CSV in part order: files hold whole runs of parts, or one directory each."""
    writer = df.repartitionByRange(F.col(part)).sortWithinPartitions(part).write.mode("overwrite")
    writer = writer.options(**CSV_CELLS).option("maxRecordsPerFile", CSV_FILE_ROWS)
    if directory_per_part:
        writer = writer.option("partitionOverwriteMode", "static").partitionBy(part)
    writer.csv(path)


def publish(df: DataFrame, snapshot_path: str, latest_path: str) -> None:
    """The same typed rows as a version of the snapshot and of ``latest``; written once.

    Readers of either see the version before until the new one is whole (``commits``).
    """
    commits.publish(df, snapshot_path, also=[latest_path])


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV as an export; cells keep blanks and line ends."""
    df.write.mode("overwrite").options(**CSV_CELLS).option("maxRecordsPerFile", CSV_FILE_ROWS).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").partitionBy("event").json(path)


def write_chunks(chunked: DataFrame, path: str, partition_id: str = "partition_id", form: str = "parquet") -> None:
    """One directory per chunk with the fixed column list; other columns are left out.

    Jobs hand chunks on as Parquet; ``form`` may be ``csv`` for an export.
    """
    rows = gathered(chunked.select(partition_id, *DISCOVERY_COLUMNS), partition_id)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition_id)
    if form == "csv":
        writer = writer.options(**CSV_CELLS).option("maxRecordsPerFile", CSV_FILE_ROWS)
    writer.format(form).save(path)


def write_manifest(chunks: DataFrame, header: dict[str, Column], path: str) -> None:
    """Run header as one document, chunk descriptors as a table beside it.

    ``header`` holds constants and aggregates over the chunks, ``run_id`` among them.
    """
    write_json(chunks.agg(*[value.alias(name) for name, value in header.items()]), f"{path}/manifest")
    write_json(chunks.withColumn("run_id", header["run_id"]), f"{path}/partitions")
