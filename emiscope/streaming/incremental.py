"""Incremental steps as Structured Streaming queries.

All run with ``availableNow``: they take what is new since the last run, as the
checkpoint records it, and stop.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emiscope.operators.ranking import last_write_wins
from emiscope.schemas import BUDGET_WINDOW_SECONDS
from emiscope.session import write_through
from emiscope.sources.writers import drop_directories


def page_stream(
    spark: SparkSession, path: str, schema, max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _finish(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


def ingest_pages(pages: DataFrame, out: str, checkpoint: str) -> None:
    """Each new page file once, into an append-only table."""
    writer = pages.writeStream.format("parquet").outputMode("append")
    _finish(writer.option("path", out).option("checkpointLocation", checkpoint))


def _batch_writer(out: str, shape: Callable[[DataFrame], DataFrame]) -> Callable:
    def write(batch: DataFrame, batch_id: int) -> None:
        # A replayed batch overwrites its own directory, so a restart adds nothing twice.
        shape(batch).write.mode("overwrite").parquet(f"{out}/part_number={batch_id}")

    return write


def flush_parts(rows: DataFrame, out: str, checkpoint: str) -> None:
    """Each micro-batch into its own numbered part."""
    writer = rows.writeStream.foreachBatch(_batch_writer(out, lambda df: df))
    _finish(writer.option("checkpointLocation", checkpoint))


def track_latest(
    rows: DataFrame, keys: list[str], sequence: list[str], out: str, checkpoint: str
) -> None:
    """Newest row per key. Each micro-batch writes only the keys it changed."""
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*sequence)).alias("_row")
    latest = rows.groupBy(*keys).agg(newest)

    def shape(df: DataFrame) -> DataFrame:
        return df.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])

    writer = latest.writeStream.outputMode("update").foreachBatch(_batch_writer(out, shape))
    _finish(writer.option("checkpointLocation", checkpoint))


def current_state(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """The table a ``track_*`` query keeps: the last revision of each key."""
    revisions = spark.read.parquet(out)
    return last_write_wins(revisions, keys, ["part_number"]).drop("part_number")


def compact(spark: SparkSession, out: str, keys: list[str]) -> None:
    """Fold the revisions of a ``track_latest`` table before the newest part into one per key.

    The folded rows become a part of their own, numbered below all others; then the parts it
    holds go, lowest first. At every moment the newest revision of each key is there, and a
    batch that is replayed writes its own part only. Not for two callers at a time.
    """
    stored = spark.read.parquet(out)
    ends = stored.agg(F.max("part_number").alias("top"), F.min("part_number").alias("low")).first()
    if ends["top"] is None:
        return
    older = stored.where(F.col("part_number") < ends["top"])
    numbers = write_through(older.select("part_number").distinct().orderBy("part_number"), "folded_parts")
    place = f"{out}/part_number={min(ends['low'], 0) - 1}"
    last_write_wins(older, keys, ["part_number"]).drop("part_number").write.parquet(place)
    drop_directories(spark, numbers.orderBy("part_number"), out)


def track_call_windows(
    calls: DataFrame, ts: str, out: str, checkpoint: str, seconds: int = BUDGET_WINDOW_SECONDS
) -> None:
    """Calls per clock-aligned window, as counts of each micro-batch.

    The counts add up (``call_windows``), so a late call counts in its own window however
    late it is, and no state is kept between batches.
    """

    def shape(batch: DataFrame) -> DataFrame:
        windows = batch.where(F.col(ts).isNotNull()).groupBy(F.window(ts, f"{seconds} seconds").alias("_w"))
        return windows.agg(F.count(F.lit(1)).alias("calls")).select(F.col("_w.start").alias("window_start"), "calls")

    writer = calls.writeStream.foreachBatch(_batch_writer(out, shape))
    _finish(writer.option("checkpointLocation", checkpoint))


def call_windows(spark: SparkSession, out: str) -> DataFrame:
    """The table that ``track_call_windows`` keeps: calls of each window over all batches."""
    return spark.read.parquet(out).groupBy("window_start").agg(F.sum("calls").alias("calls"))


def over_budget(windows: DataFrame, budget: int) -> DataFrame:
    excess: Column = F.greatest(F.col("calls") - budget, F.lit(0).cast("bigint"))
    return windows.withColumns({"over_budget": F.col("calls") > budget, "excess_calls": excess})
