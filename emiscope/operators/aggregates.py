"""Counts, run metrics and totals. Spark combines all of them before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emiscope.operators.ranking import rank_in_group, running_totals
from emiscope.schemas import BATCH_ROWS, FLUSH_PAGES, FLUSH_ROWS


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    return count_by(df, *keys).where(F.col("count") > 1)


def total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_records"))


def partition_metrics(
    attempts: DataFrame, keys: list[str], succeeded: Column, called: Column, batch_rows: int = BATCH_ROWS
) -> DataFrame:
    """Run counters per partition from one row per processed record."""
    return attempts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("input_count"),
        F.count(F.lit(1)).alias("processed_count"),
        F.count_if(succeeded).alias("success_count"),
        F.count_if(~succeeded).alias("failed_count"),
        F.count_if(called).alias("api_calls_count"),
        F.ceil(F.count_if(succeeded) / batch_rows).alias("batches_written"),
    )


def batch_numbers(
    rows: DataFrame, group: list[str], order: list[Column], size: int = BATCH_ROWS
) -> DataFrame:
    """Number of the output batch each row of a group lands in."""
    ranked = rank_in_group(rows, group, order, "_rank")
    return ranked.withColumn("batch", F.ceil(F.col("_rank") / size)).drop("_rank")


def call_windows(
    calls: DataFrame, group: list[str], order: list[Column], budget: int, seconds: int
) -> DataFrame:
    """Planned budget window of each call and its offset from the group's start."""
    ranked = rank_in_group(calls, group, order, "_rank")
    window = F.floor((F.col("_rank") - 1) / budget)
    return ranked.select(
        *calls.columns, window.alias("call_window"), (window * seconds).alias("offset_seconds")
    )


def page_totals(page_rows: DataFrame, has_emission: str) -> DataFrame:
    """Models and matches of each listing page, and both as running totals."""
    pages = page_rows.groupBy("snapshot_id", "page").agg(
        F.count(F.lit(1)).alias("page_size"), F.count_if(F.col(has_emission)).alias("page_matches")
    )
    return running_totals(
        pages,
        ["snapshot_id"],
        "page",
        {"total_models_seen": "page_size", "models_with_emissions": "page_matches"},
    )


def flush_segments(
    pages: DataFrame, every_pages: int = FLUSH_PAGES, every_rows: int = FLUSH_ROWS
) -> DataFrame:
    """Part number that each page's matches are flushed into; NULL where a page has none.

    A flush is due on every ``every_pages``-th page and whenever enough rows are
    pending. The first rule empties the pending rows at each block end, so blocks
    of pages stand alone: the fold runs over one block, and part numbers follow
    from a running total over blocks.
    """
    blocks = (
        pages.withColumn("_block", F.floor((F.col("page") - 1) / every_pages))
        .groupBy("snapshot_id", "_block")
        .agg(F.array_sort(F.collect_list(F.struct("page", "page_matches"))).alias("_pages"))
    )
    start = F.struct(
        F.lit(0).cast("bigint").alias("pending"),
        F.lit(0).alias("parts"),
        F.array().cast("array<struct<page:bigint,page_matches:bigint,part:int>>").alias("out"),
    )

    def step(acc: Column, p: Column) -> Column:
        pending = acc["pending"] + p["page_matches"]
        due = (pending > 0) & ((p["page"] % every_pages == 0) | (pending >= every_rows))
        part = F.when(p["page_matches"] > 0, acc["parts"] + 1)
        line = F.struct(
            p["page"].alias("page"), p["page_matches"].alias("page_matches"), part.alias("part")
        )
        return F.struct(
            F.when(due, F.lit(0).cast("bigint")).otherwise(pending).alias("pending"),
            F.when(due, acc["parts"] + 1).otherwise(acc["parts"]).alias("parts"),
            F.array_append(acc["out"], line).alias("out"),
        )

    folded = blocks.select(
        "snapshot_id", "_block", F.aggregate("_pages", start, step).alias("_fold")
    ).select(
        "snapshot_id",
        "_block",
        # Rows left over at the very end make one more part.
        (F.col("_fold.parts") + F.when(F.col("_fold.pending") > 0, 1).otherwise(0)).alias("_parts"),
        F.col("_fold.out").alias("_out"),
    )
    numbered = running_totals(folded, ["snapshot_id"], "_block", {"_upto": "_parts"})
    line = F.explode("_out").alias("_line")
    return numbered.select("snapshot_id", (F.col("_upto") - F.col("_parts")).alias("_base"), line).select(
        "snapshot_id",
        F.col("_line.page").alias("page"),
        F.col("_line.page_matches").alias("page_matches"),
        (F.col("_base") + F.col("_line.part")).alias("part_number"),
    )


def discovery_totals(page_rows: DataFrame, has_emission: str, key: str) -> DataFrame:
    """Models seen, models with emissions, and distinct models with emissions."""
    per_key = page_rows.groupBy("snapshot_id", key).agg(
        F.count(F.lit(1)).alias("_seen"), F.count_if(F.col(has_emission)).alias("_matched")
    )
    return per_key.groupBy("snapshot_id").agg(
        F.sum("_seen").alias("total_models_seen"),
        F.sum("_matched").alias("models_with_emissions"),
        F.count_if(F.col("_matched") > 0).alias("final_rows_count"),
    )
