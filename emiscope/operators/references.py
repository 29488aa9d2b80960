"""What a stream of runs refers to: how many different items, how many new ones, which are used most.

Each run leaves one row with two sketches of its references, made in one pass and combined before
the shuffle; later questions read those rows alone. Numbers of different items are exact up to
``EXACT_ITEMS`` of them and estimates beyond. Most used items are named by a sketch and then
counted exactly; if the sketch cannot rule out that it missed one, all items are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emiscope.session import write_through

_LOG_ITEMS = 16
EXACT_ITEMS = 1 << _LOG_ITEMS
#: Items that a frequency sketch keeps track of. One it lost has at most ``LOST_SHARE`` of all references.
TRACKED = 4096
LOST_SHARE = 3.5 / TRACKED


def run_sketches(rows: DataFrame, run: str, item: str) -> DataFrame:
    """``run, items, top, references`` of each run; rows without an item are no references."""
    known = rows.where(F.col(item).isNotNull())
    return known.groupBy(run).agg(
        F.theta_sketch_agg(item, _LOG_ITEMS).alias("items"),
        F.expr(f"approx_top_k_accumulate(`{item}`, {TRACKED})").alias("top"),
        F.count(F.lit(1)).alias("references"),
    )


def items_over_runs(sketches: DataFrame, run: str) -> DataFrame:
    """Per run: its references and different items, those of all runs so far, and those no earlier run had.

    ``lost_items`` are those of the run before that this run lacks. Runs follow each other in
    the order of ``run``; there is one row per run, so one task orders them.
    """
    earlier = Window.orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    before = F.theta_union_agg("items", F.lit(_LOG_ITEMS)).over(earlier)
    last = F.lag("items").over(Window.orderBy(run))

    def number(sketch: Column) -> Column:
        return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0).cast("bigint"))

    placed = sketches.select(run, "references", "items", before.alias("_before"), last.alias("_last"))
    fresh = F.when(F.col("_before").isNull(), F.col("items")).otherwise(F.theta_difference("items", "_before"))
    so_far = F.when(F.col("_before").isNull(), F.col("items")).otherwise(F.theta_union("items", "_before", F.lit(_LOG_ITEMS)))
    return placed.select(
        run, "references", number(F.col("items")).alias("items"), number(so_far).alias("items_so_far"),
        number(fresh).alias("new_items"), number(F.theta_difference("_last", "items")).alias("lost_items"),
    )


def frequent_candidates(sketches: DataFrame, item: str) -> DataFrame:
    """At most ``TRACKED`` items that the runs' sketches together hold to be frequent."""
    merged = sketches.agg(F.expr(f"approx_top_k_combine(top, {TRACKED})").alias("top"))
    listed = merged.select(F.expr(f"inline(approx_top_k_estimate(top, {TRACKED}))"))
    return listed.select(F.col("item").alias(item))


def top_items(rows: DataFrame, sketches: DataFrame, item: str, k: int) -> DataFrame:
    """The ``k`` items with most references, with their exact ``references``; ties go by item.

    ``sketches`` are those of all of ``rows``.
    """
    known = rows.where(F.col(item).isNotNull())
    order = [F.desc("references"), F.asc(item)]
    total = sketches.agg(F.sum("references")).first()[0] or 0
    if total:
        named = write_through(frequent_candidates(sketches, item), "candidates")
        # The candidates are at most TRACKED.
        counted = known.join(F.broadcast(named), item, "left_semi").groupBy(item).agg(F.count(F.lit(1)).alias("references"))
        best = write_through(counted.orderBy(*order).limit(k), "top_items")
        least = best.agg(F.count(F.lit(1)), F.min("references")).first()
        if least[0] == k and least[1] > LOST_SHARE * total:
            return best
    return known.groupBy(item).agg(F.count(F.lit(1)).alias("references")).orderBy(*order).limit(k)


def counts_over_runs(rows: DataFrame, run: str, item: str, named: DataFrame) -> DataFrame:
    """``run, item, references``: exact counts of the named items in each run that refers to them."""
    return rows.join(F.broadcast(named.select(item)), item, "left_semi").groupBy(run, item).agg(F.count(F.lit(1)).alias("references"))
