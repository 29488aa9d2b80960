"""Exact answers with the help of mergeable sketches that are kept per snapshot.

A quantile sketch of each snapshot is a few kilobytes; merged, the sketches say between which
two values a quantile lies. One pass then counts what lies in between those values, value by
value, and everything else in bulk. So the bounds are exact, while only the values near them
are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emiscope.operators.ranking import covering_values, interpolated
from emiscope.session import write_through

#: Size parameter of the sketches; ranks are off by about ``RANK_ERROR`` of all rows, seldom more.
SKETCH_K = 800
RANK_ERROR = 0.004


def value_sketches(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """``by, sketch, rows`` of the values of each group; NULL and NaN are left out. Combined before the shuffle."""
    value = F.col(column).cast("double")
    known = df.where(value.isNotNull() & ~F.isnan(value))
    return known.groupBy(*by).agg(F.kll_sketch_agg_double(value, SKETCH_K).alias("sketch"), F.count(F.lit(1)).alias("rows"))


def merged_sketch(sketches: DataFrame) -> DataFrame:
    """One row: the sketch of all groups' values together."""
    return sketches.agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("rows").alias("rows"))


def _windows(sketch: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Disjoint windows in rising order that cover the given ones."""
    joined: list[tuple[float, float]] = []
    for low, high in sorted(sketch):
        if joined and low <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(high, joined[-1][1]))
        else:
            joined.append((low, high))
    return joined


def _between(merged: DataFrame, parts: int, error: float) -> list[tuple[float, float]]:
    """Values that the sketch takes for less and for greater than each wanted quantile."""
    ranks = [(max(0.0, i / parts - error), min(1.0, i / parts + error)) for i in range(parts + 1)]
    quantile = F.kll_sketch_get_quantile_double
    cells = [F.array(quantile("sketch", F.lit(a)), quantile("sketch", F.lit(b))) for a, b in ranks]
    return _windows([tuple(pair) for pair in merged.select(F.array(*cells)).first()[0]])


def sketched_quantiles(df: DataFrame, column: str, parts: int, sketches: DataFrame | None = None) -> DataFrame:
    """``step, bound`` as ``exact_quantiles`` gives them, of a column's values without NaN.

    ``sketches`` are stored ones of all rows of ``df``, in any grouping; without them one is made
    here. A sketch that misses is found out by the counts, and the pass is repeated with a wider
    margin; so old sketches cost time, and do not change the result unless they hold no row at all.
    """
    merged = write_through(merged_sketch(value_sketches(df, column) if sketches is None else sketches), "sketch")
    none = df.sparkSession.createDataFrame([], "step INT, bound DOUBLE")
    if not merged.first()["rows"]:
        return none
    value = F.col(column).cast("double")
    known = df.where(value.isNotNull() & ~F.isnan(value)).select(value.alias("_v"))
    error = RANK_ERROR
    while True:
        windows = _between(merged, parts, error) if error < 0.5 else [(float("-inf"), float("inf"))]
        # How many window edges a value has passed: an odd number inside a window, an even one between two.
        passed: Column = F.lit(0)
        for low, high in windows:
            passed = passed + (F.col("_v") >= low).cast("int") + (F.col("_v") > high).cast("int")
        inside = F.col("_passed") % 2 == 1
        counted = known.withColumn("_passed", passed).groupBy("_passed", F.when(inside, F.col("_v")).alias("_v"))
        counted = write_through(counted.agg(F.count(F.lit(1)).alias("_n")), "counted_values")
        sizes = {r["_passed"]: r["n"] for r in counted.groupBy("_passed").agg(F.sum("_n").alias("n")).collect()}
        before, spans = 0, {}
        for k in range(2 * len(windows) + 1):
            spans[k] = (before, before + sizes.get(k, 0))
            before = spans[k][1]
        # The rows that are there count, should stored sketches be of others.
        if not before:
            return none
        wanted = [i * (before - 1) / parts for i in range(parts + 1)]
        held = [spans[k] for k in range(1, 2 * len(windows), 2)]
        if all(any(low <= int(at) and -int(-at // 1) < high for low, high in held) for at in wanted):
            break
        error *= 4
    # Of the values in the windows, the counts of what lies between are added to the running count.
    skipped, shift = 0, F.lit(0).cast("bigint")
    for k in range(0, 2 * len(windows), 2):
        skipped += sizes.get(k, 0)
        shift = F.when(F.col("_passed") == k + 1, F.lit(skipped).cast("bigint")).otherwise(shift)
    near = counted.where("_passed % 2 = 1").withColumn("_shift", shift)
    return interpolated(covering_values(near), wanted)
