"""Latest-row, numbering and running-total operators.

Nothing here numbers rows in a single task. A global order is made once by a range
sort, which spreads any group over several partitions, and is written out; the
rest works with one small row per range partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emiscope.session import write_through

# Group start tables up to this many rows are broadcast.
BROADCAST_GROUPS = 100_000
_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row position below


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    Rank-equals-one lets Spark cut each map task to one row per key before the
    shuffle, so a hot key costs no more than a cold one.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def first_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """At most ``n`` rows of each key, with the same map-side cut."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def last_write_wins(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """One row per key, the one with the highest ``sequence``; combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*sequence)).alias("_row")
    chosen = df.groupBy(*keys).agg(newest)
    return chosen.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def _placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` range-sorted and written, with the partition and position of each row."""
    at = F.monotonically_increasing_id()
    stored = write_through(df.orderBy(*order).withColumn("_at", at), "ordered")
    return stored.select(
        *df.columns,
        F.shiftright("_at", _POSITION_BITS).cast("int").alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"),
    )


def _before(measure: str) -> Column:
    """Sum over earlier range partitions. One row per partition, so one task is enough."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(measure).over(earlier), F.lit(0))


def _indexed(df: DataFrame, order: Sequence[Column], index: str) -> DataFrame:
    placed = _placed(df, order)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    starts = counts.select("_part", _before("_rows").alias("_start"))
    return placed.join(F.broadcast(starts), "_part").withColumn(
        index, F.col("_start") + F.col("_pos")
    )


def global_index(df: DataFrame, order: Sequence[Column], index: str = "idx") -> DataFrame:
    """Zero-based position of each row in ``order``, which must be total."""
    return _indexed(df, order, index).select(*df.columns, index)


def rank_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], rank: str = "rank"
) -> DataFrame:
    """One-based position of each row in its group, for groups of any size.

    Rows are sorted by group and order, so a rank is the distance to the group's
    first index. Few groups are looked up in a broadcast table; with many, each range
    partition finds its own starts and learns that of the one group it may have inherited.
    """
    rows = _indexed(df, [*[F.col(g) for g in group], *order], "_idx")
    firsts = rows.groupBy(*[F.col(g).alias(f"_g_{g}") for g in group])
    starts = write_through(firsts.agg(F.min("_idx").alias("_first")), "starts")
    if starts.count() <= BROADCAST_GROUPS:
        same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group]
        ranked = rows.join(F.broadcast(starts), reduce(lambda a, b: a & b, same))
        return ranked.select(*df.columns, (F.col("_idx") - F.col("_first") + 1).alias(rank))
    return _rank_by_partition(rows, group, rank).select(*df.columns, rank)


def _rank_by_partition(rows: DataFrame, group: Sequence[str], rank: str) -> DataFrame:
    """Ranks of indexed rows without gathering a group that spans range partitions."""
    key = F.struct(*group)
    edges = rows.groupBy("_part").agg(
        F.min_by(key, "_pos").alias("_head"), F.max_by(key, "_pos").alias("_tail")
    )
    tails = (
        rows.select("_part", key.alias("_key"), "_idx")
        .join(F.broadcast(edges), "_part")
        .where(F.col("_key").eqNullSafe(F.col("_tail")))
        .groupBy(F.col("_part").alias("_from"), "_tail")
        .agg(F.min("_idx").alias("_first"))
    )
    inherited = (
        edges.select("_part", "_head")
        .join(
            F.broadcast(tails),
            F.col("_head").eqNullSafe(F.col("_tail")) & (F.col("_from") < F.col("_part")),
        )
        .groupBy("_part", "_head")
        .agg(F.min("_first").alias("_first"))
    )
    local_start = F.min("_idx").over(Window.partitionBy("_part", *group))
    start = F.when(key.eqNullSafe(F.col("_head")), F.col("_first")).otherwise(local_start)
    return rows.join(F.broadcast(inherited), "_part", "left").withColumn(
        rank, F.col("_idx") - start + 1
    )


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    position: str,
    measures: dict[str, str],
    span: int = 4096,
) -> DataFrame:
    """Running sums along a dense integer ``position``, one row per position.

    Positions are cut into spans. A window runs inside each span, a second one
    over the span totals, so no task holds a whole group.
    """
    # The same filter on both sides of the join lets Spark reuse the shuffle below them.
    cut = df.withColumn("_span", F.floor(F.col(position) / span)).where("_span IS NOT NULL")
    inside = Window.partitionBy(*group, "_span").orderBy(position)
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    totals = cut.groupBy(*group, "_span").agg(
        *[F.sum(source).alias(f"_{name}") for name, source in measures.items()]
    )
    earlier = Window.partitionBy(*group).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *group,
        "_span",
        *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in measures],
    )
    local = cut.select(
        "*", *[F.sum(source).over(inside).alias(name) for name, source in measures.items()]
    )
    joined = local.join(starts, [*group, "_span"])
    return joined.select(
        *df.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in measures]
    )


def chunk_rows(rate: int, workers: int, calls_per_row: int = 1) -> int:
    """Rows one worker may fetch within the rate limit, at least one."""
    return max(1, rate // (workers * calls_per_row))


def assign_chunks(df: DataFrame, order: Sequence[Column], size: int) -> DataFrame:
    """Cut the ordered rows into chunks of ``size``: adds ``idx`` and ``chunk``."""
    return global_index(df, order).withColumn("chunk", F.floor(F.col("idx") / size))


def chunk_bounds(chunked: DataFrame, emission: str = "co2_eq_emissions") -> DataFrame:
    """Index range, row count and emission range of each chunk."""
    return chunked.groupBy("chunk").agg(
        F.min("idx").alias("start_index"),
        (F.max("idx") + 1).alias("end_index"),
        F.count(F.lit(1)).alias("records_count"),
        F.min(emission).alias("emission_min"),
        F.max(emission).alias("emission_max"),
    )


def exact_quantiles(df: DataFrame, column: str, parts: int) -> DataFrame:
    """Exact quantile bounds ``0, 1/parts .. 1`` with linear interpolation.

    Rows are counted per value before anything is ordered; the bounds are then the
    values whose running count covers the wanted positions.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v"))
    counts = write_through(counts.agg(F.count(F.lit(1)).alias("_n")), "value_counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    covered = covering_values(counts.withColumn("_shift", F.lit(0).cast("bigint")))
    return interpolated(covered, [i * (total - 1) / parts for i in range(parts + 1)])


def covering_values(counts: DataFrame) -> DataFrame:
    """``_v, _lo, _hi``: the positions ``_lo <= p < _hi`` that each value takes in the order of all.

    ``counts`` has each value once with its count ``_n``, and how many rows stand before it that
    are not in ``counts`` (``_shift``).
    """
    placed = _placed(counts, [F.col("_v")])
    starts = placed.groupBy("_part").agg(F.sum("_n").alias("_rows"))
    starts = starts.select("_part", _before("_rows").alias("_start"))
    inside = Window.partitionBy("_part").orderBy("_pos")
    end = F.col("_shift") + F.col("_start") + F.sum("_n").over(inside)
    return placed.join(F.broadcast(starts), "_part").select("_v", (end - F.col("_n")).alias("_lo"), end.alias("_hi"))


def interpolated(covered: DataFrame, positions: Sequence[float]) -> DataFrame:
    """``step, bound``: the value at each position, between its two neighbours."""
    wanted = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(at).alias("at")) for i, at in enumerate(positions)])

    def covers(position: Column) -> Column:
        return (F.col("_lo") <= position) & (position < F.col("_hi"))

    near = F.filter(wanted, lambda w: covers(F.floor(w["at"])) | covers(F.ceil(w["at"])))
    return (
        covered.select("_v", F.explode(near).alias("_w"))
        .groupBy(F.col("_w.step").alias("step"), F.col("_w.at").alias("_at"))
        .agg(F.min("_v").alias("_a"), F.max("_v").alias("_b"))
        .select(
            "step",
            (
                F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_at") - F.floor("_at"))
            ).alias("bound"),
        )
    )
