"""Lookup, range, reconciliation and skip joins."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emiscope.functions.text import strip
from emiscope.operators.ranking import global_index
from emiscope.operators.staging import where_computed
from emiscope.schemas import EMISSION_RANGES, RANGE_SCHEMA
from emiscope.session import write_through

# Ranges up to this count are broadcast (24 bytes each); more are joined by a sweep.
BROADCAST_RANGES = 2000
# Facts of a block of the sweep join at least and at most, and of a pack; blocks of one cut of a long range.
BLOCK, WIDEST_BLOCK, PACK, BLOCKS_PER_CUT = 256, 1 << 16, 64, 4096
# Ranges that meet one copy of a block.
RANGES_TOGETHER = 1 << 14


def emission_ranges(spark: SparkSession) -> DataFrame:
    """The fixed emission ranges as a local relation."""
    lines = ", ".join(
        f"({shard}, {low}D, {'NULL' if high is None else f'{high}D'})"
        for shard, low, high in EMISSION_RANGES
    )
    rows = spark.sql(f"SELECT * FROM VALUES {lines} AS t(shard_id, min_emissions, max_emissions)")
    return rows.to(StructType.fromDDL(RANGE_SCHEMA))


class Lookup:
    """Rows split by what their id leads to. Each side costs what it needs.

    Absent payloads are found by their ids alone. The rows that have a payload are joined and
    written when the first of ``found`` and ``unreadable`` is asked for, and read by both.
    """

    def __init__(self, rows: DataFrame, payloads: DataFrame, json_column: str):
        self.with_id, self.missing_id = split_missing_id(rows)
        self.payloads, self.json_column = payloads, json_column
        named = payloads.where(F.col(json_column).isNotNull()).select(F.col("model_id").alias("_id"))
        keyed = self.with_id.withColumn("_id", strip(F.col("model_id")))
        self.missing_payload = keyed.join(named, "_id", "left_anti").drop("_id")

    @cached_property
    def attached(self) -> DataFrame:
        there = attach_payloads(self.with_id, self.payloads, self.json_column).where("error_type IS NULL OR error_type <> 'LookupError'")
        return write_through(there, "lookup")

    @property
    def found(self) -> DataFrame:
        return self.attached.where("error_type IS NULL").drop("error_type", "error_message", "called")

    @property
    def unreadable(self) -> DataFrame:
        return self.attached.where("error_type IS NOT NULL").drop(self.json_column, "error_type", "error_message", "called")


def split_missing_id(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a usable id, and rows whose id is absent or blank."""
    blank = strip(F.coalesce(F.col("model_id"), F.lit(""))) == ""
    return rows.where(~blank), rows.where(blank)


def attach_payloads(rows: DataFrame, payloads: DataFrame, json_column: str = "payload_json") -> DataFrame:
    """Every row once with its payload, or with the error that keeps it from one.

    Adds the payload, ``error_type`` and ``error_message`` (NULL for a usable payload) and
    ``called``: whether the row led to a lookup. A payload that is no JSON object is an
    error. Of several payloads of one id the last by byte order counts. Payloads that no row
    asks for stay where they are. Rows without an id pass by the join.
    """
    with_id, missing_id = split_missing_id(rows)
    with_id = with_id.withColumn("_id", strip(F.col("model_id")))
    known = payloads.select(F.col("model_id").alias("_id"), F.col(json_column)).where("_id is not null")
    known = known.join(with_id.select("_id").distinct(), "_id", "left_semi")
    known = known.groupBy("_id").agg(F.max(json_column).alias(json_column))
    joined = with_id.join(known, "_id", "left").drop("_id")
    absent = F.col(json_column).isNull()
    # Keys of the outer object: NULL for broken text and for any other kind of value.
    broken = F.json_object_keys(json_column).isNull()
    checked = joined.withColumns(
        {
            "error_type": F.when(absent, "LookupError").when(broken, "InvalidPayload"),
            "error_message": F.when(absent, F.concat(F.lit("No payload for "), F.col("model_id"))).when(
                broken, F.concat(F.lit("Payload is no JSON object: "), F.col("model_id"))
            ),
            "called": F.lit(True),
        }
    )
    blank = missing_id.withColumns(
        {
            json_column: F.lit(None).cast("string"),
            "error_type": F.lit("ValueError"),
            "error_message": F.lit("Missing model_id"),
            "called": F.lit(False),
        }
    )
    return checked.unionByName(blank)


def lookup_payloads(rows: DataFrame, payloads: DataFrame, json_column: str = "payload_json") -> Lookup:
    """Each row with its payload by id, split by outcome."""
    return Lookup(rows, payloads, json_column)


def capture_errors(rows: DataFrame, json_column: str, shaped: dict[str, Column], document: str = "_doc") -> DataFrame:
    """Rows with ``status`` and ``error`` beside the columns shaped from their JSON text.

    ``shaped`` reads the parsed VARIANT named ``document``. Unreadable text gives status
    ``error`` and NULLs instead of failing the job; missing text gives ``empty``.
    """
    read = rows.withColumn(document, F.try_parse_json(json_column))
    empty, failed = F.col(json_column).isNull(), F.col(document).isNull()
    status = F.when(empty, "empty").when(failed, "error").otherwise("ok")
    error = F.when(~empty & failed, F.lit(f"ValueError: unreadable {json_column}"))
    return read.withColumns({**shaped, "status": status, "error": error}).drop(document)


def _within(value: Column) -> Column:
    """Half-open: the lower bound belongs to the range, the upper one does not."""
    upper = F.col("max_emissions")
    return (value >= F.col("min_emissions")) & (upper.isNull() | (value < upper))


def _span(ranges: DataFrame) -> tuple[float | None, float | None]:
    """Least lower and greatest upper bound: one row; the upper one is None when a range is open."""
    low, high, open_ = ranges.agg(
        F.min("min_emissions"), F.max("max_emissions"), F.count_if(F.col("max_emissions").isNull())
    ).first()
    return low, None if open_ else high


def _spanned(facts: DataFrame, ranges: DataFrame, value: str, stored: bool) -> DataFrame:
    """Facts that lie within the bounds of all ranges together."""
    low, high = _span(ranges)
    inside = F.col(value).isNotNull()
    if low is not None:
        inside = inside & (F.col(value) >= low)
    if high is not None:
        inside = inside & (F.col(value) < high)
    return facts.where(inside) if stored else where_computed(facts, inside)


def in_ranges(facts: DataFrame, ranges: DataFrame, value: str, stored: bool = False) -> DataFrame:
    """Inner range join. Few ranges are broadcast; many are joined by a sweep.

    ``stored`` says that ``value`` is a column of the scanned table, so that its filters
    may reach the scan; the filters of a computed value stay above the computation.
    """
    if ranges.count() > BROADCAST_RANGES:
        return sweep_join(facts, ranges, value, stored)
    facts = _spanned(facts, ranges, value, stored)
    # Ids and bounds only: 24 bytes a range. What else a range carries is joined by its id.
    slim = F.broadcast(ranges.select("shard_id", "min_emissions", "max_emissions"))
    hits = facts.join(slim, _within(F.col(value)))
    more = [c for c in ranges.columns if c not in slim.columns]
    return hits.join(ranges.select("shard_id", *more), "shard_id") if more else hits


def _in_order(x: Column) -> Column:
    """Both zeros are one value."""
    return F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double")).alias("_v")


def place_in_order(facts: DataFrame, ranges: DataFrame, value: str) -> tuple[DataFrame, DataFrame]:
    """Facts with ``_place``, their position in the order of values, and the ranges placed among them.

    Equal values are told apart by their place in the input, so that a value which a third of all
    facts share is cut over several partitions. NULL values are left out.
    """
    tie = F.monotonically_increasing_id().alias("_tie")
    rows = facts.where(F.col(value).isNotNull()).select(_in_order(F.col(value)), tie, F.struct(*facts.columns).alias("_fact"))
    # The index is written, so all uses read files.
    found = global_index(rows, [F.col("_v"), F.col("_tie")], "_place").select("_fact.*", "_place")
    return found, placed_ranges(found.select(value), ranges, value)


def placed_ranges(facts: DataFrame, ranges: DataFrame, value: str) -> DataFrame:
    """Ranges that can hold a value, with ``_first`` and ``_end``: their facts have ``_first < _place < _end``.

    One range sort takes values and bounds. A bound stands before the facts of its value, so lower
    bounds belong to their range and upper ones do not. The number of facts before a bound is its
    position in this order less its position among the bounds alone, so bounds take no place among
    the facts, however many they are. Ranges without a lower bound and ranges that end where or
    before they begin are left out. ``_tie`` tells equal ranges apart.
    """
    tie = F.monotonically_increasing_id().alias("_tie")
    values = facts.where(F.col(value).isNotNull()).select(_in_order(F.col(value)), F.lit(1).alias("_kind"), tie)
    low, high = F.col("min_emissions"), F.col("max_emissions")
    holding = ranges.where(low.isNotNull() & (high.isNull() | (low < high)))
    sides = holding.select(F.struct(*ranges.columns).alias("_range"), tie)  # both bounds carry one tie
    sides = sides.select("_tie", "_range", F.posexplode(F.array("_range.min_emissions", "_range.max_emissions")).alias("_side", "_bound"))
    # The range goes with its lower bound.
    carried = F.when(F.col("_side") == 0, F.col("_range")).alias("_range")
    sides = sides.where("_bound IS NOT NULL").select(_in_order(F.col("_bound")), F.lit(0).alias("_kind"), "_tie", carried)
    both = values.unionByName(sides, allowMissingColumns=True)
    ordered = global_index(both, [F.col("_v"), F.col("_kind"), F.col("_tie")], "_order")
    ranked = global_index(ordered.where("_kind = 0").select("_tie", "_range", "_order"), [F.col("_order")], "_rank")
    before = F.col("_order") - F.col("_rank")
    paired = ranked.groupBy("_tie").agg(F.first("_range", ignorenulls=True).alias("_range"), F.min(before).alias("_low"), F.max(before).alias("_high"))
    # All facts stand before the end of an open range.
    end = F.when(F.col("_range.max_emissions").isNull(), F.lit(ordered.where("_kind = 1").count())).otherwise(F.col("_high"))
    return paired.select("_range.*", (F.col("_low") - 1).alias("_first"), end.alias("_end"), "_tie")


def covered_blocks(placed: DataFrame, last: int, block: int | None = None) -> DataFrame:
    """One row for each block of positions that a range touches: hits over ``block``, and two more at most.

    Long ranges are cut in two steps, so that no row holds a long list.
    """
    block = block or BLOCK
    end = F.least(F.col("_end"), F.lit(last + 1))
    wide, narrow = block * BLOCKS_PER_CUT, F.lit(block)
    cuts = F.explode(F.sequence(F.expr(f"_first div {wide}"), F.expr(f"_end div {wide}"))).alias("_cut")
    cut = placed.withColumn("_end", end).where("_first < _end").select("*", cuts)
    low = F.greatest(F.expr(f"_first div {block}"), F.col("_cut") * BLOCKS_PER_CUT)
    high = F.least(F.floor(F.col("_end") / narrow), F.col("_cut") * BLOCKS_PER_CUT + (BLOCKS_PER_CUT - 1))
    return cut.select("*", F.explode(F.sequence(low, high)).alias("_block")).drop("_cut")


def packed(found: DataFrame, columns: list[str], block: int) -> DataFrame:
    """Placed facts in packs of up to ``PACK`` neighbours of one block: ``_facts`` from position ``_from`` to ``_to``."""
    rows = found.select("_place", F.struct(*columns).alias("_fact"))
    packs = rows.groupBy(F.expr(f"_place div {block}").alias("_block"), F.expr(f"_place % {block} div {PACK}").alias("_pack"))
    packs = packs.agg(F.min("_place").alias("_from"), F.max("_place").alias("_to"), F.collect_list(F.struct("_place", "_fact")).alias("_facts"))
    in_order = F.array_sort("_facts", lambda a, b: (a["_place"] - b["_place"]).cast("int"))
    return packs.select("_block", "_from", "_to", F.transform(in_order, lambda x: x["_fact"]).alias("_facts"))


def sweep_join(facts: DataFrame, ranges: DataFrame, value: str, stored: bool = False) -> DataFrame:
    """Range join for any number of ranges, overlapping or not, over any distribution of values.

    A range's facts are a run of positions (``place_in_order``). Runs meet the facts by blocks of as
    many positions as a run has on average, ``BLOCK`` at least; so runs take three rows each on
    average as long as that is below ``WIDEST_BLOCK``. Facts come to a block in packs of ``PACK``
    neighbours, and a pack gives the hits of each run that reaches into it. What moves is the
    facts three times, their values, the bounds, and the rows of the runs; never a hit, nor a fact
    per range. A block under more than ``RANGES_TOGETHER`` runs is copied, each copy for a part of
    them, so no task has to take all runs of a hot block.
    """
    found, placed = place_in_order(_spanned(facts, ranges, value, stored), ranges, value)
    placed = write_through(placed.where("_end - _first > 1"), "placed_ranges")
    held = F.col("_end") - F.col("_first") - 1
    count, hits, end = placed.agg(F.count(F.lit(1)), F.coalesce(F.sum(held), F.lit(0)), F.coalesce(F.max("_end"), F.lit(0))).first()
    block = max(BLOCK, min(WIDEST_BLOCK, hits // max(count, 1)))
    runs = covered_blocks(placed, end, block)
    touched = write_through(runs.groupBy("_block").agg(F.count(F.lit(1)).alias("_runs")), "touched_blocks")
    # A block is hot by RANGES_TOGETHER rows of runs, so hot blocks are few beside those.
    copies = F.ceil(F.col("_runs") / RANGES_TOGETHER).alias("_copies")
    hot = F.broadcast(touched.where(F.col("_runs") > RANGES_TOGETHER).select("_block", copies))
    copies = F.coalesce("_copies", F.lit(1).cast("bigint"))
    packs = packed(found, facts.columns, block).join(hot, "_block", "left")
    packs = packs.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1)))
    rows = touched.agg(F.coalesce(F.sum("_runs"), F.lit(0))).first()[0]
    runs = runs.join(hot, "_block", "left").withColumn("_copy", F.pmod(F.xxhash64("_tie"), copies)).drop("_copies")
    if rows > RANGES_TOGETHER:
        # The few bytes of a run say nothing of its hits, so adaptive execution may not gather runs by them.
        least = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        runs = runs.repartition(max(least, 2 * rows // RANGES_TOGETHER), "_block", "_copy")
    # The merge hint keeps Spark from broadcasting runs or packs, whose numbers it cannot foresee.
    met = packs.drop("_copies").join(runs.hint("merge"), ["_block", "_copy"])
    low, high = F.greatest("_from", F.col("_first") + 1), F.least("_to", F.col("_end") - 1)
    at = F.sequence((low - F.col("_from")).cast("int"), (high - F.col("_from")).cast("int"))
    found_at = met.where(low <= high).select("_facts", *ranges.columns, F.explode(at).alias("_at"))
    return found_at.select(F.get("_facts", F.col("_at")).alias("_fact"), *ranges.columns).select("_fact.*", *ranges.columns)


def count_in_ranges(facts: DataFrame, ranges: DataFrame, value: str) -> DataFrame:
    """Every range with its ``facts_count``, the difference of its bounds' places; no fact is joined."""
    named = write_through(ranges.withColumn("_id", F.monotonically_increasing_id()), "named_ranges")
    placed = placed_ranges(facts.select(value), named, value)
    counted = named.join(placed.select("_id", (F.col("_end") - F.col("_first") - 1).alias("facts_count")), "_id", "left").drop("_id")
    return counted.withColumn("facts_count", F.coalesce("facts_count", F.lit(0).cast("bigint")))


def shard_by_range(facts: DataFrame, ranges: DataFrame, value: str, stored: bool = False) -> DataFrame:
    """Facts with their range, plus one bare row for each range without a fact.

    The hits are written once, so the facts are read and computed once; the empty ranges
    come from an anti join on the ids in the written table.
    """
    hits = write_through(in_ranges(facts, ranges, value, stored), "range_hits")
    idle = ranges.join(hits.select("shard_id").distinct(), "shard_id", "left_anti")
    return hits.unionByName(idle, allowMissingColumns=True)


def reconcile_counts(
    declared: DataFrame, actual_rows: DataFrame, keys: tuple[str, ...] = ("partition_id",)
) -> DataFrame:
    """Declared against counted rows per partition, from both sides."""
    counted = actual_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("actual_count"))
    both = declared.select(*keys, "records_count").join(counted, list(keys), "full_outer")
    return both.select(
        *keys,
        "records_count",
        F.coalesce("actual_count", F.lit(0)).alias("actual_count"),
        (~F.col("records_count").eqNullSafe(F.coalesce("actual_count", F.lit(0)))).alias("mismatch"),
    )


def not_yet_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not done. Repeated keys are merged before they are shuffled."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def to_reprocess(rows: DataFrame, dead_letters: DataFrame, key: str) -> DataFrame:
    """Rows whose key has a dead letter, with the same early merge."""
    return rows.join(dead_letters.select(key).distinct(), key, "left_semi")
