"""Windows, sorts, limits and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from emiscope.operators import aggregates as A
from emiscope.operators import joins as J
from emiscope.operators import ranking as R
from emiscope.plans.catalog.base import DISCOVERY_CTES, query
from emiscope.plans.catalog.scans import (
    CHUNK_CTES, SEGMENT_CTES, SHARDED_CTES, chunked, discovered, discovered_table, page_rows, segments,
)
from emiscope.plans.fixtures import relation, table
from emiscope.plans.jobs import prepare_order
from emiscope.session import fresh_path
from emiscope.sources import clustered

LATEST_SQL = """
SELECT k, attempt_id, strftime(enriched_at, '%Y%m%dT%H%M%SZ') AS enriched_at, status, value FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY enriched_at DESC, attempt_id DESC) AS rn FROM enrich_log)
WHERE rn = 1"""


def shown(rows):
    return rows.withColumn("enriched_at", F.date_format("enriched_at", "yyyyMMdd'T'HHmmss'Z'"))


@query("gold_latest_per_model", LATEST_SQL)
def gold_latest_per_model(spark, sf):
    log = relation(spark, sf, "enrich_log")
    return shown(R.latest_per_key(log, ["k"], [F.desc("enriched_at"), F.desc("attempt_id")]))


@query("chunk_assignment", "SELECT model_id, idx, chunk FROM chunked", CHUNK_CTES)
def chunk_assignment(spark, sf):
    return chunked(spark, sf).select("model_id", "idx", "chunk")


@query(
    "page_running_totals",
    """SELECT 's' AS snapshot_id, page, page_size, page_matches,
      CAST(SUM(page_size) OVER (ORDER BY page) AS BIGINT) AS total_models_seen,
      CAST(SUM(page_matches) OVER (ORDER BY page) AS BIGINT) AS models_with_emissions FROM page_counts""",
    SEGMENT_CTES,
)
def page_running_totals(spark, sf):
    return A.page_totals(page_rows(spark, sf), "has_emission")


@query(
    "batch_numbers",
    """SELECT event_id, partition_no, CAST(ceil(row_number() OVER (PARTITION BY partition_no ORDER BY event_id) / 50.0) AS BIGINT) AS batch
    FROM attempts WHERE outcome = 'COMPLETED'""",
)
def batch_numbers(spark, sf):
    rows = relation(spark, sf, "attempts").where("outcome = 'COMPLETED'")
    rows = rows.select("event_id", "partition_no")
    return A.batch_numbers(rows, ["partition_no"], [F.asc("event_id")])


@query("flush_segments", "SELECT snapshot_id, page, page_matches, part_number FROM segments", SEGMENT_CTES)
def flush_segments(spark, sf):
    return segments(spark, sf)


@query(
    "rate_window_plan",
    """SELECT event_id, partition_no, (rn - 1) // 250 AS call_window, (rn - 1) // 250 * 300 AS offset_seconds FROM (
      SELECT event_id, partition_no, row_number() OVER (PARTITION BY partition_no ORDER BY ts, event_id) AS rn FROM attempts)""",
)
def rate_window_plan(spark, sf):
    calls = relation(spark, sf, "attempts").select("event_id", "partition_no", "ts")
    order = [F.asc("ts"), F.asc("event_id")]
    return A.call_windows(calls, ["partition_no"], order, 250, 300).drop("ts")


@query(
    "sort_three_keys",
    "SELECT model_id, downloads, likes, co2_eq_emissions FROM discovered "
    "ORDER BY downloads DESC, likes DESC, co2_eq_emissions DESC, model_id",
    DISCOVERY_CTES,
)
def sort_three_keys(spark, sf):
    rows = discovered_table(spark, sf).select("model_id", "downloads", "likes", "co2_eq_emissions")
    return rows.orderBy(*prepare_order())


@query(
    "topk_models",
    "SELECT model_id, downloads, likes, co2_eq_emissions FROM discovered "
    "ORDER BY downloads DESC, likes DESC, co2_eq_emissions DESC, model_id LIMIT 10",
    DISCOVERY_CTES,
)
def topk_models(spark, sf):
    rows = discovered(spark, sf, keep=()).select("model_id", "downloads", "likes", "co2_eq_emissions")
    return rows.orderBy(*prepare_order()).limit(10)


@query(
    "limit_per_shard",
    """SELECT shard_id, o_orderkey FROM (
      SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY o_orderkey) AS rn FROM hits) WHERE rn <= 10""",
    SHARDED_CTES,
)
def limit_per_shard(spark, sf):
    facts = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    hits = J.in_ranges(facts, J.emission_ranges(spark), "o_totalprice", stored=True)
    return R.first_n_per_key(hits, ["shard_id"], [F.asc("o_orderkey")], 10).select("shard_id", "o_orderkey")


@query(
    "slice_range",
    "SELECT model_id, idx FROM chunked WHERE idx >= 100 AND idx < 350",
    CHUNK_CTES,
)
def slice_range(spark, sf):
    rows = R.global_index(discovered_table(spark, sf), prepare_order())
    return rows.where("idx >= 100 AND idx < 350").select("model_id", "idx")


@query(
    "hot_value_index",
    """SELECT l_orderkey, l_linenumber, copies, first_idx FROM (
      SELECT l_orderkey, l_linenumber, COUNT(*) AS copies, MIN(idx) AS first_idx FROM (
        SELECT *, row_number() OVER (ORDER BY l_returnflag, l_orderkey, l_linenumber) - 1 AS idx FROM lineitem)
      GROUP BY l_returnflag, l_orderkey, l_linenumber)""",
)
def hot_value_index(spark, sf):
    """Global index over three hot leading values with repeated full keys."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    keys = ["l_returnflag", "l_orderkey", "l_linenumber"]
    rows = R.global_index(lines, [F.asc(k) for k in keys])
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("copies"), F.min("idx").alias("first_idx")
    ).drop("l_returnflag")


@query(
    "clustered_range_read",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_totalprice >= 100000 AND o_totalprice <= 180000 AND o_custkey <= (SELECT max(o_custkey) // 8 FROM orders)""",
)
def clustered_range_read(spark, sf):
    """Ranges of two columns from a table that is laid out along both; files are chosen before the scan."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = fresh_path(spark, "clustered")
    clustered.write_clustered(rows, path, ["o_totalprice", "o_custkey"], 64)
    highest = rows.agg(F.expr("max(o_custkey) div 8")).first()[0]
    return clustered.read_range(spark, path, {"o_totalprice": (100000, 180000), "o_custkey": (None, highest)})
