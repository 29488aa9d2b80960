"""Joins, aggregations and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from emiscope.operators import aggregates as A
from emiscope.operators import digests as D
from emiscope.operators import joins as J
from emiscope.operators import ranking as R
from emiscope.operators import sketches as sketches_of
from emiscope.plans.catalog.base import CARDS, DISCOVERY_CTES, query
from emiscope.plans.catalog.rows import emission_facts
from emiscope.plans.catalog.scans import (
    CHUNK_CTES, METRICS_SQL, SHARDED_CTES, chunked, discovered, metrics, order_bronze, page_rows,
    sharded_orders,
)
from emiscope.plans.fixtures import relation, table
from emiscope.session import fresh_path, write_through
from emiscope.sources import history


def payload_table(spark, sf):
    """The payloads that can be found: every eleventh model has none."""
    return relation(spark, sf, "payloads").where("k % 11 <> 0")


@query(
    "enrich_lookup_join",
    """SELECT d.model_id, CASE WHEN d.k % 11 = 0 THEN 'missing' ELSE 'found' END AS side,
      CASE WHEN d.k % 11 <> 0 THEN p.payload_json END AS payload_json
    FROM discovered d JOIN payloads p ON p.k = d.k""",
    DISCOVERY_CTES,
)
def enrich_lookup_join(spark, sf):
    look = J.lookup_payloads(discovered(spark, sf), payload_table(spark, sf))
    found = look.found.select("model_id", F.lit("found").alias("side"), "payload_json")
    missing = look.missing_payload.select("model_id", F.lit("missing").alias("side"))
    return found.unionByName(missing, allowMissingColumns=True)


@query(
    "reconcile_counts",
    """SELECT COALESCE(d.partition_no, a.partition_no) AS partition_id, d.declared AS records_count,
      COALESCE(a.actual, 0) AS actual_count, d.declared IS DISTINCT FROM COALESCE(a.actual, 0) AS mismatch
    FROM (SELECT partition_no, COUNT(*) AS declared FROM attempts WHERE partition_no <> 3 GROUP BY 1) d
    FULL JOIN (SELECT partition_no, COUNT(*) AS actual FROM attempts
      WHERE partition_no <> 5 AND NOT (partition_no = 2 AND outcome = 'FAILED') GROUP BY 1) a
    ON a.partition_no = d.partition_no""",
)
def reconcile_counts(spark, sf):
    rows = relation(spark, sf, "attempts").withColumnRenamed("partition_no", "partition_id")
    declared = rows.where("partition_id <> 3").groupBy("partition_id")
    declared = declared.agg(F.count(F.lit(1)).alias("records_count"))
    kept = rows.where("partition_id <> 5 AND NOT (partition_id = 2 AND outcome = 'FAILED')")
    return J.reconcile_counts(declared, kept)


@query(
    "reconcile_content",
    """SELECT CAST(part AS BIGINT) AS partition_id, CASE WHEN part <> 6 THEN n END AS records_count, CASE WHEN part <> 7 THEN n ELSE 0 END AS actual_count,
      part IN (3, 5, 6, 7) AS mismatch, part IN (3, 5) AS altered
    FROM (SELECT o_orderkey % 16 AS part, COUNT(*) AS n FROM orders GROUP BY 1)""",
)
def reconcile_content(spark, sf):
    """Equal counts, but prices of two rows swapped in one partition and one row altered in another."""
    declared = table(spark, sf, "orders").withColumn("partition_id", F.col("o_orderkey") % 16)
    columns = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    ends = declared.groupBy("partition_id").agg(
        F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"),
        F.min_by("o_totalprice", "o_orderkey").alias("low_price"), F.max_by("o_totalprice", "o_orderkey").alias("high_price"),
    )
    low, high = F.col("o_orderkey") == F.col("low"), F.col("o_orderkey") == F.col("high")
    swapped = F.when(low, F.col("high_price")).when(high, F.col("low_price")).otherwise(F.col("o_totalprice"))
    actual = declared.join(ends, "partition_id").withColumns(
        {
            "o_totalprice": F.when(F.col("partition_id") == 3, swapped).otherwise(F.col("o_totalprice")),
            "o_orderstatus": F.when((F.col("partition_id") == 5) & low, F.lit(None)).otherwise(F.col("o_orderstatus")),
        }
    )
    key = ["partition_id"]
    # The actual rows come in batches, whose digests are merged.
    batches = D.content_digests(actual.where("partition_id <> 7").withColumn("batch", F.col("o_orderkey") % 3), [*key, "batch"], columns)
    return D.reconcile_content(D.content_digests(declared.where("partition_id <> 6"), key, columns), D.merged(batches, key), key)


@query(
    "shard_range_join",
    "SELECT shard_id, o_orderkey, o_totalprice, o_orderstatus FROM sharded",
    SHARDED_CTES,
)
def shard_range_join(spark, sf):
    return sharded_orders(spark, sf).select("shard_id", "o_orderkey", "o_totalprice", "o_orderstatus")


@query(
    "shard_range_scan",
    """SELECT shard_id, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY o_totalprice, o_orderkey) AS rn FROM hits) WHERE rn <= 100""",
    SHARDED_CTES,
)
def shard_range_scan(spark, sf):
    facts = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    hits = J.in_ranges(facts, J.emission_ranges(spark), "o_totalprice", stored=True)
    order = [F.asc("o_totalprice"), F.asc("o_orderkey")]
    return R.first_n_per_key(hits, ["shard_id"], order, 100).select(
        "shard_id", "o_orderkey", "o_totalprice"
    )


@query(
    "many_ranges_join",
    """SELECT lo.p_partkey, COUNT(*) AS orders_in_range FROM part lo JOIN orders
      ON o_totalprice >= lo.p_retailprice * 50 AND o_totalprice < lo.p_retailprice * 50 + 2000 GROUP BY lo.p_partkey""",
)
def many_ranges_join(spark, sf):
    """The sweep form, which takes ranges too many to broadcast."""
    facts = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    hits = J.sweep_join(facts, price_ranges(spark, sf), "o_totalprice", stored=True)
    return hits.groupBy(F.col("shard_id").alias("p_partkey")).agg(
        F.count(F.lit(1)).alias("orders_in_range")
    )


def price_ranges(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("shard_id"),
        (F.col("p_retailprice") * 50).alias("min_emissions"),
        (F.col("p_retailprice") * 50 + 2000).alias("max_emissions"),
    )


@query(
    "many_ranges_count",
    """SELECT lo.p_partkey, COUNT(o_orderkey) AS orders_in_range FROM part lo LEFT JOIN orders
      ON o_totalprice >= lo.p_retailprice * 50 AND o_totalprice < lo.p_retailprice * 50 + 2000 GROUP BY lo.p_partkey""",
)
def many_ranges_count(spark, sf):
    """Counts of all ranges from positions alone, empty ranges too."""
    facts = table(spark, sf, "orders").select("o_totalprice")
    counted = J.count_in_ranges(facts, price_ranges(spark, sf), "o_totalprice")
    return counted.select(F.col("shard_id").alias("p_partkey"), F.col("facts_count").alias("orders_in_range"))


@query(
    "incremental_anti",
    "SELECT k, model_id FROM payloads WHERE k NOT IN (SELECT k FROM enrich_log WHERE status = 'F')",
)
def incremental_anti(spark, sf):
    done = relation(spark, sf, "enrich_log").where("status = 'F'")
    rows = relation(spark, sf, "payloads").select("k", "model_id")
    return J.not_yet_done(rows, done, "k")


@query(
    "history_anti",
    "SELECT k, model_id FROM payloads WHERE k NOT IN (SELECT k FROM enrich_log WHERE attempt_id % 4 <> 3)",
)
def history_anti(spark, sf):
    """Models that none of three runs has worked, by a table in which the runs' keys are kept in buckets."""
    rows = relation(spark, sf, "payloads").select("k", "model_id")
    return history.not_yet_kept(rows, three_runs(spark, sf))


def three_runs(spark, sf):
    kept = history.KeyedTable(fresh_path(spark, "history"), ("k",), 8)
    log = relation(spark, sf, "enrich_log")
    for run in range(3):
        history.merge_latest(kept, log.where(F.col("attempt_id") % 4 == run), ["attempt_id"])
    return kept


@query(
    "history_latest",
    """SELECT k, attempt_id, status, value FROM (
      SELECT *, row_number() OVER (PARTITION BY k ORDER BY attempt_id DESC) AS rn FROM enrich_log WHERE attempt_id % 4 <> 3) WHERE rn = 1""",
)
def history_latest(spark, sf):
    """The newest row of each model after three merges, each of which shuffles its own rows only."""
    return three_runs(spark, sf).read(spark).select("k", "attempt_id", "status", "value")


@query(
    "reprocess_semi",
    "SELECT k, model_id FROM payloads WHERE k IN (SELECT k FROM enrich_log WHERE status = 'P')",
)
def reprocess_semi(spark, sf):
    failed = relation(spark, sf, "enrich_log").where("status = 'P'")
    rows = relation(spark, sf, "payloads").select("k", "model_id")
    return J.to_reprocess(rows, failed, "k")


# Aggregations -----------------------------------------------------------------------


@query(
    "dedup_last_wins",
    """SELECT k, attempt_id, status, value FROM (
      SELECT *, row_number() OVER (PARTITION BY k ORDER BY attempt_id DESC) AS rn FROM enrich_log) WHERE rn = 1""",
)
def dedup_last_wins(spark, sf):
    rows = relation(spark, sf, "enrich_log").select("k", "attempt_id", "status", "value")
    return R.last_write_wins(rows, ["k"], ["attempt_id"])


@query("count_by_status", 'SELECT status, COUNT(*) AS "count" FROM bronze GROUP BY status', SHARDED_CTES)
def count_by_status(spark, sf):
    return A.count_by(order_bronze(spark, sf), "status")


@query("count_by_shard", 'SELECT shard_id, COUNT(*) AS "count" FROM bronze GROUP BY shard_id', SHARDED_CTES)
def count_by_shard(spark, sf):
    return A.count_by(order_bronze(spark, sf), "shard_id").orderBy("shard_id")


@query(
    "duplicate_models",
    """SELECT run_id, shard_id, model_key, "count" FROM (
      SELECT b.run_id, b.shard_id, o.o_custkey AS model_key, COUNT(*) AS "count" FROM bronze b
      JOIN orders o ON o.o_orderkey = b.model_key WHERE b.status = 'ok' GROUP BY ALL) WHERE "count" > 1""",
    SHARDED_CTES,
)
def duplicate_models(spark, sf):
    facts = table(spark, sf, "orders").where("o_orderstatus <> 'P'")
    facts = facts.select(F.col("o_custkey").alias("model_key"), "o_totalprice")
    hits = J.in_ranges(facts, J.emission_ranges(spark), "o_totalprice", stored=True)
    rows = hits.withColumn("run_id", F.lit("20260101T000000Z"))
    return A.duplicates(rows, "run_id", "shard_id", "model_key")


@query("total_records", "SELECT COUNT(*) AS total_records FROM bronze", SHARDED_CTES)
def total_records(spark, sf):
    return A.total(order_bronze(spark, sf))


@query(
    "chunk_boundaries",
    "SELECT chunk, start_index, end_index, records_count, emission_min, emission_max FROM bounds",
    CHUNK_CTES,
)
def chunk_boundaries(spark, sf):
    return R.chunk_bounds(chunked(spark, sf))


@query("partition_metrics", METRICS_SQL)
def partition_metrics(spark, sf):
    return metrics(spark, sf)


def quantile_sql(column: str, table_name: str) -> str:
    return f"""SELECT CAST(i AS INTEGER) AS shard_id, round(q[i + 1], 6) AS min_emissions, round(q[i + 2], 6) AS max_emissions
    FROM (SELECT quantile_cont({column}, [0.0, 0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875, 1.0]) AS q FROM {table_name}),
      range(8) t(i)"""


def as_shards(bounds):
    upper = bounds.select((F.col("step") - 1).alias("step"), F.col("bound").alias("upper"))
    return bounds.join(upper, "step").select(
        F.col("step").alias("shard_id"),
        F.round("bound", 6).alias("min_emissions"),
        F.round("upper", 6).alias("max_emissions"),
    )


@query("quantile_shards", quantile_sql("p_retailprice", "part"))
def quantile_shards(spark, sf):
    return as_shards(R.exact_quantiles(table(spark, sf, "part"), "p_retailprice", 8))


@query("quantile_shards_sketched", quantile_sql("l_extendedprice", "lineitem"))
def quantile_shards_sketched(spark, sf):
    """Exact bounds from the stored sketches of seven snapshots and one counting pass."""
    lines = table(spark, sf, "lineitem").select(F.pmod("l_orderkey", F.lit(7)).alias("snapshot"), "l_extendedprice")
    sketches = write_through(sketches_of.value_sketches(lines, "l_extendedprice", ["snapshot"]), "sketches")
    return as_shards(sketches_of.sketched_quantiles(lines, "l_extendedprice", 8, sketches))


@query(
    "discovery_totals",
    """SELECT 's' AS snapshot_id, COUNT(*) AS total_models_seen,
      CAST(SUM(CASE WHEN has_emission THEN 1 ELSE 0 END) AS BIGINT) AS models_with_emissions,
      COUNT(DISTINCT CASE WHEN has_emission THEN k END) AS final_rows_count FROM page_log""",
)
def discovery_totals(spark, sf):
    return A.discovery_totals(page_rows(spark, sf), "has_emission", "k")


@query("distinct_shards", "SELECT DISTINCT shard_id FROM bronze WHERE status <> 'empty'", SHARDED_CTES)
def distinct_shards(spark, sf):
    rows = order_bronze(spark, sf).where("status <> 'empty'")
    return rows.select("shard_id").distinct().orderBy("shard_id")


# Set operations ---------------------------------------------------------------------


@query(
    "union_parts",
    "SELECT attempt_id, k, status FROM enrich_log",
)
def union_parts(spark, sf):
    path = fresh_path(spark, "union")
    log = relation(spark, sf, "enrich_log").select("attempt_id", "k", "status")
    paths = []
    for status in ("F", "O", "P"):
        paths.append(f"{path}/{status}")
        log.where(F.col("status") == status).write.parquet(paths[-1])
    return spark.read.schema(log.schema).parquet(*paths)


@query(
    "append_runs",
    "SELECT run, COUNT(*) AS run_rows, CAST(SUM(attempt_id) AS BIGINT) AS id_sum FROM ("
    "SELECT 'first' AS run, attempt_id FROM enrich_log UNION ALL "
    "SELECT 'retry' AS run, attempt_id FROM enrich_log WHERE status = 'P') GROUP BY run",
)
def append_runs(spark, sf):
    path = fresh_path(spark, "append")
    log = relation(spark, sf, "enrich_log")
    log.withColumn("run", F.lit("first")).write.mode("append").partitionBy("run").parquet(path)
    retry = log.where("status = 'P'").withColumn("run", F.lit("retry"))
    retry.write.mode("append").partitionBy("run").parquet(path)
    return spark.read.parquet(path).groupBy("run").agg(
        F.count(F.lit(1)).alias("run_rows"), F.sum("attempt_id").alias("id_sum")
    )


@query(
    "retry_shards",
    """SELECT shard_id FROM ranges EXCEPT
    SELECT shard_id FROM bronze GROUP BY shard_id HAVING COUNT(*) FILTER (status <> 'ok') = 0""",
    SHARDED_CTES,
)
def retry_shards(spark, sf):
    done = order_bronze(spark, sf).groupBy("shard_id").agg(
        F.count_if(F.col("status") != "ok").alias("_open")
    )
    shards = J.emission_ranges(spark).select("shard_id")
    return J.not_yet_done(shards, done.where("_open = 0"), "shard_id")


@query(
    "udtf_shard_expand",
    """SELECT shard_id, status, CASE WHEN status = 'error' THEN 'ValueError: unreadable payload_json' END AS error,
      COUNT(*) AS status_rows, COUNT(*) FILTER (status = 'ok') AS models
    FROM (SELECT *, CASE WHEN k IS NULL THEN 'empty' WHEN k % 5 = 0 THEN 'error' ELSE 'ok' END AS status FROM card_bronze)
    GROUP BY shard_id, status""",
    (
        CARDS,
        """
card_hits AS (
  SELECT shard_id, k FROM emitting
  JOIN ranges ON emission >= min_emissions AND (max_emissions IS NULL OR emission < max_emissions)),
card_bronze AS (
  SELECT * FROM card_hits UNION ALL
  SELECT shard_id, NULL FROM ranges WHERE shard_id NOT IN (SELECT shard_id FROM card_hits))""",
    ),
)
def udtf_shard_expand(spark, sf):
    """One range row in, many status rows out, failures among them, without a Python function."""
    facts = emission_facts(spark, sf).withColumn(
        "payload_json", F.when(F.col("k") % 5 == 0, "!").otherwise(F.col("payload_json"))
    )
    sharded = J.shard_by_range(facts, J.emission_ranges(spark), "emission")
    shown = J.capture_errors(sharded, "payload_json", {"doc_model": F.try_variant_get("_doc", "$.id", "string")})
    return shown.groupBy("shard_id", "status", "error").agg(
        F.count(F.lit(1)).alias("status_rows"), F.count("doc_model").alias("models")
    )


@query(
    "error_capture",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'error' ELSE 'ok' END AS status,
      CASE WHEN event_id % 3 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS value,
      CASE WHEN event_id % 3 = 0 THEN 'ValueError: unreadable props' END AS error FROM events""",
)
def error_capture(spark, sf):
    """A row that cannot be read becomes a status row; the job goes on."""
    broken = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("!"), "props")).otherwise(F.col("props"))
    rows = table(spark, sf, "events").select("event_id", broken.alias("props"))
    value = F.try_variant_get("_doc", "$.k", "bigint")
    return J.capture_errors(rows, "props", {"value": value}).drop("props")
