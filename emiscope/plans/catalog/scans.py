"""Scans and sinks. Each writes a derived relation, reads it back and returns the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from emiscope.functions import payload as P
from emiscope.functions.text import padded_id, parse_float
from emiscope.operators import aggregates as A
from emiscope.operators import control as K
from emiscope.operators import joins as J
from emiscope.operators import ranking as R
from emiscope.operators import rows as W
from emiscope.plans.catalog.base import (
    DISCOVERY_CTES, ENRICHED_CTES, RUN, STAMP, query,
)
from emiscope.plans.fixtures import relation, table
from emiscope.plans.jobs import prepare_order
from emiscope.schemas import (
    CHUNK_SCHEMA, DISCOVERY_TEXT_SCHEMA, ENRICHED_SCHEMA,
)
from emiscope.session import fresh_path, write_through
from emiscope.sources import drift, readers, writers

def discovered(spark, sf, keep=("k",)):
    return W.discovery_rows(relation(spark, sf, "payloads"), RUN, STAMP, keep=keep)


def enriched(spark, sf):
    """Discovery rows with their payload, for models whose payload can be found."""
    found = discovered(spark, sf, keep=("k", "payload_json")).where("k % 11 <> 0")
    return W.enriched_rows(found, RUN, padded_id(F.col("k") % 8), F.lit(STAMP), keep=("k",))


def sharded_orders(spark, sf):
    """Orders by the emission range their total falls in, empty ranges included."""
    facts = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return J.shard_by_range(facts, J.emission_ranges(spark), "o_totalprice", stored=True)


def order_bronze(spark, sf):
    """A slim bronze table over orders with an ok / error / empty status."""
    return sharded_orders(spark, sf).select(
        F.lit(RUN).alias("run_id"),
        "shard_id",
        F.col("o_orderkey").alias("model_key"),
        F.col("o_totalprice").alias("emission"),
        F.when(F.col("o_orderkey").isNull(), "empty")
        .when(F.col("o_orderstatus") == "P", "error")
        .otherwise("ok")
        .alias("status"),
    )


SHARDED = """
hits AS (
  SELECT shard_id, o_orderkey, o_totalprice, o_orderstatus FROM orders
  JOIN ranges ON o_totalprice >= min_emissions AND (max_emissions IS NULL OR o_totalprice < max_emissions)),
sharded AS (
  SELECT * FROM hits UNION ALL
  SELECT shard_id, NULL, NULL, NULL FROM ranges WHERE shard_id NOT IN (SELECT shard_id FROM hits)),
bronze AS (
  SELECT '20260101T000000Z' AS run_id, shard_id, o_orderkey AS model_key, o_totalprice AS emission,
    CASE WHEN o_orderkey IS NULL THEN 'empty' WHEN o_orderstatus = 'P' THEN 'error' ELSE 'ok' END AS status
  FROM sharded)"""
SHARDED_CTES = (SHARDED,)

SLIM_BRONZE = "run_id STRING, shard_id INT, model_key BIGINT, emission DOUBLE, status STRING"


# Scans ------------------------------------------------------------------------------


@query(
    "scan_csv_required",
    "SELECT model_id, co2_eq_emissions, tags, training_type, downloads FROM discovered",
    DISCOVERY_CTES,
)
def scan_csv_required(spark, sf):
    path = fresh_path(spark, "csv")
    writers.write_csv(discovered(spark, sf, keep=()), path)
    read = readers.read_header_csv(spark, path)
    return read.select(
        "model_id",
        parse_float(F.col("co2_eq_emissions")).alias("co2_eq_emissions"),
        "tags",
        "training_type",
        F.col("downloads").cast("bigint").alias("downloads"),
    )


@query(
    "scan_jsonl_glob",
    'SELECT "modelId", datasets, size, partition_id, performance_score FROM enriched',
    ENRICHED_CTES,
)
def scan_jsonl_glob(spark, sf):
    path = fresh_path(spark, "jsonl")
    rows = enriched(spark, sf).drop("k").withColumn("dir", F.col("partition_id"))
    rows.write.partitionBy("dir").json(path)
    read = readers.read_json_lines(spark, f"{path}/dir=*/*.json", ENRICHED_SCHEMA)
    return read.select("modelId", "datasets", "size", "partition_id", "performance_score")


@query(
    "scan_partitioned_run",
    "SELECT run_id, shard_id, model_key, emission, status FROM bronze",
    SHARDED_CTES,
)
def scan_partitioned_run(spark, sf):
    path = fresh_path(spark, "runs")
    rows = writers.gathered(order_bronze(spark, sf), "run_id", "shard_id")
    writers.append_json(rows, path, "run_id", "shard_id")
    writers.append_json(rows.withColumn("run_id", F.lit("other")), path, "run_id", "shard_id")
    read = readers.read_run(spark, path, SLIM_BRONZE, RUN)
    return read.select("run_id", "shard_id", "model_key", "emission", "status")


@query(
    "emission_ranges",
    "SELECT r.shard_id, r.min_emissions, r.max_emissions, COUNT(h.o_orderkey) AS models "
    "FROM ranges r LEFT JOIN hits h ON h.shard_id = r.shard_id GROUP BY ALL",
    SHARDED_CTES,
)
def emission_ranges(spark, sf):
    rows = J.shard_by_range(
        table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
        J.emission_ranges(spark),
        "o_totalprice",
    )
    return rows.groupBy("shard_id", "min_emissions", "max_emissions").agg(
        F.count("o_orderkey").alias("models")
    )


@query(
    "scan_parts_union",
    "SELECT k % 5 AS part_number, model_id, co2_eq_emissions FROM discovered",
    DISCOVERY_CTES,
)
def scan_parts_union(spark, sf):
    path = fresh_path(spark, "parts")
    rows = discovered(spark, sf).withColumn("part_number", F.col("k") % 5).drop("k")
    writers.write_csv_parts(rows, path, directory_per_part=True)
    read = readers.read_csv_parts(spark, path, DISCOVERY_TEXT_SCHEMA)
    return read.select(
        F.regexp_extract("part_file", r"part_number=(\d+)", 1).cast("bigint").alias("part_number"),
        "model_id",
        parse_float(F.col("co2_eq_emissions")).alias("co2_eq_emissions"),
    )


MANIFEST = """
SELECT 'run-1' AS run_id, COUNT(*) AS events, COUNT(DISTINCT partition_no) AS partitions,
  CAST(SUM(CASE WHEN outcome = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed FROM attempts"""


@query("scan_manifest_json", MANIFEST)
def scan_manifest_json(spark, sf):
    path = fresh_path(spark, "document")
    attempts = relation(spark, sf, "attempts")
    summary = attempts.agg(
        F.lit("run-1").alias("run_id"),
        F.count(F.lit(1)).alias("events"),
        F.countDistinct("partition_no").alias("partitions"),
        F.count_if(F.col("outcome") == "FAILED").alias("failed"),
    )
    writers.write_json(summary, path)
    schema = "run_id STRING, events BIGINT, partitions BIGINT, failed BIGINT"
    return readers.read_document(spark, path, schema)


@query(
    "control_prefix_scan",
    """SELECT 'RUN#run-1' AS "PK", 'PARTITION#' || lpad(CAST(partition_no AS VARCHAR), 6, '0') AS "SK",
      COUNT(*) AS records_count FROM attempts WHERE partition_no % 2 = 1 GROUP BY partition_no""",
)
def control_prefix_scan(spark, sf):
    attempts = relation(spark, sf, "attempts")
    run = F.concat(F.lit("RUN#run-"), (F.col("partition_no") % 2).cast("string"))
    items = attempts.groupBy("partition_no").agg(F.count(F.lit(1)).alias("records_count"))
    control = items.select(
        run.alias("PK"),
        F.concat(F.lit("PARTITION#"), padded_id(F.col("partition_no"))).alias("SK"),
        "records_count",
    )
    meta = attempts.agg(
        F.lit("RUN#run-1").alias("PK"), F.lit("META").alias("SK"), F.count(F.lit(1)).alias("records_count")
    )
    path = fresh_path(spark, "control")
    control.unionByName(meta).write.partitionBy("PK").parquet(path)
    return K.prefix_scan(spark.read.parquet(path), "RUN#run-1", "PARTITION#").select(
        "PK", "SK", "records_count"
    )


# Sinks ------------------------------------------------------------------------------


@query(
    "sink_json_partitioned",
    "SELECT run_id, shard_id, COUNT(*) AS rows_written, COUNT(model_key) AS models FROM bronze GROUP BY ALL",
    SHARDED_CTES,
)
def sink_json_partitioned(spark, sf):
    path = fresh_path(spark, "bronze")
    rows = writers.gathered(order_bronze(spark, sf), "run_id", "shard_id")
    writers.append_json(rows, path, "run_id", "shard_id")
    read = spark.read.schema(SLIM_BRONZE).json(path)
    return read.groupBy("run_id", "shard_id").agg(
        F.count(F.lit(1)).alias("rows_written"), F.count("model_key").alias("models")
    )


@query(
    "sink_parquet_overwrite",
    "SELECT attempt_id, k, status, value FROM enrich_log",
)
def sink_parquet_overwrite(spark, sf):
    path = fresh_path(spark, "gold")
    rows = relation(spark, sf, "enrich_log")
    writers.overwrite_parquet(rows, path)
    writers.overwrite_parquet(rows, path)
    return spark.read.parquet(path).select("attempt_id", "k", "status", "value")


@query(
    "sink_csv_export",
    """SELECT model_id, '[' || COALESCE(array_to_string(list_transform(
        CAST(datasets AS VARCHAR[]), lambda x: x), ', '), '') || ']' AS datasets_list,
      CASE WHEN metrics_text = '' THEN NULL ELSE metrics_text END AS performance_metrics
    FROM detailed""",
    ENRICHED_CTES,
)
def sink_csv_export(spark, sf):
    doc, card = F.col("_doc"), F.col("_card")
    rows = relation(spark, sf, "payloads").withColumn("_doc", P.parsed(F.col("payload_json")))
    rows = rows.withColumn("_card", P.card(doc)).withColumn("_key", P.metrics_key(card))
    rows = rows.select(
        "model_id",
        P.dataset_list(P.dataset_entry(doc, card)).alias("datasets_list"),
        P.metrics_text(
            F.col("payload_json"), doc, F.col("_key"), P.metrics_entry(card, F.col("_key"))
        ).alias("performance_metrics"),
    )
    path = fresh_path(spark, "export")
    writers.export_csv(W.gold_export(rows), path)
    reader = spark.read.schema("model_id STRING, datasets_list STRING, performance_metrics STRING")
    return reader.option("header", True).option("sep", ";").option("escape", '"').csv(path)


@query(
    "sink_snapshot_dataset",
    "SELECT '2026-01-01' AS snapshot_date, attempt_id, value FROM enrich_log WHERE status <> 'P' UNION ALL "
    "SELECT '2026-01-02' AS snapshot_date, attempt_id, value FROM enrich_log WHERE status = 'P'",
)
def sink_snapshot_dataset(spark, sf):
    path = fresh_path(spark, "snapshots")
    log = relation(spark, sf, "enrich_log").select("attempt_id", "value", "status")
    first = log.where("status <> 'P'").drop("status")
    second = log.where("status = 'P'").drop("status")
    writers.write_snapshot(W.stamp_snapshot(second, "2025-12-31").drop("ingested_at_utc"), path, True)
    writers.write_snapshot(W.stamp_snapshot(first, "2026-01-01").drop("ingested_at_utc"), path, True)
    writers.write_snapshot(W.stamp_snapshot(second, "2026-01-02").drop("ingested_at_utc"), path, False)
    read = spark.read.schema("attempt_id BIGINT, value DOUBLE, snapshot_date STRING").parquet(path)
    return read.select("snapshot_date", "attempt_id", "value")


@query(
    "sink_jsonl_batches",
    """SELECT partition_id, CAST(ceil(rn / 50.0) AS BIGINT) AS batch, COUNT(*) AS batch_rows,
        MIN(event_id) AS first_event, MAX(event_id) AS last_event FROM (
      SELECT lpad(CAST(partition_no AS VARCHAR), 6, '0') AS partition_id, event_id,
        row_number() OVER (PARTITION BY partition_no ORDER BY event_id) AS rn
      FROM attempts WHERE outcome = 'COMPLETED') GROUP BY ALL""",
)
def sink_jsonl_batches(spark, sf):
    path = fresh_path(spark, "batches")
    rows = relation(spark, sf, "attempts").where("outcome = 'COMPLETED'").select(
        padded_id(F.col("partition_no")).alias("partition_id"), "event_id", "value"
    )
    numbered = A.batch_numbers(rows, ["partition_id"], [F.asc("event_id")])
    writers.write_batches(numbered, path, ["partition_id"])
    read = spark.read.schema("event_id BIGINT, partition_id STRING, batch BIGINT").json(path)
    return read.groupBy("partition_id", "batch").agg(
        F.count(F.lit(1)).alias("batch_rows"),
        F.min("event_id").alias("first_event"),
        F.max("event_id").alias("last_event"),
    )


# Part of each page by recursion over pages, one page at a time.
SEGMENTS = """
page_counts AS (
  SELECT page, CAST(SUM(CASE WHEN has_emission THEN 1 ELSE 0 END) AS BIGINT) AS page_matches,
    COUNT(*) AS page_size FROM page_log GROUP BY page),
page_walk AS (
  SELECT page, page_matches, row_number() OVER (ORDER BY page) AS n FROM page_counts),
fold AS (
  SELECT n, page, page_matches, page_matches AS pending_in, CAST(1 AS BIGINT) AS part,
    page_matches > 0 AND (page % 5 = 0 OR page_matches >= 100) AS flush FROM page_walk WHERE n = 1
  UNION ALL
  SELECT w.n, w.page, w.page_matches,
    CASE WHEN f.flush THEN 0 ELSE f.pending_in END + w.page_matches,
    CASE WHEN f.flush THEN f.part + 1 ELSE f.part END,
    CASE WHEN f.flush THEN 0 ELSE f.pending_in END + w.page_matches > 0
      AND (w.page % 5 = 0 OR CASE WHEN f.flush THEN 0 ELSE f.pending_in END + w.page_matches >= 100)
  FROM fold f JOIN page_walk w ON w.n = f.n + 1),
segments AS (
  SELECT 's' AS snapshot_id, page, page_matches, CASE WHEN page_matches > 0 THEN part END AS part_number FROM fold)"""
SEGMENT_CTES = (SEGMENTS,)


def page_rows(spark, sf):
    return relation(spark, sf, "page_log").withColumn("snapshot_id", F.lit("s"))


def segments(spark, sf):
    pages = page_rows(spark, sf).groupBy("snapshot_id", "page").agg(
        F.count(F.lit(1)).alias("page_size"), F.count_if("has_emission").alias("page_matches")
    )
    return A.flush_segments(pages)


@query(
    "sink_csv_parts",
    """SELECT part_number, seq, k, '  <' || CAST(k AS VARCHAR) || chr(10) || '"' AS cell
    FROM page_log p JOIN segments s ON s.page = p.page WHERE has_emission""",
    SEGMENT_CTES,
)
def sink_csv_parts(spark, sf):
    path = fresh_path(spark, "parts")
    rows = page_rows(spark, sf).where("has_emission").select("page", "seq", "k")
    parts = segments(spark, sf).select("page", "part_number")
    cell = F.concat(F.lit("  <"), F.col("k").cast("string"), F.lit('\n"')).alias("cell")
    writers.write_csv_parts(rows.join(parts, "page").select("seq", "k", cell, "part_number"), path)
    layout = "seq BIGINT, k BIGINT, cell STRING, part_number BIGINT"
    return readers.read_csv_parts(spark, path, layout).drop("part_file")


@query(
    "sink_snapshot_latest",
    "SELECT place, model_id, co2_eq_emissions, likes FROM discovered, (VALUES ('snapshot'), ('latest')) t(place)",
    DISCOVERY_CTES,
)
def sink_snapshot_latest(spark, sf):
    path = fresh_path(spark, "publish")
    writers.publish(discovered(spark, sf, keep=()), f"{path}/snapshot", f"{path}/latest")

    def read(place):
        rows = readers.read_discovery(spark, f"{path}/{place}", "parquet")
        return rows.select(
            F.lit(place).alias("place"),
            "model_id",
            "co2_eq_emissions",
            "likes",
        )

    return read("snapshot").unionByName(read("latest"))


@query(
    "sink_dead_letter",
    f"""SELECT '{RUN}' AS run_id, lpad(CAST(partition_no AS VARCHAR), 6, '0') AS partition_id,
      CAST(event_id AS VARCHAR) AS model_id, 'RuntimeError' AS error_type, props AS error_message,
      '{STAMP}' AS failed_at FROM attempts WHERE outcome = 'FAILED'""",
)
def sink_dead_letter(spark, sf):
    path = fresh_path(spark, "errors")
    failed = relation(spark, sf, "attempts").where("outcome = 'FAILED'")
    failed = failed.withColumn("model_id", F.col("event_id").cast("string"))
    pid = padded_id(F.col("partition_no"))
    rows = W.error_rows(failed, RUN, pid, F.lit("RuntimeError"), F.col("props"), F.lit(STAMP))
    writers.write_json(rows, path)
    return readers.read_json_lines(spark, path, ", ".join(f"{c} STRING" for c in rows.columns))


METRICS_SQL = """
SELECT lpad(CAST(partition_no AS VARCHAR), 6, '0') AS partition_id, COUNT(*) AS input_count,
  COUNT(*) AS processed_count,
  CAST(SUM(CASE WHEN outcome = 'COMPLETED' THEN 1 ELSE 0 END) AS BIGINT) AS success_count,
  CAST(SUM(CASE WHEN outcome = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed_count,
  COUNT(*) AS api_calls_count,
  CAST(ceil(SUM(CASE WHEN outcome = 'COMPLETED' THEN 1 ELSE 0 END) / 50.0) AS BIGINT) AS batches_written
FROM attempts GROUP BY partition_no"""


def metrics(spark, sf):
    attempts = relation(spark, sf, "attempts")
    attempts = attempts.withColumn("partition_id", padded_id(F.col("partition_no")))
    return A.partition_metrics(
        attempts, ["partition_id"], F.col("outcome") == "COMPLETED", F.lit(True)
    )


@query("sink_run_metrics", METRICS_SQL)
def sink_run_metrics(spark, sf):
    path = fresh_path(spark, "metrics")
    rows = metrics(spark, sf)
    writers.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


# Chunks of the discovered models, most used first.
CHUNKED = """
ordered AS (
  SELECT *, row_number() OVER (ORDER BY downloads DESC, likes DESC, co2_eq_emissions DESC, model_id) - 1 AS idx
  FROM discovered),
chunked AS (SELECT *, CAST(idx // 250 AS BIGINT) AS chunk, lpad(CAST(idx // 250 AS VARCHAR), 6, '0') AS partition_id
  FROM ordered),
bounds AS (
  SELECT chunk, partition_id, MIN(idx) AS start_index, MAX(idx) + 1 AS end_index, COUNT(*) AS records_count,
    MIN(co2_eq_emissions) AS emission_min, MAX(co2_eq_emissions) AS emission_max
  FROM chunked GROUP BY chunk, partition_id)"""
CHUNK_CTES = (*DISCOVERY_CTES, CHUNKED)


def discovered_table(spark, sf, keep=("k",)):
    """Discovery rows written out: a range sort reads its input twice, payloads only once."""
    return write_through(discovered(spark, sf, keep), "discovered")


def chunked(spark, sf):
    size = R.chunk_rows(1000, 4)
    rows = R.assign_chunks(discovered_table(spark, sf), prepare_order(), size)
    return rows.withColumn("partition_id", padded_id(F.col("chunk")))


def settings(spark):
    return K.PrepareSettings(run_id=RUN, source_path="/source.csv", prepared_path="/prepared")


@query(
    "sink_chunk_csv",
    "SELECT partition_id, model_id, co2_eq_emissions, downloads, tags FROM chunked",
    CHUNK_CTES,
)
def sink_chunk_csv(spark, sf):
    path = fresh_path(spark, "chunks")
    writers.write_chunks(chunked(spark, sf), path, form="csv")
    schema = f"{DISCOVERY_TEXT_SCHEMA}, partition_id STRING"
    read = readers.read_csv_parts(spark, path, schema)
    return read.select(
        "partition_id",
        "model_id",
        parse_float(F.col("co2_eq_emissions")).alias("co2_eq_emissions"),
        F.col("downloads").cast("bigint").alias("downloads"),
        "tags",
    )


@query(
    "sink_manifest",
    f"""SELECT '{RUN}' AS run_id, 'PREPARED' AS status, (SELECT COUNT(*) FROM bounds) AS partitions_count,
      partition_id, '/prepared/chunks/partition_id=' || partition_id AS input_path, records_count, emission_min, emission_max
    FROM bounds""",
    CHUNK_CTES,
)
def sink_manifest(spark, sf):
    path = fresh_path(spark, "manifest")
    chunks = K.chunk_descriptors(R.chunk_bounds(chunked(spark, sf)), settings(spark))
    header = {
        "run_id": F.lit(RUN),
        "status": F.lit("PREPARED"),
        "partitions_count": F.count(F.lit(1)),
    }
    writers.write_manifest(chunks, header, path)
    return readers.read_manifest(
        spark, path, "run_id STRING, status STRING, partitions_count BIGINT", CHUNK_SCHEMA
    ).select(
        "run_id", "status", "partitions_count", "partition_id", "input_path", "records_count",
        "emission_min", "emission_max",
    )


@query(
    "sink_progress_events",
    """SELECT CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'rate_limited' ELSE 'result' END AS event,
      COUNT(*) AS events, MAX(event_id) AS last_event FROM events GROUP BY 1""",
)
def sink_progress_events(spark, sf):
    path = fresh_path(spark, "progress")
    kind = (
        F.when(F.col("event_type") == "error", "error")
        .when(F.col("event_type") == "purchase", "rate_limited")
        .otherwise("result")
    )
    events = table(spark, sf, "events").select(kind.alias("event"), "event_id", "props")
    writers.append_events(events.where("event = 'result'"), path)
    writers.append_events(events.where("event <> 'result'"), path)
    read = spark.read.schema("event STRING, event_id BIGINT, props STRING").json(path)
    return read.groupBy("event").agg(
        F.count(F.lit(1)).alias("events"), F.max("event_id").alias("last_event")
    )


# Documents whose fields differ from run to run, and the same documents' structure in the oracle.
DRIFT = """
drifting AS (
  SELECT 'r' || CAST(k % 3 AS VARCHAR) AS run_id, payload_json FROM payloads WHERE k % 3 < 2 OR k % 4 <> 0),
structures AS (SELECT run_id, json_group_structure(CAST(payload_json AS JSON)) AS structure FROM drifting GROUP BY run_id),
drift_fields AS (
  SELECT run_id, replace(replace(substr(t.fullkey, 3), '[0]', '[]'), '"', '') AS field,
    CASE t.type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'list'
      ELSE CASE json_extract_string(t.atom, '$') WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number'
        WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'mixed' END END AS kind
  FROM structures, json_tree(structure) t WHERE t.fullkey <> '$')"""


def drifting(spark, sf):
    """Three runs of documents as stored lines, each in its directory."""
    rows = relation(spark, sf, "payloads").where("k % 3 < 2 OR k % 4 <> 0")
    path = fresh_path(spark, "drift")
    rows.select(F.concat(F.lit("r"), F.col("k") % 3).alias("run_id"), F.col("payload_json").alias("value")).write.partitionBy("run_id").text(path)
    return spark.read.text(path), path


@query(
    "schema_changes",
    """SELECT f.run_id, f.previous, f.field, CASE WHEN b.kind IS NULL THEN 'new' WHEN a.kind IS NULL THEN 'lost'
        WHEN a.kind = b.kind THEN 'same' ELSE 'changed' END AS change, b.kind AS before, a.kind AS after
    FROM (SELECT p.run_id, p.previous, d.field FROM (VALUES ('r1', 'r0'), ('r2', 'r1')) p(run_id, previous)
      JOIN drift_fields d ON d.run_id IN (p.run_id, p.previous) GROUP BY ALL) f
    LEFT JOIN drift_fields a USING (run_id, field) LEFT JOIN drift_fields b ON b.run_id = f.previous AND b.field = f.field""",
    (DRIFT,),
)
def schema_changes(spark, sf):
    lines, _ = drifting(spark, sf)
    shapes = write_through(drift.observed(lines, "value"), "shapes")
    return drift.changes(drift.fields(shapes), shapes)


@query(
    "schema_history",
    """SELECT field, CASE WHEN len(kinds) = 0 THEN 'null' WHEN len(kinds) = 1 THEN kinds[1]
        WHEN len(list_filter(kinds, lambda x: x NOT IN ('integer', 'number'))) = 0 THEN 'number' ELSE 'mixed' END AS kind, runs, first_run, last_run
    FROM (SELECT field, coalesce(list(DISTINCT kind) FILTER (kind <> 'null'), []) AS kinds, COUNT(DISTINCT run_id) AS runs,
      MIN(run_id) AS first_run, MAX(run_id) AS last_run FROM drift_fields GROUP BY field)""",
    (DRIFT,),
)
def schema_history(spark, sf):
    lines, _ = drifting(spark, sf)
    return drift.history(drift.fields(write_through(drift.observed(lines, "value"), "shapes")))


@query(
    "scan_inferred_json",
    """SELECT run_id, json_extract_string(payload_json, '$.id') AS id, CAST(json_extract(payload_json, '$.downloads') AS BIGINT) AS downloads,
      json_extract_string(payload_json, '$.pipeline_tag') AS pipeline_tag, CAST(json_extract(payload_json, '$.safetensors.total') AS BIGINT) AS total,
      CAST(json_array_length(payload_json, '$.siblings') AS INTEGER) AS siblings FROM drifting""",
    (DRIFT,),
)
def scan_inferred_json(spark, sf):
    """Stored lines of all runs, read with the schema that they are found to have."""
    _, path = drifting(spark, sf)
    rows = drift.read_json(spark, path)
    return rows.select(
        "run_id", "id", "downloads", "pipeline_tag", F.col("safetensors.total").alias("total"), F.size("siblings").alias("siblings")
    )
