"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from emiscope.functions import payload as P
from emiscope.functions.text import iso_time, padded_id
from emiscope.operators import control as K
from emiscope.operators import joins as J
from emiscope.operators import rows as W
from emiscope.operators.staging import where_computed
from emiscope.plans.catalog.base import (
    CARDS, DISCOVERY_CTES, ENRICHED_CTES, RUN, STAMP, number, query,
)
from emiscope.plans.catalog.scans import (
    SHARDED_CTES, discovered, enriched, order_bronze,
)
from emiscope.plans.fixtures import relation, table
from emiscope.schemas import BRONZE_COLUMNS, DISCOVERY_COLUMNS, ENRICHED_COLUMNS


@query("discovery_rows", f"SELECT {', '.join(DISCOVERY_COLUMNS)} FROM discovered", DISCOVERY_CTES)
def discovery_rows(spark, sf):
    return discovered(spark, sf, keep=())


@query(
    "enriched_rows",
    "SELECT " + ", ".join(f'"{c}"' for c in ENRICHED_COLUMNS if c not in ("modelId", "model_id"))
    + ', "modelId" AS payload_id, model_id FROM enriched',
    ENRICHED_CTES,
)
def enriched_rows(spark, sf):
    return enriched(spark, sf).drop("k").withColumnRenamed("modelId", "payload_id")


MISSING = "k % 11 = 0"


@query(
    "dead_letter_rows",
    f"""SELECT '{RUN}' AS run_id, lpad(CAST(k % 8 AS VARCHAR), 6, '0') AS partition_id, model_id,
      'LookupError' AS error_type, 'No payload for ' || model_id AS error_message, '{STAMP}' AS failed_at
    FROM discovered WHERE {MISSING}""",
    DISCOVERY_CTES,
)
def dead_letter_rows(spark, sf):
    look = J.lookup_payloads(discovered(spark, sf), relation(spark, sf, "payloads").where("k % 11 <> 0"))
    message = F.concat(F.lit("No payload for "), F.col("model_id"))
    return W.error_rows(
        look.missing_payload, RUN, padded_id(F.col("k") % 8), F.lit("LookupError"), message, F.lit(STAMP)
    )


def emission_facts(spark, sf):
    """Payloads with the number by which a model is put in an emission range."""
    rows = relation(spark, sf, "payloads")
    rows = rows.withColumn("_doc", P.parsed(F.col("payload_json"), P.CARD_KEYS))
    rows = rows.withColumn("_card", P.card(F.col("_doc")))
    co2 = P.co2_object(F.col("_card"))
    return rows.select("k", "model_id", "payload_json", co2["emissions"].alias("emission"))


CARD_SHARDS = """
card_hits AS (
  SELECT shard_id, min_emissions, max_emissions, model_id, em_text, co2, card, j FROM emitting
  JOIN ranges ON emission >= min_emissions AND (max_emissions IS NULL OR emission < max_emissions)),
card_bronze AS (
  SELECT * FROM card_hits UNION ALL
  SELECT shard_id, min_emissions, max_emissions, NULL, NULL, NULL, NULL, NULL FROM ranges
  WHERE shard_id NOT IN (SELECT shard_id FROM card_hits))"""
CARD_SHARD_CTES = (CARDS, CARD_SHARDS)


def card_bronze(spark, sf):
    sharded = J.shard_by_range(emission_facts(spark, sf), J.emission_ranges(spark), "emission")
    return W.bronze_rows(sharded, RUN, ingested_at=F.lit(STAMP).cast("timestamp"))


BRONZE_SELECT = f"""
SELECT '{RUN}' AS run_id, shard_id, model_id, min_emissions AS emissions_threshold_min,
  max_emissions AS emissions_threshold_max, em_text AS co2_emissions,
  json_extract_string(co2, '$.source') AS co2_source,
  json_extract_string(co2, '$.training_type') AS co2_training_type,
  json_extract_string(co2, '$.geographical_location') AS co2_geographical_location,
  json_extract_string(co2, '$.hardware_used') AS co2_hardware_used,
  CASE WHEN model_id IS NULL THEN 'empty' ELSE 'ok' END AS status, CAST(NULL AS VARCHAR) AS error,
  json_extract_string(card, '$.language') AS card_language,
  json_extract_string(j, '$.createdAt') AS raw_created_at
FROM card_bronze"""


def bronze_checked(rows):
    """JSON columns are compared by a member each, as key order differs by engine."""
    shown = [c for c in BRONZE_COLUMNS if c not in ("card_data_json", "model_raw_json", "ingested_at")]
    return rows.select(
        *shown,
        F.get_json_object("card_data_json", "$.language").alias("card_language"),
        F.get_json_object("model_raw_json", "$.createdAt").alias("raw_created_at"),
    )


@query("bronze_card_rows", BRONZE_SELECT, CARD_SHARD_CTES)
def bronze_card_rows(spark, sf):
    return bronze_checked(card_bronze(spark, sf))


RAW_MODELS = """
SELECT json_extract_string(j, '$.id') AS model_id, json_extract_string(j, '$.author') AS author,
  json_extract_string(j, '$.createdAt') AS created_at, json_extract_string(j, '$.lastModified') AS last_modified,
  CAST(json_extract(j, '$.downloads') AS BIGINT) AS downloads, CAST(json_extract(j, '$.likes') AS BIGINT) AS likes,
  json_extract_string(j, '$.pipeline_tag') AS pipeline_tag, json_extract_string(j, '$.library_name') AS library_name,
  json_extract_string(card, '$.language') AS language, json_extract_string(card, '$.license') AS license,
  CASE json_type(card, '$.datasets') WHEN 'VARCHAR' THEN json_extract_string(card, '$.datasets')
    WHEN 'ARRAY' THEN nullif(array_to_string(CAST(json_extract(card, '$.datasets') AS VARCHAR[]), ', '), '') END AS datasets,
  CASE WHEN co2_type = 'OBJECT' THEN em_text ELSE json_extract_string(co2, '$') END AS co2_emissions_grams,
  json_extract_string(co2, '$.source') AS source, json_extract_string(co2, '$.training_type') AS training_type,
  json_extract_string(co2, '$.geographical_location') AS geographical_location,
  json_extract_string(co2, '$.hardware_used') AS hardware_used
FROM cards WHERE co2_type <> 'NULL' AND CAST(co2 AS VARCHAR) <> '{}'"""


@query("raw_model_rows", RAW_MODELS, (CARDS,))
def raw_model_rows(spark, sf):
    return W.raw_model_rows(relation(spark, sf, "payloads"))


# Several enrichment attempts per model, the newest of which counts.
GOLD_SQL = """
SELECT * EXCLUDE (rn) FROM (
  SELECT e.model_id, e.size, e.downloads, e.performance_score, CAST(e.datasets AS JSON) AS listed,
    strftime(l.enriched_at, '%Y-%m-%dT%H:%M:%S+00:00') AS enriched_at, lpad(CAST(l.attempt_id AS VARCHAR), 6, '0') AS partition_id,
    row_number() OVER (PARTITION BY e."modelId" ORDER BY l.enriched_at DESC, lpad(CAST(l.attempt_id AS VARCHAR), 6, '0') DESC) AS rn
  FROM enriched e JOIN enrich_log l ON l.k = e.k) WHERE rn = 1"""
GOLD_ORACLE = f"""
SELECT model_id, size, downloads, performance_score, enriched_at, partition_id,
  CAST(json_array_length(listed) AS INTEGER) AS datasets_size,
  array_to_string(CAST(listed AS VARCHAR[]), '|') AS datasets_list FROM ({GOLD_SQL})"""


def repeated_enriched(spark, sf):
    """Enriched rows once per logged attempt, with the attempt's time."""
    log = relation(spark, sf, "enrich_log").select(
        "k", iso_time(F.col("enriched_at")).alias("_at"), padded_id(F.col("attempt_id")).alias("_pid")
    )
    rows = enriched(spark, sf).join(log, "k")
    return rows.withColumns({"enriched_at": F.col("_at"), "partition_id": F.col("_pid")}).select(
        *ENRICHED_COLUMNS
    )


def gold_checked(gold):
    return gold.select(
        "model_id", "size", "downloads", "performance_score", "enriched_at", "partition_id",
        "datasets_size", F.array_join("datasets_list", "|").alias("datasets_list"),
    )


@query("gold_models", GOLD_ORACLE, ENRICHED_CTES)
def gold_models(spark, sf):
    return gold_checked(W.gold_rows(repeated_enriched(spark, sf)))


@query(
    "bronze_ok_columns",
    "SELECT shard_id, model_key, emission, status FROM bronze WHERE status = 'ok'",
    SHARDED_CTES,
)
def bronze_ok_columns(spark, sf):
    return order_bronze(spark, sf).where("status = 'ok'").select(
        "shard_id", "model_key", "emission", "status"
    )


@query("stamp_snapshot", f"SELECT *, '2026-01-01' AS snapshot_date FROM ({RAW_MODELS})", (CARDS,))
def stamp_snapshot(spark, sf):
    rows = W.raw_model_rows(relation(spark, sf, "payloads"))
    return W.stamp_snapshot(rows, "2026-01-01").drop("ingested_at_utc")


# Filters ----------------------------------------------------------------------------


@query(
    "valid_models",
    f"""SELECT trim(model_id) AS model_id, emission AS co2_eq_emissions, downloads, likes FROM (
      SELECT CASE WHEN k % 9 = 0 THEN '  ' ELSE ' ' || model_id END AS model_id, {number('trim(em_text)')} AS emission,
        CAST(json_extract(j, '$.downloads') AS BIGINT) AS downloads, CAST(json_extract(j, '$.likes') AS BIGINT) AS likes
      FROM cards) WHERE trim(model_id) <> '' AND emission IS NOT NULL""",
    (CARDS,),
)
def valid_models(spark, sf):
    rows = relation(spark, sf, "payloads").select(
        F.when(F.col("k") % 9 == 0, "  ").otherwise(F.concat(F.lit(" "), "model_id")).alias("model_id"),
        F.get_json_object("payload_json", "$.cardData.co2_eq_emissions.emissions").alias("co2_eq_emissions"),
        F.get_json_object("payload_json", "$.downloads").alias("downloads"),
        F.get_json_object("payload_json", "$.likes").alias("likes"),
    )
    return W.valid_models(rows)


@query("models_with_emissions", "SELECT model_id, co2_eq_emissions FROM discovered", DISCOVERY_CTES)
def models_with_emissions(spark, sf):
    rows = where_computed(emission_facts(spark, sf), F.col("emission").isNotNull())
    return rows.select("model_id", F.col("emission").alias("co2_eq_emissions"))


@query(
    "status_not_ok",
    "SELECT shard_id, model_key, status FROM bronze WHERE status <> 'ok'",
    SHARDED_CTES,
)
def status_not_ok(spark, sf):
    return order_bronze(spark, sf).where("status <> 'ok'").select("shard_id", "model_key", "status")


@query(
    "shards_isin",
    "SELECT shard_id, model_key, emission FROM bronze WHERE shard_id IN (11, 13, 19)",
    SHARDED_CTES,
)
def shards_isin(spark, sf):
    rows = order_bronze(spark, sf).where(F.col("shard_id").isin(11, 13, 19))
    return rows.select("shard_id", "model_key", "emission")


@query(
    "split_missing_id",
    """SELECT CASE WHEN event_type = 'error' THEN 'missing' ELSE 'kept' END AS side, COUNT(*) AS side_rows,
      CAST(SUM(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1""",
)
def split_missing_id(spark, sf):
    blank = F.when(F.col("event_id") % 2 == 0, F.lit(" \t")).otherwise(F.lit(None))
    ids = F.when(F.col("event_type") == "error", blank).otherwise(F.col("event_type"))
    kept, missing = J.split_missing_id(table(spark, sf, "events").select(ids.alias("model_id"), "event_id"))
    both = kept.withColumn("side", F.lit("kept")).unionByName(missing.withColumn("side", F.lit("missing")))
    return both.groupBy("side").agg(
        F.count(F.lit(1)).alias("side_rows"), F.sum("event_id").alias("id_sum")
    )


@query(
    "claimable_partitions",
    "SELECT event_id, outcome AS status FROM attempts WHERE outcome IN ('PENDING', 'FAILED')",
)
def claimable_partitions(spark, sf):
    rows = relation(spark, sf, "attempts").withColumnRenamed("outcome", "status")
    return K.claimable(rows).select("event_id", "status")


_STATUS_SQL = """CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'RATE_LIMITED'
  WHEN 'view' THEN 'RUNNING' ELSE 'COMPLETED' END"""


@query(
    "resumable_runs",
    f"""SELECT event_id, {_STATUS_SQL} AS status FROM attempts
    WHERE {_STATUS_SQL} IN ('RUNNING', 'FAILED', 'RATE_LIMITED', 'INTERRUPTED')""",
)
def resumable_runs(spark, sf):
    rows = relation(spark, sf, "attempts").select("event_id", F.expr(_STATUS_SQL).alias("status"))
    return K.resumable(rows)


@query("guard_nonempty", "SELECT COUNT(*) AS valid_models FROM discovered", DISCOVERY_CTES)
def guard_nonempty(spark, sf):
    rows = discovered(spark, sf).agg(F.count(F.lit(1)).alias("valid_models"))
    guard = F.assert_true(F.col("valid_models") > 0, F.lit("no valid models in the source"))
    return rows.select(F.when(guard.isNull(), F.col("valid_models")).alias("valid_models"))


@query(
    "guard_params",
    """SELECT CASE WHEN p_partkey % 7 = 0 THEN 'workers must be greater than 0'
      WHEN p_partkey % 5 = 0 THEN 'source_path is required'
      WHEN p_partkey % 3 = 0 THEN 'source_path is no absolute path or URI: ' || p_brand END AS refused, COUNT(*) AS settings
    FROM part GROUP BY 1""",
)
def guard_params(spark, sf):
    """Settings made from table rows: the reason each is refused for, NULL for accepted ones."""
    key = F.col("p_partkey")
    rows = table(spark, sf, "part").select(
        F.when(key % 7 == 0, -F.col("p_size")).otherwise(F.col("p_size")).alias("workers"),
        F.when(key % 5 == 0, "").when(key % 3 == 0, F.col("p_brand")).otherwise("s3://b/x.csv").alias("source_path"),
    )
    return K.refused(rows).groupBy("refused").agg(F.count(F.lit(1)).alias("settings"))
