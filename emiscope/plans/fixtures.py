"""Catalogue relations derived from the given tables.

The text runs unchanged in Spark and in DuckDB; only the way a table is named differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Relation -> the tables it is made from, and its CTEs.
RELATIONS = {
    "payloads": (
        ("part", "lineitem",),
        r"""
usage AS (
  SELECT l_partkey, COUNT(*) AS downloads, COUNT(DISTINCT l_suppkey) AS likes
  FROM {lineitem} GROUP BY l_partkey),
base AS (
  SELECT p_partkey AS k, p_size AS sz, p_type, p_brand,
         CAST(p_partkey AS STRING) AS ks,
         COALESCE(downloads, 0) AS downloads, COALESCE(likes, 0) AS likes
  FROM {part} LEFT JOIN usage ON l_partkey = p_partkey),
payloads AS (
  SELECT k, 'org' || CAST(k % 17 AS STRING) || '/m' || ks AS model_id,
    '{{"id":"org' || CAST(k % 17 AS STRING) || '/m' || ks || '"'
    || CASE WHEN k % 4 = 0 THEN '' ELSE ',"pipeline_tag":"' || p_type || '"' END
    || ',"library_name":"' || p_brand || '"'
    || ',"downloads":' || CAST(downloads AS STRING)
    || ',"likes":' || CAST(likes AS STRING)
    || ',"createdAt":"2022-03-' || CASE WHEN k % 28 < 9 THEN '0' ELSE '' END
    || CAST(k % 28 + 1 AS STRING) || 'T23:29:04.000Z"'
    || ',"tags":[' || CASE WHEN k % 6 = 0 THEN '' ELSE '"transformers","dataset:ds' || CAST(k % 13 AS STRING)
         || '","dataset:ds' || CAST(k % 7 AS STRING) || '"'
         || CASE WHEN k % 5 = 0 THEN ',"AutoTrain"' ELSE '' END END || ']'
    || ',"safetensors":' || CASE WHEN k % 3 = 0 THEN '{{"total":' || CAST(1000 + k AS STRING) || '}}' ELSE 'null' END
    || ',"siblings":[' || CASE WHEN k % 5 = 4 THEN '' ELSE '{{"rfilename":"a","size":'
         || CASE WHEN k % 2 = 0 THEN CAST(sz AS STRING) ELSE 'null' END
         || '}},{{"rfilename":"b","size":' || CASE WHEN k % 7 = 0 THEN CAST(sz * 10 AS STRING) ELSE 'null' END || '}}' END || ']'
    || ',"cardData":{{"language":"en"'
    || CASE k % 12
         WHEN 0 THEN ',"co2_eq_emissions":{{"emissions":"1,' || CAST(100 + k % 900 AS STRING) || '.5 g","source":"calc","training_type":"fine-tuning","geographical_location":"EU","hardware_used":"1xGPU"}}'
         WHEN 1 THEN ',"co2_eq_emissions":{{"emissions":"' || CAST(k % 50 AS STRING) || '.25 kg CO2eq"}}'
         WHEN 2 THEN ',"co2_eq_emissions":{{"emissions":"unknown"}}'
         WHEN 3 THEN ',"co2_eq_emissions":{{}}'
         WHEN 4 THEN ',"co2_eq_emissions":' || CAST(sz AS STRING) || '.5'
         WHEN 5 THEN ''
         WHEN 6 THEN ',"co2_eq_emissions":{{"emissions":"1e' || CAST(k % 6 AS STRING) || '"}}'
         WHEN 7 THEN ',"co2_eq_emissions":{{"emissions":"12d"}}'
         WHEN 8 THEN ',"co2_eq_emissions":null'
         WHEN 9 THEN ',"co2_eq_emissions":{{"emissions":0}}'
         ELSE ',"co2_eq_emissions":{{"emissions":' || CAST(sz AS STRING) || '.5,"source":"tracker"}}' END
    || CASE k % 5
         WHEN 0 THEN ',"datasets":["ds' || CAST(k % 13 AS STRING) || '","ds' || CAST(k % 7 AS STRING) || '","ds' || CAST(k % 13 AS STRING) || '"]'
         WHEN 1 THEN ',"datasets":"ds' || CAST(k % 13 AS STRING) || '"'
         WHEN 2 THEN ',"datasets":[]' WHEN 3 THEN ',"dataset":"ds1"' ELSE '' END
    || CASE WHEN k % 4 = 1 THEN ',"model-index":[{{"name":"m-' || ks || '","results":[{{"metrics":[{{"type":"f1","value":0.'
         || CAST(10 + k % 90 AS STRING) || '}},{{"type":"loss","value":-' || CAST(sz AS STRING) || ',"ok":'
         || CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END || '}}]}}]}}]'
         WHEN k % 4 = 2 THEN ',"model-index":[],"metrics":["accuracy"]' ELSE '' END
    || '}}}}' AS payload_json
  FROM base)
""",
    ),
    "enrich_log": (
        ("orders",),
        r"""
enrich_log AS (
  SELECT o_custkey AS k, o_orderkey AS attempt_id, o_orderdate AS enriched_at,
         o_orderstatus AS status, o_totalprice AS value
  FROM {orders})
""",
    ),
    "page_log": (
        ("orders",),
        r"""
page_log AS (
  SELECT o_orderkey AS seq, CAST(FLOOR(o_orderkey / 100) AS BIGINT) + 1 AS page,
         o_custkey AS k, o_orderstatus <> 'O' AS has_emission
  FROM {orders})
""",
    ),
    "attempts": (
        ("events",),
        r"""
attempts AS (
  SELECT event_id, ts, user_id % 8 AS partition_no, event_type,
         CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'COMPLETED' END AS outcome, value, props
  FROM {events})
""",
    ),
}

RANGES_SQL = """
ranges AS (
  SELECT shard_id, CAST(lo AS DOUBLE) AS min_emissions, CAST(hi AS DOUBLE) AS max_emissions
  FROM (VALUES (0, 0, 1), (1, 1, 5), (2, 5, 10), (3, 10, 25), (4, 25, 50), (5, 50, 100),
    (6, 100, 250), (7, 250, 500), (8, 500, 1000), (9, 1000, 2500), (10, 2500, 5000),
    (11, 5000, 10000), (12, 10000, 25000), (13, 25000, 50000), (14, 50000, 100000),
    (15, 100000, 250000), (16, 250000, 500000), (17, 500000, 1000000), (18, 1000000, 5000000),
    (19, 5000000, NULL)) AS t(shard_id, lo, hi))
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than cores over all cores; any larger scan as it is.

    Payload work is heavy per row, and one small file would keep it in one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived relation as a DataFrame; parts it does not use are dropped by Spark."""
    needed, ctes = RELATIONS[name]
    frames = {t: table(spark, sf_dir, t) for t in needed}
    if "part" in frames:
        frames["part"] = spread(frames["part"])
    return spark.sql(f"WITH {ctes} SELECT * FROM {name}", **frames)


def with_relations(query: str, *extra: str) -> str:
    """DuckDB text: the derived relations, further CTEs, then the query."""
    named = {t: t for t in TABLES}
    own = [*[ctes.format(**named) for _, ctes in RELATIONS.values()], RANGES_SQL, *extra]
    return f"WITH RECURSIVE {', '.join(part.strip() for part in own)} {query}"
