"""Registry of queries and their DuckDB oracles, and SQL pieces the oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emiscope.plans.fixtures import with_relations

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RUN = "20260101T000000Z"
STAMP = "2026-01-01T00:00:00+00:00"


def query(name: str, oracle: str | None = None, ctes: tuple[str, ...] = ()):
    """Register a query under ``name`` with its oracle text."""

    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_relations(oracle, *ctes)
        return fn

    return register


def cleaned(x: str) -> str:
    """Emission text without its unit words."""
    text = f"trim(lower({x}))"
    for word in ("kg", "grams", "gram", "g", "co2eq", "co2e", "co₂eq", "co₂e", ","):
        text = f"replace({text}, '{word}', '')"
    return f"trim({text})"


def number(x: str) -> str:
    pattern = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
    return f"CASE WHEN regexp_matches({x}, '{pattern}') THEN CAST({x} AS DOUBLE) END"


# Payloads with their card and emission entry taken apart.
CARDS = f"""
cards AS (
  SELECT k, model_id, payload_json AS j,
    json_extract(payload_json, '$.cardData') AS card,
    json_extract(payload_json, '$.cardData.co2_eq_emissions') AS co2,
    json_type(payload_json, '$.cardData.co2_eq_emissions') AS co2_type,
    json_type(payload_json, '$.cardData.co2_eq_emissions.emissions') AS em_type,
    json_extract_string(payload_json, '$.cardData.co2_eq_emissions.emissions') AS em_text
  FROM payloads),
emitting AS (
  SELECT *, CASE WHEN co2_type <> 'OBJECT' THEN NULL
    WHEN em_type = 'VARCHAR' THEN {number(cleaned("em_text"))}
    ELSE TRY_CAST(em_text AS DOUBLE) END AS emission
  FROM cards)"""

TAGS_TEXT = "replace(CAST(json_extract(j, '$.tags') AS VARCHAR), ',', ', ')"

DISCOVERED = f"""
discovered AS (
  SELECT k, json_extract_string(j, '$.id') AS model_id, emission AS co2_eq_emissions,
    json_extract_string(co2, '$.source') AS co2_source,
    json_extract_string(co2, '$.training_type') AS training_type,
    json_extract_string(co2, '$.geographical_location') AS geographical_location,
    json_extract_string(co2, '$.hardware_used') AS hardware_used,
    json_extract_string(j, '$.createdAt') AS created_at,
    CAST(json_extract(j, '$.downloads') AS BIGINT) AS downloads,
    CAST(json_extract(j, '$.likes') AS BIGINT) AS likes,
    json_extract_string(j, '$.library_name') AS library_name,
    json_extract_string(j, '$.pipeline_tag') AS pipeline_tag,
    {TAGS_TEXT} AS tags, '{RUN}' AS snapshot_id, '{STAMP}' AS discovered_at
  FROM emitting WHERE emission IS NOT NULL)"""

# Datasets of the card as (k, pos, name), and the metrics entry of the card.
DETAILS = """
listed AS (
  SELECT *, CASE json_type(card, '$.datasets')
      WHEN 'ARRAY' THEN CASE WHEN json_array_length(card, '$.datasets') > 0
        THEN json_extract(card, '$.datasets') END
      WHEN 'VARCHAR' THEN json_array(json_extract_string(card, '$.datasets')) END AS first_list,
    CASE WHEN json_type(card, '$.dataset') = 'VARCHAR'
      THEN json_array(json_extract_string(card, '$.dataset')) END AS second_list,
    CASE WHEN json_array_length(card, '$.model-index') > 0 THEN json_extract(card, '$.model-index')
      WHEN json_array_length(card, '$.metrics') > 0 THEN json_extract(card, '$.metrics') END AS metrics,
    CASE WHEN json_type(j, '$.safetensors.total') IN ('UBIGINT', 'BIGINT')
      THEN CAST(json_extract(j, '$.safetensors.total') AS BIGINT)
      ELSE CAST(list_sum(CAST(json_extract(j, '$.siblings[*].size') AS BIGINT[])) AS BIGINT) END AS size
  FROM emitting),
detailed AS (
  SELECT *, COALESCE(first_list, second_list, CAST('[]' AS JSON)) AS datasets,
    CAST(json_array_length(COALESCE(first_list, second_list, CAST('[]' AS JSON))) AS INTEGER) AS datasets_size,
    COALESCE(replace(replace(CAST(metrics AS VARCHAR), ',', ', '), ':', ': '), '') AS metrics_text
  FROM listed),
scores AS (
  SELECT d.k, max(CASE t.type WHEN 'BOOLEAN' THEN CASE WHEN CAST(t.atom AS VARCHAR) = 'true' THEN 1.0 ELSE 0.0 END
      ELSE CAST(CAST(t.atom AS VARCHAR) AS DOUBLE) END) AS score
  FROM detailed d, json_tree(d.metrics) t
  WHERE t.type IN ('DOUBLE', 'UBIGINT', 'BIGINT', 'BOOLEAN') GROUP BY d.k)"""

ENRICHED = f"""
enriched AS (
  SELECT x.k, x.model_id AS "modelId", replace(CAST(x.datasets AS VARCHAR), ',', ', ') AS datasets,
    x.datasets_size, d.co2_eq_emissions, TRUE AS co2_reported, d.co2_source AS source,
    d.training_type, d.geographical_location, CAST(NULL AS VARCHAR) AS environment,
    x.metrics_text AS performance_metrics, s.score AS performance_score,
    CASE WHEN d.downloads <> 0 THEN d.downloads ELSE 0 END AS downloads, d.likes,
    d.library_name,
    COALESCE(d.pipeline_tag, json_extract_string(x.j, '$.tags[0]'),
      CASE WHEN json_array_length(x.j, '$.tags') = 0 THEN substr(d.tags, 1, 100) END) AS domain,
    x.size, d.created_at,
    CASE WHEN x.size > 0 THEN d.downloads / x.size END AS size_efficency,
    CASE WHEN x.datasets_size > 0 THEN d.downloads / x.datasets_size END AS datasets_size_efficency,
    contains(lower(CAST(json_extract(x.j, '$.tags') AS VARCHAR)), 'auto') AS auto,
    '{RUN}' AS run_id, lpad(CAST(x.k % 8 AS VARCHAR), 6, '0') AS partition_id,
    '{STAMP}' AS enriched_at, d.model_id AS model_id, d.co2_source, d.hardware_used,
    d.pipeline_tag, d.tags, d.snapshot_id, d.discovered_at
  FROM discovered d JOIN detailed x ON x.k = d.k LEFT JOIN scores s ON s.k = d.k
  WHERE d.k % 11 <> 0)"""

PAYLOAD_CTES = (CARDS,)
DISCOVERY_CTES = (CARDS, DISCOVERED)
DETAIL_CTES = (CARDS, DETAILS)
ENRICHED_CTES = (CARDS, DISCOVERED, DETAILS, ENRICHED)
