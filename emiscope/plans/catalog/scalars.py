"""Scalar functions, run over every payload or event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emiscope.functions import payload as P
from emiscope.functions import text as T
from emiscope.operators.staging import where_computed
from emiscope.plans.catalog.base import (
    DETAIL_CTES, DISCOVERY_CTES, PAYLOAD_CTES, cleaned, number, query,
)
from emiscope.plans.catalog.scans import discovered
from emiscope.plans.fixtures import relation, table


def doc() -> Column:
    return F.col("_doc")


def card() -> Column:
    return F.col("_card")


def cards(spark, sf) -> DataFrame:
    rows = relation(spark, sf, "payloads").withColumn("_doc", P.parsed(F.col("payload_json")))
    return rows.withColumn("_card", P.card(doc()))


def emission_text() -> Column:
    return P.text_at(P.at(card(), "co2_eq_emissions"), "emissions")


@query(
    "co2_normalize",
    f"SELECT model_id, em_text AS emission_text, {number(cleaned('em_text'))} AS emission FROM cards",
    PAYLOAD_CTES,
)
def co2_normalize(spark, sf):
    rows = cards(spark, sf).select("model_id", emission_text().alias("emission_text"))
    return rows.withColumn("emission", T.parse_emission(F.col("emission_text")))


_CO2_DETAILS = ", ".join(
    f"json_extract_string(co2, '$.{k}') AS {k}"
    for k in ("source", "training_type", "geographical_location", "hardware_used")
)


def _co2_columns(rows: DataFrame, fields: Column) -> DataFrame:
    return rows.select("model_id", fields.alias("_co2")).select("model_id", "_co2.*")


@query(
    "co2_fields_any",
    f"""SELECT model_id, CASE WHEN co2_type = 'OBJECT' THEN em_text
      ELSE json_extract_string(co2, '$') END AS emissions, {_CO2_DETAILS} FROM cards""",
    PAYLOAD_CTES,
)
def co2_fields_any(spark, sf):
    return _co2_columns(cards(spark, sf), P.co2_any(card()))


@query(
    "co2_fields_truthy",
    f"""SELECT model_id, CASE WHEN co2_type = 'OBJECT' THEN em_text
      ELSE json_extract_string(co2, '$') END AS emissions, {_CO2_DETAILS} FROM cards
    WHERE co2_type NOT IN ('NULL') AND CAST(co2 AS VARCHAR) NOT IN ('{{}}', '0', '""', '[]', 'false', '0.0')""",
    PAYLOAD_CTES,
)
def co2_fields_truthy(spark, sf):
    rows = cards(spark, sf).withColumn("_kept", P.co2_truthy(card()))
    rows = where_computed(rows, F.col("_kept").isNotNull())
    return rows.select("model_id", "_kept.*")


@query(
    "co2_fields_object",
    f"SELECT model_id, emission AS emissions, {_CO2_DETAILS} FROM emitting WHERE emission IS NOT NULL",
    PAYLOAD_CTES,
)
def co2_fields_object(spark, sf):
    rows = cards(spark, sf).withColumn("_kept", P.co2_object(card()))
    rows = where_computed(rows, F.col("_kept.emissions").isNotNull())
    return rows.select("model_id", "_kept.*")


@query(
    "safe_float",
    f"SELECT model_id, {number('trim(em_text)')} AS value FROM cards",
    PAYLOAD_CTES,
)
def safe_float(spark, sf):
    return cards(spark, sf).select("model_id", T.parse_float(emission_text()).alias("value"))


@query(
    "safe_int",
    f"SELECT model_id, CAST(COALESCE(trunc({number('trim(em_text)')}), 0) AS BIGINT) AS value FROM cards",
    PAYLOAD_CTES,
)
def safe_int(spark, sf):
    return cards(spark, sf).select("model_id", T.parse_int(emission_text()).alias("value"))


@query(
    "to_decimal",
    "SELECT p_partkey, CAST(CAST(p_retailprice AS VARCHAR) AS DECIMAL(38,18)) AS price FROM part",
)
def to_decimal(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", T.exact_decimal(F.col("p_retailprice")).alias("price")
    )


@query(
    "efficiency_ratios",
    """SELECT model_id, CASE WHEN size > 0 THEN CAST(json_extract(j, '$.downloads') AS BIGINT) / size END AS per_size,
      CASE WHEN datasets_size > 0 THEN CAST(json_extract(j, '$.downloads') AS BIGINT) / datasets_size END AS per_dataset
    FROM detailed""",
    DETAIL_CTES,
)
def efficiency_ratios(spark, sf):
    rows = cards(spark, sf).select(
        "model_id",
        F.try_variant_get(doc()["downloads"], "$", "bigint").alias("downloads"),
        P.model_size(doc()).alias("size"),
        F.size(P.dataset_list(P.dataset_entry(doc(), card()))).alias("listed"),
    )
    return rows.select(
        "model_id",
        P.ratio(F.col("downloads"), F.col("size")).alias("per_size"),
        P.ratio(F.col("downloads"), F.col("listed")).alias("per_dataset"),
    )


@query(
    "chunk_size",
    """SELECT p_partkey, CAST(greatest(1, 1000 // ((p_size % 7 + 1) * (p_partkey % 300 + 1))) AS BIGINT) AS chunk_rows,
      CAST(ceil(p_size / greatest(1, 1000 // ((p_size % 7 + 1) * (p_partkey % 300 + 1)))) AS BIGINT) AS chunks FROM part""",
)
def chunk_size(spark, sf):
    workers, calls = F.col("p_size") % 7 + 1, F.col("p_partkey") % 300 + 1
    rows = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(1000) / (workers * calls)))
    return table(spark, sf, "part").select(
        "p_partkey", rows.alias("chunk_rows"), F.ceil(F.col("p_size") / rows).alias("chunks")
    )


# Half seconds, with every fifth header absent and every seventh unreadable.
def _wait_header() -> Column:
    return (
        F.when(F.col("event_id") % 5 == 0, F.lit(None))
        .when(F.col("event_id") % 7 == 0, F.lit("soon"))
        .otherwise((F.col("event_id") % 400 / 2).cast("string"))
    )


@query(
    "retry_after_seconds",
    """SELECT event_id, CAST(CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN 180
      ELSE greatest(trunc(event_id % 400 / 2), 1) END AS BIGINT) AS wait_seconds FROM events""",
)
def retry_after_seconds(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", T.wait_seconds(_wait_header()).alias("wait_seconds")
    )


@query(
    "safe_json",
    """SELECT model_id, replace(CAST(json_extract(j, '$.tags') AS VARCHAR), ',', ', ') AS tags_json,
      CASE WHEN co2_type = 'NULL' THEN '' ELSE COALESCE(
        CAST(json_extract(co2, '$.emissions') AS VARCHAR), '') END AS emissions_json FROM cards""",
    PAYLOAD_CTES,
)
def safe_json(spark, sf):
    inner = P.at(P.at(card(), "co2_eq_emissions"), "emissions")
    return cards(spark, sf).select(
        "model_id",
        P.spaced_json(doc()["tags"]).alias("tags_json"),
        P.spaced_json(inner).alias("emissions_json"),
    )


@query(
    "json_sorted_keys",
    """SELECT model_id, '{' || array_to_string(list_transform(list_sort(json_keys(co2)),
      lambda n: '"' || n || '": ' || CAST(json_extract(co2, '$.' || n) AS VARCHAR)), ', ') || '}' AS co2_json
    FROM cards WHERE co2_type = 'OBJECT'""",
    PAYLOAD_CTES,
)
def json_sorted_keys(spark, sf):
    co2 = P.at(card(), "co2_eq_emissions")
    rows = cards(spark, sf).where(P.is_object(co2))
    return rows.select("model_id", P.spaced_json(co2).alias("co2_json"))


@query(
    "card_object",
    "SELECT model_id, CAST(card AS VARCHAR) AS card_json FROM cards",
    PAYLOAD_CTES,
)
def card_object(spark, sf):
    return cards(spark, sf).select(
        "model_id", P.card_text(F.col("payload_json"), doc()).alias("card_json")
    )


@query("performance_metrics", "SELECT model_id, metrics_text AS metrics_json FROM detailed", DETAIL_CTES)
def performance_metrics(spark, sf):
    rows = cards(spark, sf).withColumn("_key", P.metrics_key(card()))
    return rows.select(
        "model_id", P.metrics_text(
            F.col("payload_json"), doc(), F.col("_key"), P.metrics_entry(card(), F.col("_key"))
        ).alias("metrics_json"),
    )


@query(
    "performance_score",
    "SELECT d.model_id, s.score FROM detailed d LEFT JOIN scores s ON s.k = d.k",
    DETAIL_CTES,
)
def performance_score(spark, sf):
    rows = cards(spark, sf).withColumn("_key", P.metrics_key(card()))
    rows = rows.withColumn("_metrics", P.metrics_entry(card(), F.col("_key")))
    return rows.select(
        "model_id", P.greatest_number(F.col("_metrics")).alias("score")
    )


@query(
    "datasets_list",
    "SELECT model_id, replace(CAST(datasets AS VARCHAR), ',', ', ') AS datasets_json FROM detailed",
    DETAIL_CTES,
)
def datasets_list(spark, sf):
    return cards(spark, sf).select(
        "model_id", P.dataset_list_json(P.dataset_entry(doc(), card())).alias("datasets_json")
    )


@query("datasets_size", "SELECT model_id, datasets_size FROM detailed", DETAIL_CTES)
def datasets_size(spark, sf):
    return cards(spark, sf).select(
        "model_id", F.size(P.dataset_list(P.dataset_entry(doc(), card()))).alias("datasets_size")
    )


# Distinct dataset references of each model, from its card, else from its tags.
REFS = """
named AS (
  SELECT model_id, k, unnest(CAST(first_list AS VARCHAR[])) AS ref FROM listed WHERE first_list IS NOT NULL
  UNION ALL
  SELECT model_id, k, replace(tag, 'dataset:', '') FROM (
    SELECT model_id, k, unnest(CAST(json_extract(j, '$.tags') AS VARCHAR[])) AS tag FROM listed WHERE first_list IS NULL)
  WHERE starts_with(tag, 'dataset:')),
refs AS (SELECT DISTINCT model_id, k, ref AS dataset_id FROM named)"""
REF_CTES = (*DETAIL_CTES, REFS)


@query(
    "dataset_refs_text",
    """SELECT c.model_id, r.refs FROM cards c LEFT JOIN (
      SELECT model_id, string_agg(dataset_id, ', ' ORDER BY dataset_id) AS refs FROM refs GROUP BY model_id) r
    ON r.model_id = c.model_id""",
    REF_CTES,
)
def dataset_refs_text(spark, sf):
    rows = cards(spark, sf).withColumn("_entry", P.at(card(), "datasets"))
    rows = rows.withColumn("_refs", P.dataset_refs(F.col("_entry"), doc()["tags"]))
    return rows.select("model_id", P.dataset_refs_text(F.col("_refs")).alias("refs"))


@query(
    "dataset_text_raw",
    """SELECT model_id, CASE json_type(card, '$.datasets') WHEN 'VARCHAR' THEN json_extract_string(card, '$.datasets')
      WHEN 'ARRAY' THEN nullif(array_to_string(CAST(json_extract(card, '$.datasets') AS VARCHAR[]), ', '), '') END AS datasets
    FROM cards""",
    PAYLOAD_CTES,
)
def dataset_text_raw(spark, sf):
    return cards(spark, sf).select("model_id", P.dataset_text(card()).alias("datasets"))


@query(
    "datasets_reparse",
    """SELECT model_id, array_to_string(CAST(datasets AS VARCHAR[]), '|') AS names,
      CAST(json_array_length(datasets) AS INTEGER) AS listed FROM detailed""",
    DETAIL_CTES,
)
def datasets_reparse(spark, sf):
    listed = P.dataset_list_json(P.dataset_entry(doc(), card()))
    # Every other list comes with escaped quotes, as a twice-encoded text does.
    escaped = F.when(F.col("k") % 2 == 0, F.replace(listed, F.lit('"'), F.lit('\\"'))).otherwise(listed)
    rows = cards(spark, sf).select("model_id", P.reparsed_list(escaped).alias("_list"))
    return rows.select(
        "model_id", F.array_join("_list", "|").alias("names"), F.size("_list").alias("listed")
    )


@query("model_size", "SELECT model_id, size FROM detailed", DETAIL_CTES)
def model_size(spark, sf):
    return cards(spark, sf).select("model_id", P.model_size(doc()).alias("size"))


@query(
    "infer_domain",
    """SELECT model_id, COALESCE(pipeline_tag, json_extract_string(p.payload_json, '$.tags[0]'), tags) AS domain
    FROM discovered d JOIN payloads p USING (model_id)""",
    DISCOVERY_CTES,
)
def infer_domain(spark, sf):
    rows = discovered(spark, sf)
    docs = relation(spark, sf, "payloads").select("k", P.parsed(F.col("payload_json")).alias("_doc"))
    return rows.join(docs, "k").select(
        "model_id", P.tag_domain(F.col("pipeline_tag"), doc(), F.col("tags")).alias("domain")
    )


@query(
    "infer_auto",
    "SELECT model_id, contains(lower(CAST(json_extract(j, '$.tags') AS VARCHAR)), 'auto') AS auto FROM cards",
    PAYLOAD_CTES,
)
def infer_auto(spark, sf):
    return cards(spark, sf).select(
        "model_id", P.mentions_auto(doc(), F.lit(None).cast("string")).alias("auto")
    )


@query(
    "pad_partition_id",
    """SELECT event_id, lpad(CAST(partition_no AS VARCHAR), 6, '0') AS partition_id,
      CASE WHEN event_id < 1000000 THEN lpad(CAST(event_id AS VARCHAR), 6, '0') ELSE CAST(event_id AS VARCHAR) END AS event_no,
      event_type AS unchanged FROM attempts""",
)
def pad_partition_id(spark, sf):
    return relation(spark, sf, "attempts").select(
        "event_id",
        T.padded_id(F.col("partition_no")).alias("partition_id"),
        T.padded_id(F.col("event_id")).alias("event_no"),
        T.padded_id(F.col("event_type")).alias("unchanged"),
    )


@query(
    "uri_parts",
    r"""SELECT page_id, regexp_extract(url, '^https?://([^/]*)', 1) AS bucket,
      regexp_replace(regexp_replace(url, '^https?://[^/]*', ''), '^/+', '') AS "key" FROM pages""",
)
def uri_parts(spark, sf):
    pages = table(spark, sf, "pages")
    parts = F.coalesce(
        T.bucket_and_key(F.col("url"), "https"), T.bucket_and_key(F.col("url"), "http")
    )
    return pages.select("page_id", parts.alias("_p")).select("page_id", "_p.bucket", "_p.key")


@query(
    "link_cursor",
    """SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN 'a/' || CAST(page_id AS VARCHAR) || '=' END AS next_cursor FROM pages""",
)
def link_cursor(spark, sf):
    number_text = F.col("page_id").cast("string")
    first = F.concat(F.lit("<"), F.col("url"), F.lit('>; rel="first"'))
    following = F.concat(
        F.lit(', <https://host/api?limit=10&cursor=a%2F'), number_text, F.lit('%3D>; rel="next"')
    )
    header = F.when(F.col("page_id") % 3 == 0, first).otherwise(F.concat(first, following))
    return table(spark, sf, "pages").select("page_id", T.next_cursor(header).alias("next_cursor"))


@query(
    "encode_id",
    """SELECT p_partkey, replace(p_name, ' ', '%20') || '/' || replace(replace(p_brand, '#', '%23'), ' ', '%20') AS encoded FROM part""",
)
def encode_id(spark, sf):
    name = F.concat_ws("/", "p_name", "p_brand")
    return table(spark, sf, "part").select("p_partkey", T.encoded_id(name).alias("encoded"))


@query(
    "output_paths",
    """SELECT event_id, 'enriched/run_id=r1/partition_id=' || lpad(CAST(partition_no AS VARCHAR), 6, '0') || '/batches/batch_'
      || lpad(CAST(event_id % 1000 AS VARCHAR), 6, '0') || '.jsonl' AS path FROM attempts""",
)
def output_paths(spark, sf):
    return relation(spark, sf, "attempts").select(
        "event_id",
        T.batch_path(
            "enriched", F.lit("r1"), T.padded_id(F.col("partition_no")), F.col("event_id") % 1000
        ).alias("path"),
    )


@query("format_run_id", "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS run_id FROM events")
def format_run_id(spark, sf):
    return table(spark, sf, "events").select("event_id", T.compact_time(F.col("ts")).alias("run_id"))


@query(
    "created_at_text",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN ''
      ELSE '.' || lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0') END || '+00:00' AS created_at FROM events""",
)
def created_at_text(spark, sf):
    return table(spark, sf, "events").select("event_id", T.iso_time(F.col("ts")).alias("created_at"))
