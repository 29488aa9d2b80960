"""Row shapes: payloads in, discovery, bronze, raw, enriched, error and gold rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emiscope.functions import payload as P
from emiscope.functions.text import iso_time, parse_float, parse_int, strip
from emiscope.operators.ranking import latest_per_key
from emiscope.operators.staging import where_computed
from emiscope.schemas import (
    BRONZE_COLUMNS,
    DISCOVERY_COLUMNS,
    ENRICHED_COLUMNS,
    ERROR_COLUMNS,
)


_LISTING_KEYS = (
    "id", "modelId", *P.CARD_KEYS, "createdAt", "created_at", "downloads", "likes",
    "library_name", "libraryName", "pipeline_tag", "pipelineTag", "tags",
)
_ENRICHING_KEYS = (
    "id", *P.CARD_KEYS, "datasets", "downloads", "likes", "library_name", "pipeline_tag",
    "createdAt", "created_at", "tags", "safetensors", "siblings",
)
_RAW_KEYS = (
    "id", *P.CARD_KEYS, "author", "createdAt", "lastModified", "downloads", "likes",
    "pipeline_tag", "library_name",
)


def now_text() -> Column:
    return iso_time(F.current_timestamp())


def _stored(value: Column) -> Column:
    """A VARIANT as the text a CSV cell or string column holds."""
    return P.text(value)


def discovery_rows(
    payloads: DataFrame,
    snapshot_id: str,
    discovered_at: str | None = None,
    json_column: str = "payload_json",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Payloads to discovery rows; rows without a usable emission object are left out.

    ``keep`` names input columns to carry along, such as a page or sequence number.
    """
    doc = F.col("_doc")
    stamp = F.lit(discovered_at) if discovered_at else now_text()
    co2 = P.co2_object(F.col("_card"))
    rows = (
        payloads.select(*keep, P.parsed(F.col(json_column), _LISTING_KEYS).alias("_doc"))
        .withColumn("_card", P.card(doc))
        .withColumn("_co2", co2)
    )
    rows = where_computed(rows, F.col("_co2.emissions").isNotNull())
    shaped = {
        "model_id": _stored(P.either(doc["id"], doc["modelId"])),
        "co2_eq_emissions": F.col("_co2.emissions"),
        "co2_source": F.col("_co2.source"),
        "training_type": F.col("_co2.training_type"),
        "geographical_location": F.col("_co2.geographical_location"),
        "hardware_used": F.col("_co2.hardware_used"),
        "created_at": _stored(P.either(doc["createdAt"], doc["created_at"])),
        "downloads": F.try_variant_get(doc["downloads"], "$", "bigint"),
        "likes": F.try_variant_get(doc["likes"], "$", "bigint"),
        "library_name": _stored(P.either(doc["library_name"], doc["libraryName"])),
        "pipeline_tag": _stored(P.either(doc["pipeline_tag"], doc["pipelineTag"])),
        "tags": P.spaced_json(doc["tags"]),
        "snapshot_id": F.lit(snapshot_id),
        "discovered_at": stamp,
    }
    return rows.select(*keep, *[shaped[c].alias(c) for c in DISCOVERY_COLUMNS])


def valid_models(rows: DataFrame) -> DataFrame:
    """Text rows to typed ones; blank ids and unreadable emissions are left out."""
    typed = rows.withColumns(
        {
            "model_id": strip(F.col("model_id")),
            "co2_eq_emissions": parse_float(F.col("co2_eq_emissions")),
            "downloads": parse_int(F.col("downloads")),
            "likes": parse_int(F.col("likes")),
        }
    )
    return where_computed(
        typed, (F.col("model_id") != "") & F.col("co2_eq_emissions").isNotNull()
    )


def enriched_rows(
    found: DataFrame,
    run_id: str | Column,
    partition_id: Column,
    enriched_at: Column | None = None,
    json_column: str = "payload_json",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Discovery rows that have their payload, to the 30 enriched columns."""
    doc, card = F.col("_doc"), F.col("_card")
    rows = (
        found.withColumn("_doc", P.parsed(F.col(json_column), _ENRICHING_KEYS))
        .withColumn("_card", P.card(doc))
        .withColumns(
            {
                "_entry": P.dataset_entry(doc, card),
                "_key": P.metrics_key(card),
                "_size": P.model_size(doc),
                "_emission": parse_float(F.col("co2_eq_emissions")),
                "_downloads": _count_of(doc["downloads"], F.col("downloads")),
                "_likes": _count_of(doc["likes"], F.col("likes")),
            }
        )
        .withColumns(
            {
                "_listed": F.size(P.dataset_list(F.col("_entry"))),
                "_metrics": P.metrics_entry(card, F.col("_key")),
            }
        )
    )
    shaped = {
        "modelId": _or_row(doc["id"], F.col("model_id")),
        "datasets": P.dataset_list_json(F.col("_entry")),
        "datasets_size": F.col("_listed"),
        "co2_eq_emissions": F.col("_emission"),
        "co2_reported": F.col("_emission").isNotNull(),
        "source": F.col("co2_source"),
        "environment": P.text_at(card, "environment"),
        "performance_metrics": P.metrics_text(
            F.col(json_column), doc, F.col("_key"), F.col("_metrics")
        ),
        "performance_score": P.greatest_number(F.col("_metrics")),
        "downloads": F.col("_downloads"),
        "likes": F.col("_likes"),
        "library_name": _or_row(doc["library_name"], F.col("library_name")),
        "domain": P.tag_domain(F.col("pipeline_tag"), doc, F.col("tags")),
        "size": F.col("_size"),
        "created_at": F.coalesce(
            *[F.when(P.truthy(doc[k]), P.text(doc[k])) for k in ("createdAt", "created_at")],
            F.col("created_at"),
        ),
        "size_efficency": P.ratio(F.col("_downloads"), F.col("_size")),
        "datasets_size_efficency": P.ratio(F.col("_downloads"), F.col("_listed")),
        "auto": P.mentions_auto(doc, F.col("tags")),
        "run_id": F.lit(run_id),
        "partition_id": partition_id,
        "enriched_at": enriched_at if enriched_at is not None else now_text(),
    }
    return rows.select(*keep, *[shaped.get(c, F.col(c)).alias(c) for c in ENRICHED_COLUMNS])


def _count_of(value: Column, row_value: Column) -> Column:
    return parse_int(F.when(P.truthy(value), P.text(value)).otherwise(row_value.cast("string")))


def _or_row(value: Column, row_value: Column) -> Column:
    return F.when(P.truthy(value), P.text(value)).otherwise(row_value)


def error_rows(
    failed: DataFrame,
    run_id: str | Column,
    partition_id: Column,
    error_type: Column,
    message: Column,
    failed_at: Column | None = None,
) -> DataFrame:
    """Failed input rows to dead-letter rows."""
    shaped = {
        "run_id": F.lit(run_id),
        "partition_id": partition_id,
        "model_id": F.col("model_id"),
        "error_type": error_type,
        "error_message": message,
        "failed_at": failed_at if failed_at is not None else now_text(),
    }
    return failed.select(*[shaped[c].alias(c) for c in ERROR_COLUMNS])


def bronze_rows(
    sharded: DataFrame,
    run_id: str,
    json_column: str = "payload_json",
    ingested_at: Column | None = None,
) -> DataFrame:
    """Range-joined payloads to bronze card rows.

    Status is ``empty`` for a range without a model, ``error`` for a payload that
    is no JSON object, else ``ok``.
    """
    rows = sharded.withColumn("_raw", F.try_parse_json(F.col(json_column)))
    rows = rows.withColumn("_card", P.card_of(F.col("_raw")))
    card = F.col("_card")
    rows = rows.withColumn("_co2", P.co2_any(card)).withColumn("_json", P.spaced_json(F.col("_raw")))
    empty = F.col(json_column).isNull()
    broken = ~empty & ~F.col("_json").startswith("{")
    ok = ~empty & ~broken
    shaped = {
        "run_id": F.lit(run_id),
        "shard_id": F.col("shard_id"),
        "model_id": F.when(ok, F.col("model_id")),
        "emissions_threshold_min": F.col("min_emissions"),
        "emissions_threshold_max": F.col("max_emissions"),
        "card_data_json": F.when(ok, P.object_json(card)),
        "model_raw_json": F.when(ok, F.col("_json")),
        "co2_emissions": F.when(ok, F.col("_co2.emissions")),
        "co2_source": F.when(ok, F.col("_co2.source")),
        "co2_training_type": F.when(ok, F.col("_co2.training_type")),
        "co2_geographical_location": F.when(ok, F.col("_co2.geographical_location")),
        "co2_hardware_used": F.when(ok, F.col("_co2.hardware_used")),
        "status": F.when(empty, "empty").when(broken, "error").otherwise("ok"),
        "error": F.when(broken, F.lit("ValueError('payload is not a JSON object')")),
        "ingested_at": ingested_at if ingested_at is not None else F.current_timestamp(),
    }
    return rows.select(*[shaped[c].alias(c) for c in BRONZE_COLUMNS])


def raw_model_rows(payloads: DataFrame, json_column: str = "payload_json") -> DataFrame:
    """Payloads with a non-empty emission entry, scalar or object, to raw model rows."""
    doc, card = F.col("_doc"), F.col("_card")
    rows = (
        payloads.select(P.parsed(F.col(json_column), _RAW_KEYS).alias("_doc"))
        .withColumn("_card", P.card(doc))
        .withColumn("_co2", P.co2_truthy(card))
    )
    rows = where_computed(rows, F.col("_co2").isNotNull())

    def listed(key: str) -> Column:
        return F.when(P.truthy(P.at(card, key)), P.shown(P.at(card, key)))

    return rows.select(
        P.text(doc["id"]).alias("model_id"),
        P.text(doc["author"]).alias("author"),
        P.text(doc["createdAt"]).alias("created_at"),
        P.text(doc["lastModified"]).alias("last_modified"),
        F.coalesce(F.try_variant_get(doc["downloads"], "$", "bigint"), F.lit(0)).alias("downloads"),
        F.coalesce(F.try_variant_get(doc["likes"], "$", "bigint"), F.lit(0)).alias("likes"),
        P.text(doc["pipeline_tag"]).alias("pipeline_tag"),
        P.text(doc["library_name"]).alias("library_name"),
        listed("language").alias("language"),
        listed("license").alias("license"),
        P.dataset_text(card).alias("datasets"),
        F.col("_co2.emissions").alias("co2_emissions_grams"),
        F.col("_co2.source").alias("source"),
        F.col("_co2.training_type").alias("training_type"),
        F.col("_co2.geographical_location").alias("geographical_location"),
        F.col("_co2.hardware_used").alias("hardware_used"),
    )


def stamp_snapshot(rows: DataFrame, snapshot_date: str, ingested_at: Column | None = None) -> DataFrame:
    at = ingested_at if ingested_at is not None else F.current_timestamp()
    return rows.withColumns({"snapshot_date": F.lit(snapshot_date), "ingested_at_utc": at})


def gold_rows(enriched: DataFrame, negative_size_for_null: bool = False) -> DataFrame:
    """Latest enriched row per model, with its dataset list parsed again.

    Equal times are settled by the highest ``partition_id`` and then by row content.
    ``negative_size_for_null`` gives -1 for an unreadable list, as older Spark
    sessions do.
    """
    tie_break = [F.col(c).desc() for c in ("enriched_at", "partition_id", "model_id", "datasets")]
    newest = latest_per_key(enriched, ["modelId"], tie_break)
    listed = newest.withColumn("datasets_list", P.reparsed_list(F.col("datasets")))
    length = F.size("datasets_list")
    if negative_size_for_null:
        length = F.coalesce(length, F.lit(-1))
    return listed.withColumn("datasets_size", length).drop("datasets")


def gold_export(gold: DataFrame) -> DataFrame:
    """Gold rows with every column in a form a CSV file can hold."""
    return gold.withColumns(
        {
            "datasets_list": F.col("datasets_list").cast("string"),
            "performance_metrics": F.col("performance_metrics").cast("string"),
        }
    )

