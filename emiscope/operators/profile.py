"""Dataset usage, silver tables, availability and quality profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emiscope.functions import payload as P
from emiscope.operators.staging import where_computed


def model_refs(payloads: DataFrame, json_column: str = "payload_json") -> DataFrame:
    """Models with their distinct sorted dataset references."""
    doc = F.col("_doc")
    rows = payloads.withColumn("_doc", P.parsed(F.col(json_column), (*P.CARD_KEYS, "tags")))
    rows = rows.withColumn("_entry", P.at(P.card(doc), "datasets"))
    return rows.select("model_id", P.dataset_refs(F.col("_entry"), doc["tags"]).alias("refs"))


def _exploded(refs: DataFrame) -> DataFrame:
    """One row per model and reference. Spark would infer the same filter and, without
    the pin, build the references once more for it."""
    listed = where_computed(refs, F.col("refs").isNotNull() & (F.size("refs") > 0))
    return listed.select("model_id", F.explode("refs").alias("dataset_id"))


def unique_refs(refs: DataFrame) -> DataFrame:
    return _exploded(refs).select("dataset_id").distinct()


def usage_counts(refs: DataFrame) -> DataFrame:
    return (
        _exploded(refs)
        .groupBy("dataset_id")
        .agg(F.count(F.lit(1)).alias("models"))
    )


def silver_datasets(refs: DataFrame, datasets: DataFrame) -> DataFrame:
    """Each referenced dataset once, with its size where it is known."""
    return unique_refs(refs).join(datasets, "dataset_id", "left")


def with_dataset_sizes(models: DataFrame, refs: DataFrame, datasets: DataFrame) -> DataFrame:
    """Models with the number of referenced datasets and their total known size.

    Only ids are exploded and joined. Sizes come from one row per dataset, so Spark
    either broadcasts them when small or splits a hot dataset on the model side.
    """
    summed = (
        _exploded(refs)
        .join(datasets, "dataset_id", "left")
        .groupBy("model_id")
        .agg(
            F.count(F.lit(1)).alias("datasets_count"),
            F.sum("dataset_size").alias("datasets_total_size"),
        )
    )
    return models.join(summed, "model_id", "left").withColumn(
        "datasets_count", F.coalesce("datasets_count", F.lit(0))
    )


def silver_models(payloads: DataFrame, json_column: str = "payload_json") -> DataFrame:
    """Model-level silver rows: size in MB, automation flag, emission context, metrics."""
    doc, card = F.col("_doc"), F.col("_card")
    keys = (*P.CARD_KEYS, "tags", "safetensors", "siblings")
    rows = payloads.withColumn("_doc", P.parsed(F.col(json_column), keys))
    rows = rows.withColumn("_card", P.card(doc))
    rows = rows.withColumns(
        {"_co2": P.co2_any(card), "_size": P.model_size(doc), "_key": P.metrics_key(card)}
    ).withColumn("_metrics", P.metrics_entry(card, F.col("_key")))
    return rows.select(
        "model_id",
        (F.col("_size") / (1024 * 1024)).alias("model_size_mb"),
        P.mentions_auto(doc, F.lit(None).cast("string")).alias("is_autotrain"),
        F.col("_co2.training_type").alias("training_type"),
        F.col("_co2.geographical_location").alias("geographical_location"),
        F.col("_co2.hardware_used").alias("hardware_used"),
        P.metrics_text(F.col(json_column), doc, F.col("_key"), F.col("_metrics")).alias(
            "performance_metrics"
        ),
    )


def availability(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Share of rows that have a value, per column, in one pass."""
    counted = rows.agg(*[F.count(c).alias(c) for c in columns], F.count(F.lit(1)).alias("_all"))
    return (
        counted.unpivot("_all", columns, "column_name", "present")
        .select("column_name", "present", F.col("_all").alias("total"))
        .withColumn("share", F.try_divide(F.col("present"), F.col("total")))
    )


def quality_checks(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Number of rows that break each rule, in one pass. A rule is true for a bad row."""
    counted = rows.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    return counted.unpivot([], list(rules), "check_name", "failed_rows")


def emission_size_correlation(rows: DataFrame, emission: str, size: str) -> DataFrame:
    return rows.agg(
        F.corr(emission, size).alias("correlation"),
        F.count_if(F.col(emission).isNotNull() & F.col(size).isNotNull()).alias("pairs"),
    )
