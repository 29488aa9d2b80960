"""Dataset usage, silver tables, availability and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from emiscope.functions import payload as P
from emiscope.operators import profile as D
from emiscope.operators import references as R
from emiscope.plans.catalog.base import DETAIL_CTES, DISCOVERY_CTES, query
from emiscope.plans.catalog.scalars import REF_CTES, cards
from emiscope.plans.catalog.scans import discovered
from emiscope.plans.fixtures import relation, table
from emiscope.session import write_through

# Suppliers stand in for datasets with a known size.
DATASETS = """
datasets AS (
  SELECT 'ds' || CAST(s_suppkey AS VARCHAR) AS dataset_id, s_suppkey * 1000 + s_nationkey AS dataset_size FROM supplier)"""
SIZED_CTES = (*REF_CTES, DATASETS)


def datasets(spark, sf):
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("ds"), F.col("s_suppkey").cast("string")).alias("dataset_id"),
        (F.col("s_suppkey") * 1000 + F.col("s_nationkey")).alias("dataset_size"),
    )


def refs(spark, sf):
    return D.model_refs(relation(spark, sf, "payloads"))


@query("unique_dataset_refs", "SELECT DISTINCT dataset_id FROM refs", REF_CTES)
def unique_dataset_refs(spark, sf):
    return D.unique_refs(refs(spark, sf))


@query(
    "silver_datasets",
    """SELECT r.dataset_id, d.dataset_size FROM (SELECT DISTINCT dataset_id FROM refs) r
    LEFT JOIN datasets d ON d.dataset_id = r.dataset_id""",
    SIZED_CTES,
)
def silver_datasets(spark, sf):
    return D.silver_datasets(refs(spark, sf), datasets(spark, sf))


@query(
    "gold_with_dataset_sizes",
    """SELECT p.model_id, COUNT(r.dataset_id) AS datasets_count, CAST(SUM(d.dataset_size) AS BIGINT) AS datasets_total_size
    FROM payloads p LEFT JOIN refs r ON r.k = p.k LEFT JOIN datasets d ON d.dataset_id = r.dataset_id GROUP BY p.model_id""",
    SIZED_CTES,
)
def gold_with_dataset_sizes(spark, sf):
    models = relation(spark, sf, "payloads").select("model_id")
    return D.with_dataset_sizes(models, refs(spark, sf), datasets(spark, sf))


@query(
    "silver_models",
    """SELECT model_id, size / 1048576.0 AS model_size_mb,
      contains(lower(CAST(json_extract(j, '$.tags') AS VARCHAR)), 'auto') AS is_autotrain,
      json_extract_string(co2, '$.training_type') AS training_type,
      json_extract_string(co2, '$.geographical_location') AS geographical_location,
      json_extract_string(co2, '$.hardware_used') AS hardware_used, metrics_text AS performance_metrics FROM detailed""",
    DETAIL_CTES,
)
def silver_models(spark, sf):
    return D.silver_models(relation(spark, sf, "payloads"))


@query(
    "corr_co2_size",
    """SELECT round(corr(emission, size), 9) AS correlation,
      COUNT(CASE WHEN emission IS NOT NULL AND size IS NOT NULL THEN 1 END) AS pairs FROM detailed""",
    DETAIL_CTES,
)
def corr_co2_size(spark, sf):
    rows = cards(spark, sf).select(
        P.co2_object(F.col("_card"))["emissions"].alias("emission"), P.model_size(F.col("_doc")).alias("size")
    )
    found = D.emission_size_correlation(rows, "emission", "size")
    return found.withColumn("correlation", F.round("correlation", 9))


@query("dataset_usage", "SELECT dataset_id, COUNT(*) AS models FROM refs GROUP BY dataset_id", REF_CTES)
def dataset_usage(spark, sf):
    return D.usage_counts(refs(spark, sf))


def yearly_refs(spark, sf):
    """References of line items to parts, as datasets of one run per year."""
    lines = table(spark, sf, "lineitem")
    return lines.select(F.year("l_shipdate").alias("run"), F.concat(F.lit("ds"), F.col("l_partkey").cast("string")).alias("dataset_id"))


YEARLY = """
yearly AS (SELECT CAST(year(CAST(l_shipdate AS DATE)) AS INTEGER) AS run, 'ds' || CAST(l_partkey AS VARCHAR) AS dataset_id FROM lineitem)"""


@query(
    "datasets_over_runs",
    """SELECT r.run, COUNT(*) AS "references", COUNT(DISTINCT y.dataset_id) AS items,
      (SELECT COUNT(DISTINCT dataset_id) FROM yearly s WHERE s.run <= r.run) AS items_so_far,
      COUNT(DISTINCT CASE WHEN f.first_run = r.run THEN y.dataset_id END) AS new_items,
      (SELECT COUNT(DISTINCT dataset_id) FROM yearly s WHERE s.run = (SELECT max(q.run) FROM yearly q WHERE q.run < r.run)
        AND s.dataset_id NOT IN (SELECT t.dataset_id FROM yearly t WHERE t.run = r.run)) AS lost_items
    FROM (SELECT DISTINCT run FROM yearly) r JOIN yearly y ON y.run = r.run
    JOIN (SELECT dataset_id, min(run) AS first_run FROM yearly GROUP BY 1) f ON f.dataset_id = y.dataset_id GROUP BY r.run""",
    (YEARLY,),
)
def datasets_over_runs(spark, sf):
    """From the stored sketches of each run alone."""
    sketches = write_through(R.run_sketches(yearly_refs(spark, sf), "run", "dataset_id"), "run_sketches")
    return R.items_over_runs(sketches, "run")


@query(
    "top_datasets_over_runs",
    """SELECT run, dataset_id, COUNT(*) AS "references" FROM yearly WHERE dataset_id IN (
      SELECT dataset_id FROM yearly GROUP BY 1 ORDER BY COUNT(*) DESC, dataset_id LIMIT 20) GROUP BY 1, 2""",
    (YEARLY,),
)
def top_datasets_over_runs(spark, sf):
    """The twenty datasets used most, and how often each run refers to them."""
    rows = yearly_refs(spark, sf)
    sketches = write_through(R.run_sketches(rows, "run", "dataset_id"), "run_sketches")
    return R.counts_over_runs(rows, "run", "dataset_id", R.top_items(rows, sketches, "dataset_id", 20))


PROFILED = ("model_id", "co2_source", "training_type", "hardware_used", "pipeline_tag", "tags")


@query(
    "availability_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS present, COUNT(*) AS total, COUNT({c}) / COUNT(*) AS share FROM discovered"
        for c in PROFILED
    ),
    DISCOVERY_CTES,
)
def availability_profile(spark, sf):
    return D.availability(discovered(spark, sf), list(PROFILED))


@query(
    "quality_checks",
    """SELECT 'no_pipeline_tag' AS check_name, COUNT(*) FILTER (pipeline_tag IS NULL) AS failed_rows FROM discovered
    UNION ALL SELECT 'no_downloads', COUNT(*) FILTER (downloads <= 0) FROM discovered
    UNION ALL SELECT 'negative_emission', COUNT(*) FILTER (co2_eq_emissions < 0) FROM discovered
    UNION ALL SELECT 'zero_emission', COUNT(*) FILTER (co2_eq_emissions = 0) FROM discovered""",
    DISCOVERY_CTES,
)
def quality_checks(spark, sf):
    rules = {
        "no_pipeline_tag": F.col("pipeline_tag").isNull(),
        "no_downloads": F.col("downloads") <= 0,
        "negative_emission": F.col("co2_eq_emissions") < 0,
        "zero_emission": F.col("co2_eq_emissions") == 0,
    }
    return D.quality_checks(discovered(spark, sf), rules)
