"""End-to-end jobs over the derived catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from emiscope.operators import control as K
from emiscope.operators import joins as J
from emiscope.operators import ranking as R
from emiscope.plans import jobs
from emiscope.plans.catalog.base import CARDS, DETAILS, DISCOVERY_CTES, ENRICHED_CTES, RUN, STAMP, query
from emiscope.plans.catalog.rows import (
    BRONZE_SELECT, CARD_SHARD_CTES, GOLD_ORACLE, RAW_MODELS, bronze_checked, emission_facts,
    gold_checked, repeated_enriched,
)
from emiscope.plans.catalog.scans import CHUNK_CTES, chunked, discovered
from emiscope.plans.fixtures import relation, table
from emiscope.schemas import DISCOVERY_SCHEMA, ENRICHED_SCHEMA, ERROR_SCHEMA, MARKER_SCHEMA, METRICS_SCHEMA, OUTPUT_FOLDERS
from emiscope.session import fresh_path, write_through
from emiscope.sources import pages, readers, writers


@query(
    "job_discovery",
    """SELECT d.model_id, d.co2_eq_emissions, CAST(d.likes AS BIGINT) AS likes, d.tags, t.seen AS total_models_seen, t.matched AS models_with_emissions
    FROM discovered d, (SELECT COUNT(*) AS seen, COUNT(e.k) AS matched FROM page_log p
      JOIN payloads x ON x.k = p.k LEFT JOIN discovered e ON e.k = p.k) t
    WHERE d.k IN (SELECT k FROM page_log)""",
    DISCOVERY_CTES,
)
def job_discovery(spark, sf):
    listing = relation(spark, sf, "page_log").join(
        relation(spark, sf, "payloads").select("k", "payload_json"), "k"
    )
    done = jobs.discover(spark, listing, fresh_path(spark, "discovery"), RUN, STAMP)
    totals = done.totals.select("snapshot_id", "total_models_seen", "models_with_emissions")
    rows = done.models.select(
        "snapshot_id",
        "model_id",
        "co2_eq_emissions",
        "likes",
        "tags",
    )
    return rows.join(totals, "snapshot_id").drop("snapshot_id")


@query(
    "job_discovery_resumed",
    """SELECT d.model_id, d.co2_eq_emissions, CAST(d.likes AS BIGINT) AS likes, d.tags, t.seen AS total_models_seen, t.matched AS models_with_emissions,
      t.pages AS pages_taken, t.pages AS last_successful_page
    FROM discovered d, (SELECT COUNT(*) AS seen, COUNT(e.k) AS matched, COUNT(DISTINCT p.page) AS pages FROM dense_pages p
      JOIN payloads x ON x.k = p.k LEFT JOIN discovered e ON e.k = p.k) t
    WHERE d.k IN (SELECT k FROM page_log)""",
    (*DISCOVERY_CTES, "dense_pages AS (SELECT l.k, CAST(floor(l.page / 20) AS BIGINT) AS page FROM page_log l JOIN payloads x ON x.k = l.k)"),
)
def job_discovery_resumed(spark, sf):
    """A listing whose second half is stored after the first run ended; the second run goes on there."""
    listing = relation(spark, sf, "page_log").join(relation(spark, sf, "payloads").select("k", "payload_json"), "k")
    # The cursor has no gaps: pages are put together in twenties and numbered anew in their order.
    listing = listing.withColumn("page", F.floor(F.col("page") / 20))
    numbers = R.global_index(listing.select("page").distinct(), [F.asc("page")], "number")
    listing = listing.join(numbers, "page").select("seq", (F.col("number") + 1).alias("page"), "payload_json")
    listing = write_through(listing, "listing")
    base = fresh_path(spark, "resumed")
    half = listing.agg(F.max("page")).first()[0] // 2
    each = half * 2 // 3 + 1  # two batches to each run
    pages.store(listing.where(F.col("page") <= half), f"{base}/pages")
    jobs.take_pages(spark, f"{base}/pages", f"{base}/out", RUN, STAMP, each)
    pages.store(listing.where(F.col("page") > half), f"{base}/pages")
    done = jobs.discover_pages(spark, f"{base}/pages", f"{base}/out", RUN, STAMP, each)
    taken = jobs.pages_taken(spark, f"{base}/out", RUN)
    taken = taken.groupBy(F.lit(RUN).alias("snapshot_id")).agg(
        F.sum("pages").alias("pages_taken"), F.max("last_successful_page").alias("last_successful_page")
    )
    totals = done.totals.drop("final_rows_count").join(taken, "snapshot_id")
    return done.models.select("snapshot_id", "model_id", "co2_eq_emissions", "likes", "tags").join(totals, "snapshot_id").drop("snapshot_id")


@query(
    "job_prepare",
    f"""SELECT 'RUN#{RUN}' AS "PK", 'PARTITION#' || partition_id AS "SK", records_count, emission_min, emission_max,
      records_count AS call_budget FROM bounds""",
    CHUNK_CTES,
)
def job_prepare(spark, sf):
    base = fresh_path(spark, "prepare")
    writers.write_csv(discovered(spark, sf, keep=()), f"{base}/source")
    config = K.PrepareSettings(run_id=RUN, source_path=f"{base}/source", prepared_path=f"{base}/prepared")
    return jobs.prepare(spark, config, F.lit(STAMP)).control.select(
        "PK", "SK", "records_count", "emission_min", "emission_max",
        F.col("partition_call_budget").alias("call_budget"),
    )


@query(
    "job_discovery_text",
    """SELECT CAST(doc_id AS VARCHAR) AS model_id, '  ' || text || chr(10) || ' ' AS co2_source,
      '["' || lang || '"]' AS tags, place FROM documents, (VALUES ('published'), ('csv')) t(place)""",
)
def job_discovery_text(spark, sf):
    """Whole texts with line ends and outer blanks through discovery, its table and its CSV export."""
    text = F.concat(F.lit("  "), "text", F.lit("\n "))
    emission = F.struct(F.lit(1.5).alias("emissions"), text.alias("source"))
    payload = F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.array("lang").alias("tags"),
        F.struct(emission.alias("co2_eq_emissions")).alias("cardData"),
    )
    listing = table(spark, sf, "documents").select(
        F.col("doc_id").alias("seq"),
        (F.floor(F.col("doc_id") / 100) + 1).alias("page"),
        F.to_json(payload).alias("payload_json"),
    )
    out = fresh_path(spark, "discovery")
    done = jobs.discover(spark, listing, out, RUN, STAMP)
    exported = readers.read_header_csv(spark, f"{out}/csv/snapshot_id={RUN}")
    both = [
        rows.select("model_id", "co2_source", "tags", F.lit(place).alias("place"))
        for rows, place in ((done.models, "published"), (exported, "csv"))
    ]
    return both[0].unionByName(both[1])


@query(
    "job_enrich",
    f"""SELECT '{RUN}' AS run_id, partition_id, COUNT(*) AS input_count, COUNT(*) AS processed_count,
      COUNT(*) FILTER (usable) AS success_count, COUNT(*) FILTER (NOT usable) AS failed_count,
      COUNT(*) FILTER (k % 29 <> 0) AS api_calls_count, CAST(ceil(COUNT(*) FILTER (usable) / 50.0) AS BIGINT) AS batches_written
    FROM (SELECT *, k % 11 <> 0 AND k % 13 <> 0 AND k % 29 <> 0 AS usable FROM chunked) GROUP BY partition_id""",
    CHUNK_CTES,
)
def job_enrich(spark, sf):
    return enrich_chunks(spark, sf).metrics.drop("last_batch_path")


def damaged_payloads(spark, sf):
    """Every eleventh payload is absent, every thirteenth unreadable or no object, and some come twice."""
    rows = relation(spark, sf, "payloads").where("k % 11 <> 0")
    bad = F.when(F.col("k") % 2 == 0, "<html>502 bad gateway").otherwise("[1, 2]")
    rows = rows.withColumn("payload_json", F.when(F.col("k") % 13 == 0, bad).otherwise(F.col("payload_json")))
    return rows.unionByName(rows.where("k % 7 = 0"))


def enrich_chunks(spark, sf):
    rows = chunked(spark, sf)
    blank = F.when(F.col("k") % 29 == 0, F.lit(" ")).otherwise(F.col("model_id"))
    rows = rows.withColumn("model_id", blank).drop("k", "idx", "chunk")
    out = fresh_path(spark, "enrich")
    return jobs.enrich(spark, rows, damaged_payloads(spark, sf), out, RUN, F.lit(STAMP))


@query(
    "job_enrich_rows",
    """SELECT c.partition_id, d.model_id, x.datasets_size, d.co2_eq_emissions, d.downloads, d.likes, s.score AS performance_score, x.size
    FROM chunked c JOIN discovered d ON d.k = c.k JOIN detailed x ON x.k = c.k LEFT JOIN scores s ON s.k = c.k
    WHERE c.k % 11 <> 0 AND c.k % 13 <> 0 AND c.k % 29 <> 0""",
    (*CHUNK_CTES, DETAILS),
)
def job_enrich_rows(spark, sf):
    return enrich_chunks(spark, sf).enriched.select(
        "partition_id", "model_id", "datasets_size", "co2_eq_emissions", "downloads", "likes", "performance_score", "size"
    )


@query(
    "job_enrich_errors",
    """SELECT partition_id, CASE WHEN k % 29 = 0 THEN ' ' ELSE model_id END AS model_id,
      CASE WHEN k % 29 = 0 THEN 'ValueError' WHEN k % 11 = 0 THEN 'LookupError' ELSE 'InvalidPayload' END AS error_type,
      CASE WHEN k % 29 = 0 THEN 'Missing model_id' WHEN k % 11 = 0 THEN 'No payload for ' || model_id
        ELSE 'Payload is no JSON object: ' || model_id END AS error_message
    FROM chunked WHERE k % 11 = 0 OR k % 13 = 0 OR k % 29 = 0""",
    CHUNK_CTES,
)
def job_enrich_errors(spark, sf):
    return enrich_chunks(spark, sf).errors.select("partition_id", "model_id", "error_type", "error_message")


@query(
    "job_runs",
    f"""SELECT run_id, partition_id, CASE WHEN run_id = 'B' AND partition_id = '000000' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
      CASE WHEN run_id = 'A' AND partition_id = '000000' THEN 2 ELSE 1 END AS attempts,
      CASE WHEN run_id = 'B' AND partition_id = '000000' THEN COUNT(*) + 1 ELSE COUNT(*) END AS records_count,
      COUNT(*) AS actual_count, COUNT(*) FILTER (k % 11 <> 0) AS success_count, COUNT(*) FILTER (k % 11 = 0) AS failed_count,
      COUNT(*) FILTER (k % 11 <> 0) AS enriched_rows
    FROM chunked, (VALUES ('A'), ('B')) t(run_id) GROUP BY run_id, partition_id""",
    CHUNK_CTES,
)
def job_runs(spark, sf):
    """Two runs from preparation to their end, asked for twice; the first retries one partition."""
    first, last, out = two_runs(spark, sf)
    actual = first.counts.select("run_id", "partition_id", "actual_count")
    enriched = readers.read_json_lines(spark, f"{out}/batches", ENRICHED_SCHEMA)
    stored = enriched.groupBy("run_id", "partition_id").agg(F.count(F.lit(1)).alias("enriched_rows"))
    return (
        last.control.join(actual, ["run_id", "partition_id"])
        .join(stored, ["run_id", "partition_id"])
        .select(
            "run_id", "partition_id", "status", F.col("attempts").cast("int").alias("attempts"), "records_count",
            "actual_count", "success_count", "failed_count", "enriched_rows",
        )
    )


def two_runs(spark, sf):
    """Results of the first and the last worker, and the folder of the outputs.

    Run B declares one row too many for its first partition, which has to fail.
    """
    base = fresh_path(spark, "runs")
    writers.publish(discovered(spark, sf, keep=()), f"{base}/source", f"{base}/latest")
    ready = [
        jobs.prepare(
            spark,
            K.PrepareSettings(run, f"{base}/source", f"{base}/prepared_{run}", source_form="parquet"),
            F.lit(STAMP),
        ).control
        for run in ("A", "B")
    ]
    first = F.col("partition_id") == "000000"
    odd = (F.col("run_id") == "B") & first
    control = ready[0].unionByName(ready[1])
    control = control.withColumn("records_count", F.col("records_count") + odd.cast("int"))
    payloads = relation(spark, sf, "payloads").where("k % 11 <> 0")
    keys = control.select("run_id", "partition_id")
    out = f"{base}/enriched"
    done = jobs.work(spark, control, keys.unionByName(keys), payloads, out, "enrich", F.lit(STAMP))
    # One partition is declared failed and asked for again.
    again = (F.col("run_id") == "A") & first
    failed = done.control.withColumn("status", F.when(again, "FAILED").otherwise(F.col("status")))
    return done, jobs.work(spark, failed, keys.where(again), payloads, out, "enrich", F.lit(STAMP)), out


@query(
    "job_altered_chunk",
    """SELECT partition_id, CASE WHEN partition_id = '000000' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
      CASE WHEN partition_id = '000000' THEN 'ContentMismatch' END AS last_error_type, COUNT(*) AS processed_count
    FROM chunked GROUP BY partition_id""",
    CHUNK_CTES,
)
def job_altered_chunk(spark, sf):
    """One row of one chunk is altered between preparation and work; all counts stay."""
    base = fresh_path(spark, "altered")
    writers.publish(discovered(spark, sf, keep=()), f"{base}/source", f"{base}/latest")
    settings = K.PrepareSettings(RUN, f"{base}/latest", f"{base}/prepared", source_form="parquet")
    ready = jobs.prepare(spark, settings, F.lit(STAMP))
    place = f"{base}/prepared/chunks/partition_id=000000"
    chunk = write_through(spark.read.schema(DISCOVERY_SCHEMA).parquet(place), "chunk")
    first = chunk.agg(F.min("model_id")).first()[0]
    altered = F.when(F.col("model_id") == first, F.col("likes") + 1).otherwise(F.col("likes"))
    chunk.withColumn("likes", altered).write.mode("overwrite").parquet(place)
    payloads = relation(spark, sf, "payloads")
    done = jobs.work(spark, ready.control, ready.control, payloads, f"{base}/enriched", "enrich", F.lit(STAMP))
    return done.control.select("partition_id", "status", "last_error_type", "processed_count")


@query(
    "job_named_paths",
    f"""SELECT run_id, partition_id, COUNT(*) FILTER (k % 11 <> 0) AS results_rows, COUNT(*) FILTER (k % 11 = 0) AS errors_rows,
      1 AS metrics_rows, 1 AS success_marker_rows, COUNT(*) FILTER (k % 11 <> 0) AS marked_success, COUNT(*) FILTER (k % 11 = 0) AS marked_failed,
      'COMPLETED' AS marked_status, CAST(ceil(COUNT(*) FILTER (k % 11 <> 0) / 50.0) AS BIGINT) AS last_batch, '{STAMP}' AS marked_at
    FROM chunked, (VALUES ('A'), ('B')) t(run_id) WHERE run_id = 'A' OR partition_id <> '000000' GROUP BY run_id, partition_id""",
    CHUNK_CTES,
)
def job_named_paths(spark, sf):
    """What stands at every path that a completed control row names: rows, marker and last batch."""
    _, last, out = two_runs(spark, sf)
    done = last.control.where("status = 'COMPLETED'")
    found = done.select(
        "run_id", "partition_id", "last_batch_path", *[F.col(name) for name in OUTPUT_FOLDERS]
    )
    place = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/"), "/[^/]*$", "").alias("_place")

    def at(name, schema, *shown):
        """Rows per folder of one kind of output, and what else is to be shown of them."""
        rows = spark.read.schema(schema).json(f"{out}/{OUTPUT_FOLDERS[name]}").select("*", place)
        return rows.groupBy("_place").agg(F.count(F.lit(1)).alias(name.replace("_path", "_rows")), *shown)

    marker = [
        F.max("status").alias("marked_status"), F.max("success_count").alias("marked_success"),
        F.max("failed_count").alias("marked_failed"), F.max("success_marker_created_at").alias("marked_at"),
    ]
    for name, rows in (
        ("results_path", at("results_path", f"batch BIGINT, {ENRICHED_SCHEMA}")),
        ("errors_path", at("errors_path", ERROR_SCHEMA)),
        ("metrics_path", at("metrics_path", METRICS_SCHEMA)),
        ("success_marker_path", at("success_marker_path", MARKER_SCHEMA, *marker)),
        ("last_batch_path", at("results_path", f"batch BIGINT, {ENRICHED_SCHEMA}", F.max("batch").alias("last_batch")).drop("results_rows")),
    ):
        plain = F.regexp_replace(F.col(name), "^file:/+", "/")
        found = found.join(rows, plain == rows["_place"], "left").drop("_place")
    named = found.drop("last_batch_path", *OUTPUT_FOLDERS)
    return named.withColumns(
        {n: F.coalesce(n, F.lit(0).cast("bigint")) for n in ("results_rows", "errors_rows")}
        | {n: F.col(n).cast("int") for n in ("metrics_rows", "success_marker_rows")}
    )


@query("job_gold", GOLD_ORACLE, ENRICHED_CTES)
def job_gold(spark, sf):
    base = fresh_path(spark, "gold")
    repeated_enriched(spark, sf).withColumn("dir", F.col("partition_id").substr(-1, 1)).write.partitionBy(
        "dir"
    ).json(f"{base}/enriched")
    done = jobs.gold(spark, f"{base}/enriched/dir=*/*.json", f"{base}/out", RUN, F.lit(STAMP))
    return gold_checked(done.models)


@query("job_bronze", BRONZE_SELECT, CARD_SHARD_CTES)
def job_bronze(spark, sf):
    done = jobs.bronze(
        spark, emission_facts(spark, sf), J.emission_ranges(spark), "emission", fresh_path(spark, "bronze"),
        RUN, F.lit(STAMP).cast("timestamp"),
    )
    return bronze_checked(done.rows)


@query("job_raw_snapshot", f"SELECT *, '2026-01-01' AS snapshot_date FROM ({RAW_MODELS})", (CARDS,))
def job_raw_snapshot(spark, sf):
    rows = relation(spark, sf, "payloads")
    stamp = F.lit(STAMP).cast("timestamp")
    done = jobs.raw_snapshot(spark, rows, fresh_path(spark, "raw"), "2026-01-01", True, stamp)
    return done.drop("ingested_at_utc")
