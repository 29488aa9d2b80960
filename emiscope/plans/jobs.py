"""End-to-end jobs. Each is a chain of DataFrame operators between written tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emiscope.functions.text import padded_id
from emiscope.operators import aggregates as A
from emiscope.operators import control as K
from emiscope.operators import digests as D
from emiscope.operators import joins as J
from emiscope.operators import ranking as R
from emiscope.operators import rows as W
from emiscope.schemas import (
    BRONZE_SCHEMA,
    DISCOVERY_COLUMNS,
    DISCOVERY_SCHEMA,
    ENRICHED_COLUMNS,
    ENRICHED_SCHEMA,
    ERROR_SCHEMA,
    METRICS_SCHEMA,
    OUTPUT_FOLDERS,
)
from emiscope.session import write_through
from emiscope.sources import claims, pages, readers, writers


#: Steps of a discovery run, in order.
EVENTS = ("matched", "published")


def prepare_order() -> list[Column]:
    """Most used first; ties are settled by id, so that the order is total."""
    return [F.desc("downloads"), F.desc("likes"), F.desc("co2_eq_emissions"), F.asc("model_id")]


@dataclass
class DiscoveryResult:
    models: DataFrame
    totals: DataFrame


def _tell(spark: SparkSession, out: str, snapshot_id: str, event: str, counts: DataFrame, at: Column) -> None:
    told = counts.select(
        F.lit(snapshot_id).alias("run_id"), F.lit(EVENTS.index(event)).alias("step"), F.lit(event).alias("event"),
        F.lit("COMPLETED" if event == EVENTS[-1] else "RUNNING").alias("status"), at.alias("at"), "counted",
    )
    writers.append_events(told, f"{out}/events")


def _told_at(discovered_at: str | None) -> Column:
    return F.lit(discovered_at) if discovered_at is not None else W.now_text()


def discover(
    spark: SparkSession, listing: DataFrame, out: str, snapshot_id: str, discovered_at: str | None = None
) -> DiscoveryResult:
    """Listed payloads (``seq``, ``page``, ``payload_json``) to a published snapshot, in one go.

    Matches go to numbered parts, the last row of each model wins, and the result is
    published under ``snapshot_id=`` and as ``latest``. Steps hand typed Parquet on, so no
    text is lost; ``csv/snapshot_id=`` is an export. Other snapshots stay. Progress goes
    to ``events``, its newest entry of each snapshot being the run's state.
    """
    matched = write_through(
        W.discovery_rows(listing, snapshot_id, discovered_at, keep=("seq", "page")), "matches"
    )
    _tell(spark, out, snapshot_id, "matched", matched.agg(F.count(F.lit(1)).alias("counted")), _told_at(discovered_at))
    sizes = listing.groupBy("page").agg(F.count(F.lit(1)).alias("page_size"))
    return _published(spark, matched, sizes, out, snapshot_id, discovered_at)


def _published(
    spark: SparkSession, matched: DataFrame, sizes: DataFrame, out: str, snapshot_id: str, discovered_at: str | None
) -> DiscoveryResult:
    """Matches (``seq, page`` and the discovery columns) and page sizes, to parts and a published snapshot."""
    place = f"snapshot_id={snapshot_id}"
    matches = matched.groupBy("page").agg(F.count(F.lit(1)).alias("page_matches"))
    pages = sizes.join(matches, "page", "left").select(
        F.lit(snapshot_id).alias("snapshot_id"),
        "page",
        "page_size",
        F.coalesce("page_matches", F.lit(0).cast("bigint")).alias("page_matches"),
    )
    segments = A.flush_segments(pages).select("page", "part_number")
    parts = f"{out}/filtered_parts/{place}"
    writers.write_parts(matched.join(segments, "page").drop("page").withColumnRenamed("snapshot_id", "snapshot"), parts)

    layout = f"seq BIGINT, {DISCOVERY_SCHEMA}, part_number BIGINT".replace("snapshot_id", "snapshot")
    stored = spark.read.schema(layout).parquet(parts).withColumnRenamed("snapshot", "snapshot_id")
    stored = stored.where(F.coalesce("model_id", F.lit("")) != "")
    models = R.last_write_wins(
        stored.select("part_number", "seq", *DISCOVERY_COLUMNS), ["model_id"], ["part_number", "seq"]
    )
    snapshot = f"{out}/filtered/{place}"
    writers.publish(models.select(*DISCOVERY_COLUMNS), snapshot, f"{out}/latest")
    published = readers.read_discovery(spark, snapshot, "parquet")
    writers.write_csv(published, f"{out}/csv/{place}")
    totals = pages.groupBy("snapshot_id").agg(
        F.sum("page_size").alias("total_models_seen"),
        F.sum("page_matches").alias("models_with_emissions"),
    )
    result = totals.withColumn("final_rows_count", F.lit(published.count()).cast("bigint"))
    writers.write_json(result.drop("snapshot_id"), f"{out}/result/{place}")
    _tell(spark, out, snapshot_id, "published", result.select(F.col("final_rows_count").alias("counted")), _told_at(discovered_at))
    return DiscoveryResult(models=published, totals=result)


def take_pages(
    spark: SparkSession,
    pages_path: str,
    out: str,
    snapshot_id: str,
    discovered_at: str | None = None,
    pages_per_batch: int = pages.PAGES_PER_BATCH,
) -> DataFrame:
    """Match the stored pages that this snapshot has not taken yet; its progress, one row per batch.

    Each batch of pages leaves its matches, its page sizes and its progress. A batch that is
    repeated after a failure replaces its own. A failed batch ends the call with its error; the next
    call goes on after the last page that was taken.
    """
    base = f"{out}/taken/snapshot_id={snapshot_id}"

    def batch(rows: DataFrame, number: int) -> None:
        kept = rows.persist()
        try:
            matched = W.discovery_rows(kept, snapshot_id, discovered_at, keep=("seq", "page"))
            matched = matched.withColumnRenamed("snapshot_id", "snapshot")
            matched.write.mode("overwrite").parquet(f"{base}/matches/batch={number}")
            sizes = kept.groupBy("page").agg(F.count(F.lit(1)).alias("page_size"))
            sizes.write.mode("overwrite").parquet(f"{base}/sizes/batch={number}")
            progress = sizes.agg(
                F.max("page").alias("last_successful_page"), F.count(F.lit(1)).alias("pages"),
                F.coalesce(F.sum("page_size"), F.lit(0)).cast("bigint").alias("models_seen"), _told_at(discovered_at).alias("updated_at"),
            )
            progress.write.mode("overwrite").parquet(f"{base}/progress/batch={number}")
        finally:
            kept.unpersist()

    query = (
        pages.stream(spark, pages_path, pages_per_batch)
        .writeStream.foreachBatch(batch).option("checkpointLocation", f"{base}/checkpoint").start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return pages_taken(spark, out, snapshot_id)


def pages_taken(spark: SparkSession, out: str, snapshot_id: str) -> DataFrame:
    """Progress of ``take_pages``: the last page, pages and models of each batch."""
    layout = "last_successful_page BIGINT, pages BIGINT, models_seen BIGINT, updated_at STRING, batch BIGINT"
    return _stored(spark, f"{out}/taken/snapshot_id={snapshot_id}/progress", layout)


def discover_pages(
    spark: SparkSession,
    pages_path: str,
    out: str,
    snapshot_id: str,
    discovered_at: str | None = None,
    pages_per_batch: int = pages.PAGES_PER_BATCH,
) -> DiscoveryResult:
    """Discovery over stored pages: takes the pages that are left, then publishes as ``discover`` does.

    A run that ended after page k goes on with page k + 1, and its result is that of one run.
    """
    take_pages(spark, pages_path, out, snapshot_id, discovered_at, pages_per_batch)
    base = f"{out}/taken/snapshot_id={snapshot_id}"
    layout = f"seq BIGINT, page BIGINT, {DISCOVERY_SCHEMA}, batch BIGINT".replace("snapshot_id", "snapshot")
    matched = _stored(spark, f"{base}/matches", layout).withColumnRenamed("snapshot", "snapshot_id").drop("batch")
    sizes = _stored(spark, f"{base}/sizes", "page BIGINT, page_size BIGINT, batch BIGINT").drop("batch")
    _tell(spark, out, snapshot_id, "matched", matched.agg(F.count(F.lit(1)).alias("counted")), _told_at(discovered_at))
    return _published(spark, matched, sizes, out, snapshot_id, discovered_at)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table of batches, or no rows where no batch was ever taken."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def resumable_snapshots(spark: SparkSession, out: str) -> DataFrame:
    """Snapshots whose newest progress event says that they are not complete."""
    layout = "run_id STRING, step INT, status STRING, at STRING, counted BIGINT, event STRING"
    events = readers.read_json_lines(spark, f"{out}/events", layout)
    return K.resumable(K.upsert_latest(events, ["run_id"], ["step", "at"]))


@dataclass
class PrepareResult:
    rows: DataFrame
    chunks: DataFrame
    control: DataFrame


def prepare(
    spark: SparkSession, settings: K.PrepareSettings, now: Column | None = None
) -> PrepareResult:
    """Discovery rows to ordered work chunks, a manifest and pending control items.

    Discovery publishes one row per model. If another source repeats a model, the row
    discovered last wins, then the one with the greater columns.
    """
    now = now if now is not None else W.now_text()
    source = readers.read_discovery(spark, settings.source_path, settings.source_form)
    texts = source.select(*[F.col(c).cast("string").alias(c) for c in source.columns])
    typed = W.valid_models(texts).select(*DISCOVERY_COLUMNS)
    others = [c for c in DISCOVERY_COLUMNS if c not in ("model_id", "discovered_at")]
    models = R.last_write_wins(typed, ["model_id"], ["discovered_at", *others])
    size = R.chunk_rows(settings.rate_limit, settings.workers, settings.calls_per_model)
    chunked = R.assign_chunks(models, prepare_order(), size)
    chunked = chunked.withColumn("partition_id", padded_id(F.col("chunk")))
    base = settings.prepared_path.rstrip("/")
    writers.write_chunks(chunked, f"{base}/chunks")
    declared = D.content_digests(chunked.withColumn("run_id", F.lit(settings.run_id)), K.KEY, DISCOVERY_COLUMNS)
    writers.overwrite_parquet(declared, f"{base}/digests")

    bounds = R.chunk_bounds(chunked)
    chunks = write_through(K.chunk_descriptors(bounds, settings), "chunks")
    header = {
        "run_id": F.lit(settings.run_id),
        "status": F.lit("PREPARED"),
        "source_csv_path": F.lit(settings.source_path),
        "partitions_count": F.count(F.lit(1)),
        "workers": F.lit(settings.workers),
        "threads_per_worker": F.lit(settings.threads_per_worker),
        "global_rate_limit": F.lit(settings.rate_limit),
        "window_seconds": F.lit(settings.window_seconds),
        "calls_per_model": F.lit(settings.calls_per_model),
        "created_at": now,
    }
    if chunks.isEmpty():
        raise ValueError(f"no valid models in {settings.source_path}")
    writers.write_manifest(chunks, header, base)
    control = K.control_items(chunks, settings, now)
    writers.write_json(K.as_documents(control), f"{base}/control")
    writers.write_json(K.run_items(chunks, settings, now), f"{base}/runs")
    return PrepareResult(rows=chunked, chunks=chunks, control=control)


@dataclass
class EnrichResult:
    enriched: DataFrame
    errors: DataFrame
    metrics: DataFrame


def enrich(
    spark: SparkSession,
    rows: DataFrame,
    payloads: DataFrame,
    out: str,
    run_id: str | None = None,
    now: Column | None = None,
    mark: bool = True,
) -> EnrichResult:
    """Chunk rows with their payloads to batches, dead letters, run metrics and success markers.

    ``rows`` carry ``partition_id``, and ``run_id`` unless one is given for all. Every input row
    ends in exactly one of the two outputs. Payloads are read once: the join, the check and the
    shaping of a row are one pass, whose result is written and then split. All lies in the
    folders that ``control.output_paths`` names; a retry replaces the partitions it holds and
    nothing else. The result is of these runs, with their earlier partitions. Without ``mark``
    the caller writes the markers.
    """
    run = F.col("run_id") if run_id is None else F.lit(run_id)
    found = J.attach_payloads(rows, payloads)
    shaped = W.enriched_rows(
        found, run, F.col("partition_id"), now,
        keep=("error_type", "error_message", "called", F.col("model_id").alias("_given"), F.col("discovered_at").alias("_at")),
    )
    shaped = write_through(shaped.withColumn("ok", F.col("error_type").isNull()), "outcomes")
    order = [F.asc("_given"), F.asc("_at")]
    done = A.batch_numbers(shaped.where("ok").select("_given", "_at", *ENRICHED_COLUMNS), list(K.KEY), order)
    writers.write_batches(done.select("batch", *ENRICHED_COLUMNS), f"{out}/{OUTPUT_FOLDERS['results_path']}", list(K.KEY))
    failed = shaped.where("NOT ok").select("run_id", "partition_id", F.col("_given").alias("model_id"), "error_type", "error_message")
    failed = W.error_rows(
        failed, F.col("run_id"), F.col("partition_id"), F.col("error_type"), F.col("error_message"), now
    )
    writers.write_batches(failed, f"{out}/{OUTPUT_FOLDERS['errors_path']}", list(K.KEY))
    counts = A.partition_metrics(shaped, list(K.KEY), F.col("ok"), F.col("called"))
    paths = K.output_paths(out)
    # Where the last batch is: batches are numbered rows of the partition's folder.
    last = F.when(F.col("batches_written") > 0, paths["results_path"])
    counts = write_through(counts.withColumn("last_batch_path", last), "metrics")
    # A partition without rows of one kind keeps none from an earlier attempt.
    for column, path in (("success_count", "results_path"), ("failed_count", "errors_path")):
        none = counts.where(F.col(column) == 0).select(*K.KEY)
        if not none.isEmpty():
            writers.empty_directories(none, f"{out}/{OUTPUT_FOLDERS[path]}")
    writers.write_batches(counts, f"{out}/{OUTPUT_FOLDERS['metrics_path']}", list(K.KEY))
    if mark:
        write_markers(counts, out, now)
    runs = counts.select("run_id").distinct()

    def read(path: str, schema: str) -> DataFrame:
        stored = _present(spark, f"{out}/{OUTPUT_FOLDERS[path]}", schema)
        return stored.join(F.broadcast(runs), "run_id", "left_semi") if run_id is None else stored.where(F.col("run_id") == run_id)

    return EnrichResult(
        enriched=read("results_path", ENRICHED_SCHEMA), errors=read("errors_path", ERROR_SCHEMA), metrics=read("metrics_path", METRICS_SCHEMA)
    )


def write_markers(metrics: DataFrame, out: str, now: Column | None = None) -> None:
    """Success markers of finished partitions, with their counts, where control rows say."""
    told = metrics.select(
        *K.KEY, F.lit("COMPLETED").alias("status"), "input_count", "success_count", "failed_count", "api_calls_count",
        "batches_written", (now if now is not None else W.now_text()).alias("success_marker_created_at"),
    )
    writers.write_batches(told, f"{out}/{OUTPUT_FOLDERS['success_marker_path']}", list(K.KEY))


def _present(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON table, or no rows where nothing was ever written."""
    try:
        return readers.read_json_lines(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass
class WorkResult:
    control: DataFrame
    metrics: DataFrame
    counts: DataFrame


def work(
    spark: SparkSession,
    control: DataFrame,
    wanted: DataFrame,
    payloads: DataFrame,
    out: str,
    job_name: str,
    now: Column | None = None,
    claims_path: str | None = None,
) -> WorkResult:
    """Claim partitions, enrich their chunks, and move them to their end.

    Of ``wanted`` (``run_id, partition_id``) the pending and failed ones run, unless another
    worker has claimed the same attempt at ``claims_path`` (by default below ``out``): any
    number of workers may start from one control table. A partition whose outcomes are as
    many as declared, from the rows that were prepared, completes and gets its marker; any
    other fails. ``control`` comes back
    whole, with the claims of all workers; ``counts`` reconciles declared with processed rows.
    """
    now = now if now is not None else W.now_text()
    log = claims_path or f"{out}/claims"
    asked = K.claimable(control).join(wanted.select(*K.KEY).distinct(), list(K.KEY), "left_semi")
    got = claims.take(spark, log, asked.select(*K.KEY, (F.col("attempts") + 1).cast("bigint").alias("attempt")), job_name, now)
    claimed = write_through(K.apply_claims(control, claims.claims(spark, log)), "claimed")
    mine = write_through(claimed.join(got.select(*K.KEY), list(K.KEY), "left_semi"), "mine")
    if mine.isEmpty():
        none = spark.createDataFrame([], METRICS_SCHEMA)
        return WorkResult(claimed, none, J.reconcile_counts(mine, none, K.KEY))
    chunks = readers.read_chunks(spark, mine)
    done = enrich(spark, chunks, payloads, out, None, now, mark=False)
    metrics = write_through(done.metrics.join(mine.select(*K.KEY), list(K.KEY), "left_semi"), "worked")
    counted = metrics.select(*K.KEY, F.col("processed_count").alias("actual_count"))
    actual = F.coalesce("actual_count", F.lit(0).cast("bigint"))
    counts = mine.select(*K.KEY, "records_count").join(counted, list(K.KEY), "left")
    counts = write_through(
        counts.select(*K.KEY, "records_count", actual.alias("actual_count"), (~F.col("records_count").eqNullSafe(actual)).alias("mismatch")),
        "reconciled",
    )
    declared = readers.read_digests(spark, mine)
    content = D.reconcile_content(declared, D.content_digests(chunks, K.KEY, DISCOVERY_COLUMNS), K.KEY)
    # Chunks that were prepared without digests are held against their counts alone.
    altered = content.join(declared, list(K.KEY), "left_semi").where("altered").select(*K.KEY)
    altered = write_through(altered.join(counts.where("NOT mismatch"), list(K.KEY), "left_semi"), "altered")
    moved = K.merge_progress(claimed, metrics, now)
    whole = metrics.join(counts.where("NOT mismatch"), list(K.KEY), "left_semi").join(altered, list(K.KEY), "left_anti")
    write_markers(whole, out, now)
    moved = K.complete(moved, whole, out, now)
    broken = counts.where("mismatch").select(
        *K.KEY,
        F.lit("CountMismatch").alias("last_error_type"),
        F.format_string("%d rows declared, %d processed", "records_count", "actual_count").alias("last_error_message"),
    )
    changed = altered.select(
        *K.KEY,
        F.lit("ContentMismatch").alias("last_error_type"),
        F.lit("as many rows as declared, of other content").alias("last_error_message"),
    )
    return WorkResult(write_through(K.fail(moved, broken.unionByName(changed), now), "control"), metrics, counts)


@dataclass
class GoldResult:
    models: DataFrame
    pointer: DataFrame


def gold(
    spark: SparkSession, enriched_glob: str, out: str, run_id: str, now: Column | None = None
) -> GoldResult:
    """Enriched JSON lines to the gold table, its CSV export and the last-run pointer."""
    enriched = readers.read_json_lines(spark, enriched_glob, ENRICHED_SCHEMA)
    writers.overwrite_parquet(W.gold_rows(enriched), f"{out}/models")
    models = spark.read.parquet(f"{out}/models")
    writers.export_csv(W.gold_export(models), f"{out}/export_csv")
    pointer = models.agg(
        F.lit("COMPLETED").alias("gold_status"),
        F.count(F.lit(1)).alias("gold_records"),
        F.lit(f"{out}/models").alias("gold_path"),
        F.lit(f"{out}/export_csv").alias("gold_csv_path"),
        F.lit(run_id).alias("run_id"),
        (now if now is not None else W.now_text()).alias("gold_completed_at"),
    )
    writers.write_json(pointer, f"{out}/last_run")
    return GoldResult(models=models, pointer=pointer)


@dataclass
class BronzeResult:
    rows: DataFrame
    by_status: DataFrame
    by_shard: DataFrame
    repeated: DataFrame
    retry: DataFrame


def bronze(
    spark: SparkSession,
    models: DataFrame,
    ranges: DataFrame,
    emission: str,
    out: str,
    run_id: str,
    ingested_at: Column | None = None,
) -> BronzeResult:
    """Models into the bronze table by emission range, with its run checks."""
    # Which ranges were met is read from the written directories, so the models are read once.
    keys = ("run_id", "shard_id")
    hits = W.bronze_rows(J.in_ranges(models, ranges, emission), run_id, ingested_at=ingested_at)
    writers.append_json(writers.gathered(hits, *keys), out, *keys)
    met = _present(spark, out, BRONZE_SCHEMA).where(F.col("run_id") == run_id).select("shard_id").distinct()
    idle = write_through(ranges.join(met, "shard_id", "left_anti"), "idle_ranges")
    blank = F.lit(None).cast("string")
    idle = idle.withColumns({"model_id": blank, "payload_json": blank})
    writers.append_json(W.bronze_rows(idle, run_id, ingested_at=ingested_at), out, *keys)
    rows = readers.read_run(spark, out, BRONZE_SCHEMA, run_id)
    ok = rows.where("status = 'ok'")
    complete = rows.groupBy("shard_id").agg(F.count_if(F.col("status") == "error").alias("_bad"))
    return BronzeResult(
        rows=rows,
        by_status=A.count_by(rows, "status"),
        by_shard=A.count_by(rows, "shard_id"),
        repeated=A.duplicates(ok, "run_id", "shard_id", "model_id"),
        retry=J.not_yet_done(ranges.select("shard_id"), complete.where("_bad = 0"), "shard_id"),
    )


def raw_snapshot(
    spark: SparkSession,
    payloads: DataFrame,
    out: str,
    snapshot_date: str,
    full_refresh: bool = False,
    ingested_at: Column | None = None,
) -> DataFrame:
    rows = W.stamp_snapshot(W.raw_model_rows(payloads), snapshot_date, ingested_at)
    writers.write_snapshot(rows, out, full_refresh)
    return spark.read.schema(rows.schema).parquet(out)

