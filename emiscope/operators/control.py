"""Run bookkeeping as table transforms: a control table and events in, the next table out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emiscope.functions.text import padded_id
from emiscope.operators.ranking import last_write_wins
from emiscope.schemas import (
    BUDGET_WINDOW_SECONDS,
    CALL_BUDGET,
    CLAIMABLE_STATUSES,
    CONTROL_SCHEMA,
    METRIC_COUNTS,
    OUTPUT_FOLDERS,
    RESUMABLE_STATUSES,
)


#: What names a control row.
KEY = ("run_id", "partition_id")


@dataclass(frozen=True)
class PrepareSettings:
    """Settings of one preparation run. Numbers must be positive, paths need a scheme."""

    run_id: str
    source_path: str
    prepared_path: str
    workers: int = 4
    threads_per_worker: int = 1
    rate_limit: int = CALL_BUDGET
    window_seconds: int = BUDGET_WINDOW_SECONDS
    calls_per_model: int = 1
    source_form: str = "csv"
    """``csv``, or ``parquet`` for rows that a discovery job published."""

    def __post_init__(self) -> None:
        positive = (
            "workers", "threads_per_worker", "rate_limit", "window_seconds", "calls_per_model"
        )
        for name in positive:
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be greater than 0")
        if not self.source_path:
            raise ValueError("source_path is required")
        if "://" not in self.source_path and not self.source_path.startswith("/"):
            raise ValueError(f"source_path is no absolute path or URI: {self.source_path}")


def refused(settings: DataFrame) -> DataFrame:
    """Rows of settings with the reason ``PrepareSettings`` refuses them for, or NULL. Missing columns pass."""
    path = F.col("source_path")
    foreign = ~path.contains("://") & ~path.startswith("/")
    reason = F.when(foreign, F.concat(F.lit("source_path is no absolute path or URI: "), path))
    reason = F.when(F.coalesce(path, F.lit("")) == "", "source_path is required").otherwise(reason)
    for name in ("calls_per_model", "window_seconds", "rate_limit", "threads_per_worker", "workers"):
        if name in settings.columns:
            reason = F.when(F.col(name) <= 0, f"{name} must be greater than 0").otherwise(reason)
    return settings.withColumn("refused", reason)


def point_get(control: DataFrame, pk: str, sk: str) -> DataFrame:
    return control.where((F.col("PK") == pk) & (F.col("SK") == sk))


def prefix_scan(control: DataFrame, pk: str, sk_prefix: str) -> DataFrame:
    return control.where((F.col("PK") == pk) & F.col("SK").startswith(sk_prefix))


def claimable(control: DataFrame) -> DataFrame:
    return control.where(F.col("status").isin(*CLAIMABLE_STATUSES))


def resumable(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.where(F.col("status").isin(*RESUMABLE_STATUSES))


def chunk_descriptors(bounds: DataFrame, settings: PrepareSettings) -> DataFrame:
    """Chunk bounds to work descriptors with padded ids and their input paths."""
    pid = padded_id(F.col("chunk"))
    base = settings.prepared_path.rstrip("/")
    return bounds.select(
        pid.alias("partition_id"),
        F.concat(F.lit(f"{base}/chunks/partition_id="), pid).alias("input_path"),
        F.lit(settings.threads_per_worker).alias("thread_count"),
        F.col("records_count").cast("bigint").alias("records_count"),
        "emission_min",
        "emission_max",
        F.lit("PENDING").alias("status"),
    )


def control_items(chunks: DataFrame, settings: PrepareSettings, now: Column) -> DataFrame:
    """One pending control row per chunk, in ``CONTROL_SCHEMA``."""
    run = settings.run_id
    calls = F.col("records_count") * settings.calls_per_model
    prefix = F.format_string(f"enriched/run_id={run}/partition_id=%s/", "partition_id")
    known = {
        "PK": F.lit(f"RUN#{run}"),
        "SK": F.concat(F.lit("PARTITION#"), "partition_id"),
        "entity_type": F.lit("PARTITION"),
        "run_id": F.lit(run),
        "output_prefix": prefix,
        "partition_call_budget": calls,
        "estimated_calls": calls,
        "global_rate_limit": F.lit(settings.rate_limit),
        "window_seconds": F.lit(settings.window_seconds),
        "calls_per_model": F.lit(settings.calls_per_model),
        "input_count": F.col("records_count"),
        "attempts": F.lit(0),
        "created_at": now,
        "updated_at": now,
    }
    counts = {n: F.lit(0) for n in (*METRIC_COUNTS, "skipped_count") if n != "input_count"}
    given = {c: F.col(c) for c in chunks.columns}
    fields = [part.split(" ", 1) for part in CONTROL_SCHEMA.split(", ")]
    cells = {**given, **counts, **known}
    return chunks.select(*[cells.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in fields])


def as_documents(control: DataFrame) -> DataFrame:
    """Control rows as nested items: input, output, rate budget, execution, metrics and error."""
    groups = {
        "output": ("output_prefix", "results_path", "errors_path", "metrics_path", "success_marker_path"),
        "rate_budget": (
            "partition_call_budget", "estimated_calls", "global_rate_limit", "window_seconds", "calls_per_model"
        ),
        "execution": ("attempts", "started_at", "completed_at", "job_name", "job_run_id"),
        "metrics": (*METRIC_COUNTS, "skipped_count", "last_batch_path"),
        "error": ("last_error_type", "last_error_message"),
    }
    nested = {c for members in groups.values() for c in members}
    return control.select(
        *[c for c in control.columns if c not in nested],
        F.struct(F.col("input_path").alias("uri"), "records_count").alias("input"),
        *[F.struct(*members).alias(name) for name, members in groups.items()],
    )


def run_items(
    chunks: DataFrame, settings: PrepareSettings, now: Column, pipeline: str = "PIPELINE#carbon"
) -> DataFrame:
    """The run's own control item and the last-run pointer, which carries less."""
    counted = chunks.agg(F.count(F.lit(1)).alias("partitions_count"))
    kinds = F.array(
        F.struct(
            F.lit(f"RUN#{settings.run_id}").alias("SK"), F.lit("PREPARATION_RUN").alias("kind")
        ),
        F.struct(F.lit("LAST_RUN").alias("SK"), F.lit("LAST_RUN_POINTER").alias("kind")),
    )
    rows = counted.select("partitions_count", F.explode(kinds).alias("_k"))
    whole = F.col("_k.kind") == "PREPARATION_RUN"
    details = {
        "workers": settings.workers,
        "threads_per_worker": settings.threads_per_worker,
        "global_rate_limit": settings.rate_limit,
        "window_seconds": settings.window_seconds,
        "calls_per_model": settings.calls_per_model,
    }
    base = settings.prepared_path.rstrip("/")
    return rows.select(
        F.lit(pipeline).alias("PK"),
        F.col("_k.SK").alias("SK"),
        F.col("_k.kind").alias("entity_type"),
        F.lit(settings.run_id).alias("run_id"),
        F.lit("PREPARED").alias("status"),
        F.lit(settings.source_path).alias("source_csv_path"),
        F.lit(f"{base}/manifest").alias("manifest_path"),
        "partitions_count",
        *[F.when(whole, F.lit(value)).alias(name) for name, value in details.items()],
        F.when(whole, now).alias("created_at"),
        now.alias("updated_at"),
    )


def claim(control: DataFrame, wanted: DataFrame, job_name: str, now: Column) -> DataFrame:
    """Wanted pending or failed partitions start running; others stay as they are.

    ``wanted`` names runs and partitions; a request made twice claims once.
    """
    asked = wanted.select(*KEY).distinct().withColumn("_asked", F.lit(True))
    taken = F.coalesce("_asked", F.lit(False)) & F.col("status").isin(*CLAIMABLE_STATUSES)
    return (
        control.join(asked, list(KEY), "left")
        .withColumn("_taken", taken)
        .withColumns(
            {
                "status": F.when(F.col("_taken"), "RUNNING").otherwise(F.col("status")),
                "attempts": F.col("attempts") + F.col("_taken").cast("int"),
                "started_at": F.when(F.col("_taken"), F.coalesce("started_at", now)).otherwise(
                    F.col("started_at")
                ),
                "job_name": F.when(F.col("_taken"), F.lit(job_name)).otherwise(F.col("job_name")),
                "updated_at": F.when(F.col("_taken"), now).otherwise(F.col("updated_at")),
            }
        )
        .drop("_asked", "_taken")
        .select(*control.columns)
    )


def apply_claims(control: DataFrame, claims: DataFrame) -> DataFrame:
    """Control rows as the claims leave them: a claim of a later attempt makes a row running.

    Of several later claims the one of the latest attempt counts.
    """
    newest = claims.groupBy(*KEY).agg(F.max_by(F.struct("attempt", "job_name", "claimed_at"), "attempt").alias("_claim"))
    joined = control.join(newest, list(KEY), "left")
    later = F.coalesce(F.col("_claim.attempt") > F.col("attempts"), F.lit(False))
    changes = {
        "status": F.lit("RUNNING"),
        "attempts": F.col("_claim.attempt"),
        "started_at": F.coalesce("started_at", "_claim.claimed_at"),
        "job_name": F.col("_claim.job_name"),
        "updated_at": F.col("_claim.claimed_at"),
    }
    updates = {name: F.when(later, value).otherwise(F.col(name)) for name, value in changes.items()}
    return joined.withColumns(updates).select(*control.columns)


def output_paths(base: str) -> dict[str, Column]:
    """Where the outputs of a row's run and partition lie below ``base``: each a folder to read."""
    below = F.format_string("/run_id=%s/partition_id=%s", "run_id", "partition_id")
    return {name: F.concat(F.lit(f"{base}/{folder}"), below) for name, folder in OUTPUT_FOLDERS.items()}


def _merged(
    control: DataFrame,
    events: DataFrame,
    names: Sequence[str],
    changes: dict[str, Column],
    now: Column,
    sequence: Sequence[str],
) -> DataFrame:
    """Columns in ``names`` and ``changes`` follow the newest event of the same run and partition.

    Events are ordered by ``sequence``, then by their own values, so that repeats change nothing.
    """
    given = [n for n in names if n in events.columns]
    newest = F.max_by(F.struct(*given), F.struct(*sequence, *given))
    hit = events.groupBy(*KEY).agg(newest.alias("_event"), F.lit(True).alias("_hit"))
    joined = control.join(hit, list(KEY), "left")
    seen = F.coalesce("_hit", F.lit(False))
    updates = {n: F.coalesce(F.col(f"_event.{n}"), F.col(n)) for n in given}
    for name, value in {**changes, "updated_at": now}.items():
        updates[name] = F.when(seen, value).otherwise(F.col(name))
    return joined.withColumns(updates).select(*control.columns)


def merge_progress(control: DataFrame, metrics: DataFrame, now: Column, sequence: Sequence[str] = ()) -> DataFrame:
    """Counters and last batch path of running partitions."""
    names = [n for n in METRIC_COUNTS if n != "input_count"] + ["last_batch_path"]
    return _merged(control, metrics, names, {}, now, sequence)


def complete(
    control: DataFrame, metrics: DataFrame, prefix: str, now: Column, sequence: Sequence[str] = ()
) -> DataFrame:
    """Finished partitions get their counters and the paths of what they left.

    A path is named only if there is something to read: no results without a success, no errors
    without a failure.
    """
    paths = output_paths(prefix)
    some = {"results_path": "success_count", "errors_path": "failed_count"}
    named = {n: F.when(F.col(f"_event.{some[n]}") > 0, path) if n in some else path for n, path in paths.items()}
    changes = {
        "status": F.lit("COMPLETED"),
        "processed_count": F.col("_event.success_count") + F.col("_event.failed_count"),
        "output_prefix": paths["results_path"],
        **{n: path for n, path in named.items() if n in control.columns},
        "completed_at": now,
    }
    names = [n for n in METRIC_COUNTS if n != "processed_count"]
    return _merged(control, metrics, names, changes, now, sequence)


def fail(control: DataFrame, failures: DataFrame, now: Column, sequence: Sequence[str] = ()) -> DataFrame:
    """Failed partitions keep their counters and the error that ended them."""
    names = [
        "processed_count", "success_count", "failed_count", "api_calls_count",
        "last_error_type", "last_error_message",
    ]
    return _merged(control, failures, names, {"status": F.lit("FAILED")}, now, sequence)


def upsert_latest(events: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Pointer or status table: the newest event per key."""
    return last_write_wins(events, list(keys), list(sequence))
