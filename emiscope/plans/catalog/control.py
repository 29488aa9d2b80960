"""Control-table transitions over the attempt log."""

from __future__ import annotations

from pyspark.sql import functions as F

from emiscope.functions.text import padded_id
from emiscope.operators import control as K
from emiscope.operators import ranking as R
from emiscope.plans.catalog.base import RUN, STAMP, query
from emiscope.plans.catalog.scans import CHUNK_CTES, METRICS_SQL, chunked, metrics, settings
from emiscope.plans.fixtures import relation

PID_SQL = "lpad(CAST(partition_no AS VARCHAR), 6, '0')"


def control_table(spark, sf):
    """One control row per partition, its status taken from its newest attempt."""
    rows = relation(spark, sf, "attempts").withColumn("partition_id", padded_id(F.col("partition_no")))
    newest = rows.groupBy("partition_id").agg(
        F.max_by("outcome", F.struct("ts", "event_id")).alias("_last"),
        F.count_if(F.col("outcome") == "FAILED").alias("attempts"),
        F.count(F.lit(1)).alias("input_count"),
    )
    odd = F.col("partition_id").cast("int") % 3
    zero = F.lit(0).cast("bigint")
    blank = F.lit(None).cast("string")
    return newest.select(
        F.lit(RUN).alias("run_id"),
        "partition_id",
        F.when(odd == 0, "PENDING").when(odd == 1, F.col("_last")).otherwise("FAILED").alias("status"),
        "attempts",
        F.when(odd == 2, F.lit("earlier")).alias("started_at"),
        blank.alias("completed_at"),
        blank.alias("job_name"),
        "input_count",
        *[
            zero.alias(n)
            for n in (
                "processed_count", "success_count", "failed_count", "api_calls_count", "batches_written",
            )
        ],
        blank.alias("last_batch_path"),
        blank.alias("output_prefix"),
        blank.alias("success_marker_path"),
        blank.alias("last_error_type"),
        blank.alias("last_error_message"),
        F.lit("created").alias("updated_at"),
    )


CONTROL = f"""
metrics AS ({METRICS_SQL}),
control AS (
  SELECT {PID_SQL} AS partition_id,
    CASE partition_no % 3 WHEN 0 THEN 'PENDING' WHEN 1 THEN arg_max(outcome, (ts, event_id)) ELSE 'FAILED' END AS status,
    CAST(SUM(CASE WHEN outcome = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS attempts,
    CASE WHEN partition_no % 3 = 2 THEN 'earlier' END AS started_at
  FROM attempts GROUP BY partition_no)"""
CONTROL_CTES = (CONTROL,)


@query(
    "control_items",
    f"""SELECT 'RUN#{RUN}' AS "PK", 'PARTITION#' || partition_id AS "SK", 'PENDING' AS status, records_count,
      emission_min, emission_max, records_count AS call_budget, 300 AS window_seconds, CAST(0 AS BIGINT) AS attempts,
      'enriched/run_id={RUN}/partition_id=' || partition_id || '/' AS output_prefix FROM bounds""",
    CHUNK_CTES,
)
def control_items(spark, sf):
    chunks = K.chunk_descriptors(R.chunk_bounds(chunked(spark, sf)), settings(spark))
    return K.control_items(chunks, settings(spark), F.lit(STAMP)).select(
        "PK", "SK", "status", "records_count", "emission_min", "emission_max",
        F.col("partition_call_budget").alias("call_budget"), "window_seconds", "attempts", "output_prefix",
    )


@query(
    "control_claim",
    f"""SELECT partition_id, CASE WHEN taken THEN 'RUNNING' ELSE status END AS status,
      attempts + CASE WHEN taken THEN 1 ELSE 0 END AS attempts,
      CASE WHEN taken THEN COALESCE(started_at, '{STAMP}') ELSE started_at END AS started_at,
      CASE WHEN taken THEN 'enrich' END AS job_name, CASE WHEN taken THEN '{STAMP}' ELSE 'created' END AS updated_at
    FROM (SELECT *, partition_id <> '000006' AND status IN ('PENDING', 'FAILED') AS taken FROM control)""",
    CONTROL_CTES,
)
def control_claim(spark, sf):
    control = control_table(spark, sf)
    wanted = control.where("partition_id <> '000006'").select("run_id", "partition_id")
    elsewhere = control.select(F.lit("other").alias("run_id"), "partition_id")
    wanted = wanted.unionByName(wanted).unionByName(elsewhere)
    return K.claim(control, wanted, "enrich", F.lit(STAMP)).select(
        "partition_id", "status", "attempts", "started_at", "job_name", "updated_at"
    )


def with_batch_path(spark, sf):
    path = F.format_string("batch_%06d.jsonl", "batches_written")
    """Progress events of every partition: an older one with lower counts, and the newest one twice."""
    newest = metrics(spark, sf).withColumns({"run_id": F.lit(RUN), "last_batch_path": path, "step": F.lit(2)})
    older = newest.withColumns({"processed_count": F.lit(0).cast("bigint"), "step": F.lit(1)})
    other = newest.withColumns({"run_id": F.lit("other"), "step": F.lit(9)})
    return newest.unionByName(newest).unionByName(older).unionByName(other)


@query(
    "control_progress",
    f"""SELECT c.partition_id, c.status, COALESCE(m.processed_count, 0) AS processed_count,
      COALESCE(m.success_count, 0) AS success_count, COALESCE(m.failed_count, 0) AS failed_count,
      'batch_' || lpad(CAST(m.batches_written AS VARCHAR), 6, '0') || '.jsonl' AS last_batch_path,
      CASE WHEN m.partition_id IS NULL THEN 'created' ELSE '{STAMP}' END AS updated_at
    FROM control c LEFT JOIN metrics m ON m.partition_id = c.partition_id AND m.partition_id <> '000004'""",
    CONTROL_CTES,
)
def control_progress(spark, sf):
    progress = with_batch_path(spark, sf).where("partition_id <> '000004'")
    return K.merge_progress(control_table(spark, sf), progress, F.lit(STAMP), ["step"]).select(
        "partition_id", "status", "processed_count", "success_count", "failed_count",
        "last_batch_path", "updated_at",
    )


@query(
    "control_complete",
    f"""SELECT c.partition_id, CASE WHEN m.partition_id IS NULL THEN c.status ELSE 'COMPLETED' END AS status,
      COALESCE(m.success_count + m.failed_count, 0) AS processed_count, COALESCE(m.batches_written, 0) AS batches_written,
      CASE WHEN m.partition_id IS NOT NULL THEN 'enriched/markers/run_id={RUN}/partition_id=' || c.partition_id END AS success_marker_path,
      CASE WHEN m.partition_id IS NOT NULL THEN 'enriched/batches/run_id={RUN}/partition_id=' || c.partition_id END AS output_prefix,
      CASE WHEN m.partition_id IS NOT NULL THEN '{STAMP}' END AS completed_at
    FROM control c LEFT JOIN metrics m ON m.partition_id = c.partition_id AND m.partition_id <> '000004'""",
    CONTROL_CTES,
)
def control_complete(spark, sf):
    done = metrics(spark, sf).where("partition_id <> '000004'").withColumn("run_id", F.lit(RUN))
    return K.complete(control_table(spark, sf), done, "enriched", F.lit(STAMP)).select(
        "partition_id", "status", "processed_count", "batches_written", "success_marker_path", "output_prefix", "completed_at"
    )


@query(
    "control_fail",
    """SELECT c.partition_id, CASE WHEN m.partition_id IS NULL THEN c.status ELSE 'FAILED' END AS status,
      COALESCE(m.failed_count, 0) AS failed_count, CASE WHEN m.partition_id IS NOT NULL THEN 'RuntimeError' END AS last_error_type,
      m.failed_count || ' records failed' AS last_error_message
    FROM control c LEFT JOIN metrics m ON m.partition_id = c.partition_id AND m.failed_count > m.input_count * 0.2""",
    CONTROL_CTES,
)
def control_fail(spark, sf):
    failures = metrics(spark, sf).where("failed_count > input_count * 0.2").select(
        F.lit(RUN).alias("run_id"), "partition_id", "processed_count", "success_count", "failed_count", "api_calls_count",
        F.lit("RuntimeError").alias("last_error_type"),
        F.concat(F.col("failed_count").cast("string"), F.lit(" records failed")).alias("last_error_message"),
    )
    return K.fail(control_table(spark, sf), failures, F.lit(STAMP)).select(
        "partition_id", "status", "failed_count", "last_error_type", "last_error_message"
    )


@query(
    "last_run_pointer",
    """SELECT partition_no, event_id AS run_no, outcome AS status FROM (
      SELECT *, row_number() OVER (PARTITION BY partition_no ORDER BY ts DESC, event_id DESC) AS rn FROM attempts) WHERE rn = 1""",
)
def last_run_pointer(spark, sf):
    rows = relation(spark, sf, "attempts").select(
        "partition_no", "ts", F.col("event_id").alias("run_no"), F.col("outcome").alias("status")
    )
    return K.upsert_latest(rows, ["partition_no"], ["ts", "run_no"]).drop("ts")


@query(
    "run_status",
    """SELECT user_id, outcome AS status, event_id FROM (
      SELECT e.user_id, a.outcome, a.event_id, row_number() OVER (PARTITION BY e.user_id ORDER BY a.event_id DESC) AS rn
      FROM events e JOIN attempts a ON a.event_id = e.event_id) WHERE rn = 1""",
)
def run_status(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select(
        "user_id",
        F.when(F.col("event_type") == "error", "FAILED").otherwise("COMPLETED").alias("status"),
        "event_id",
    )
    return K.upsert_latest(events, ["user_id"], ["event_id"])
