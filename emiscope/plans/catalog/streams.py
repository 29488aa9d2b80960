"""Structured Streaming queries. Each takes its table in steps and ends in the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from emiscope.plans.catalog.base import query
from emiscope.plans.catalog.windows import LATEST_SQL, shown
from emiscope.plans.fixtures import relation, table
from emiscope.session import fresh_path
from emiscope.streaming import incremental as S


@query("stream_page_ingest", "SELECT seq, page, k, has_emission FROM page_log")
def stream_page_ingest(spark, sf):
    """Two runs with pages added in between, and a third that finds nothing new."""
    base = fresh_path(spark, "pages")
    log = relation(spark, sf, "page_log")
    for first_half in (True, False, None):
        if first_half is not None:
            half = log.where((F.col("page") % 2 == 0) == F.lit(first_half))
            half.write.mode("append").parquet(f"{base}/in")
        stream = S.page_stream(spark, f"{base}/in", log.schema, max_files=4)
        S.ingest_pages(stream, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(log.schema).parquet(f"{base}/out")


@query("stream_flush_parts", "SELECT seq, page, k FROM page_log WHERE has_emission")
def stream_flush_parts(spark, sf):
    base = fresh_path(spark, "flush")
    log = relation(spark, sf, "page_log")
    log.repartition(4, "page").write.parquet(f"{base}/in")
    stream = S.page_stream(spark, f"{base}/in", log.schema, max_files=1)
    S.flush_parts(stream.where("has_emission"), f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select("seq", "page", "k")


@query("stream_latest_per_model", LATEST_SQL)
def stream_latest_per_model(spark, sf):
    base = fresh_path(spark, "latest")
    log = relation(spark, sf, "enrich_log")
    log.repartition(3, "attempt_id").write.parquet(f"{base}/in")
    stream = S.page_stream(spark, f"{base}/in", log.schema, max_files=1)
    S.track_latest(stream, ["k"], ["enriched_at", "attempt_id"], f"{base}/out", f"{base}/checkpoint")
    S.compact(spark, f"{base}/out", ["k"])
    return shown(S.current_state(spark, f"{base}/out", ["k"])).select(
        "k", "attempt_id", "enriched_at", "status", "value"
    )


@query(
    "rate_window_audit",
    """SELECT strftime(time_bucket(INTERVAL '300 seconds', ts), '%Y%m%dT%H%M%SZ') AS window_start, COUNT(*) AS calls,
      COUNT(*) > 2 AS over_budget, greatest(COUNT(*) - 2, 0) AS excess_calls FROM events GROUP BY 1""",
)
def rate_window_audit(spark, sf):
    base = fresh_path(spark, "calls")
    calls = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    # Several micro-batches in no order of time, so that calls come late.
    calls.repartition(4, "event_id").write.parquet(f"{base}/in")
    stream = S.page_stream(spark, f"{base}/in", calls.schema, max_files=1)
    S.track_call_windows(stream, "ts", f"{base}/out", f"{base}/checkpoint")
    windows = S.call_windows(spark, f"{base}/out")
    return S.over_budget(windows, 2).withColumn(
        "window_start", F.date_format("window_start", "yyyyMMdd'T'HHmmss'Z'")
    )
