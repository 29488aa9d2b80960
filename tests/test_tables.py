"""Sources, sinks, jobs and streams on small written tables."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from emiscope import session
from emiscope.operators import aggregates as A
from emiscope.operators import control as K
from emiscope.operators import rows as W
from emiscope.plans import jobs
from emiscope.plans.fixtures import relation
from emiscope.schemas import CHUNK_SCHEMA, DISCOVERY_COLUMNS, DISCOVERY_SCHEMA, ERROR_SCHEMA
from emiscope.sources import readers, writers
from emiscope.streaming import incremental as S


@pytest.fixture
def out(spark, request):
    return session.fresh_path(spark, "test")


def test_csv_round_trip_of_awkward_text(spark, out):
    text = '  a "quoted", text; with [“unicode”] and \\ slash\n and a line end \r\n '
    rows = spark.createDataFrame([("m", "1.5", text), ("n", None, None)], "model_id STRING, co2_eq_emissions STRING, tags STRING")
    writers.write_csv(rows, out)
    got = {r["model_id"]: r["tags"] for r in readers.read_header_csv(spark, out).collect()}
    assert got == {"m": text, "n": None}


def test_csv_header_checks(spark, out):
    spark.createDataFrame([("m",)], "model_id STRING").write.option("header", True).csv(out)
    with pytest.raises(ValueError, match="co2_eq_emissions"):
        readers.read_header_csv(spark, out)


def test_absent_document(spark, out):
    assert readers.read_document(spark, f"{out}/nothing", "a INT") is None


def test_manifest_reads_back(spark, out):
    chunks = spark.range(5).selectExpr(
        "lpad(id, 6, '0') AS partition_id", "'p' AS input_path", "1 AS thread_count", "id AS records_count",
        "double(id) AS emission_min", "double(id) AS emission_max", "'PENDING' AS status",
    )
    header = {"run_id": F.lit("r"), "status": F.lit("PREPARED"), "partitions_count": F.count(F.lit(1))}
    writers.write_manifest(chunks, header, out)
    schema = "run_id STRING, status STRING, partitions_count BIGINT"
    rows = readers.read_manifest(spark, out, schema, CHUNK_SCHEMA).orderBy("partition_id").collect()
    assert [r["partition_id"] for r in rows] == [f"{i:06d}" for i in range(5)]
    assert {(r["run_id"], r["status"], r["partitions_count"]) for r in rows} == {("r", "PREPARED", 5)}


def test_export_is_one_file_when_asked(spark, out):
    text = ' x;"y"\nz '
    rows = spark.range(1000).repartition(4).withColumn("t", F.lit(text))
    writers.export_csv(rows, f"{out}/one", single_file=True)
    writers.export_csv(rows, f"{out}/many")
    assert len(glob.glob(f"{out}/one/*.csv")) == 1 and len(glob.glob(f"{out}/many/*.csv")) > 1
    for place in ("one", "many"):
        read = spark.read.options(**writers.CSV_CELLS).option("sep", ";").option("multiLine", True).csv(f"{out}/{place}")
        assert read.count() == 1000 and {r["t"] for r in read.select("t").distinct().collect()} == {text}


def test_batches_replace_only_their_own_directories(spark, out):
    rows = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "1", 3)], "run_id STRING, partition_id STRING, x INT")
    writers.write_batches(rows, out, ["run_id", "partition_id"])
    writers.write_batches(rows.where("x = 2").withColumn("x", F.lit(9)), out, ["run_id", "partition_id"])
    writers.drop_directories(spark, rows.where("x = 3").select("run_id", "partition_id"), out)
    read = readers.read_json_lines(spark, out, rows.schema)
    assert sorted((r.run_id, r.partition_id, r.x) for r in read.collect()) == [("a", "1", 1), ("a", "2", 9)]


def test_emptied_directories_have_no_rows(spark, out):
    rows = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "1", 3)], "run_id STRING, partition_id STRING, x INT")
    writers.write_batches(rows, out, ["run_id", "partition_id"])
    gone = spark.createDataFrame([("a", "1"), ("c", "7")], "run_id STRING, partition_id STRING")
    writers.empty_directories(gone, out)
    read = readers.read_json_lines(spark, out, rows.schema)
    assert sorted((r.run_id, r.partition_id, r.x) for r in read.collect()) == [("a", "2", 2), ("b", "1", 3)]
    writers.write_batches(rows.where("x = 1"), out, ["run_id", "partition_id"])
    assert read.sparkSession.read.schema(rows.schema).json(out).count() == 3


def test_batch_files_are_bounded(spark, out):
    rows = spark.range(230).withColumn("g", F.lit("p"))
    numbered = A.batch_numbers(rows, ["g"], [F.asc("id")])
    writers.write_batches(numbered, out, ["g"], rows_per_file=50)
    sizes = [sum(1 for _ in open(f)) for f in glob.glob(f"{out}/g=p/*.json")]
    assert sum(sizes) == 230 and max(sizes) <= 50
    batches = spark.read.json(out).groupBy("batch").count().orderBy("batch").collect()
    assert [tuple(b) for b in batches] == [(1, 50), (2, 50), (3, 50), (4, 50), (5, 30)]


def test_snapshot_modes(spark, out):
    def rows(n, day):
        return spark.range(n).withColumn("snapshot_date", F.lit(day))

    writers.write_snapshot(rows(3, "a"), out, True)
    writers.write_snapshot(rows(2, "b"), out, False)
    writers.replace_snapshot(rows(5, "b"), out)
    counts = {r[0]: r[1] for r in spark.read.parquet(out).groupBy("snapshot_date").count().collect()}
    assert counts == {"a": 3, "b": 5}
    writers.write_snapshot(rows(1, "c"), out, True)
    assert spark.read.parquet(out).count() == 1


def test_rerun_of_append_is_visible_as_duplicates(spark, out):
    rows = spark.createDataFrame([("r", 1, "m"), ("r", 2, "n")], "run_id STRING, shard_id INT, model_id STRING")
    writers.append_json(rows, out, "run_id", "shard_id")
    writers.append_json(rows.where("shard_id = 1"), out, "run_id", "shard_id")
    read = readers.read_run(spark, out, "run_id STRING, shard_id INT, model_id STRING", "r")
    assert [tuple(r) for r in A.duplicates(read, "run_id", "shard_id", "model_id").collect()] == [("r", 1, "m", 2)]


def test_write_through_keeps_rows_and_cuts_lineage(spark):
    rows = spark.range(100).withColumn("x", F.rand())
    stored = session.write_through(rows, "test")
    assert stored.collect() == stored.collect() and stored.count() == 100


# Jobs -----------------------------------------------------------------------------------


def test_chain_of_jobs(spark, sf, out):
    """Discovery to gold: every listed model with an emission ends in gold or in the dead letters."""
    payloads = relation(spark, sf, "payloads")
    listing = relation(spark, sf, "page_log").join(payloads.select("k", "payload_json"), "k")
    found = jobs.discover(spark, listing, f"{out}/discovery", "snap", "2026-01-01T00:00:00+00:00")
    models = found.models.count()
    totals = found.totals.first()
    assert totals["final_rows_count"] == models <= totals["models_with_emissions"]
    latest = readers.read_discovery(spark, f"{out}/discovery/latest", "parquet")
    assert latest.columns == list(DISCOVERY_COLUMNS) and latest.count() == models

    assert jobs.resumable_snapshots(spark, f"{out}/discovery").count() == 0
    config = K.PrepareSettings("run", f"{out}/discovery/latest", f"{out}/prepared", rate_limit=100, source_form="parquet")
    ready = jobs.prepare(spark, config)
    assert ready.rows.count() == models
    assert ready.chunks.agg(F.sum("records_count")).first()[0] == models
    assert ready.chunks.agg(F.max("records_count")).first()[0] <= 25

    for item in ready.control.collect():
        assert spark.read.parquet(item["input_path"]).count() == item["records_count"]
    assert readers.read_chunks(spark, ready.control).count() == models

    runs = spark.read.json(f"{out}/prepared/runs")
    assert {(r["SK"], r["partitions_count"]) for r in runs.collect()} == {
        ("RUN#run", ready.chunks.count()), ("LAST_RUN", ready.chunks.count())
    }

    some = payloads.where("k % 4 <> 0")
    broken = F.when(F.col("k") % 13 == 0, F.lit("<html>502 bad gateway")).otherwise(F.col("payload_json"))
    some = some.withColumn("payload_json", broken)
    some = some.unionByName(some.limit(20))
    rows = ready.rows.withColumn("model_id", F.when(F.col("idx") == 0, "  ").otherwise(F.col("model_id")))
    done = jobs.enrich(spark, rows, some, f"{out}/enriched", "run")
    assert done.enriched.count() + done.errors.count() == models
    assert done.errors.where("error_type = 'ValueError'").count() == 1
    assert done.errors.where("error_type = 'InvalidPayload'").count() > 0
    sums = done.metrics.agg(*[F.sum(c) for c in ("input_count", "success_count", "failed_count", "api_calls_count")]).first()
    assert sums[0] == sums[1] + sums[2] == models and sums[3] == models - 1

    gold = jobs.gold(spark, f"{out}/enriched/batches/run_id=*/partition_id=*/*.json", f"{out}/gold", "run")
    assert gold.models.count() == done.enriched.count() == gold.pointer.first()["gold_records"]
    assert "datasets" not in gold.models.columns and "datasets_list" in gold.models.columns


def test_runs_stay_side_by_side(spark, out):
    """A second run leaves the first alone; a retry replaces its own partition, and long messages stay whole."""
    rows = spark.createDataFrame(
        [("a", "000000"), ("b" * 2000, "000000"), ("c", "000001")], "model_id STRING, partition_id STRING"
    )
    blank = [c for c in DISCOVERY_COLUMNS if c != "model_id"]
    kinds = dict(part.split(" ") for part in DISCOVERY_SCHEMA.split(", "))
    rows = rows.withColumns({c: F.lit(None).cast(kinds[c]) for c in blank})
    payloads = spark.createDataFrame([("a", "{}"), ("c", "{}")], "model_id STRING, payload_json STRING")
    for run in ("r1", "r2"):
        jobs.enrich(spark, rows, payloads, out, run)
    both = payloads.unionByName(spark.createDataFrame([("b" * 2000, '{"id": "b"}')], payloads.schema))
    done = jobs.enrich(spark, rows.where("partition_id = '000000'"), both, out, "r1")
    assert done.enriched.count() == 3 and done.errors.count() == 0
    assert sorted((r.partition_id, r.success_count, r.failed_count) for r in done.metrics.collect()) == [("000000", 2, 0), ("000001", 1, 0)]
    errors = readers.read_json_lines(spark, f"{out}/errors", ERROR_SCHEMA).collect()
    assert [(e.run_id, e.error_message) for e in errors] == [("r2", "No payload for " + "b" * 2000)]
    markers = spark.read.json(f"{out}/markers")
    assert markers.where("run_id = 'r2'").agg(F.sum("failed_count")).first()[0] == 1


def test_control_keys_on_run_and_partition(spark):
    chunks = spark.createDataFrame([("000000", "p", 1, 3, 0.0, 1.0, "PENDING")], CHUNK_SCHEMA)
    two = [K.control_items(chunks, K.PrepareSettings(run, "/s", "/p"), F.lit("t0")) for run in ("r1", "r2")]
    control = two[0].unionByName(two[1])
    wanted = spark.createDataFrame([("r1", "000000")] * 2, "run_id STRING, partition_id STRING")
    claimed = K.claim(control, wanted, "job", F.lit("t1"))
    metrics = spark.createDataFrame([("r1", "000000", 1, 1, 0), ("r1", "000000", 3, 2, 1)], "run_id STRING, partition_id STRING, processed_count BIGINT, success_count BIGINT, failed_count BIGINT")
    moved = K.complete(K.merge_progress(claimed, metrics, F.lit("t2")), metrics, "out", F.lit("t3"), ["processed_count"])
    got = {r.run_id: (r.status, r.attempts, r.processed_count) for r in moved.collect()}
    assert got == {"r1": ("COMPLETED", 1, 3), "r2": ("PENDING", 0, 0)} and moved.count() == 2
    assert moved.columns == control.columns
    assert K.as_documents(moved).where("metrics.failed_count = 1 AND execution.job_name = 'job'").count() == 1


def test_prepare_without_models(spark, out):
    columns = ", ".join(f"{c} STRING" for c in DISCOVERY_COLUMNS)
    empty = spark.createDataFrame([tuple(None for _ in DISCOVERY_COLUMNS)], columns)
    empty.write.option("header", True).csv(f"{out}/source")
    with pytest.raises(ValueError, match="no valid models"):
        jobs.prepare(spark, K.PrepareSettings("run", f"{out}/source", f"{out}/prepared"))


def test_bronze_job_checks(spark, out):
    models = spark.createDataFrame(
        [("a", "{}", 0.5), ("b", "[]", 3.0), ("c", "{}", 7.0), ("c", "{}", 7.0)],
        "model_id STRING, payload_json STRING, emission DOUBLE",
    )
    ranges = spark.createDataFrame(
        [(0, 0.0, 1.0), (1, 1.0, 5.0), (2, 5.0, 10.0), (3, 10.0, None)],
        "shard_id INT, min_emissions DOUBLE, max_emissions DOUBLE",
    )
    done = jobs.bronze(spark, models, ranges, "emission", out, "run")
    assert {r[0]: r[1] for r in done.by_status.collect()} == {"ok": 3, "error": 1, "empty": 1}
    assert {r[0]: r[1] for r in done.by_shard.collect()} == {0: 1, 1: 1, 2: 2, 3: 1}
    assert [r["model_id"] for r in done.repeated.collect()] == ["c"]
    assert [r["shard_id"] for r in done.retry.collect()] == [1]


def test_bronze_job_without_hits(spark, out):
    models = spark.createDataFrame([("a", "{}", -1.0)], "model_id STRING, payload_json STRING, emission DOUBLE")
    ranges = spark.createDataFrame([(0, 0.0, 1.0), (1, 1.0, None)], "shard_id INT, min_emissions DOUBLE, max_emissions DOUBLE")
    done = jobs.bronze(spark, models, ranges, "emission", out, "run")
    assert {r[0]: r[1] for r in done.by_status.collect()} == {"empty": 2}


def test_line_without_null_fields(spark, out):
    """A line that leaves out null fields reads with the full schema."""
    from emiscope.schemas import BRONZE_SCHEMA

    folder = f"{out}/run_id=r/shard_id=1"
    spark.createDataFrame([(json.dumps({"model_id": "m", "co2_emissions": "4.2", "status": "ok"}),)], "value STRING").write.text(folder)
    row = readers.read_run(spark, out, BRONZE_SCHEMA, "r").first()
    assert (row["model_id"], row["shard_id"], row["error"]) == ("m", 1, None)


# Streams --------------------------------------------------------------------------------


def test_page_ingest_takes_each_file_once(spark, out):
    def add(first, last):
        spark.range(first, last).write.mode("append").parquet(f"{out}/in")

    counts = []
    add(0, 50)
    for extra in (None, (50, 80), None):
        if extra:
            add(*extra)
        S.ingest_pages(S.page_stream(spark, f"{out}/in", "id BIGINT", 2), f"{out}/t", f"{out}/c")
        counts.append(spark.read.parquet(f"{out}/t").count())
    assert counts == [50, 80, 80]


def test_latest_row_survives_out_of_order_input(spark, out):
    for seq in ([3, 1], [2, 9], [4]):
        rows = spark.createDataFrame([(s % 2, s, f"v{s}") for s in seq], "k INT, seq INT, v STRING")
        rows.write.mode("append").parquet(f"{out}/in")
        stream = S.page_stream(spark, f"{out}/in", rows.schema)
        S.track_latest(stream, ["k"], ["seq"], f"{out}/t", f"{out}/c")
    got = {r["k"]: r["v"] for r in S.current_state(spark, f"{out}/t", ["k"]).collect()}
    assert got == {0: "v4", 1: "v9"}


def test_late_calls_count(spark, out):
    for times in (["2026-01-01 10:00:00"], ["2026-01-01 14:00:00"], ["2026-01-01 10:01:00", "2026-01-01 13:59:00"]):
        rows = spark.createDataFrame([(t,) for t in times], "t STRING").select(F.col("t").cast("timestamp").alias("ts"))
        rows.write.mode("append").parquet(f"{out}/in")
        S.track_call_windows(S.page_stream(spark, f"{out}/in", rows.schema), "ts", f"{out}/t", f"{out}/c")
    windows = S.call_windows(spark, f"{out}/t")
    got = {str(r["window_start"])[11:16]: r["calls"] for r in windows.select(F.col("window_start").cast("string"), "calls").collect()}
    assert got == {"10:00": 2, "14:00": 1, "13:55": 1}


def test_compaction_keeps_the_newest_rows(spark, out):
    def add(seq):
        rows = spark.createDataFrame([(s % 2, s, f"v{s}") for s in seq], "k INT, seq INT, v STRING")
        rows.write.mode("append").parquet(f"{out}/in")
        S.track_latest(S.page_stream(spark, f"{out}/in", rows.schema), ["k"], ["seq"], f"{out}/t", f"{out}/c")

    for seq in ([3, 2], [5], [4]):
        add(seq)
    S.compact(spark, f"{out}/t", ["k"])
    S.compact(spark, f"{out}/t", ["k"])
    add([8])
    assert spark.read.parquet(f"{out}/t").select("part_number").distinct().count() <= 3
    got = {r["k"]: r["v"] for r in S.current_state(spark, f"{out}/t", ["k"]).collect()}
    assert got == {0: "v8", 1: "v5"}


def test_stamp(spark):
    row = W.stamp_snapshot(spark.range(1), "2026-01-01").first()
    assert row["snapshot_date"] == "2026-01-01" and row["ingested_at_utc"] is not None
