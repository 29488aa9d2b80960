"""The commit log, atomic publication and claims, with several writers at a time."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from emiscope import session
from emiscope.operators import control as K
from emiscope.plans import jobs
from emiscope.schemas import DISCOVERY_COLUMNS, DISCOVERY_SCHEMA, METRICS_SCHEMA
from emiscope.sources import claims, commits, readers, writers


@pytest.fixture
def out(spark):
    return session.fresh_path(spark, "commits")


def together(*calls):
    with ThreadPoolExecutor(len(calls)) as pool:
        return [f.result() for f in [pool.submit(c) for c in calls]]


@pytest.mark.parametrize("way", ["_link", "_rename"])
def test_one_of_two_writers_gets_a_version(spark, out, way, monkeypatch):
    """Both ways to create an entry refuse a number that is taken."""
    monkeypatch.setattr(commits, "_link", getattr(commits, way))
    assert commits.versions(spark, out) == []
    assert commits.try_commit(spark, out, 1, {"data": "a"})
    assert not commits.try_commit(spark, out, 1, {"data": "b"})
    assert commits.entry(spark, out)["data"] == "a" and commits.versions(spark, out) == [1]


def test_versions_of_writers_at_a_time_are_dense(spark, out):
    made = together(*[lambda k=k: commits.commit(spark, out, {"data": str(k)}) for k in range(8)])
    assert sorted(made) == commits.versions(spark, out) == list(range(1, 9))
    assert {commits.entry(spark, out, v)["data"] for v in made} == {str(k) for k in range(8)}


def test_exactly_one_of_many_wins(spark, out):
    commits.commit(spark, out, {"data": "first"})
    won = together(*[lambda k=k: commits.try_commit(spark, out, 2, {"data": str(k)}) for k in range(8)])
    assert sum(won) == 1 and commits.entry(spark, out, 2)["data"] == str(won.index(True))


def test_aborted_publication_is_never_seen(spark, out):
    """A reader during and after a publication that fails has the version before, whole."""
    assert commits.publish(spark.range(100), out) == 1
    during = commits.read(spark, out)
    broken = spark.range(1000, 2000, 1, 4).withColumn("id", F.when(F.col("id") == 1999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(PySparkException):
        commits.publish(broken, out)
    assert during.agg(F.sum("id")).first()[0] == sum(range(100))
    assert commits.read(spark, out).count() == 100 and commits.versions(spark, out) == [1]


def test_a_writer_that_dies_before_its_commit(spark, out, monkeypatch):
    commits.publish(spark.range(10), out)
    monkeypatch.setattr(commits, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        commits.publish(spark.range(99), out)
    monkeypatch.undo()
    assert commits.read(spark, out).count() == 10
    assert len(commits.vacuum(spark, out)) == 1 and commits.read(spark, out).count() == 10


def test_readers_pin_a_version(spark, out):
    for n in (3, 5, 8):
        commits.publish(spark.range(n), out)
    pinned = commits.read(spark, out, version=2)
    commits.publish(spark.range(13), out)
    assert (pinned.count(), commits.read(spark, out).count(), commits.read(spark, out, version=1).count()) == (5, 13, 3)
    with pytest.raises(commits.NoVersion):
        commits.read(spark, out, version=9)
    with pytest.raises(commits.NoVersion):
        commits.read(spark, f"{out}/none")
    assert len(commits.vacuum(spark, out, keep=2)) == 2
    assert commits.read(spark, out, version=3).count() == 8


def _models(spark, ids):
    blank = ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in (p.split(" ") for p in DISCOVERY_SCHEMA.split(", ")[1:]))
    return spark.createDataFrame([(m,) for m in ids], "model_id STRING").selectExpr("model_id", *blank.split(", ")).select(*DISCOVERY_COLUMNS)


def test_snapshot_and_latest_share_their_rows(spark, out):
    writers.publish(_models(spark, ["a", "b"]), f"{out}/s=1", f"{out}/latest")
    writers.publish(_models(spark, ["c"]), f"{out}/s=2", f"{out}/latest")

    def ids(place):
        return sorted(r.model_id for r in readers.read_discovery(spark, f"{out}/{place}", "parquet").collect())

    assert (ids("s=1"), ids("s=2"), ids("latest")) == (["a", "b"], ["c"], ["c"])
    assert commits.entry(spark, f"{out}/latest")["data"].startswith(f"{out}/s=2/")
    assert commits.vacuum(spark, f"{out}/latest") == []  # its data is not its own
    _models(spark, ["p"]).write.parquet(f"{out}/plain")
    assert ids("plain") == ["p"]


def _wanted(spark, keys, attempt=1):
    return spark.createDataFrame([("r", k, attempt) for k in keys], "run_id STRING, partition_id STRING, attempt BIGINT")


def test_each_partition_is_claimed_once(spark, out):
    now = F.lit("t")
    asked = [_wanted(spark, [f"{k:03d}" for k in range(first, first + 30)]) for first in (0, 10, 20, 0)]
    got = together(*[lambda rows=rows: {r.partition_id for r in claims.take(spark, out, rows, "job", now).collect()} for rows in asked])
    assert sorted(p for part in got for p in part) == [f"{k:03d}" for k in range(50)]
    held = claims.claims(spark, out)
    assert held.count() == held.select(*claims.KEY).distinct().count() == 50
    assert claims.take(spark, out, asked[0], "job", now).count() == 0
    assert claims.take(spark, out, _wanted(spark, ["001", "001"], 2), "job", now).count() == 1
    odd = spark.createDataFrame([(None, "x", 1), ("r", None, 1)], asked[0].schema)
    assert claims.take(spark, out, odd, "job", now).count() == 0


def test_folded_claims_stay_whole(spark, out, monkeypatch):
    monkeypatch.setattr(claims, "FOLD", 2)
    for k in range(6):
        assert claims.take(spark, out, _wanted(spark, [str(k), str(k + 1)]), "job", F.lit("t")).count() == (2 if k == 0 else 1)
    assert sorted(r.partition_id for r in claims.claims(spark, out).collect()) == [str(k) for k in range(7)]


def test_claims_move_only_earlier_attempts(spark):
    rows = [("r", "a", "PENDING", 0, None), ("r", "b", "FAILED", 1, "old"), ("r", "c", "COMPLETED", 2, "old")]
    control = spark.createDataFrame(rows, "run_id STRING, partition_id STRING, status STRING, attempts BIGINT, started_at STRING")
    control = control.withColumns({"job_name": F.lit("none"), "updated_at": F.lit("u")})
    held = [("r", "a", 1, "h", "j1", "t1"), ("r", "b", 2, "h", "j2", "t2"), ("r", "b", 1, "h", "j0", "t0"), ("r", "c", 2, "h", "j3", "t3"), ("s", "a", 9, "h", "x", "x")]
    moved = K.apply_claims(control, spark.createDataFrame(held, claims.CLAIM_SCHEMA))
    assert sorted(tuple(r) for r in moved.collect()) == [
        ("r", "a", "RUNNING", 1, "t1", "j1", "t1"), ("r", "b", "RUNNING", 2, "old", "j2", "t2"), ("r", "c", "COMPLETED", 2, "old", "none", "u"),
    ]


def test_two_workers_enrich_each_partition_once(spark, out, sf):
    """Two workers with one control table: together they work each partition, and none twice."""
    from emiscope.plans.catalog.scans import discovered
    from emiscope.plans.fixtures import relation

    writers.publish(discovered(spark, sf, keep=()), f"{out}/source", f"{out}/latest")
    settings = K.PrepareSettings("run", f"{out}/latest", f"{out}/prepared", rate_limit=40, source_form="parquet")
    control = session.write_through(jobs.prepare(spark, settings, F.lit("t")).control, "control")
    payloads = relation(spark, sf, "payloads").where("k % 11 <> 0")
    done = together(*[lambda name=name: jobs.work(spark, control, control, payloads, f"{out}/enriched", name, F.lit("t")) for name in ("one", "two")])
    worked = [{r.partition_id for r in d.metrics.collect()} for d in done]
    everything = {r.partition_id for r in control.collect()}
    assert worked[0] | worked[1] == everything and not worked[0] & worked[1]
    for mine, result in zip(worked, done):
        rows = {r.partition_id: (r.status, r.attempts) for r in result.control.collect()}
        assert {p for p, row in rows.items() if row == ("COMPLETED", 1)} == mine
        assert set(rows) == everything and result.counts.where("mismatch").count() == 0
    stored = readers.read_json_lines(spark, f"{out}/enriched/metrics", METRICS_SCHEMA)
    assert stored.count() == len(everything)
    assert stored.agg(F.sum("input_count")).first()[0] == control.agg(F.sum("records_count")).first()[0]


def test_a_missing_store_is_an_error(spark):
    with pytest.raises(Py4JJavaError):
        commits.versions(spark, "nosuch://store/table")
