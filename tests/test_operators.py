"""Property checks of the operators against plain Python and plain windows."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from emiscope.operators import aggregates as A
from emiscope.operators import control as K
from emiscope.operators import joins as J
from emiscope.operators import profile as D
from emiscope.operators import ranking as R
from emiscope.operators import rows as W

rng = random.Random(7)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one group, a null group, and many small ones."""
    rows = [
        (i, None if i % 11 == 0 else ("hot" if i % 3 == 0 else f"g{i % 40}"), rng.random())
        for i in range(6000)
    ]
    return spark.createDataFrame(rows, "id INT, grp STRING, x DOUBLE").cache()


def test_global_index_is_dense_and_ordered(skewed):
    rows = R.global_index(skewed, [F.desc("x"), F.asc("id")]).orderBy("idx").collect()
    assert [r["idx"] for r in rows] == list(range(6000))
    assert [r["x"] for r in rows] == sorted((r["x"] for r in rows), reverse=True)


@pytest.mark.parametrize("bound", [100_000, 0])
def test_rank_in_group_equals_window(skewed, monkeypatch, bound):
    monkeypatch.setattr(R, "BROADCAST_GROUPS", bound)
    ranked = R.rank_in_group(skewed, ["grp"], [F.asc("x"), F.asc("id")], "got")
    w = Window.partitionBy("grp").orderBy("x", "id")
    wrong = ranked.withColumn("want", F.row_number().over(w)).where("got <> want")
    assert wrong.count() == 0 and ranked.count() == 6000


@pytest.mark.parametrize("bound", [100_000, 0])
def test_rank_in_group_single_group(spark, monkeypatch, bound):
    monkeypatch.setattr(R, "BROADCAST_GROUPS", bound)
    rows = spark.range(5000).withColumn("g", F.lit(1))
    ranked = R.rank_in_group(rows, ["g"], [F.desc("id")], "rank")
    assert ranked.where("rank <> 5000 - id").count() == 0


def test_chunks_cover_rows_once(skewed):
    chunked = R.assign_chunks(skewed.withColumnRenamed("x", "co2_eq_emissions"), [F.asc("id")], 250)
    bounds = R.chunk_bounds(chunked).orderBy("chunk").collect()
    assert [b["start_index"] for b in bounds] == list(range(0, 6000, 250))
    assert [b["end_index"] for b in bounds] == list(range(250, 6001, 250))
    assert all(b["records_count"] == 250 for b in bounds)


def test_chunk_rows():
    assert R.chunk_rows(1000, 4) == 250
    assert R.chunk_rows(10, 40) == 1
    assert R.chunk_rows(1000, 3, 2) == 166


def test_last_write_wins_is_idempotent(skewed):
    once = R.last_write_wins(skewed, ["grp"], ["id"])
    twice = R.last_write_wins(once, ["grp"], ["id"])
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert once.where("grp = 'hot'").first()["id"] == 5997


def test_latest_and_first_n(skewed):
    latest = R.latest_per_key(skewed, ["grp"], [F.desc("id")])
    assert latest.count() == skewed.select("grp").distinct().count()
    firsts = R.first_n_per_key(skewed, ["grp"], [F.asc("id")], 3)
    assert firsts.groupBy("grp").count().where("count > 3").count() == 0


@pytest.mark.parametrize("parts", [1, 4, 8])
def test_exact_quantiles(spark, parts):
    data = [round(rng.gauss(0, 100), 3) for _ in range(997)] + [0.0] * 500
    rows = spark.createDataFrame([(x,) for x in data] + [(None,)], "x DOUBLE")
    got = [r["bound"] for r in R.exact_quantiles(rows, "x", parts).orderBy("step").collect()]
    assert np.allclose(got, np.quantile(data, np.linspace(0, 1, parts + 1)))


def test_running_totals_across_spans(spark):
    pages = [(s, p, rng.randrange(9)) for s in ("a", "b") for p in range(1, 101)]
    rows = spark.createDataFrame(pages, "s STRING, page INT, n INT")
    got = {
        (r["s"], r["page"]): r["total"]
        for r in R.running_totals(rows, ["s"], "page", {"total": "n"}, span=7).collect()
    }
    for s in ("a", "b"):
        total = 0
        for _, page, n in [p for p in pages if p[0] == s]:
            total += n
            assert got[s, page] == total


@pytest.mark.parametrize("seed", range(4))
def test_flush_segments_against_loop(spark, seed):
    local = random.Random(seed)
    pages = [(p, local.choice([0, 0, 3, 40, 120])) for p in range(1, 94)]
    want, pending, part = {}, 0, 0
    for page, matches in pages:
        pending += matches
        want[page] = part + 1 if matches else None
        if pending and (page % 5 == 0 or pending >= 100):
            part, pending = part + 1, 0
    rows = spark.createDataFrame([("s", *p) for p in pages], "snapshot_id STRING, page BIGINT, page_matches BIGINT")
    got = {r["page"]: r["part_number"] for r in A.flush_segments(rows).collect()}
    assert got == want


def test_call_windows(spark):
    calls = spark.range(10).withColumn("g", F.lit("p"))
    rows = A.call_windows(calls, ["g"], [F.asc("id")], 4, 300).orderBy("id").collect()
    assert [r["call_window"] for r in rows] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]
    assert rows[-1]["offset_seconds"] == 600


# Joins --------------------------------------------------------------------------------


def brute_ranges(facts, ranges):
    return sorted(
        (s, i) for i, x in facts for s, lo, hi in ranges
        if x is not None and x >= lo and (hi is None or x < hi)
    )


def awkward_ranges():
    """Overlapping, nested, repeated, open, empty, turned and unbounded ranges, over values with a hot one."""
    facts = [(k, rng.choice([7.25, round(rng.uniform(-5, 60), 1)])) for k in range(700)]
    facts += [(9000, 0.0), (9001, -0.0), (9002, None), (9003, 1e12), (9004, -1e300), (9005, float("inf")), (9006, float("nan"))]
    ranges = [(k, lo, lo + rng.choice([0.1, 1.0, 30.0])) for k, lo in enumerate(round(rng.uniform(-8, 55), 1) for _ in range(60))]
    ranges += [(100, 7.25, 7.25), (101, 9.0, 3.0), (102, None, 5.0), (103, 0.0, 0.1), (104, -0.0, 7.25), (105, 7.25, None)]
    ranges += [(106, -1e308, 1e308), (106, 20.0, 21.0), (107, 1e300, 1e305), (107, 1e300, 1e305)]
    return facts, ranges


@pytest.mark.parametrize("block", [1, 3, 256])
def test_sweep_against_loop(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "BLOCKS_PER_CUT", 5)
    facts, ranges = awkward_ranges()
    given = spark.createDataFrame(facts, "id INT, x DOUBLE"), spark.createDataFrame(ranges, "shard_id INT, min_emissions DOUBLE, max_emissions DOUBLE")
    # NaN is the greatest value, so that open ranges hold it.
    loop = sorted(
        (s, k) for k, x in facts for s, lo, hi in ranges
        if x is not None and lo is not None and (hi is None if x != x else x >= lo and (hi is None or x < hi))
    )
    got = J.sweep_join(*given, "x")
    assert sorted((r["shard_id"], r["id"]) for r in got.collect()) == loop
    assert got.columns == ["id", "x", "shard_id", "min_emissions", "max_emissions"]
    counts = J.count_in_ranges(*given, "x").collect()
    assert sorted((r[0], r[1] or 0.0, r[3]) for r in counts) == sorted(
        (s, lo or 0.0, sum(x is not None and lo is not None and (hi is None if x != x else x >= lo and (hi is None or x < hi)) for _, x in facts))
        for s, lo, hi in ranges
    )


def test_sweep_without_facts_or_ranges(spark):
    facts, ranges = "id INT, x DOUBLE", "shard_id INT, min_emissions DOUBLE, max_emissions DOUBLE"
    some = spark.createDataFrame([(1, 2.0)], facts), spark.createDataFrame([(1, 0.0, 5.0)], ranges)
    none = spark.createDataFrame([], facts), spark.createDataFrame([], ranges)
    assert J.sweep_join(some[0], none[1], "x").count() == J.sweep_join(none[0], some[1], "x").count() == 0
    assert [r["facts_count"] for r in J.count_in_ranges(none[0], some[1], "x").collect()] == [0]
    assert J.count_in_ranges(some[0], none[1], "x").count() == 0


def test_bounds_take_no_place_among_facts(spark):
    """The rows that ranges take follow their hits, not how many other ranges begin or end within them."""
    facts = spark.range(100).selectExpr("id", "CAST(id AS DOUBLE) AS x")
    ranges = spark.range(3000).selectExpr("CAST(id AS INT) AS shard_id", "40.5D + id / 1000 AS min_emissions", "50.5D + id / 1000 AS max_emissions")
    _, placed = J.place_in_order(facts, ranges, "x")
    assert placed.selectExpr("sum(_end - _first - 1)").first()[0] == 3000 * 10
    assert J.covered_blocks(placed, 100 + 2 * 3000).count() <= 2 * 3000
    counts = J.sweep_join(facts, ranges, "x").groupBy("shard_id").count()
    assert counts.where("count = 10").count() == 3000


@pytest.mark.parametrize("together, pack", [(1, 1), (7, 5), (1 << 14, 64)])
def test_sweep_shares_out_hot_blocks(spark, monkeypatch, together, pack):
    """Equal and overlapping ranges over one hot block, facts with equal rows and a column that has no order."""
    for name, value in (("RANGES_TOGETHER", together), ("PACK", pack), ("BLOCK", 4), ("WIDEST_BLOCK", 32)):
        monkeypatch.setattr(J, name, value)
    facts = [(k // 2, rng.choice([3.0, round(rng.uniform(0, 9), 1)]), {"k": k // 2}) for k in range(160)]
    ranges = [(k % 20, lo, lo + 2.5) for k, lo in enumerate([2.0] * 30 + [round(rng.uniform(0, 8), 1) for _ in range(10)])]
    ranges += [(50, -1.0, None), (51, 3.0, 3.1)]
    got = J.sweep_join(
        spark.createDataFrame(facts, "id INT, x DOUBLE, more MAP<STRING, INT>"),
        spark.createDataFrame(ranges, "shard_id INT, min_emissions DOUBLE, max_emissions DOUBLE"),
        "x",
    ).collect()
    assert all(r["more"] == {"k": r["id"]} and r["x"] >= r["min_emissions"] for r in got)
    assert sorted((r["shard_id"], r["id"]) for r in got) == brute_ranges([(i, x) for i, x, _ in facts], ranges)


def test_sweep_takes_more_ranges_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(J, "BROADCAST_RANGES", 3)
    facts = spark.range(300).selectExpr("id", "id / 10 AS x")
    ranges = spark.range(40).selectExpr("CAST(id AS INT) AS shard_id", "id - 5.0D AS min_emissions", "id - 3.0D AS max_emissions", "'r' || id AS name")
    got = J.in_ranges(facts, ranges, "x")
    assert got.count() == sum(k - 5 <= i / 10 < k - 3 for i in range(300) for k in range(40))
    assert {(r.shard_id, r.name) for r in got.select("shard_id", "name").distinct().collect()} == {(k, f"r{k}") for k in range(4, 35)}


@pytest.mark.parametrize("join", [J.in_ranges, J.sweep_join])
def test_range_joins_against_loop(spark, join):
    facts = [(i, 0.0 if i % 3 == 0 else round(rng.uniform(-5, 60), 2)) for i in range(900)]
    facts += [(9001, 5.0), (9002, None), (9003, 1e12)]
    ranges = [(i, float(i), float(i + 1 + i % 4)) for i in range(40)] + [(99, 30.0, None)]
    got = join(
        spark.createDataFrame(facts, "id INT, x DOUBLE"),
        spark.createDataFrame(ranges, "shard_id INT, min_emissions DOUBLE, max_emissions DOUBLE"),
        "x",
    )
    assert sorted((r["shard_id"], r["id"]) for r in got.collect()) == brute_ranges(facts, ranges)


def test_empty_range_gives_one_row(spark):
    facts = spark.createDataFrame([(1, 3.0), (2, 3.5)], "id INT, x DOUBLE")
    rows = J.shard_by_range(facts, J.emission_ranges(spark), "x").collect()
    assert len(rows) == 2 + 19
    assert {r["shard_id"] for r in rows} == set(range(20))


def test_lookup_keeps_every_row(spark):
    rows = spark.createDataFrame([("a",), (" b ",), ("c",), ("",), (None,), ("a",)], "model_id STRING")
    payloads = spark.createDataFrame([("a", "{}"), ("b", "{}"), ("c", None)], "model_id STRING, payload_json STRING")
    look = J.lookup_payloads(rows, payloads)
    assert (look.found.count(), look.missing_payload.count(), look.missing_id.count()) == (3, 1, 2)
    assert look.unreadable.count() == 0 and look.missing_payload.columns == ["model_id"]
    odd = spark.createDataFrame([("d", "<html>"), ("e", "[{}]"), ("a", "{"), ("f", "{}"), ("f", "{}")], payloads.schema)
    rows = rows.unionByName(spark.createDataFrame([("d",), ("e",), ("f",)], "model_id STRING"))
    flags = J.attach_payloads(rows, payloads.unionByName(odd)).groupBy("error_type", "called").count().collect()
    got = {tuple(r)[:2]: r[2] for r in flags}
    assert got == {(None, True): 4, ("LookupError", True): 1, ("InvalidPayload", True): 2, ("ValueError", False): 2}


def test_reconcile(spark):
    declared = spark.createDataFrame([("a", 2), ("b", 1)], "partition_id STRING, records_count BIGINT")
    actual = spark.createDataFrame([("a",), ("a",), ("c",)], "partition_id STRING")
    got = {r["partition_id"]: (r["actual_count"], r["mismatch"]) for r in J.reconcile_counts(declared, actual).collect()}
    assert got == {"a": (2, False), "b": (0, True), "c": (1, True)}


# Rows and control ---------------------------------------------------------------------


def test_bronze_statuses(spark):
    rows = spark.createDataFrame(
        [(0, 0.0, 1.0, "m", '{"cardData":{"co2_eq_emissions":0.5}}'), (1, 1.0, None, "n", "[1]"), (2, 5.0, 9.0, None, None)],
        "shard_id INT, min_emissions DOUBLE, max_emissions DOUBLE, model_id STRING, payload_json STRING",
    )
    got = W.bronze_rows(rows, "r").orderBy("shard_id").collect()
    assert [g["status"] for g in got] == ["ok", "error", "empty"]
    assert got[0]["card_data_json"] == '{"co2_eq_emissions": 0.5}' and got[0]["co2_emissions"] == "0.5"
    assert got[1]["error"] and got[1]["model_id"] is None and got[2]["model_raw_json"] is None


def test_gold_size_of_unreadable_list(spark):
    columns = "modelId STRING, enriched_at STRING, partition_id STRING, model_id STRING, datasets STRING"
    rows = spark.createDataFrame([("a", "1", "p", "a", "[]"), ("a", "2", "p", "a", "oops"), ("b", "1", "p", "b", '["x"]')], columns)
    sizes = {r["modelId"]: r["datasets_size"] for r in W.gold_rows(rows).collect()}
    assert sizes == {"a": None, "b": 1}
    old = {r["modelId"]: r["datasets_size"] for r in W.gold_rows(rows, True).collect()}
    assert old == {"a": -1, "b": 1}


@pytest.mark.parametrize(
    "change", [{"workers": 0}, {"calls_per_model": -1}, {"source_path": ""}, {"source_path": "rel/x"}]
)
def test_settings_guard(change):
    with pytest.raises(ValueError):
        K.PrepareSettings(**{"run_id": "r", "source_path": "s3://b/k", "prepared_path": "/p", **change})


def test_claim_touches_only_claimable(spark):
    columns = "run_id STRING, partition_id STRING, status STRING, attempts BIGINT, started_at STRING, job_name STRING, updated_at STRING"
    control = spark.createDataFrame(
        [("r", "a", "PENDING", 0, None, None, "t0"), ("r", "b", "FAILED", 2, "t0", "x", "t0"), ("r", "c", "RUNNING", 1, "t0", "x", "t0"), ("r", "d", "PENDING", 0, None, None, "t0")],
        columns,
    )
    wanted = control.where("partition_id <> 'd'")
    got = {r["partition_id"]: tuple(r)[2:] for r in K.claim(control, wanted, "j", F.lit("t1")).collect()}
    assert got["a"] == ("RUNNING", 1, "t1", "j", "t1")
    assert got["b"] == ("RUNNING", 3, "t0", "j", "t1")
    assert got["c"] == ("RUNNING", 1, "t0", "x", "t0") and got["d"][0] == "PENDING"


def test_dataset_sizes_with_hot_dataset(spark):
    refs = spark.createDataFrame(
        [(f"m{i}", ["hot", f"d{i % 5}"] if i % 3 == 0 else []) for i in range(300)], "model_id STRING, refs ARRAY<STRING>"
    )
    sizes = spark.createDataFrame([("hot", 10), ("d0", 1)], "dataset_id STRING, dataset_size BIGINT")
    got = D.with_dataset_sizes(refs.select("model_id"), refs, sizes)
    assert got.count() == 300
    assert got.where("datasets_count = 2").count() == 100
    assert got.where("model_id = 'm0'").first()["datasets_total_size"] == 11


def test_point_and_prefix_reads(spark):
    items = [("RUN#1", "PARTITION#a"), ("RUN#1", "PARTITION#b"), ("RUN#1", "META"), ("RUN#2", "PARTITION#a")]
    control = spark.createDataFrame(items, "PK STRING, SK STRING")
    assert K.point_get(control, "RUN#1", "META").count() == 1
    assert K.prefix_scan(control, "RUN#1", "PARTITION#").count() == 2
