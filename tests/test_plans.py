"""Plans that the operators rely on."""

import re

import pytest

from emiscope.operators import joins as J
from emiscope.plans.catalog import QUERIES
from emiscope.plans.catalog.joins import price_ranges
from emiscope.plans.catalog.scans import SLIM_BRONZE
from emiscope.plans.fixtures import relation, table
from emiscope.session import fresh_path
from emiscope.sources import readers, writers


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_is_cut_before_the_shuffle(spark, sf):
    text = plan(QUERIES["gold_latest_per_model"](spark, sf))
    assert re.search(r"WindowGroupLimit.*Final", text) and re.search(r"WindowGroupLimit.*Partial", text)


@pytest.mark.parametrize("name", ["gold_latest_per_model", "enriched_rows", "bronze_card_rows", "dataset_usage"])
def test_no_python_in_the_plan(spark, sf, name):
    assert "EvalPython" not in plan(QUERIES[name](spark, sf))


@pytest.mark.parametrize("name, times", [("discovery_rows", 1), ("enriched_rows", 2), ("raw_model_rows", 1), ("dataset_usage", 1)])
def test_payload_is_parsed_once_per_shape(spark, sf, name, times):
    assert len(re.findall(r"from_json\(StructField\(", plan(QUERIES[name](spark, sf)))) == times


def test_ranges_are_the_broadcast_side(spark, sf):
    facts = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    text = plan(J.shard_by_range(facts, J.emission_ranges(spark), "o_totalprice"))
    for side in re.findall(r"BroadcastNestedLoopJoin (\w+)", text):
        assert side == "BuildRight"
    assert "CartesianProduct" not in text


def test_sweep_moves_facts_bounds_and_blocks(spark, sf):
    """An equi join on blocks, whose rows follow the hits and not the product of both sides."""
    facts = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    ranges = price_ranges(spark, sf)
    joined = J.sweep_join(facts, ranges, "o_totalprice")
    text = plan(joined)
    assert "NestedLoop" not in text and "CartesianProduct" not in text and "SortMergeJoin [_block" in text
    found, placed = J.place_in_order(facts, ranges, "o_totalprice")
    n, m = facts.count(), ranges.count()
    assert found.count() == n and placed.count() == m
    blocks = J.covered_blocks(placed, n + 2 * m).count()
    positions = placed.selectExpr("sum(_end - _first)").first()[0]
    assert blocks <= 2 * m + positions / J.BLOCK


def test_run_is_pruned_by_directory(spark):
    path = fresh_path(spark, "prune")
    rows = spark.createDataFrame([("r", 1, 5, 0.5, "ok"), ("s", 1, 6, 0.5, "ok")], SLIM_BRONZE)
    writers.append_json(rows, path, "run_id", "shard_id")
    text = plan(readers.read_run(spark, path, SLIM_BRONZE, "r"))
    assert re.search(r"PartitionFilters: \[.*run_id", text)


def test_scan_reads_only_used_columns(spark, sf):
    text = plan(relation(spark, sf, "enrich_log").where("status = 'F'").select("k"))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in text
    assert "EqualTo(o_orderstatus,F)" in text


def test_missing_side_moves_no_payload(spark, sf):
    stored = fresh_path(spark, "payloads")
    relation(spark, sf, "payloads").select("model_id", "payload_json").write.parquet(stored)
    rows = spark.createDataFrame([("a",), ("org3/m3",), (None,)], "model_id STRING")
    look = J.lookup_payloads(rows, spark.read.parquet(stored))
    text = plan(look.missing_payload)
    assert "LeftAnti" in text and "attached" not in vars(look)
    for line in text.splitlines():
        # The payload is tested for being there, in the scan's own filter, and goes no further.
        assert "Exchange" not in line or "payload_json" not in line
    assert [r.model_id for r in look.missing_payload.collect()] == ["a"]


def test_payloads_nobody_asks_for_are_not_joined(spark, sf):
    stored = fresh_path(spark, "payloads")
    relation(spark, sf, "payloads").select("model_id", "payload_json").write.parquet(stored)
    rows = spark.createDataFrame([("org3/m3",), ("nobody",)], "model_id STRING")
    text = plan(J.attach_payloads(rows, spark.read.parquet(stored)))
    assert "LeftSemi" in text


def test_no_query_numbers_rows_in_one_task(spark, sf):
    for name in ("chunk_assignment", "batch_numbers", "rate_window_plan"):
        text = plan(QUERIES[name](spark, sf))
        for line in text.splitlines():
            assert "row_number()" not in line


def test_stored_values_are_filtered_in_the_scan(spark, sf):
    facts = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    text = plan(J.in_ranges(facts, J.emission_ranges(spark), "o_totalprice", stored=True))
    assert re.search(r"PushedFilters: \[IsNotNull\(o_totalprice\), GreaterThanOrEqual\(o_totalprice", text)


def test_payload_column_is_scanned_once(spark, sf):
    stored = fresh_path(spark, "payloads")
    relation(spark, sf, "payloads").select("model_id", "payload_json").write.parquet(stored)
    rows = spark.createDataFrame([("a",), (None,)], "model_id STRING")
    text = plan(J.attach_payloads(rows, spark.read.parquet(stored)))
    assert len(re.findall(r"ReadSchema: struct<[^>]*payload_json", text)) == 1
