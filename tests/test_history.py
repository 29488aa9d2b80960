"""Keyed tables in buckets: what they hold after several runs, and that the stored side is not shuffled."""

import glob
import random
import re

import pytest
from pyspark.sql import functions as F

from emiscope import session
from emiscope.sources import commits, history

SCHEMA = "k STRING, part INT, seq BIGINT, v STRING"


@pytest.fixture
def table(spark):
    return history.KeyedTable(session.fresh_path(spark, "history"), ("k", "part"), 5)


def rows(spark, seed, n=400):
    draw = random.Random(seed)
    data = [(draw.choice(["a", "b", "ü", ""]) + str(draw.randint(0, 30)), draw.randint(0, 2), draw.randint(0, 50), f"{seed}-{i}") for i in range(n)]
    return data + [(None, 1, 99, "x"), ("a", None, 99, "x")]


def plain(runs):
    """Stored rows win ties; within a run the greater value does."""
    state = {}
    for run in runs:
        new = {}
        for k, part, seq, v in run:
            if k is not None and part is not None and ((k, part) not in new or (seq, v) > new[k, part]):
                new[k, part] = (seq, v)
        for key, row in new.items():
            if key not in state or row[0] > state[key][0]:
                state[key] = row
    return state


def test_three_runs_against_a_dictionary(spark, table):
    runs = [rows(spark, s) for s in (1, 2, 3)]
    for n, run in enumerate(runs, 1):
        assert history.merge_latest(table, spark.createDataFrame(run, SCHEMA), ["seq", "v"]) == n
    state, want = {(r.k, r.part): (r.seq, r.v) for r in table.read(spark).collect()}, {}
    for run in runs:
        for k, part, seq, v in run:
            if k is not None and part is not None:
                want[k, part] = max(want.get((k, part), (-1, "")), (seq, v))
    assert state == want
    first = table.read(spark, version=1)
    assert {(r.k, r.part): (r.seq, r.v) for r in first.collect()} == plain(runs[:1])
    new = spark.createDataFrame([("a0", 0, 1, "n"), ("never", 0, 1, "n"), (None, 0, 1, "n")], SCHEMA)
    left = {r.k for r in history.not_yet_kept(new, table).collect()}
    assert left == {"never", None} | ({"a0"} if ("a0", 0) not in want else set())


def test_stored_rows_win_ties(spark, table):
    runs = [[("a", 1, 5, "old"), ("b", 1, 5, "old")], [("a", 1, 5, "new"), ("b", 1, 6, "new"), ("c", 1, 0, "new")]]
    for run in runs:
        history.merge_latest(table, spark.createDataFrame(run, SCHEMA), ["seq"])
    assert {(r.k, r.part): (r.seq, r.v) for r in table.read(spark).collect()} == plain(runs)


def exchanged(df) -> list[str]:
    """Columns that the plan's shuffles move, by exchange."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange [^\n]*\n[^\n]*", text)


def up_to_the_join(lines: list[str]) -> str:
    """The plan from the stored table's scan up to the first join."""

    def depth(line):
        return re.search(r"[A-Za-z]", line).start()

    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    path, level = [lines[at]], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            path.append(line)
            level = depth(line)
            if "Join" in line:
                break
    return "\n".join(path)


def test_only_new_rows_are_shuffled(spark, table):
    for s in (1, 2):
        history.merge_latest(table, spark.createDataFrame(rows(spark, s), SCHEMA), ["seq"])
    path = session.fresh_path(spark, "new")
    spark.createDataFrame(rows(spark, 3), SCHEMA).write.parquet(path)
    new = spark.read.parquet(path)
    # New rows go to the buckets; before a merge they are cut to one per key, which is a shuffle of its own.
    for df, most in ((history.not_yet_kept(new, table), 1), (history.merged_latest(table, new, ["seq"]), 2)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Bucketed: true" in text
        moved = exchanged(df)
        assert len(moved) == most and sum(", 5)" in m for m in moved) == 1
        assert "Exchange" not in up_to_the_join(text.splitlines())
    assert "Exchange" not in table.read(spark).groupBy("k", "part").agg(F.max("seq"))._jdf.queryExecution().executedPlan().toString()


def test_a_bucket_is_one_file(spark, table):
    for s in (1, 2):
        history.merge_latest(table, spark.createDataFrame(rows(spark, s), SCHEMA), ["seq"])
        data = commits.entry(spark, table.path)["data"]
        assert len(glob.glob(f"{data}/part-*.parquet")) <= 5


def test_other_sessions_and_layouts(spark, table):
    history.merge_latest(table, spark.createDataFrame([("a", 1, 1, "x")], SCHEMA), ["seq"])
    data = commits.entry(spark, table.path)["data"]
    spark.sql(f"DROP TABLE {table._name(data)}")  # as another session finds it; the files stay
    assert table.read(spark).count() == 1
    assert "Bucketed: true" in table.read(spark).groupBy("k", "part").count()._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        history.KeyedTable(table.path, ("k",), 5).read(spark)


def test_no_rows(spark, table):
    none = spark.createDataFrame([], SCHEMA)
    assert history.not_yet_kept(none, table).count() == 0
    history.merge_latest(table, none, ["seq"])
    history.merge_latest(table, none, ["seq"])
    assert table.read(spark).count() == 0
