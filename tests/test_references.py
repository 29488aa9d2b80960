"""Items over runs by stored sketches, against sets and counters."""

import random
from collections import Counter

import pytest

from emiscope.operators import references as R
from emiscope.session import write_through


def drawn(seed=3, runs=6, each=400, items=90):
    draw = random.Random(seed)
    rows = []
    for run in range(runs):
        low = run * 8
        rows += [(run, f"d{low + min(int(draw.expovariate(0.1)), items)}") for _ in range(each)]
    return rows


def frames(spark, rows):
    df = spark.createDataFrame(rows, "run INT, item STRING").repartition(5)
    return df, write_through(R.run_sketches(df, "run", "item"), "sketches")


def test_items_over_runs_against_sets(spark):
    rows = drawn()
    df, sketches = frames(spark, [*rows, (0, None), (9, None)])
    want, before, last = {}, set(), set()
    for run in sorted({r for r, _ in rows}):
        mine = [i for r, i in rows if r == run]
        now = set(mine)
        want[run] = (len(mine), len(now), len(now | before), len(now - before), len(last - now))
        before, last = before | now, now
    assert {r["run"]: tuple(r)[1:] for r in R.items_over_runs(sketches, "run").collect()} == want


@pytest.mark.parametrize("share", [R.LOST_SHARE, 1.0])
def test_top_items_are_exact(spark, monkeypatch, share):
    """With a bound that can be met and with one that cannot, where all items are counted."""
    monkeypatch.setattr(R, "LOST_SHARE", share)
    rows = drawn(5)
    df, sketches = frames(spark, [*rows, (1, None)])
    counts = Counter(i for _, i in rows)
    best = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    for k in (1, 7, 500):
        top = R.top_items(df, sketches, "item", k)
        assert [tuple(r) for r in top.collect()] == best[:k]
    named = R.top_items(df, sketches, "item", 3)
    per = Counter(rows)
    got = {(r.run, r.item): r.references for r in R.counts_over_runs(df, "run", "item", named).collect()}
    assert got == {(run, i): n for (run, i), n in per.items() if i in {b for b, _ in best[:3]}}


def test_no_references(spark):
    df, sketches = frames(spark, [(1, None)])
    assert R.items_over_runs(sketches, "run").count() == 0
    assert R.top_items(df, sketches, "item", 5).count() == 0
