"""Exact quantiles with sketches, against the plain ones."""

import math
import random

import pytest
from pyspark.sql import functions as F

from emiscope.operators import ranking as R
from emiscope.operators import sketches as S


def bounds(df):
    return {r["step"]: r["bound"] for r in df.collect()}


def plain(values, parts):
    values = sorted(values)
    out = {}
    for i in range(parts + 1):
        at = i * (len(values) - 1) / parts
        low = values[int(at)]
        out[i] = low + (values[math.ceil(at)] - low) * (at - int(at))
    return out


draw = random.Random(8)
CASES = {
    "spread": [draw.gauss(0, 100) for _ in range(5000)],
    "hot": [1.5] * 2000 + [draw.uniform(0, 3) for _ in range(1000)],
    "two": [0.0, 10.0],
    "one": [4.25],
    "equal": [7.0] * 50,
    "far": [-1e300, 1e300, 0.0, float("inf"), float("-inf"), 5.0, 6.0],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("parts", [1, 7])
def test_sketched_bounds_are_exact(spark, name, parts):
    values = CASES[name]
    df = spark.createDataFrame([(k % 5, v) for k, v in enumerate(values)], "snapshot INT, x DOUBLE").repartition(6)
    odd = spark.createDataFrame([(1, None), (2, float("nan"))], df.schema)
    stored = S.value_sketches(df.unionByName(odd), "x", ["snapshot"])
    got = bounds(S.sketched_quantiles(df.unionByName(odd), "x", parts, stored))
    want = bounds(R.exact_quantiles(df, "x", parts))
    assert {k: repr(v) for k, v in got.items()} == {k: repr(v) for k, v in want.items()}
    if name != "far":
        assert all(math.isclose(got[k], v, rel_tol=1e-12, abs_tol=1e-12) for k, v in plain(values, parts).items())


def test_a_sketch_that_misses_is_found_out(spark, monkeypatch):
    """Sketches of other values and a tiny margin lead astray; the counts tell, and the margin grows."""
    monkeypatch.setattr(S, "RANK_ERROR", 1e-6)
    values = [float(v * v) for v in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    wrong = S.value_sketches(df.select((F.col("x") / 3 - 50).alias("x")), "x")
    got = bounds(S.sketched_quantiles(df, "x", 5, wrong))
    assert all(math.isclose(got[k], v, rel_tol=1e-12) for k, v in plain(values, 5).items())


def test_only_values_near_the_bounds_are_ordered(spark, monkeypatch):
    seen = []
    real = S.covering_values
    monkeypatch.setattr(S, "covering_values", lambda near: seen.append(near.count()) or real(near))
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("x"))
    assert len(bounds(S.sketched_quantiles(df, "x", 4))) == 5
    assert seen[0] < 0.06 * 200_000


def test_no_values(spark):
    none = spark.createDataFrame([(None,), (float("nan"),)], "x DOUBLE")
    assert S.sketched_quantiles(none, "x", 4).count() == 0
