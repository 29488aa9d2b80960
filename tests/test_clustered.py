"""Tables along a space-filling curve: the rows found, and the files read for them."""

import pytest
from pyspark.sql import functions as F

from emiscope import session
from emiscope.plans.fixtures import table as given
from emiscope.sources import clustered, commits


@pytest.fixture
def out(spark):
    return session.fresh_path(spark, "clustered")


def test_two_ranges_read_few_files(spark, out):
    rows = given(spark, "/root/testdata/sf0.01", "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    clustered.write_clustered(rows, out, ["o_totalprice", "o_custkey"], 64)
    everything = clustered.chosen_files(spark, out, {}).count()
    assert everything > 50
    low, high = rows.approxQuantile("o_totalprice", [0.4, 0.6], 0.001)
    a, b = rows.approxQuantile("o_custkey", [0.7, 0.9], 0.001)
    ranges = {"o_totalprice": (low, high), "o_custkey": (int(a), int(b))}
    assert clustered.chosen_files(spark, out, ranges).count() < everything / 5
    got = sorted(tuple(r) for r in clustered.read_range(spark, out, ranges).collect())
    want = sorted(tuple(r) for r in rows.where(F.col("o_totalprice").between(low, high) & F.col("o_custkey").between(int(a), int(b))).collect())
    assert got == want and got
    read = clustered.read_range(spark, out, ranges)
    assert len(read.inputFiles()) < everything / 5


def test_awkward_values(spark, out):
    data = [(k, float(k % 7), k // 7) for k in range(200)]
    data += [(900, None, 3), (901, 2.0, None), (902, float("nan"), 4), (903, float("inf"), 5), (904, -0.0, 0), (905, -1e300, 1)]
    rows = spark.createDataFrame(data, "file INT, x DOUBLE, low_0 INT")  # names that are used inside
    clustered.write_clustered(rows, out, ["x", "low_0"], 8)
    assert clustered.read_range(spark, out, {}).count() == len(data)

    def ids(**ranges):
        return {r["file"] for r in clustered.read_range(spark, out, ranges).collect()}

    assert ids(x=(2.0, 3.0), low_0=(4, None)) == {i for i, x, y in data if x is not None and y is not None and 2 <= x <= 3 and y >= 4}
    assert ids(x=(None, 0.0)) == {i for i, x, _ in data if x is not None and x <= 0}
    assert ids(x=(1e5, None)) == {902, 903}  # NaN is the greatest value
    assert ids(x=(1e5, 1e6)) == set()
    assert ids(file=(5, 9), x=(0.0, 9.0)) == set(range(5, 10))


def test_hot_value_and_versions(spark, out):
    clustered.write_clustered(spark.range(300).select((F.col("id") % 2).alias("a"), F.lit(7).alias("b")), out, ["a", "b"], 4)
    assert clustered.read_range(spark, out, {"a": (1, 1), "b": (7, 7)}).count() == 150
    clustered.write_clustered(spark.range(10).select(F.col("id").alias("a"), F.lit(None).cast("int").alias("b")), out, ["a", "b"], 4)
    assert clustered.read_range(spark, out, {"a": (3, 5)}).count() == 3
    assert clustered.read_range(spark, out, {"b": (0, None)}).count() == 0
    assert clustered.read_range(spark, out, {"a": (1, 1)}, version=1).count() == 150


def test_no_rows_and_no_table(spark, out):
    clustered.write_clustered(spark.createDataFrame([], "a INT, b INT"), out, ["a", "b"], 4)
    assert clustered.read_range(spark, out, {"a": (0, 5)}).count() == 0
    with pytest.raises(commits.NoVersion):
        clustered.read_range(spark, f"{out}/none", {})
    with pytest.raises(ValueError):
        clustered.write_clustered(spark.range(3), out, [], 4)


def test_curve_takes_bits_in_turn(spark):
    ranks = [F.lit(0b10000001).cast("bigint"), F.lit(0b00000001).cast("bigint")]
    assert spark.range(1).select(clustered.curve_key(ranks)).first()[0] == (1 << 15) | 0b11


def test_ranks_count_the_cuts(spark):
    cuts = [float(c // 3) for c in range(255)]
    values = [-1.0, 0.0, 0.5, 1.0, 41.0, 84.0, 1e9, None]
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    got = [r[0] for r in df.select(clustered._ranked("x", cuts)).collect()]
    assert got == [0 if v is None else sum(c <= v for c in cuts) for v in values]
