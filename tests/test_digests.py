"""Content digests tell apart what counts do not."""

import random

from pyspark.sql import functions as F

from emiscope.operators import digests as D

SCHEMA = "g INT, part INT, a STRING, b STRING, n BIGINT"
COLUMNS = ["a", "b", "n"]


def digest(spark, rows):
    df = D.content_digests(spark.createDataFrame(rows, SCHEMA), ["g"], COLUMNS)
    return {r["g"]: tuple(r)[1:] for r in df.collect()}


def test_digests_follow_the_rows_alone(spark):
    draw = random.Random(2)
    rows = [(k % 4, k % 3, draw.choice(["x", None, ""]), draw.choice(["x", "y", None]), draw.choice([None, 0, 1])) for k in range(300)]
    whole = digest(spark, rows)
    shuffled = rows[:]
    draw.shuffle(shuffled)
    assert digest(spark, shuffled) == whole
    parts = D.content_digests(spark.createDataFrame(rows, SCHEMA), ["g", "part"], COLUMNS)
    assert {r["g"]: tuple(r)[1:] for r in D.merged(parts, ["g"]).collect()} == whole


def test_small_changes_are_seen(spark):
    base = [(0, 0, "x", "y", 1), (0, 0, "y", "x", 2), (0, 0, None, "x", 3), (0, 0, "x", None, 3)]
    others = [
        [(0, 0, "x", "y", 2), (0, 0, "y", "x", 1), *base[2:]],  # swapped numbers
        [(0, 0, "xy", "", 1), *base[1:]],  # a letter moved over
        [(0, 0, "x", "y", None), *base[1:]],
        [base[0], base[0], *base[2:]],  # one row twice instead of another
        [*base[:2], base[2], base[2]],  # NULL in the other column
        [*base[:2], base[0], base[0]],
        base[:3],
        [*base, base[0]],
    ]
    seen = {digest(spark, rows)[0] for rows in [base, *others]}
    assert len(seen) == 1 + len(others)


def test_reconciled_from_both_sides(spark):
    declared = D.content_digests(spark.createDataFrame([(1, 0, "x", "y", 1), (2, 0, "x", "y", 1), (3, 0, "x", "y", 1)], SCHEMA), ["g"], COLUMNS)
    actual = D.content_digests(spark.createDataFrame([(1, 0, "x", "y", 1), (2, 0, "x", "y", 9), (4, 0, "x", "y", 1)], SCHEMA), ["g"], COLUMNS)
    got = {r.g: (r.records_count, r.actual_count, r.mismatch, r.altered) for r in D.reconcile_content(declared, actual, ["g"]).collect()}
    assert got == {1: (1, 1, False, False), 2: (1, 1, True, True), 3: (1, 0, True, False), 4: (None, 1, True, False)}


def test_no_rows(spark):
    none = D.content_digests(spark.createDataFrame([], SCHEMA), ["g"], COLUMNS)
    assert none.count() == D.reconcile_content(none, none, ["g"]).where(F.lit(True)).count() == 0
