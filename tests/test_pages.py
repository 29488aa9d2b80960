"""Stored pages as a stream, and discovery that goes on after the last page it took."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from emiscope import session
from emiscope.plans import jobs
from emiscope.sources import pages

AT = "2026-01-01T00:00:00+00:00"


@pytest.fixture
def out(spark):
    return session.fresh_path(spark, "pages")


def listing(spark, first, last, each=5):
    """Pages ``first`` to ``last``; the models of two pages repeat, and every third emits nothing."""
    rows = []
    for page in range(first, last + 1):
        for k in range(each):
            seq = page * each + k
            co2 = "" if seq % 3 == 0 else f', "co2_eq_emissions": {{"emissions": {seq}.5}}'
            rows.append((seq, page, f'{{"id": "m{seq % (each * 2)}", "likes": {seq}, "tags": [], "cardData": {{"x": 1{co2}}}}}'))
    return spark.createDataFrame(rows, pages.LISTING_SCHEMA)


def models(result):
    return sorted((r.model_id, r.co2_eq_emissions, r.likes) for r in result.models.collect())


def totals(result):
    return {k: v for k, v in result.totals.first().asDict().items()}


def progress(df):
    return sorted((r.batch, r.last_successful_page, r.pages, r.models_seen) for r in df.collect())


def test_pages_are_found_without_open_ones(spark, out):
    assert pages.stored_pages(out) == set()
    pages.store(listing(spark, 1, 3), out)
    os.makedirs(f"{out}/page=4")
    os.makedirs(f"{out}/_temporary/page=5")
    open(f"{out}/_temporary/page=5/x.parquet", "w").close()
    assert pages.stored_pages(out) == {1, 2, 3} == pages.stored_pages(f"file:{out}")


def test_second_run_goes_on_after_the_last_page(spark, out):
    pages.store(listing(spark, 1, 5), f"{out}/in")
    first = jobs.take_pages(spark, f"{out}/in", f"{out}/r", "s", AT, 2)
    assert progress(first) == [(0, 2, 2, 10), (1, 4, 2, 10), (2, 5, 1, 5)]
    again = jobs.take_pages(spark, f"{out}/in", f"{out}/r", "s", AT, 2)
    assert progress(again) == progress(first)
    # Page 8 waits for page 7.
    pages.store(listing(spark, 6, 6).unionByName(listing(spark, 8, 8)), f"{out}/in")
    third = jobs.take_pages(spark, f"{out}/in", f"{out}/r", "s", AT, 2)
    assert progress(third)[3:] == [(3, 6, 1, 5)]
    pages.store(listing(spark, 7, 7), f"{out}/in")
    resumed = jobs.discover_pages(spark, f"{out}/in", f"{out}/r", "s", AT, 2)
    whole = jobs.discover(spark, listing(spark, 1, 8), f"{out}/whole", "s", AT)
    assert models(resumed) == models(whole) and totals(resumed) == totals(whole)
    assert totals(whole)["total_models_seen"] == 40


def test_failed_page_is_taken_by_the_next_run(spark, out):
    """A run that fails at a page keeps what it took; the next one takes that page and those after it."""
    pages.store(listing(spark, 1, 4), f"{out}/in")
    good = [f for f in os.listdir(f"{out}/in/page=3") if f.endswith(".parquet")][0]
    kept = open(f"{out}/in/page=3/{good}", "rb").read()
    with open(f"{out}/in/page=3/{good}", "wb") as f:
        f.write(b"cut short")
    with pytest.raises(PySparkException):
        jobs.take_pages(spark, f"{out}/in", f"{out}/r", "s", AT, 1)
    taken = spark.read.parquet(f"{out}/r/taken/snapshot_id=s/progress")
    assert taken.agg(F.max("last_successful_page")).first()[0] == 2
    with open(f"{out}/in/page=3/{good}", "wb") as f:
        f.write(kept)
    resumed = jobs.discover_pages(spark, f"{out}/in", f"{out}/r", "s", AT, 1)
    assert models(resumed) == models(jobs.discover(spark, listing(spark, 1, 4), f"{out}/whole", "s", AT))
    assert progress(spark.read.parquet(f"{out}/r/taken/snapshot_id=s/progress")) == [(k, k + 1, 1, 5) for k in range(4)]


def test_discovery_without_pages(spark, out):
    result = jobs.discover_pages(spark, f"{out}/none", f"{out}/r", "s", AT)
    assert result.models.count() == 0


def test_batches_hold_a_page_at_least(spark, out):
    pages.store(listing(spark, 1, 1), f"{out}/in")
    with pytest.raises(PySparkException, match="pages_per_batch"):
        jobs.take_pages(spark, f"{out}/in", f"{out}/r", "s", AT, 0)
