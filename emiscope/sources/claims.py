"""Claims on work partitions: of several workers that want a partition one gets it.

A claim names a run, a partition and the attempt. Claims are the versions of a commit log. A
worker reads the claims there are, writes those it wants and finds free as one data folder, and
commits it as the next version; if another worker was first, it looks again. So one exclusive
file decides over all claims of a call, however many partitions it takes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emiscope.schemas import CLAIM_SCHEMA
from emiscope.sources import commits

KEY = ("run_id", "partition_id", "attempt")
#: A version that would be this many after the last whole one holds all claims so far.
FOLD = 16


def _parts(spark: SparkSession, path: str, known: list[int]) -> tuple[list[str], int]:
    """Data folders that together hold all claims, and how many versions since a whole one."""
    folders: list[str] = []
    for version in reversed(known):
        found = commits.entry(spark, path, version)
        folders.append(found["data"])
        if found["whole"]:
            break
    return folders, len(folders)


def claims(spark: SparkSession, path: str) -> DataFrame:
    """All claims that were committed, one row each."""
    folders, _ = _parts(spark, path, commits.versions(spark, path))
    reader = spark.read.schema(CLAIM_SCHEMA)
    return reader.parquet(*folders) if folders else spark.createDataFrame([], CLAIM_SCHEMA)


def take(spark: SparkSession, path: str, wanted: DataFrame, job_name: str, now: Column) -> DataFrame:
    """Claim ``wanted`` (``run_id, partition_id, attempt``); the claims that this call got.

    Rows that are wanted twice are claimed once. Rows with a null are never claimed. What another
    call holds is left out, whichever of the two began first.
    """
    holder = uuid.uuid4().hex
    asked = wanted.select(*KEY).dropna().distinct().select(
        *KEY, F.lit(holder).alias("holder"), F.lit(job_name).alias("job_name"), now.alias("claimed_at")
    )
    while True:
        known = commits.versions(spark, path)
        folders, since = _parts(spark, path, known)
        held = spark.read.schema(CLAIM_SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], CLAIM_SCHEMA)
        free = asked.join(held, list(KEY), "left_anti")
        whole = since >= FOLD or not known
        data = commits.data_folder(path)
        (held.unionByName(free) if whole else free).write.parquet(data)
        mine = spark.read.schema(CLAIM_SCHEMA).parquet(data).where(F.col("holder") == holder)
        if mine.isEmpty():
            return mine
        if commits.try_commit(spark, path, (known[-1] if known else 0) + 1, {"data": data, "whole": whole}):
            return mine
