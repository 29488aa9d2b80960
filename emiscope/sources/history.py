"""Keyed tables that keep their rows in buckets, so that only new rows are shuffled.

Each version of a table lies in files of one bucket each, sorted by key, and is named by a
commit log. A join or an aggregate by the key reads the stored side bucket by bucket, with no
exchange; the new rows are shuffled to as many partitions as there are buckets. A merge leaves
its result in that layout, and writes each bucket in one task.

Spark knows buckets from its catalogue. A table is entered there under a name made from its
data folder, in whatever session reads it first; the files themselves need no catalogue.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emiscope.operators.ranking import last_write_wins
from emiscope.sources import commits


@dataclass(frozen=True)
class KeyedTable:
    """A table at ``path`` with rows of the same ``keys`` in one of ``buckets``. The layout never changes."""

    path: str
    keys: tuple[str, ...]
    buckets: int

    def exists(self, spark: SparkSession) -> bool:
        return bool(commits.versions(spark, self.path))

    def _name(self, data: str) -> str:
        return "keyed_" + hashlib.sha256(data.encode()).hexdigest()[:24]

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The newest version, or a pinned one."""
        said = commits.entry(spark, self.path, version)
        if (tuple(said["keys"]), said["buckets"]) != (self.keys, self.buckets):
            raise ValueError(f"{self.path} has keys {said['keys']} in {said['buckets']} buckets")
        name, schema = self._name(said["data"]), StructType.fromJson(said["schema"])
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{said['data']}'"
            )
        return spark.table(name)

    def write(self, df: DataFrame, arranged: bool = False) -> int:
        """The next version. ``arranged``: ``df`` is partitioned by the keys into the buckets already."""
        spark = df.sparkSession
        data = commits.data_folder(self.path)
        rows = df if arranged else df.repartition(self.buckets, *self.keys)
        rows.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", data).format("parquet").saveAsTable(self._name(data))
        said = {"data": data, "schema": df.schema.jsonValue(), "keys": list(self.keys), "buckets": self.buckets}
        return commits.commit(spark, self.path, said)


def not_yet_kept(rows: DataFrame, table: KeyedTable) -> DataFrame:
    """Rows whose keys the table does not hold; all of them where there is no table yet."""
    spark = rows.sparkSession
    if not table.exists(spark):
        return rows
    return rows.join(table.read(spark).select(*table.keys).hint("merge"), list(table.keys), "left_anti")


def merged_latest(table: KeyedTable, rows: DataFrame, sequence: Sequence[str]) -> DataFrame:
    """One row per key, of the table (which holds one) and ``rows``: the one with the highest ``sequence``.

    ``rows`` have the table's columns. Of equal sequences the stored row stays. Rows with a NULL key are
    left out, as they name nothing.
    """
    known = rows.where(" AND ".join(f"`{k}` IS NOT NULL" for k in table.keys))
    new = last_write_wins(known, list(table.keys), list(sequence))
    stored = table.read(rows.sparkSession)
    kept = stored.columns
    theirs = new.select(*table.keys, F.struct(*kept).alias("_new"))
    ours = stored.select(*table.keys, F.struct(*kept).alias("_old"))
    both = ours.join(theirs.hint("merge"), list(table.keys), "full_outer")

    def order(side: str):
        return F.struct(*[F.col(f"{side}.{s}") for s in sequence])

    newer = F.col("_old").isNull() | (F.col("_new").isNotNull() & (order("_new") > order("_old")))
    chosen = both.select(F.when(newer, F.col("_new")).otherwise(F.col("_old")).alias("_row"))
    return chosen.select("_row.*")


def merge_latest(table: KeyedTable, rows: DataFrame, sequence: Sequence[str]) -> int:
    """Publish the table with ``rows`` merged in; the first call makes it."""
    if not table.exists(rows.sparkSession):
        known = rows.where(" AND ".join(f"`{k}` IS NOT NULL" for k in table.keys))
        return table.write(last_write_wins(known, list(table.keys), list(sequence)))
    return table.write(merged_latest(table, rows, sequence), arranged=True)
