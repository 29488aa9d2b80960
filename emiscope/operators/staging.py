"""Plan shaping that costs nothing at run time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_computed(rows: DataFrame, condition: Column) -> DataFrame:
    """Filter on columns that were costly to make, without making them twice.

    Spark would copy their expressions into a filter below the projection. The row
    id pins the filter where it is.
    """
    pinned = rows.withColumn("_pin", F.monotonically_increasing_id())
    return pinned.where(condition & (F.col("_pin") >= 0)).drop("_pin")
