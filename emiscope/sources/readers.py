"""Scans. Schemas are explicit; row order comes from columns, never from file order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emiscope.operators.digests import DIGEST_SCHEMA
from emiscope.schemas import DISCOVERY_COLUMNS, DISCOVERY_SCHEMA
from emiscope.sources import commits
from emiscope.sources.writers import CSV_CELLS

REQUIRED_CSV_COLUMNS = ("model_id", "co2_eq_emissions")


def read_header_csv(
    spark: SparkSession,
    path: str,
    required: Iterable[str] = REQUIRED_CSV_COLUMNS,
    multi_line: bool = True,
) -> DataFrame:
    """Header CSV with doubled quotes, all columns text; missing columns are an error.

    The header is checked against every file. ``multi_line`` allows line ends in
    quoted cells at the price of one task per file; exports bound their files. Outer
    blanks are kept.
    """
    reader = spark.read.options(**CSV_CELLS).option("multiLine", multi_line)
    header = reader.csv(path).columns
    if not header:
        raise ValueError(f"CSV has no header: {path}")
    lacking = sorted(set(required) - set(header))
    if lacking:
        raise ValueError(f"CSV lacks required columns {lacking}: {path}")
    schema = ", ".join(f"`{name}` STRING" for name in header)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_csv_parts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All CSV parts below ``path`` with their file, which sorts in part order."""
    reader = spark.read.options(**CSV_CELLS).option("multiLine", True).schema(schema)
    return reader.csv(path).select("*", F.col("_metadata.file_path").alias("part_file"))


def read_json_lines(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(glob)


def read_run(spark: SparkSession, path: str, schema: str, run_id: str) -> DataFrame:
    """One run of a JSON table partitioned by ``run_id`` and ``shard_id``; others are pruned."""
    return spark.read.schema(schema).json(path).where(F.col("run_id") == run_id)


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """One JSON document as a one-row relation; None when there is none."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_discovery(spark: SparkSession, path: str, form: str) -> DataFrame:
    """Discovery rows as a job published them or from plain files (``parquet``), or from a header CSV (``csv``)."""
    if form == "csv":
        return read_header_csv(spark, path)
    if commits.versions(spark, path):
        return commits.read(spark, path, DISCOVERY_SCHEMA)
    return spark.read.schema(DISCOVERY_SCHEMA).parquet(path)


def read_chunks(spark: SparkSession, items: DataFrame) -> DataFrame:
    """The rows behind control items (``run_id, partition_id, input_path``), each with its item's key.

    Chunks of one run share a folder; its directories are pruned to the items' ids.
    """
    base = F.regexp_replace("input_path", "/partition_id=[^/]*/?$", "")
    keyed = items.select("run_id", "partition_id", base.alias("_base"))
    found = None
    for row in keyed.select("_base").distinct().toLocalIterator():  # one row per run
        rows = spark.read.schema(f"{DISCOVERY_SCHEMA}, partition_id STRING").parquet(row["_base"])
        mine = keyed.where(F.col("_base") == row["_base"]).select("run_id", "partition_id").distinct()
        rows = rows.join(mine, "partition_id").select("run_id", "partition_id", *DISCOVERY_COLUMNS)
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        raise ValueError("no control items to read")
    return found


def read_digests(spark: SparkSession, items: DataFrame) -> DataFrame:
    """The content digests that were prepared with the chunks of control items; none where there are none."""
    base = F.regexp_replace("input_path", "/[^/]+/partition_id=[^/]*/?$", "/digests")
    found = spark.createDataFrame([], DIGEST_SCHEMA)
    for row in items.select(base.alias("_base")).distinct().toLocalIterator():  # one row per run
        try:
            rows = spark.read.schema(DIGEST_SCHEMA).parquet(row["_base"])
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found = found.unionByName(rows)
    return found.join(items.select("run_id", "partition_id"), ["run_id", "partition_id"], "left_semi")


def read_manifest(spark: SparkSession, path: str, header_schema: str, chunk_schema: str) -> DataFrame:
    """One row per chunk with the run header. The header's names win over a chunk's."""
    header = spark.read.schema(header_schema).json(f"{path}/manifest")
    chunks = spark.read.schema(f"run_id STRING, {chunk_schema}").json(f"{path}/partitions")
    own = [c for c in chunks.columns if c == "run_id" or c not in header.columns]
    return chunks.select(*own).join(F.broadcast(header), "run_id")  # the header is one row per run
