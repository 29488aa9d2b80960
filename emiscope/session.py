"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def build_session(master: str | None = None, app: str = "emiscope", **conf: str) -> SparkSession:
    """A UTC session with adaptive execution on. ``master`` is left to the cluster when unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Streaming state on local disk with checkpoints, not on the heap.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local temporary one only in local mode without one."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="emiscope-")
    return _local_dirs[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; all of one application lie in one directory."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/{app}/{label}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder, with the writer's ``options``, and read it back.

    The lineage ends at the written table, so a lost executor costs one re-read
    and every later use sees the same rows in the same files.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
