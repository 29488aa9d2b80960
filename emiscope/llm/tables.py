"""Reading the synthetic tables and small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from emiscope.session import write_through

#: Rows of a piece that a task holds as Python values, and of a batch that Spark sends it.
PIECE_ROWS = 256
BATCH_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string")) % folds


def fold_of(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def by_row(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with a unique number of each row in ``column``, the same whenever they are read.

    Where ``doc_id`` is never null and never repeated it is that number. Otherwise, which a count
    tells, the rows are written once with numbers of their own, unique but not dense.
    """
    key = F.col("doc_id").cast("long")
    odd = rows.select(key.alias("id")).groupBy("id").count().where("id is null or count > 1")
    if odd.isEmpty():
        return rows.withColumn(column, key)
    return write_through(rows.withColumn(column, F.monotonically_increasing_id()), "numbered")


def free_name(rows: DataFrame, name: str) -> str:
    """``name``, with as many lines before it as no column of ``rows`` has."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bounded_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, those with the smallest hash of ``key``; all of them if they are fewer.

    A threshold on the hash goes first, so that the ordered step sees about ``2 * most`` rows.
    """
    total = rows.count()
    mark = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 32))
    rows = rows.withColumn("_mark", mark)
    if total > 2 * most:
        rows = rows.where(F.col("_mark") < (2 * most << 32) // total)
    return rows.orderBy("_mark", key).limit(most).drop("_mark")


def labelled(labels: DataFrame, column: str, folds: int, held_out: int) -> DataFrame:
    """``doc_id, label`` of the rows to learn from; of conflicting labels of an id the larger counts."""
    rows = labels.select(F.col("doc_id").cast("long"), F.col(column).cast("int").alias("label"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold(F.col("doc_id"), folds) != held_out))
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))


_held: dict[tuple, object] = {}
_asked: set[tuple] = set()


def held(key: tuple, make: Callable[[], object]):
    """What ``make`` gives, kept by this worker process for its next tasks.

    A task of ``map_pieces`` that does not ask for it lets it go, so that the operators that a
    worker serves one after another do not add up in its memory.
    """
    _asked.add(key)
    if key not in _held:
        _held[key] = make()
    return _held[key]


def _let_go() -> None:
    for key in _held.keys() - _asked:
        del _held[key]
    _asked.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed pages otherwise
    if trim is not None:
        trim(0)


def map_pieces(
    rows: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str | StructType
) -> DataFrame:
    """Like ``mapInPandas``, in pieces of few rows.

    Spark's batches hold many thousand rows; with whole texts in them, a task would hold
    them all as Python values. Here it holds a piece's. The session's batches become
    ``BATCH_ROWS`` rows if they were larger, as their buffers stand on both sides.
    """
    conf = rows.sparkSession.conf
    if not 0 < int(conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        conf.set(BATCH_SETTING, str(BATCH_ROWS))
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    layout = to_arrow_schema(kind)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE_ROWS):
                yield batch.slice(at, PIECE_ROWS).to_pandas()

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _asked.clear()
        for frame in run(pieces(batches)):
            yield pa.RecordBatch.from_pandas(frame, schema=layout, preserve_index=False)
        _let_go()  # the worker goes on to other tasks

    return rows.mapInArrow(mapped, kind)


def rows_of(frames: Iterator[pd.DataFrame], *columns: str) -> Iterator[tuple]:
    """Rows as tuples, one Arrow batch at a time."""
    for frame in frames:
        yield from zip(*(frame[c] for c in columns))
