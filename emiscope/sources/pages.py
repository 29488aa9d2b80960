"""A stream over the stored pages of a listing. Its offset is the page cursor.

A listing is stored as folders ``page=<number>``, numbered from 1, each written whole. The stream
hands pages on in order and never past a gap, as a cursor leads from one page to the next; a page
that is stored later is read by a later batch. A batch holds at most ``pages_per_batch`` pages,
one task each. The checkpoint of a query keeps the cursor, so a query that ended after page k
goes on with page k + 1.

Pages are listed and read through Arrow's file systems, since a Python data source has no access
to Hadoop's; the path must be one that both know.

    spark.dataSource.register(StoredPages)
    spark.readStream.format("stored_pages").option("pages_per_batch", 5).load(path)
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

LISTING_SCHEMA = "seq BIGINT, page BIGINT, payload_json STRING"
PAGES_PER_BATCH = 100
_FOLDER = re.compile(r"page=(\d+)$")


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else fs.FileSystem.from_uri("file://" + path.removeprefix("file:"))


def stored_pages(path: str) -> set[int]:
    """Numbers of the pages there are. A folder without a data file is being written still."""
    system, place = _opened(path)
    found = system.get_file_info(fs.FileSelector(place, allow_not_found=True, recursive=True))
    parents = {f.path.rsplit("/", 1)[0] for f in found if f.is_file and f.extension == "parquet" and not re.search(r"/[._]", f.path[len(place) :])}
    return {int(m[1]) for m in map(_FOLDER.search, parents) if m}


@dataclass
class Page(InputPartition):
    number: int


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, most: int, schema: StructType):
        self.path, self.most, self.schema = path, most, schema
        self.cursor = 0  # the last page that a batch has been planned for

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        there = stored_pages(self.path)
        last = self.cursor
        while last + 1 in there and last - self.cursor < self.most:
            last += 1
        return {"page": last}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        # A query that starts again has its last batch planned first, which tells where it was.
        self.cursor = max(self.cursor, end["page"])
        return [Page(number) for number in range(start["page"] + 1, end["page"] + 1)]

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        system, place = _opened(self.path)
        layout = to_arrow_schema(self.schema)
        inside = pa.schema([f for f in layout if f.name != "page"])
        rows = ds.dataset(f"{place}/page={partition.number}", schema=inside, filesystem=system, format="parquet")
        for batch in rows.to_batches():
            number = pa.array([partition.number] * batch.num_rows, layout.field("page").type)
            columns = [number if f.name == "page" else batch.column(f.name).cast(f.type) for f in layout]
            yield pa.RecordBatch.from_arrays(columns, schema=layout)


class StoredPages(DataSource):
    """Options: ``path``, and ``pages_per_batch``."""

    @classmethod
    def name(cls) -> str:
        return "stored_pages"

    def schema(self) -> str:
        return LISTING_SCHEMA

    def streamReader(self, schema: StructType) -> _Reader:
        most = int(self.options.get("pages_per_batch", PAGES_PER_BATCH))
        if most < 1:
            raise ValueError("pages_per_batch must be greater than 0")
        return _Reader(self.options["path"], most, schema)


def stream(spark: SparkSession, path: str, pages_per_batch: int = PAGES_PER_BATCH) -> DataFrame:
    spark.dataSource.register(StoredPages)
    return spark.readStream.format("stored_pages").option("pages_per_batch", pages_per_batch).load(path)


def store(listing: DataFrame, path: str) -> None:
    """Rows of a listing (``seq, page, payload_json``) as its stored pages; other pages stay."""
    rows = listing.select("seq", "page", "payload_json").hint("rebalance", "page")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("page").parquet(path)
