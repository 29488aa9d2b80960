"""A small commit log: versions of a table that appear whole or not at all.

A table is a folder. Its rows lie in data folders that are never changed; its versions are the
numbered files of ``_commits``, each naming one data folder. A version comes into being when its
file is created, and of two writers that create the same number one is refused: on a local store
the file is a hard link to a finished one, elsewhere it is renamed into place without
overwriting, which a Hadoop file system does in one step. (An object store whose rename is no
single step needs a committer of its own.) So a reader sees the version before or the version
after, and a writer that dies leaves data that no version names.

A file system call here is one small file per commit; rows are read and written by Spark.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

LOG = "_commits"
#: Java classes that say that a file is there already.
_THERE = ("java.nio.file.FileAlreadyExistsException", "org.apache.hadoop.fs.FileAlreadyExistsException")


class NoVersion(ValueError):
    """The table has no such version."""


def _store(spark: SparkSession, path: str):
    """The path as Hadoop's, and its file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _entry_path(path: str, version: int) -> str:
    return f"{path}/{LOG}/{version:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all versions, rising; none where there is no table."""
    place, store = _store(spark, f"{path}/{LOG}")
    if not store.exists(place):
        return []
    names = [status.getPath().getName() for status in store.listStatus(place)]
    return sorted(int(name[:12]) for name in names if name.endswith(".json") and name[:12].isdigit())


def entry(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """What a version says; the newest one's unless a version is pinned."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise NoVersion(f"no version {'' if version is None else version} of {path}")
    place, store = _store(spark, _entry_path(path, known[-1] if version is None else version))
    stream = store.open(place)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _link(spark: SparkSession, source: str, target: str) -> None:
    files, to_path = spark.sparkContext._jvm.java.nio.file.Files, spark.sparkContext._jvm.java.io.File

    def local(path: str):
        return to_path(_store(spark, path)[0].toUri().getPath()).toPath()

    files.createLink(local(target), local(source))


def _rename(spark: SparkSession, source: str, target: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place, _ = _store(spark, source)
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = getattr(hadoop.Options.Rename, "NONE")
    context = hadoop.FileContext.getFileContext(place.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(place, hadoop.Path(target), options)


def try_commit(spark: SparkSession, path: str, version: int, said: dict) -> bool:
    """Create a version; False when another writer has created it."""
    draft = f"{path}/{LOG}/.draft-{uuid.uuid4().hex}"
    place, store = _store(spark, draft)
    stream = store.create(place, False)
    stream.write(bytearray(json.dumps(said | {"version": version}).encode()))
    stream.close()
    try:
        (_link if store.getUri().getScheme() == "file" else _rename)(spark, draft, _entry_path(path, version))
        return True
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() not in _THERE:
            raise
        return False
    finally:
        store.delete(place, False)


def commit(spark: SparkSession, path: str, said: dict) -> int:
    """Create the next version, after those of other writers."""
    while True:
        known = versions(spark, path)
        version = (known[-1] if known else 0) + 1
        if try_commit(spark, path, version, said):
            return version


def data_folder(path: str) -> str:
    """A new data folder of a table."""
    return f"{path}/data/{uuid.uuid4().hex}"


def publish(df: DataFrame, path: str, also: Iterable[str] = ()) -> int:
    """Write ``df`` as the next version of ``path``, and name the same data in the tables ``also``."""
    data = data_folder(path)
    df.write.parquet(data)
    said = {"data": data, "schema": df.schema.json()}
    version = commit(df.sparkSession, path, said)
    for other in also:
        commit(df.sparkSession, other, said)
    return version


def read(spark: SparkSession, path: str, schema: str | None = None, version: int | None = None) -> DataFrame:
    """One version's rows. The data folder is chosen now; later versions do not change what is read."""
    found = entry(spark, path, version)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(found["data"])


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove data folders of the table that none of its newest ``keep`` versions names.

    Not while a publication runs, whose data no version names yet. Data that lies elsewhere, as
    in ``publish(also=...)``, is left to its own table.
    """
    known = versions(spark, path)
    kept = {entry(spark, path, v)["data"].rstrip("/").rsplit("/", 1)[-1] for v in known[-keep:]}
    place, store = _store(spark, f"{path}/data")
    gone = []
    for status in store.listStatus(place) if store.exists(place) else []:
        if status.getPath().getName() not in kept:
            store.delete(status.getPath(), True)
            gone.append(status.getPath().getName())
    return gone
