"""What JSON documents look like, run by run, and how that changes.

The schema of each run's documents is found by one aggregate over their VARIANT form, merged in
the tasks before anything is shuffled: one line of text per run. From there on tables are small,
a row per run and field. Fields are named by path: ``a.b`` is field ``b`` of object ``a``, and
``a[]`` an element of list ``a``. Kinds are ``integer, number, text, boolean, null, object, list``
and ``mixed``, which is what values of several kinds are together; integers and numbers are
numbers together, and a null is of any kind. The fields of an object that is mixed with other
kinds are not listed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DecimalType, FractionalType, IntegralType, NullType, StringType, StructField, StructType, VariantType,
)
from pyspark.sql.window import Window

FIELD_SCHEMA = "run_id STRING, field STRING, kind STRING"
_KINDS = (
    (StructType, "object"), (ArrayType, "list"), (VariantType, "mixed"), (NullType, "null"), (StringType, "text"),
    (BooleanType, "boolean"), (IntegralType, "integer"), (DecimalType, "number"), (FractionalType, "number"),
)
_QUOTED_OR_OBJECT = re.compile(r"`(?:[^`]|``)*`|OBJECT<")


def observed(docs: DataFrame, json_column: str) -> DataFrame:
    """``run_id, documents, unreadable, shape``: the merged schema of each run's documents.

    Empty and missing texts count as unreadable. A run without a readable document has the shape
    ``VOID``.
    """
    read = docs.select("run_id", F.try_parse_json(json_column).alias("_doc"))
    return read.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("_doc").isNull()).alias("unreadable"),
        F.schema_of_variant_agg("_doc").alias("shape"),
    )


def type_of(shape: str) -> DataType:
    """A shape as a type, in which objects are structs."""
    return DataType.fromDDL(_QUOTED_OR_OBJECT.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], shape))


def _kind(kind: DataType) -> str:
    return next((name for cls, name in _KINDS if isinstance(kind, cls)), kind.simpleString())


def _fields(kind: DataType, path: str) -> Iterator[tuple[str, str]]:
    if path:
        yield path, _kind(kind)
    if isinstance(kind, StructType):
        for field in kind:
            yield from _fields(field.dataType, f"{path}.{field.name}" if path else field.name)
    elif isinstance(kind, ArrayType):
        yield from _fields(kind.elementType, f"{path}[]")


def fields(shapes: DataFrame) -> DataFrame:
    """``run_id, field, kind`` of observed shapes, of which there is one per run."""
    rows = [(r["run_id"], *found) for r in shapes.select("run_id", "shape").toLocalIterator() for found in _fields(type_of(r["shape"]), "")]
    return shapes.sparkSession.createDataFrame(rows, FIELD_SCHEMA)


def changes(table: DataFrame, runs: DataFrame) -> DataFrame:
    """``run_id, previous, field, change, before, after``: what each run's fields are to the run before.

    ``change`` is ``new``, ``lost``, ``changed`` or ``same``. ``runs`` (``run_id``) names all runs, as
    a run without fields loses those before it; runs follow each other in the order of their ids,
    and the first is not compared.
    """
    follow = Window.orderBy("run_id")  # one row per run
    pairs = runs.select("run_id").distinct().withColumn("previous", F.lag("run_id").over(follow)).where("previous IS NOT NULL")
    after = pairs.join(table.withColumnRenamed("kind", "after"), "run_id")
    before = pairs.join(table.select(F.col("run_id").alias("previous"), "field", F.col("kind").alias("before")), "previous")
    both = before.join(after, ["run_id", "previous", "field"], "full_outer")
    change = (
        F.when(F.col("before").isNull(), "new").when(F.col("after").isNull(), "lost")
        .when(F.col("before") == F.col("after"), "same").otherwise("changed")
    )
    return both.select("run_id", "previous", "field", change.alias("change"), "before", "after")


def history(table: DataFrame) -> DataFrame:
    """``field, kind, runs, first_run, last_run``: each field over all runs, with the kind that holds for all."""
    kinds = F.array_remove(F.collect_set("kind"), "null")
    seen = table.groupBy("field").agg(
        kinds.alias("_kinds"), F.count_distinct("run_id").alias("runs"), F.min("run_id").alias("first_run"), F.max("run_id").alias("last_run")
    )
    numbers = F.size(F.array_except("_kinds", F.array(F.lit("integer"), F.lit("number")))) == 0
    kind = (
        F.when(F.size("_kinds") == 0, "null").when(F.size("_kinds") == 1, F.col("_kinds")[0]).when(numbers, "number").otherwise("mixed")
    )
    return seen.select("field", kind.alias("kind"), "runs", "first_run", "last_run")


def _readable(kind: DataType) -> DataType:
    """The type to read a shape's documents with: text where there are only nulls."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _readable(f.dataType)) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(_readable(kind.elementType))
    return StringType() if isinstance(kind, NullType) else kind


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines below ``path`` with the schema that they have; mixed fields are VARIANT.

    The schema comes from one pass over the lines, whatever directories they lie in.
    """
    lines = spark.read.text(path).select(F.lit("").alias("run_id"), "value")
    found = observed(lines, "value").first()
    kind = _readable(type_of(found["shape"])) if found else StructType([])
    if not isinstance(kind, StructType):
        raise ValueError(f"not all lines are JSON objects: {path}")
    return spark.read.schema(kind).json(path)


def lost_fields(shapes: DataFrame, required: StructType) -> DataFrame:
    """``run_id, field`` of each required field that a run's documents do not have at all."""
    wanted = F.array(*[F.lit(name) for name, _ in _fields(required, "")])
    asked = shapes.select("run_id", F.explode(wanted).alias("field"))
    return asked.join(fields(shapes), ["run_id", "field"], "left_anti")
