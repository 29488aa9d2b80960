"""Observed schemas of JSON documents and how they change from run to run."""

import json
import random

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emiscope import session
from emiscope.sources import drift


def shapes(spark, runs):
    rows = [(run, d if isinstance(d, str) or d is None else json.dumps(d)) for run, docs in runs.items() for d in docs]
    return session.write_through(drift.observed(spark.createDataFrame(rows, "run_id STRING, doc STRING"), "doc"), "shapes")


def table(spark, runs):
    return {(r.run_id, r.field): r.kind for r in drift.fields(shapes(spark, runs)).collect()}


def plain_fields(docs):
    """Kinds by field, from the documents one by one."""
    names = {dict: "object", list: "list", str: "text", bool: "boolean", int: "integer", float: "number", type(None): "null"}
    values = [d for d in docs]

    def merged(found):
        kinds = {names[type(v)] for v in found} - {"null"}
        if not kinds:
            return "null"
        if len(kinds) == 1:
            return kinds.pop()
        return "number" if kinds == {"integer", "number"} else "mixed"

    out = {}

    def walk(found, path):
        kind = merged(found)
        if path:
            out[path] = kind
        if kind == "object":
            for key in sorted({k for v in found if v for k in v}):
                walk([v[key] for v in found if v and key in v], f"{path}.{key}" if path else key)
        if kind == "list":
            walk([x for v in found if v for x in v], f"{path}[]")

    walk(values, "")
    return out


def drawn(draw, depth=0):
    kinds = ["int", "float", "str", "bool", "null"] + (["dict", "list"] if depth < 3 else [])
    kind = draw.choice(kinds)
    if kind == "dict":
        return {draw.choice("abc d`é-"): drawn(draw, depth + 1) for _ in range(draw.randint(0, 3))}
    if kind == "list":
        return [drawn(draw, 3) for _ in range(draw.randint(0, 3))]
    return {"int": draw.randint(-9, 9), "float": draw.randint(1, 99) + 0.25, "str": draw.choice(["x", "", "OBJECT<"]), "bool": True, "null": None}[kind]


def test_fields_against_a_walk_over_the_documents(spark):
    draw = random.Random(5)
    runs = {f"r{k:02d}": [{draw.choice("abcde"): drawn(draw) for _ in range(4)} for _ in range(draw.randint(1, 6))] for k in range(40)}
    want = {(run, field): kind for run, docs in runs.items() for field, kind in plain_fields(docs).items()}
    assert table(spark, runs) == want


def test_odd_names_and_documents(spark):
    runs = {
        "a": [{"x y": 1, "q`t": {"OBJECT<": [{"z": None}]}, "e": []}],
        "b": ["<html>", "", None, "[1, 2]", '"text"'],
        "c": ["broken", None],
    }
    found = shapes(spark, runs)
    assert {r.run_id: (r.documents, r.unreadable) for r in found.collect()} == {"a": (1, 0), "b": (5, 3), "c": (2, 2)}
    got = {(r.run_id, r.field): r.kind for r in drift.fields(found).collect()}
    assert got == {
        ("a", "x y"): "integer", ("a", "q`t"): "object", ("a", "q`t.OBJECT<"): "list", ("a", "q`t.OBJECT<[]"): "object",
        ("a", "q`t.OBJECT<[].z"): "null", ("a", "e"): "list", ("a", "e[]"): "null",
    }


def test_changes_follow_the_runs(spark):
    runs = {
        "1": [{"a": 1, "b": "x", "n": {"p": 1}}],
        "2": [{"a": 1.5, "n": {"p": 1, "q": True}}, {"c": [1]}],
        "3": ["unreadable"],
    }
    found = shapes(spark, runs)
    rows = drift.changes(drift.fields(found), found).collect()
    got = {(r.run_id, r.previous, r.field): (r.change, r.before, r.after) for r in rows}
    assert len(got) == len(rows)
    assert got == {
        ("2", "1", "a"): ("changed", "integer", "number"), ("2", "1", "b"): ("lost", "text", None), ("2", "1", "n"): ("same", "object", "object"),
        ("2", "1", "n.p"): ("same", "integer", "integer"), ("2", "1", "n.q"): ("new", None, "boolean"), ("2", "1", "c"): ("new", None, "list"),
        ("2", "1", "c[]"): ("new", None, "integer"),
        **{("3", "2", f): ("lost", k, None) for f, k in {"a": "number", "n": "object", "n.p": "integer", "n.q": "boolean", "c": "list", "c[]": "integer"}.items()},
    }
    history = {r.field: (r.kind, r.runs, r.first_run, r.last_run) for r in drift.history(drift.fields(found)).collect()}
    assert history["a"] == ("number", 2, "1", "2") and history["b"] == ("text", 1, "1", "1")


def test_required_fields_that_are_lost(spark):
    found = shapes(spark, {"1": [{"a": 1, "n": {"p": 1}}], "2": [{"a": 1}], "3": [None]})
    wanted = StructType.fromDDL("a INT, n STRUCT<p: INT>")
    assert sorted((r.run_id, r.field) for r in drift.lost_fields(found, wanted).collect()) == [("2", "n"), ("2", "n.p"), ("3", "a"), ("3", "n"), ("3", "n.p")]


def test_no_documents(spark):
    found = shapes(spark, {})
    assert found.count() == drift.fields(found).count() == drift.changes(drift.fields(found), found).count() == drift.history(drift.fields(found)).count() == 0


def test_lines_are_read_with_what_they_hold(spark):
    path = session.fresh_path(spark, "lines")
    docs = [{"a": 1, "m": 2}, {"a": 2.5, "m": "x", "o": {"p": [1]}}, {"z": None}]
    spark.createDataFrame([(json.dumps(d),) for d in docs], "value STRING").write.text(path)
    rows = drift.read_json(spark, path)
    kinds = dict(rows.dtypes)
    assert kinds["m"] == "variant" and kinds["z"] == "string" and kinds["o"] == "struct<p:array<bigint>>"
    assert sorted(float(r.a) for r in rows.where("a IS NOT NULL").collect()) == [1.0, 2.5]
    assert sorted(r[0] for r in rows.select(F.to_json("m")).where("m IS NOT NULL").collect()) == ['"x"', "2"]
