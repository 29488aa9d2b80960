"""Literal cases for every scalar function."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from emiscope.functions import payload as P
from emiscope.functions import text as T


def values(spark, inputs, make, kind="string"):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i INT, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("x"))).collect()]


def test_parse_emission(spark):
    cases = {
        "12": 12.0, "1,234.5 g": 1234.5, "3.25 kg CO2eq": 3.25, " 7 Grams ": 7.0, "2 gram": 2.0,
        "5 co₂eq": 5.0, "4 CO₂e": 4.0, "1e3": 1000.0, "unknown": None, "": None, "12d": None,
        "1.5f": None, "1_000": 1000.0, "-3": -3.0, ".5": 0.5, "5.": 5.0, "1__0": None, None: None,
        "0x10": None, "8 \t\n": 8.0,
    }
    assert values(spark, list(cases), T.parse_emission) == list(cases.values())


def test_parse_float_special(spark):
    got = values(spark, ["inf", "-Infinity", "nan", "+NaN", "in", " 1.5\t"], T.parse_float)
    assert got[:2] == [math.inf, -math.inf] and math.isnan(got[2]) and math.isnan(got[3])
    assert got[4:] == [None, 1.5]


def test_parse_int(spark):
    cases = {"3.9": 3, "-3.9": -3, "x": 0, "": 0, None: 0, "nan": 0, "inf": 0, "1e3": 1000}
    assert values(spark, list(cases), T.parse_int) == list(cases.values())


def test_wait_seconds(spark):
    cases = {None: 180, "": 180, "soon": 180, "0": 1, "0.5": 1, "42.9": 42, "-7": 1}
    assert values(spark, list(cases), T.wait_seconds) == list(cases.values())


def test_padded_id(spark):
    cases = {"3": "000003", "000003": "000003", "0": "000000", "1234567": "1234567", "a7": "a7", "": ""}
    assert values(spark, list(cases), T.padded_id) == list(cases.values())


def test_next_cursor(spark):
    cases = {
        '<https://h/api?limit=5&cursor=ab%3D%3D>; rel="next"': "ab==",
        '<https://h/a?cursor=x>; rel="prev", <https://h/a?cursor=y&z=1>; rel="next"': "y",
        '<https://h/a?limit=1>; rel="next"': None,
        '<https://h/a?cursor=x>; rel="last"': None,
        "": None,
        None: None,
    }
    assert values(spark, list(cases), T.next_cursor) == list(cases.values())


def test_encoded_id(spark):
    cases = {"org/my model": "org/my%20model", "a+b/c~d*": "a%2Bb/c~d%2A", "é/ü": "%C3%A9/%C3%BC"}
    assert values(spark, list(cases), T.encoded_id) == list(cases.values())


def test_bucket_and_key(spark):
    got = values(spark, ["s3://b/k/x.csv", "s3://b", "http://b/k"], lambda c: T.bucket_and_key(c, "s3"))
    assert [tuple(g) if g else None for g in got] == [("b", "k/x.csv"), ("b", ""), None]


def test_float_text(spark):
    cases = ["1", "0.5", "1000.0", "1.0E-5", "1.5E20", "12345678901.5", "0", "-0.25", "1.0E16", "1.0E10"]
    want = [str(float(c)) for c in cases]
    assert values(spark, cases, T.float_text) == want


def test_exact_decimal(spark):
    got = values(spark, [0.1, 1234.56, None], T.exact_decimal, "double")
    assert [None if g is None else str(g.normalize()) for g in got] == ["0.1", "1234.56", None]


# JSON ---------------------------------------------------------------------------------


def over(spark, docs, make):
    """``make(doc, card)`` over payload texts."""
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i INT, j STRING")
    rows = rows.withColumn("_doc", P.parsed(F.col("j")))
    rows = rows.withColumn("_card", P.card(F.col("_doc"))).orderBy("i")
    return [r[0] for r in rows.select(make(F.col("_doc"), F.col("_card"))).collect()]


@pytest.mark.parametrize(
    "text, want",
    [("null", False), ("0", False), ("0.0", False), ("false", False), ('""', False), ("[]", False),
     ("{}", False), ('"0"', True), ('"false"', True), ("[0]", True), ('{"a":null}', True), ("-1", True)],
)
def test_truthy(spark, text, want):
    got = over(spark, ['{"downloads":%s}' % text], lambda d, c: P.truthy(d["downloads"]))
    assert got == [want]


def test_card_spelling(spark):
    docs = [
        '{"cardData":{"datasets":"a"},"card_data":{"datasets":"b"}}',
        '{"cardData":{},"card_data":{"datasets":"b"}}',
        '{"card_data":{"datasets":"b"}}',
        '{"cardData":"text","card_data":{"datasets":"b"}}',
        "{}",
        "broken",
    ]
    got = over(spark, docs, lambda d, c: P.text_at(c, "datasets"))
    assert got == ["a", "b", "b", None, None, None]


def test_dataset_refs_against_a_plain_sort(spark):
    """References of drawn cards and tags: every kind of entry, repeated, mixed, absent."""
    draw = random.Random(17)
    names = [f"{a}{b}" for a in ("corpus-", "Set_", "ü", "x/") for b in range(6)]

    def entry():
        return draw.choice([
            lambda: [draw.choice([*names, None]) for _ in range(draw.randint(0, 5))],
            lambda: draw.choice(names), lambda: draw.randint(0, 99), lambda: None, lambda: "", lambda: [],
        ])()

    def tags():
        return [draw.choice([f"dataset:{draw.choice(names)}", draw.choice(names), 5, "dataset:"]) for _ in range(draw.randint(0, 6))]

    docs, want = [], []
    for _ in range(250):
        doc = {"tags": tags()}
        if draw.random() < 0.8:
            doc["cardData"] = {"datasets": entry()}
        docs.append(json.dumps(doc))
        listed = doc.get("cardData", {}).get("datasets")
        if listed:
            found = [str(x) for x in (listed if isinstance(listed, list) else [listed]) if x is not None]
        else:
            found = [t.removeprefix("dataset:") for t in doc["tags"] if isinstance(t, str) and t.startswith("dataset:")]
        found = sorted(set(found), key=lambda f: f.encode())
        want.append(", ".join(found) if found else None)
    got = over(spark, docs, lambda d, c: P.dataset_refs_text(P.dataset_refs(P.at(c, "datasets"), d["tags"])))
    assert got == want


def test_co2_any_golden(spark):
    docs = [
        '{"cardData":{"co2_eq_emissions":{"emissions":0.03967468113268738}}}',
        '{"cardData":{"co2_eq_emissions":0.9413042739759596}}',
        '{"cardData":{"co2_eq_emissions":null}}',
        "{}",
        '{"cardData":{"co2_eq_emissions":5.0}}',
        '{"cardData":{"co2_eq_emissions":0}}',
        '{"cardData":{"co2_eq_emissions":{"emissions":"1 kg","source":"s"}}}',
        '{"cardData":{"co2_eq_emissions":{}}}',
    ]
    got = over(spark, docs, lambda d, c: P.co2_any(c))
    assert [g["emissions"] for g in got] == [
        "0.03967468113268738", "0.9413042739759596", None, None, "5.0", "0", "1 kg", None,
    ]
    assert [g["source"] for g in got] == [None] * 6 + ["s", None]


def test_three_emission_modes(spark):
    """A scalar counts in two modes, a scalar zero in one, an inner zero in all three."""
    docs = ['{"cardData":{"co2_eq_emissions":%s}}' % x for x in ("4", "0", '{"emissions":0}', "{}")]
    object_only = over(spark, docs, lambda d, c: P.co2_object(c)["emissions"])
    kept = over(spark, docs, lambda d, c: P.co2_truthy(c)["emissions"])
    assert object_only == [None, None, 0.0, None]
    assert kept == ["4", None, "0", None]


def test_dataset_list(spark):
    docs = [
        '{"cardData":{"datasets":["a","b","a"]}}', '{"cardData":{"datasets":"a"}}',
        '{"cardData":{"datasets":[],"dataset":"d"}}', '{"cardData":{},"datasets":["p"]}',
        '{"cardData":{"datasets":{"a":1}}}', "{}", '{"cardData":{"datasets":["say \\"x\\", y"]}}',
    ]
    lists = over(spark, docs, lambda d, c: P.dataset_list(P.dataset_entry(d, c)))
    texts = over(spark, docs, lambda d, c: P.dataset_list_json(P.dataset_entry(d, c)))
    assert lists == [["a", "b", "a"], ["a"], ["d"], ["p"], [], [], ['say "x", y']]
    assert texts == [
        '["a", "b", "a"]', '["a"]', '["d"]', '["p"]', "[]", "[]", '["say \\"x\\", y"]'
    ]


def test_dataset_text(spark):
    docs = [
        '{"cardData":{"datasets":[" b ","","a",null]}}', '{"cardData":{"datasets":" s "}}',
        '{"cardData":{"datasets":[]}}', '{"cardData":{}}',
    ]
    assert over(spark, docs, lambda d, c: P.dataset_text(c)) == ["b, a", " s ", None, None]


def test_reparsed_list(spark):
    cases = ['["a", "b"]', '[\\"a\\"]', "[]", "a", None]
    assert values(spark, cases, P.reparsed_list) == [["a", "b"], ["a"], [], None, None]


def test_metrics(spark):
    docs = [
        '{"cardData":{"model-index":[{"b":"9","a":[1.5,{"x":true}]}]}}',
        '{"cardData":{"model-index":[],"metrics":["accuracy"]}}',
        '{"cardData":{"performance":{"note":"say \\"7, 8: 9\\"","v":-2}}}',
        '{"cardData":{"metrics":"f1, 3"}}',
        "{}",
    ]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i INT, j STRING")
    rows = rows.withColumn("_doc", P.parsed(F.col("j"))).withColumn("_card", P.card(F.col("_doc")))
    rows = rows.withColumn("_key", P.metrics_key(F.col("_card")))
    rows = rows.withColumn("_m", P.metrics_entry(F.col("_card"), F.col("_key"))).orderBy("i")
    got = rows.select(
        P.metrics_text(F.col("j"), F.col("_doc"), F.col("_key"), F.col("_m")), P.greatest_number(F.col("_m"))
    ).collect()
    assert [g[0] for g in got] == [
        '[{"b": "9", "a": [1.5, {"x": true}]}]', '["accuracy"]',
        '{"note": "say \\"7, 8: 9\\"", "v": -2}', '"f1, 3"', "",
    ]
    assert [g[1] for g in got] == [1.5, None, -2.0, None, None]


def test_greatest_number_long_string(spark):
    """Very long strings and many escapes must not exhaust the regex stack."""
    noise = "x1 " * 200_000 + '\\"' * 50_000
    doc = '{"cardData":{"metrics":{"note":"%s","v":[3,{"w":7.25}]}}}' % noise
    got = over(
        spark, [doc], lambda d, c: P.greatest_number(P.metrics_entry(c, P.metrics_key(c)))
    )
    assert got == [7.25]


def test_model_size(spark):
    docs = [
        '{"safetensors":{"total":10},"siblings":[{"size":3}]}',
        '{"safetensors":{"total":10.0},"siblings":[{"size":3},{"size":null},{"size":"4"},{"size":5}]}',
        '{"safetensors":null,"siblings":[{"rfilename":"a"}]}',
        '{"siblings":[{"size":0}]}',
        "{}",
    ]
    assert over(spark, docs, lambda d, c: P.model_size(d)) == [10, 8, None, 0, None]


def test_domain_and_auto(spark):
    rows = spark.createDataFrame(
        [
            (0, "row-tag", "[]", '{"pipeline_tag":"p","tags":["t"]}'),
            (1, "", "[]", '{"pipeline_tag":"p","tags":["t"]}'),
            (2, None, "[]", '{"tags":["t","AutoTrain"]}'),
            (3, None, "x" * 150, '{"tags":[]}'),
            (4, None, None, '{"tags":"free autotrain text"}'),
            (5, None, "automatic", "{}"),
            (6, None, None, "{}"),
        ],
        "i INT, tag STRING, tags STRING, j STRING",
    ).withColumn("_doc", P.parsed(F.col("j")))
    got = rows.orderBy("i").select(
        P.tag_domain(F.col("tag"), F.col("_doc"), F.col("tags")), P.mentions_auto(F.col("_doc"), F.col("tags"))
    ).collect()
    assert [g[0] for g in got] == [
        "row-tag", "p", "t", "x" * 100, "free autotrain text", "automatic", None
    ]
    assert [g[1] for g in got] == [False, False, True, False, True, True, False]


def test_spaced_json(spark):
    got = values(
        spark,
        ['{ "b" : [1,2],"a":"x, \\"y:z\\" \\\\" }', '"s,t"', "[]", None],
        P.sorted_json,
    )
    assert got == ['{"a": "x, \\"y:z\\" \\\\", "b": [1, 2]}', '"s,t"', "[]", ""]


def test_shown_lists(spark):
    docs = ['{"tags":%s}' % x for x in ('["en","fr"]', '"mit"', '["it\'s",1,1.0,null,true]', '["a\\"b\'c"]', "[]")]
    want = ["['en', 'fr']", "mit", str(["it's", 1, 1.0, None, True]), str(["a\"b'c"]), "[]"]
    assert over(spark, docs, lambda d, c: P.shown(d["tags"])) == want


def test_json_text_keeps_every_character(spark):
    """Private-use characters, escapes and nested lists come through respacing as they are."""
    texts = ['{"a":"\ue000\ue001","b":[1,[2,"x, y: z"]]}', '{"q":"say \\"hi\\", \\\\ and \\n\\u0001"}', '{"e":[],"o":{}}']
    rows = spark.createDataFrame([(t,) for t in texts], "j STRING")
    got = [r[0] for r in rows.select(P.spaced_json(F.parse_json("j"))).collect()]
    for have, text in zip(got, texts):
        assert json.loads(have) == json.loads(text)
    assert got[0] == '{"a": "\ue000\ue001", "b": [1, [2, "x, y: z"]]}'
