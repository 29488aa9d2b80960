import corpus_pipeline
from emiscope.llm import catalog
from tests.llm.data import DOCS, prose
from tests.llm.test_text_operators import plain_links


def test_every_operator_has_a_query():
    assert {q.split("_")[0] for q in catalog.QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_stages_on_a_small_corpus(spark, tmp_path):
    """Each stage against a plain version on what its predecessor kept."""
    good = [t + " Then the rest of it follows with a few more words." for t in prose(80, 7)]
    bad = [" ".join(f"{w.upper()}!!" for w in t.split()) for t in prose(40, 8)]
    texts = [*good, *bad, "12 34", "", None]
    rows = [(k, t, "en", "s", len(t or ""), 1, 2, "h", "l", "z", "v", "k") for k, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(k, int(k < 80), 0) for k in range(120) if k % 5]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append({r.doc_id for r in docs.collect()})
    assert kept[0] == set(range(120))
    assert kept[1] == set(range(80))
    assert kept[2] == {k for k, (_, part) in plain_links(good).items() if part == k}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == kept[2]
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "start").collect())) == sorted((r.doc_id, r.start) for r in packed)


def test_stages_on_odd_rows(spark, tmp_path):
    """Null and repeated ids, long and empty texts, rows judged one by one."""
    good = [t + " Then the rest of it follows with a few more words." for t in prose(60, 7)]
    bad = [" ".join(f"{w.upper()}!!" for w in t.split()) for t in prose(40, 8)]
    long = " ".join(f"w{k} then the rest" for k in range(60_000))
    rows = [*enumerate([*good, *bad]), (None, good[0]), (None, "12 34"), (1, "12 34"), (2, bad[0]), (7, good[7]), (200, long), (None, long + "."), (None, None)]
    table = spark.createDataFrame([(k, t, "en", "s", len(t or ""), 1, 2, "h", "l", "z", "v", "k") for k, t in rows], DOCS)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(k, int(k < 60), 0) for k in range(100) if k % 5]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    named = dict(corpus_pipeline.STAGES)
    lettered = named["language"](spark, docs, str(tmp_path))
    texts = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    assert texts(lettered) == sorted((r for r in rows if any(c.isalpha() for c in r[1] or "")), key=str)
    once = named["near_duplicates"](spark, docs, str(tmp_path))

    def representatives(rows):
        order = [(k is None, k or 0) for k, _ in rows]
        parts = [part for _, part in plain_links([t for _, t in rows]).values()]
        return sorted(min(o for o, q in zip(order, parts) if q == p) for p in set(parts))

    assert once.columns == docs.columns
    assert sorted(((r.doc_id is None, r.doc_id or 0) for r in once.collect())) == representatives(rows)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    fine = representatives([r for r in rows if r[1] in {*good, long, long + "."}])
    assert sorted(((r.doc_id is None, r.doc_id or 0) for r in packed if r.start == 0)) == fine
    docs.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/empty/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
