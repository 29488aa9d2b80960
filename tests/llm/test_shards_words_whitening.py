"""Sharding, spelling variants and whitening against plain versions."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from emiscope.llm import catalog, sharding, spelling, whitening
from tests.compare import connect, difference
from tests.llm.data import AWKWARD, DOCS, documents, prose


# --- sharding


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40, 41, 100, 1000, 4099])
def test_network_is_a_permutation_that_can_be_undone(n):
    places = sharding.permuted(np.arange(n), n)
    assert sorted(places.tolist()) == list(range(n))
    assert sharding.permuted(places, n, back=True).tolist() == list(range(n))
    assert n < 40 or places.tolist() != list(range(n))
    shard, slot = sharding.place_of(n - 1, n, 7)
    assert sharding.row_at(shard, slot, n, 7) == n - 1


def test_places_of_large_tables_stay_inside():
    n = (1 << 45) + 12_345
    numbers = np.array([0, 1, n // 2, n - 1])
    places = sharding.permuted(numbers, n)
    assert ((0 <= places) & (places < n)).all() and len(set(places.tolist())) == 4
    assert sharding.permuted(places, n, back=True).tolist() == numbers.tolist()


def _sharded(df):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size, r.law, r.shard, r.slot, r.grown_shard) for r in sharding.shard_documents(df).collect())


def test_shards_of_awkward_documents(spark):
    docs = documents(spark, [*AWKWARD, *prose(150, 3)])
    again = docs.where("doc_id = 5").withColumn("text", F.lit("another text of this id"))
    docs = docs.unionByName(again).unionByName(docs.where("doc_id in (4, 20)")).unionByName(docs.where("doc_id = 30").withColumn("doc_id", F.lit(None).cast("long")))
    rows = _sharded(docs)
    assert rows == _sharded(docs.repartition(7, "text")) == _sharded(docs.coalesce(1))
    assert Counter((r[1] if r[0] else None, r[2], r[3]) for r in rows) == Counter(
        (r.doc_id, zlib.crc32((r.text or "").encode()), len((r.text or "").encode()) + 16) for r in docs.collect()
    )
    counts = Counter(r[5] for r in rows)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, size in counts.items():
        assert sorted(r[6] for r in rows if r[5] == shard) == list(range(size))
    assert {(r[4], r[7]) for r in rows} == {("rows", None)}


def test_whole_rows_follow_the_network(spark, tmp_path):
    docs = documents(spark, prose(90, 5)).withColumn("shard", F.lit("old")).withColumn("number", F.lit("x"))
    placed = sharding.shuffle_rows(docs, [F.col("doc_id")], 8, 11)
    assert set(placed.columns) == {*docs.columns, "slot"}
    assert all((r.shard, r.slot) == sharding.place_of(r.doc_id, 90, 8, 11) for r in placed.collect())
    sharding.write_shards(placed, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 90 and back.select("shard").distinct().count() == 8


def test_many_equal_rows_are_numbered(spark):
    docs = spark.range(500).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    rows = sharding.shard_documents(docs).collect()
    assert {(r.shard, r.slot) for r in rows} == {(p % 40, p // 40) for p in range(500)}


def test_no_documents_no_shards(spark):
    assert sharding.shard_documents(documents(spark, [])).count() == 0


# --- spelling variants


def plain_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_variants(counts):
    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        long, short = (a, b) if len(a) > len(b) else (b, a)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    found = {}
    for w, n in counts.items():
        others = [(-counts[o], o) for o in counts if near(w, o)]
        best = min(others, default=None)
        far = best is not None and -best[0] >= 10 * n
        found[w] = [best[1] if far else None, None, n, len(others), -best[0] if far else None]
    for w, row in found.items():
        end = w
        while found[end][0] is not None:
            end = found[end][0]
        row[1] = end
    return {w: tuple(row) for w, row in found.items()}


def spelled(seed=4):
    """Texts in which words and misspelt copies of them repeat, down a chain of rarer and rarer forms."""
    draw = random.Random(seed)
    letters = "abcdeéüßÀ"
    base = ["".join(draw.choices(letters, k=draw.randint(6, 11))) for _ in range(25)] + ["aaaaaaaa", "abababab"]
    bag = []
    for word in base:
        bag += [word.capitalize()] * draw.choice([2, 30, 300])
        for _ in range(draw.randint(0, 5)):
            i = draw.randrange(len(word))
            edited = draw.choice([word[:i] + word[i + 1 :], word[:i] + draw.choice(letters) + word[i:], word[:i] + draw.choice(letters) + word[i + 1 :]])
            bag += [edited] * draw.choice([1, 2, 3, 25])
            bag += [edited[:2] + "z" + edited[2:]] * draw.choice([0, 2])
    draw.shuffle(bag)
    return [" ".join(bag[k : k + 40]) for k in range(0, len(bag), 40)]


def _rows(df):
    out = {}
    for r in df.collect():
        assert r.word not in out
        out[r.word] = (r.form, r.root, r.n, r.n_near, r.form_n)
    return out


def _awkward_words(spark):
    texts = [*AWKWARD, *spelled(), "y" * 5000 + " " + "y" * 4999 + " " + "y" * 5000 + " " + "y" * 4999]
    docs = documents(spark, texts)
    docs = docs.unionByName(docs.where("doc_id in (13, 14)")).unionByName(docs.where("doc_id = 15").withColumn("doc_id", F.lit(None).cast("long")))
    return docs.unionByName(docs.where("doc_id = 16").withColumn("doc_id", F.lit(17).cast("long")))


def test_variants_against_all_pairs(spark):
    docs = _awkward_words(spark)
    counts = plain_words([(r.doc_id, r.text) for r in docs.collect()])
    want = plain_variants(counts)
    assert any(row[1] not in (w, row[0]) for w, row in want.items())  # a chain of two forms
    assert max(map(len, counts)) > 4000
    assert _rows(spelling.group_variants(docs)) == want


def test_rounds_and_segments_find_the_same_pairs(spark, monkeypatch):
    vocab = spelling.vocabulary(_awkward_words(spark))
    whole = {(r.word, r.near) for r in spelling.near_pairs(vocab).collect()}
    monkeypatch.setattr(spelling, "SEGMENT_BLOCKS", 1)
    held = spelling.near_pairs(vocab, most_bytes=128).collect()
    assert len(held) == len(whole) and {(r.word, r.near) for r in held} == whole


def test_rounds_cover_each_segment_once(monkeypatch):
    monkeypatch.setattr(spelling, "SEGMENT_BLOCKS", 4)
    shards = {k: spelling.Shard.for_words(n) for k, n in ((7, 1), (8, 1000), (9, 37))}
    rounds = spelling._rounds(shards, 600)
    seen = [(k, s) for held in rounds for k, (low, high) in held.items() for s in range(low, high)]
    assert sorted(seen) == [(k, s) for k in shards for s in range(shards[k].segments)]


def test_no_words_no_variants(spark):
    assert spelling.group_variants(documents(spark, [])).count() == 0
    assert spelling.group_variants(documents(spark, [None, "", "short words only", "oneword twoword"])).count() == 0


# --- whitening


def plain_whitening(rows):
    """``vec_id, x`` rows and the fit over the different vectors."""
    grid = [(i, tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v)) for i, v in rows]
    fit = np.array(sorted({x for _, x in grid}), np.int64)
    off = fit - fit.mean(axis=0)
    values, vectors = np.linalg.eigh(off.T @ off / len(fit))
    return grid, fit, values[::-1], vectors[:, ::-1]


def _embeddings(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, x string, weight int")


def test_whitening_against_numpy(spark):
    draw = np.random.default_rng(3)
    mix = draw.normal(size=(20, 20)) * np.linspace(3, 0.1, 20)
    clean = [(k, [float(c) for c in (draw.normal(size=20) @ mix).astype(np.float32)]) for k in range(300)]
    clean += [(k + 1000, clean[7][1]) for k in range(150)] + [(8, clean[9][1]), (None, clean[3][1]), (2000, [0.0] * 20)]
    clean.append((2001, [float(c) + 0.0001 for c in np.floor(np.array(clean[5][1]) * 64) / 64]))  # another vector in the same cells
    odd = [(1, None), (2, []), (3, [None] + [1.0] * 19), (4, [float("nan")] * 20), (5, [float("inf")] + [0.0] * 19), (6, [1.0] * 19)]
    found = whitening.whiten(_embeddings(spark, clean + odd, "double")).collect()
    grid, fit, values, vectors = plain_whitening(clean)
    assert len(found) == 16 * len(clean)
    n, sums = len(fit), fit.sum(axis=0)
    want = Counter((i, c + 1, n, int(((n * np.array(x) - sums) ** 2).sum())) for i, x in grid for c in range(16))
    assert Counter((r.vec_id, r.component, r.n, r.deviation) for r in found) == want
    by_row = {(r.vec_id, r.deviation, r.component): r for r in found}
    for i, x in grid[::17]:
        rows = [by_row[i, int(((n * np.array(x) - sums) ** 2).sum()), c + 1] for c in range(16)]
        plain = (np.array(x) - sums / n) @ vectors[:, :16] / np.sqrt(values[:16])
        assert np.allclose(np.abs([r.whitened for r in rows]), np.abs(plain), atol=1e-8)
        assert np.allclose([r.explained for r in rows], values[:16] / values.sum(), rtol=1e-9)
    signs = {}
    for i, x in grid:
        plain = (np.array(x) - sums / n) @ vectors[:, :16] / np.sqrt(values[:16])
        for c in range(16):
            have = by_row[i, int(((n * np.array(x) - sums) ** 2).sum()), c + 1].whitened
            if abs(have) > 1e-3:
                signs.setdefault(c, set()).add(bool((have > 0) == (plain[c] > 0)))
    assert all(len(s) == 1 for s in signs.values())
    assert len({r.identity_error for r in found}) == 1 and 0 <= found[0].identity_error < 1e-9


def test_counts_as_weights(spark):
    rows = [(k, [float(k % 5), float(k % 3), float(k * k % 7)]) for k in range(40)]
    grid = whitening.grid_rows(_embeddings(spark, rows)).cache()
    groups = whitening.groups_of(grid, "counts")
    model = whitening.fit(groups, 3)
    x = np.array([[64 * c + 1_000_000 for c in v] for _, v in rows])
    assert (model.n, model.sums) == (40, x.sum(axis=0).astype(int).tolist())
    assert np.allclose(model.eigenvalues, np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1])
    assert whitening.identity_error(whitening.apply_to_groups(groups, model), model) < 1e-9
    with pytest.raises(ValueError):
        whitening.groups_of(grid, "other")


def test_components_without_variance(spark):
    rows = [(k, [float(k), 2.0 * k, 5.0]) for k in range(10)]
    found = whitening.whiten(_embeddings(spark, rows)).collect()
    assert len(found) == 30
    assert all((r.whitened is None) == (r.component > 1) for r in found)
    assert {r.identity_error < 1e-9 for r in found} == {True}
    one = whitening.whiten(_embeddings(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert sorted(tuple(r) for r in one) == [(i, c, 1, 0, None, 0.0, 0.0) for i in (1, 2) for c in (1, 2)]


def test_large_components(spark):
    rows = [(1, [2.0**45, 0.0]), (2, [-(2.0**45), 1.0]), (3, [1.0, 1.0]), (4, [1e300, 1.0])]
    found = whitening.whiten(_embeddings(spark, rows, "double")).collect()
    assert {r.vec_id for r in found} == {1, 2, 3} and all(r.deviation is None for r in found if r.vec_id < 3)
    assert {r.n for r in found} == {3}


def test_no_vectors_no_rows(spark):
    empty = whitening.whiten(_embeddings(spark, []))
    assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(_embeddings(spark, [(1, None), (2, [])])).count() == 0


# --- their SQL on awkward rows


@pytest.mark.parametrize("name", ["op11_feistel", "op12_variants"])
def test_oracle_on_awkward_documents(spark, tmp_path, name):
    texts = [*AWKWARD, *spelled(9)]
    rows = [(k % 40 if k else None, t, "en", "s", 1, 1, 2, "h", "l", "z", "v", "k") for k, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    sql = catalog.ORACLES[name]
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert difference(catalog.QUERIES[name](spark, str(tmp_path)), con, sql) is None
