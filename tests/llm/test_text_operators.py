import hashlib
import itertools
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from emiscope.llm import bpe, catalog, language, matrices, ngram_join, packing, quality, toxicity
from emiscope.llm.components import components
from emiscope.llm.textbytes import batches
from emiscope.llm.token_ids import TokenIds
from tests.llm.data import AWKWARD, DOCS, documents, prose

BYTE, WORD = (public_tokenizers.path(f"{name}.json") for name in ("byte_bpe_50k", "word_bpe_49k"))


def noise(count: int, seed: int = 4) -> list[str]:
    draw = random.Random(seed)
    letters = list("abcdeFTHÉß  \n\n\t'sre  .,!?_0123456789éüñßŒ日😀\x1c​́᠎½²ⅷΣİ×\xad\x85")
    letters += ["<|endoftext|>", " the", "ing", "'ll", "\r\n", ". ", ", ", "%%. ", "<|"]
    return ["".join(draw.choices(letters, k=draw.randint(0, 60))) for _ in range(count)]


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE)


def test_bpe_equals_the_library(byte_library):
    pairs = bpe.BytePairs(BYTE)
    texts = noise(1500) + ["x" * 3000, "é" * 400, "ab" * 5000, " a" * 300]
    for ids, text in zip(pairs.encode(texts), texts):
        assert np.frombuffer(ids, "<u4").tolist() == byte_library.encode(text, add_special_tokens=False).ids
        assert pairs.decode(ids) == text
    broken = np.array([pairs.of_byte[0xE6], pairs.of_byte[65]], "<u4").tobytes()
    assert pairs.decode(broken) == "�A"


def test_bpe_cache_may_be_emptied(byte_library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 10)
    pairs = bpe.BytePairs(BYTE)
    for text in noise(60, seed=8):
        assert np.frombuffer(pairs.encode([text])[0], "<u4").tolist() == byte_library.encode(text, add_special_tokens=False).ids


def test_bpe_rows(spark, byte_library):
    docs = documents(spark, AWKWARD)
    docs = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(None,) * 12], DOCS))
    rows = bpe.digests(bpe.encode_documents(docs, BYTE)).collect()
    assert len(rows) == len(AWKWARD) + 4
    for row in rows:
        text = AWKWARD[row.doc_id] or "" if row.doc_id is not None else ""
        ids = byte_library.encode(text, add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_documents(docs.limit(0), BYTE).count() == 0


def test_token_ids_equal_the_library():
    library, own = Tokenizer.from_file(WORD), TokenIds(WORD)
    texts = noise(2500, seed=5) + ["word, " * 500, "q" * 2000]
    for ids, text in zip(own.encode(texts), texts):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_rows_are_grouped_up_to_the_size_asked_for():
    rows = [(k, "x" * 9) for k in range(25)]
    assert [len(g) for g in batches(rows, 1, 100)] == [10, 10, 5]
    assert [len(g) for g in batches(rows, 1)] == [25]


def assert_ids(own, texts):
    library = Tokenizer.from_file(WORD)
    for ids, text in zip(own.encode(texts), texts, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_token_ids_of_every_latin_letter_and_quote():
    latin = [chr(b) for b in range(256)]
    draw = random.Random(9)
    near = ["'"] * 4 + [*"stmdrevlRLa1!", " ", "’", "<|endoftext|>", "́", "'s", "'re"]
    texts = [a + b + c for a in ("", "x", "'", " ") for b in latin for c in ("", "y", "'s", "’")]
    assert_ids(TokenIds(WORD), ["", *texts, "", *("".join(draw.choices(near, k=draw.randint(1, 12))) for _ in range(4000)), ""])


def test_token_ids_of_texts_cut_into_blocks_with_few_words_kept():
    own = TokenIds(WORD, kept_words=20, block_bytes=50)
    for texts in ([], [""], noise(300, seed=6), ["a" * 300, "b c " * 200, " " * 200, "d\n" * 90 + "e" * 70 + " f’s " * 30]):
        assert_ids(own, texts)
        assert len(own.words) <= 20


def test_words_are_looked_up_without_the_marks_around_them():
    own = TokenIds(WORD)
    words = ["".join(w) for w in itertools.product("abcde", repeat=4)]
    own.encode([" ".join(f"({w}{mark}" for w in words) for mark in ("", ".", "%%%", "###,", "***", "-1-")])
    assert len(own.words) <= len(words) + 20
    assert own.words.nbytes + own.ids.nbytes < 100_000


def whole_ids(texts):
    library = Tokenizer.from_file(WORD)
    return {k: [*library.encode(t or "", add_special_tokens=False).ids, 1] for k, t in enumerate(texts)}


def assert_lossless(rows, ids, window):
    pieces, places = {}, {}
    for r in rows:
        assert zlib.crc32(struct.pack(f"<{r.length}I", *ids[r.doc_id][r.start : r.start + r.length])) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for group, size in [*((pieces[k], len(v)) for k, v in ids.items()), *((p, None) for p in places.values())]:
        at = 0
        for start, length in sorted(group):
            assert start == at and length > 0
            at += length
        assert at == size if size is not None else at <= window
    return [sum(n for _, n in p) for p in places.values()]


@pytest.mark.parametrize("window, open_windows", [(64, 1), (64, 4), (2048, 16)])
def test_packing_is_lossless_and_full(spark, window, open_windows):
    texts = AWKWARD + prose(60)
    docs = documents(spark, texts).repartition(7, "doc_id")
    packed = packing.pack_documents(docs, WORD, window, open_windows)
    fills = assert_lossless(packing.digests(packed).collect(), whole_ids(texts), window)
    assert sum(f < window for f in fills) <= 1


def test_packing_takes_null_ids_and_no_rows(spark):
    docs = documents(spark, ["one two", None])
    blank = spark.createDataFrame([(None, "three") + (None,) * 10], DOCS)
    rows = packing.pack_documents(docs.unionByName(blank).unionByName(docs), WORD).collect()
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in rows) == [-1, 0, 0, 1, 1]
    assert len({r.sequence_id for r in rows}) == 1
    assert packing.pack_documents(docs.limit(0), WORD).count() == 0


def test_windows_prefer_the_best_fit():
    windows = packing.OpenWindows(0, 10, 2)
    for doc, size in enumerate([6, 7, 3, 5]):
        windows.add(doc, 0, b"\0\0\0\0" * size, size)
    # 3 goes to the window of 7. 5 fits with 6 in none, opens one.
    assert [(d[0], d[5], d[6]) for d in windows.done] == [(1, 0, 0), (2, 0, 7)]
    assert [fill for fill, _ in windows.open] == [6, 5]
    windows.add(4, 0, b"\0\0\0\0" * 8, 8)
    # The fullest is filled up and emitted; the rest goes to the other.
    assert [(d[0], d[1], d[2]) for d in windows.done[2:]] == [(0, 0, 6), (4, 0, 4)]
    assert [fill for fill, _ in windows.open] == [9]


def test_best_fit_decreasing_against_a_plain_search():
    draw = random.Random(3)
    for _ in range(60):
        window = draw.choice([8, 10, 64])
        lengths = [draw.randint(1, window) for _ in range(draw.randint(0, 50))]
        free, plain = [], []
        for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
            fits = [(f, n) for n, f in enumerate(free) if f >= lengths[k]]
            if not fits:
                free.append(window)
                plain.append([])
                fits = [(window, len(free) - 1)]
            least = min(f for f, _ in fits)
            n = max(n for f, n in fits if f == least)
            free[n] -= lengths[k]
            plain[n].append(k)
        made = matrices.best_fit_decreasing(lengths, window)
        assert sorted(map(sum, ([lengths[k] for k in m] for m in made))) == sorted(sum(lengths[k] for k in p) for p in plain)
        assert sorted(k for m in made for k in m) == list(range(len(lengths)))


def test_matrices(spark, tmp_path):
    texts = AWKWARD + prose(40)
    made = matrices.packed_matrices(documents(spark, texts), WORD, 64, 2000)
    ids = whole_ids(texts)
    assert_lossless(matrices.segments(made).collect(), ids, 64)
    matrices.write_matrices(made, f"{tmp_path}/m")
    for row in spark.read.parquet(f"{tmp_path}/m").collect():
        values, positions = (np.frombuffer(row[c], "<u4") for c in ("ids", "positions"))
        assert len(values) == len(positions) == 64 and row.cu_seqlens[0] == 0
        for doc, start, a, b in zip(row.doc_ids, row.starts, row.cu_seqlens, row.cu_seqlens[1:]):
            assert values[a:b].tolist() == ids[doc][start : start + b - a]
            assert positions[a:b].tolist() == list(range(b - a))
        assert not values[row.cu_seqlens[-1] :].any() and not positions[row.cu_seqlens[-1] :].any()
    assert matrices.packed_matrices(documents(spark, []), WORD).count() == 0


def test_matrices_query_rests_on_written_files(spark, sf):
    found = catalog.op7_matrices(spark, sf)
    files = found.inputFiles()
    assert files and all("/matrices-" in f for f in files)
    written = spark.read.parquet(*files)
    assert {"ids", "cu_seqlens", "positions"} <= set(written.columns)
    assert sorted(matrices.segments(written).collect()) == sorted(found.collect())


def plain_links(texts):
    sets = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()})
    part = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]) and part[a] != part[b]:
                low, high = sorted((part[a], part[b]))
                part = [low if p == high else p for p in part]
    return {k: (len(s), part[k]) for k, s in enumerate(sets)}


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_against_all_pairs(spark, seed):
    texts = AWKWARD + prose(220, seed)
    docs = documents(spark, texts)
    rows = ngram_join.link_documents(docs.unionByName(docs.limit(5)).unionByName(spark.createDataFrame([(None, "a b c d e") + (None,) * 10], DOCS))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain_links(texts)
    assert len(rows) == len(texts)


def test_ngram_join_links_an_id_by_each_of_its_texts(spark):
    """Id 3 has two texts, each a copy of another document's; a repeated row changes nothing."""
    one, two, other = "a b c d e f g", "h i j k l m n o", "p q r s t u"
    rows = [(5, one), (3, two), (3, one), (9, two), (9, two), (4, other), (7, None), (7, other), (8, "")]
    found = ngram_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found)) == [(3, 4, 3), (4, 2, 4), (5, 3, 3), (7, 2, 4), (8, 0, 8), (9, 4, 3)]


def test_keep_one_judges_rows(spark):
    one, two = "a b c d e f g", "h i j k l m n o"
    rows = [(5, one, 0), (3, one, 1), (3, one, 2), (3, two, 3), (None, two, 4), (None, "x y", 5), (None, "X y", 6), (None, None, 7), (8, "", 8), (8, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    left = {r.row for r in kept.collect()}
    assert len(left & {1, 2}) == len(left & {5, 6}) == 1 and left - {1, 2, 5, 6} == {3, 7, 8, 9}
    assert ngram_join.keep_one(docs.limit(0)).count() == 0


def test_shingle_counters_in_rounds(spark, monkeypatch):
    """Counters merged in rounds equal those added at once, sparse or dense."""
    monkeypatch.setattr(ngram_join, "FAN_IN", 2)
    draw = np.random.default_rng(3)
    size, rows, want = 1 << ngram_join.BLOCK_BITS, [], np.zeros((3, 1 << ngram_join.BLOCK_BITS))
    for task in range(7):
        for block, share in enumerate((0.01, 0.9, 0.5)):
            counts = np.where(draw.random(size) < share, draw.integers(1, 1 << 31, size), 0)
            want[block] += counts
            rows.append((block, task, *ngram_join._packed(counts)))
    assert {r[2] is None for r in rows} == {True, False}
    levels = ngram_join._levels(spark.createDataFrame(rows, ngram_join.COUNTS))
    want = np.minimum(np.log2(np.minimum(want, ngram_join.MOST_COUNT) + 1) * 6, 255).astype(np.uint8)
    assert (levels[: 3 * size] == want.reshape(-1)).all() and not levels[3 * size :].any()


def test_ngram_join_of_nothing(spark):
    assert ngram_join.link_documents(documents(spark, [])).count() == 0
    assert [tuple(r) for r in ngram_join.link_documents(documents(spark, [None, ""])).orderBy("doc_id").collect()] == [(0, 0, 0), (1, 0, 1)]


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)]
    links = spark.createDataFrame([*chain, (100, 101), (102, 101), (5, 5), (None, 3), (7, None)], "a long, b long")
    found = {r.vertex: r.component for r in components(links).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}
    assert components(links.limit(0)).count() == 0


def test_scores_do_not_depend_on_neighbours():
    texts = [t.encode() for t in ["one two", "", "three", "a", " b ", "the end"]]
    model = quality.Model(np.random.default_rng(1).normal(size=1 << quality.BUCKET_BITS), 0.1)
    assert model.scores(texts).tolist() == pytest.approx([float(model.scores([t])[0]) for t in texts])
    table = np.random.default_rng(1).normal(size=(1 << language.BUCKET_BITS, 2))
    reader = language.Model(["a", "b"], table)
    together = reader.read([t.decode() for t in texts])
    alone = [reader.read([t.decode()]) for t in texts]
    assert np.allclose(together[0], [a[0][0] for a in alone])
    assert together[1].tolist() == [a[1][0] for a in alone] == [6, 0, 5, 1, 1, 6]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def test_quality_on_held_out_documents(spark):
    good = prose(150, 3)
    bad = [" ".join(f"{w.upper()}!!" for w in t.split()) for t in prose(60, 9)]
    texts = [t for pair in zip(good, bad) for t in pair] + good[60:] + [None, "", "x" * 9000]
    docs = documents(spark, texts)
    marks = labels(spark, [(k, int(not (k < 120 and k % 2)), 0, "t") for k in range(len(texts) - 3)] + [(None, 1, 0, "t"), (1, 0, 0, "t"), (3, None, 0, "t")])
    rows = quality.score_documents(docs, quality.fit(docs, marks)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id < len(texts) - 3:
            assert r.predicted == int(not (r.doc_id < 120 and r.doc_id % 2))
    kept = quality.keep_good(docs, quality.fit(docs, marks))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}


def test_quality_without_labels(spark):
    docs = documents(spark, AWKWARD)
    rows = quality.score_documents(docs, quality.fit(docs, labels(spark, []))).collect()
    assert {r.score for r in rows} == {0.5}
    assert quality.score_documents(docs.limit(0), quality.fit(docs, labels(spark, []))).count() == 0


def test_block_max_search_is_exact():
    random_ = np.random.default_rng(2)
    examples = []
    for _ in range(300):
        terms = np.sort(random_.choice(40, random_.integers(1, 6), replace=False))
        weights = random_.random(len(terms))
        examples.append((terms, weights / np.linalg.norm(weights)))
    index = toxicity.Index(40, examples)
    dense = np.zeros((300, 40))
    for e, (terms, weights) in enumerate(examples):
        dense[e, terms] = weights
    for e in range(0, 300, 7):
        cosines = dense @ dense[e]
        wanted = sorted((-c, k) for k, c in enumerate(cosines) if c > 0)[:25]
        found = index.nearest(*examples[e], 25)
        assert np.allclose([c for c, _ in found], [-c for c, _ in wanted])
        assert {k for c, k in found if c > found[-1][0] + 1e-9} == {k for c, k in wanted if -c > found[-1][0] + 1e-9}


def test_toxicity_on_held_out_documents(spark):
    draw = random.Random(6)
    texts = prose(300, 5)
    toxic = set(draw.sample(range(300), 60))
    for k in toxic:
        texts[k] += " Vile" + draw.choice(["ness,", "ly", "r."]) + " scum"
    docs = documents(spark, [*texts, None, "", "vilest thing", "z" * 9000])
    marks = labels(spark, [(k, 1, int(k in toxic), "t") for k in range(300)] + [(None, 1, 1, "t"), (2, 1, None, "t")])
    rows = toxicity.score_documents(docs, toxicity.fit(docs, marks)).collect()
    assert len(rows) == 304
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.doc_id in toxic or r.doc_id == 302)
        assert len(r.nearest) == len(r.cosines) and (not r.predicted or set(r.nearest) <= toxic)


def test_copies_of_toxic_examples_meet_them(spark):
    texts = [f"{t} plain{k}" for k, t in enumerate(prose(160, 5, 60))]
    family = " ".join(f"odd{n}" for n in range(40))  # one family of copies gives no telling terms
    copies = list(range(160, 172))
    docs = documents(spark, texts + [family + (f" end{k}" if k % 2 else "") for k in copies])
    marks = labels(spark, [(k, 1, int(k in copies), "t") for k in range(172)])
    rows = toxicity.score_documents(docs, toxicity.fit(docs, marks)).collect()
    assert any(r.held_out for r in rows if r.doc_id in copies)
    for r in rows:
        assert r.predicted == int(r.doc_id in copies)
        if r.predicted:
            assert set(r.nearest) <= set(copies) and r.cosines[0] > 0.9


def plain_toxicity(texts: dict, marks: dict) -> dict:
    """Scores, first neighbours and cosines by dictionaries and all pairs, few examples."""

    def terms(text):
        found = Counter()
        for word in re.findall(rb"[a-z0-9\x80-\xff]+", (text or "").lower().encode()):
            found[word] += 1
            for n in (4, 5, 6):
                if len(word) > n:
                    found[n, word[:n]] += 1
        return found

    counts = {d: terms(t) for d, t in texts.items()}
    held = Counter(t for c in counts.values() for t in c)
    examples = sorted(d for d in marks if zlib.crc32(str(d).encode()) % 4 != 2)
    known = {t for d in examples for t in counts[d]}
    toxic = [d for d in examples if marks[d]]

    def vectors(stop):
        made = {}
        for d, c in counts.items():
            v = {t: (1 + math.log(n)) * math.log((len(texts) + 1) / (held[t] + 1)) for t, n in c.items() if t in known and held[t] <= max(stop * len(texts), 1)}
            length = math.sqrt(sum(w * w for w in v.values()))
            made[d] = {t: w / length for t, w in v.items()}
        return made

    def near(made, d, but):
        found = [(-sum(w * made[e].get(t, 0) for t, w in made[d].items()), e) for e in examples if e != but]
        return sorted((round(c, 12), e) for c, e in found if round(c, 12) < 0)

    def odds(found):
        share = sum(-c for c, e in found if marks[e]) / sum(-c for c, _ in found)
        share = min(max(share, 0.005), 0.995)
        return math.log(share / (1 - share))

    best = None
    for stop in (0.05, 0.1, 0.2):
        made = vectors(stop)
        own = {d: near(made, d, d) for d in examples}
        without = [marks[d] for d, f in own.items() if not f]
        rest = (sum(without) + len(toxic) / len(examples)) / (len(without) + 1)
        for k in (10, 25, 50, 100, 200):
            judged = [(odds(f[:k]), marks[d]) for d, f in own.items() if f]

            def loss(slope, shift, judged=judged, hold=1):
                z = [(slope * x + shift, y) for x, y in judged]
                return sum(math.log1p(math.exp(-abs(v))) + max(v, 0) - y * v for v, y in z) + hold * ((slope - 1) ** 2 + 0.01 * shift**2) / 2

            at, step = (1.0, 0.0), 1.0
            while step > 1e-6:  # a plain pattern search
                tries = [(at[0] + a * step, at[1] + b * step) for a, b in itertools.product((-1, 0, 1), repeat=2)]
                least = min(tries, key=lambda t: loss(*t))
                at, step = (least, step) if loss(*least) < loss(*at) else (at, step / 2)
            total = loss(*at, hold=0) - sum(math.log(rest if y else 1 - rest) for y in without)
            if best is None or total < best[0] - 1e-6:
                best = total, made, at, rest, k
    _, made, (slope, shift), rest, k = best
    scores = {}
    for d in texts:
        found = near(made, d, None)[:k]
        score = 1 / (1 + math.exp(-slope * odds(found) - shift)) if found else rest
        scores[d] = score, [-c for c, e in found if marks[e] == (score >= 0.3)][:3]
    return scores


def test_toxicity_equals_the_plain_search(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "VARIANTS", toxicity.VARIANTS[:3])  # telling terms have a test of their own
    draw = random.Random(8)
    texts = dict(enumerate(prose(150, 12, 25)))
    marks = {k: int(draw.random() < 0.3) for k in range(140)}
    for k in texts:
        texts[k] += f" own{k}" + (" vile" + draw.choice(["ness", "r", "st"]) if marks.get(k) and draw.random() < 0.9 else "")
        texts[k] += draw.choice(["", " grim", " odd word"]) if k % 9 == 0 else ""
    texts |= {150: None, 151: "", 152: "vilest", 153: "unheard of"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = toxicity.fit(docs, labels(spark, [(k, 1, v, "t") for k, v in marks.items()]))
    wanted = plain_toxicity(texts, marks)
    rows = toxicity.score_documents(docs, found).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.score == pytest.approx(wanted[r.doc_id][0], abs=1e-4)
        assert r.cosines == pytest.approx(wanted[r.doc_id][1])


def test_telling_terms_against_plain_arithmetic():
    draw = random.Random(3)
    rows = []
    for d in range(200):
        label = int(draw.random() < 0.3)
        held = sorted({draw.randrange(30) for _ in range(8)} | ({30} if label and draw.random() < 0.7 else set()) | ({31} if draw.random() < 0.5 else set()))
        rows.append((d, label, d // 2, d, held))
    frame = pd.DataFrame([(d, y, a, b, np.array(t, np.int32).tobytes()) for d, y, a, b, t in rows], columns=["doc_id", "label", "least", "most", "terms"])
    counted = [r for r in rows if r[0] % 2 == 0]  # the others share the least shingle with one before
    share = sum(r[1] for r in counted) / len(counted)
    wanted = []
    for term in range(33):
        marks = [r[1] for r in counted if term in r[4]]
        a, b = sum(marks), len(marks) - sum(marks)
        chance = a and a * math.log(a / len(marks) / share)
        chance += b and b * math.log(b / len(marks) / (1 - share))
        wanted.append(a >= 3 and a > len(marks) * share and chance >= math.log(32))
    assert toxicity.telling_terms(frame, 33).tolist() == wanted and wanted[30] and sum(wanted) < 5


def test_toxicity_with_repeated_and_null_ids(spark):
    texts = [f"{t} plain{k}" + (" vile scum" if k < 20 else "") for k, t in enumerate(prose(120, 5, 30))]
    rows = [(k, t, "x") for k, t in enumerate(texts)]
    odd = [(None, texts[3], "x"), (None, None, "x"), (5, texts[5], "y"), (5, texts[100], "z"), (100, texts[100], "z")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, label string")
    marks = labels(spark, [(k, 1, int(k < 20), "t") for k in range(120)] + [(7, 1, 0, "t")])
    got = toxicity.score_documents(docs, toxicity.fit(docs, marks)).collect()
    assert len(got) == len(rows) + len(odd)
    assert {r.predicted for r in got if r.doc_id == 5} == {0, 1}
    assert sorted(r.predicted for r in got if r.doc_id is None) == [0, 1] and not any(r.held_out for r in got if r.doc_id is None)
    assert toxicity.score_documents(docs.limit(0), toxicity.fit(docs.limit(0), marks)).count() == 0


def test_toxicity_without_labels(spark):
    docs = documents(spark, AWKWARD)
    rows = toxicity.score_documents(docs, toxicity.fit(docs, labels(spark, []))).collect()
    assert {(r.score, r.predicted) for r in rows} == {(0.0, 0)}


PLACES = "key string, text string, declared string, host string, lang string, suffix string"


def test_language_fusion_against_plain_arithmetic(spark):
    docs = spark.createDataFrame(
        [("the thing with that", "en"), ("der und die das nicht", "de"), (None, "en"), ("text", None), ("and there", " EN ")], "text string, lang string"
    )
    model = language.fit(docs)
    assert model.languages == ["de", "en"]
    rows = [
        ("a", "the thing that", "en-US", "x.example.de"),
        ("b", "der die das", "de", "y.example.de"),
        ("c", "das nicht und der", None, "y.example.de"),
        ("d", None, "de", "y.example.de"),
        ("e", "12 34 !", None, None),
        ("e", "th", "", "localhost"),
        (None, "das", "fr", "other.org"),
    ]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], PLACES)
    found = language.identify(table, model).collect()
    assert len(found) == len(rows)

    def soft(v):
        v = np.exp(np.array(v) - np.max(v))
        return v / v.sum()

    host = lambda h: (h or "").lower() or None
    domain = lambda h: ".".join(h.split(".")[-2:]) if h else None
    suffix = lambda h: h.split(".")[-1] if h and "." in h else None
    said = lambda d: (d or "").split("-")[0].lower() or None
    like, letters = model.read([t or "" for _, t, _, _ in rows])
    shares = [soft(v) for v in like]
    total = sum((s for s, n in zip(shares, letters) if n), np.zeros(2))
    overall = (total + 1) / (total.sum() + 2)

    def group(key, value):
        return sum((s for s, n, r in zip(shares, letters, rows) if n and key(r) == value), np.zeros(2))

    wanted = []
    for k, r in enumerate(rows):
        log = like[k].copy()
        prior = overall
        if domain(host(r[3])) is not None:
            sums = group(lambda r: domain(host(r[3])), domain(host(r[3])))
            prior = (sums + 20 * overall) / (sums.sum() + 20) if sums.sum() else overall
        own = np.zeros(2)
        if host(r[3]) is not None:
            own = np.maximum(group(lambda r: host(r[3]), host(r[3])) - (shares[k] if letters[k] else 0), 0)
        log += np.log((own + 8 * prior) / (own.sum() + 8))
        for key in (lambda r: said(r[2]), lambda r: suffix(host(r[3]))):
            if key(r) is not None and group(key, key(r)).sum():
                sums = group(key, key(r))
                log += np.log((sums + 2 * sums.sum() / total.sum()) / (total + 2))
        post = soft(log)
        wanted.append((r[0], model.languages[int(post.argmax())] if letters[k] else "und", round(float(post.max()), 9)))
    assert sorted(map(str, wanted)) == sorted(str((f.key, f.lang, round(f.probability, 9))) for f in found)


def test_language_of_many_values_and_long_texts(spark):
    """The commonest values are the languages; a long text counts and is read whole."""
    long = "und " * 200_000 + "the " * 300_000
    docs = spark.createDataFrame([("the", "en"), ("und der", "de"), ("das", "de"), ("that", "en"), ("zzz", "junk")], "text string, lang string")
    model = language.fit(docs, most=2)
    assert model.languages == ["de", "en"]
    counted = language.fit(docs.unionByName(spark.createDataFrame([(long, "junk")], docs.schema)))
    assert counted.languages == ["de", "en", "junk"]
    of_text, buckets = language._trigrams([long, "zzz"])
    counts = np.bincount(buckets, minlength=1 << language.BUCKET_BITS) + language.SMOOTHING
    assert np.allclose(counted.log_likelihood[:, 2], np.log(counts / counts.sum()))
    one = spark.createDataFrame([(1, long, "", "")], "key long, text string, declared string, host string")
    assert [r.lang for r in language.identify(one, model).collect()] == ["en"]


def test_language_of_pages_and_nothing(spark):
    page = '<html lang="de-AT"><script>var x = "the";</script><p>das &amp; nicht</p></html>'
    pages = spark.createDataFrame([(1, "https://u@www.example.de:80/x", page), (2, None, None)], "page_id long, url string, html string")
    rows = language.page_rows(pages).orderBy("key").collect()
    assert (rows[0].declared, rows[0].host, rows[0].text.split()) == ("de", "www.example.de", ["das", "nicht"])
    nothing = language.fit(spark.createDataFrame([], "text string, lang string"))
    assert {(r.lang, r.probability) for r in language.identify(language.page_rows(pages), nothing).collect()} == {("und", 0.0)}
    known = language.fit(spark.createDataFrame([("das nicht", "de")], "text string, lang string"))
    assert language.identify(language.page_rows(pages.limit(0)), known).count() == 0
