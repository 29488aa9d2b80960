import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from emiscope.llm import block_labeller, forest, graph_search
from emiscope.llm.html_blocks import leaves

EMBEDDINGS = "vec_id long, embedding array<float>, label int, size string, class_id string, copies string, vector string, shard string"


def embeddings(spark, rows):
    return spark.createDataFrame([(*r, "s", "c", "n", "v", "x") for r in rows], EMBEDDINGS)


def awkward(first):
    return [
        (first, None, 0), (first + 1, [], 0), (first + 2, [0.0] * 8, 0), (first + 3, [1.0] * 7 + [None], 0),
        (first + 4, [math.nan] * 8, 0), (first + 5, [math.inf] + [0.0] * 7, 0), (first + 6, [1.0] * 8, None), (first + 7, [1.0, 2.0], 0),
    ]


def grouped(count, seed=1):
    random = np.random.default_rng(seed)
    rows = []
    for k in range(count):
        if k and random.random() < 0.4:
            base = np.array(rows[random.integers(len(rows))][1])
            vector = base if random.random() < 0.4 else base + random.normal(0, 0.04 * np.linalg.norm(base), 8)
        else:
            vector = random.normal(0, 1, 8)
        rows.append((k, [float(x) for x in np.float32(vector)], int(random.integers(2))))
    return rows


def test_forest_against_all_pairs(spark):
    rows = grouped(500)
    table = embeddings(spark, rows + awkward(1000) + [(None, [1.0] * 8, 0)] + rows[:3])
    found = {r.vec_id: r for r in forest.link_vectors(table).collect()}
    assert len(found) == len(rows) + 8
    unit = np.array([v for _, v, _ in rows], np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([y for _, _, y in rows])
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :]) & ~np.eye(len(rows), dtype=bool)
    part = np.arange(len(rows))
    for a, b in zip(*np.nonzero(np.triu(near))):
        low, high = sorted((part[a], part[b]))
        part[part == high] = low
    for k in range(len(rows)):
        assert (found[k].n_links, found[k].component_id, found[k].kept) == (near[k].sum(), part[k], part[k] == k)
    for k in range(1000, 1008):
        assert (found[k].n_links, found[k].component_id, found[k].kept) == (0, k, True)


def test_forest_parts_more_rows_than_a_leaf(spark, monkeypatch):
    monkeypatch.setattr(forest, "LEAF", 32)
    random = np.random.default_rng(3)
    unit = random.normal(0, 1, (900, 8))
    unit[450:] = unit[:450] + random.normal(0, 0.02, (450, 8))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = set(zip(*np.nonzero(np.triu(unit @ unit.T >= 0.98, 1))))
    met = set()
    for tree in range(forest.TREES):
        for leaf in forest._leaves(unit, tree, 0, 1, 0.98):
            met.update((a, b) for a in leaf.tolist() for b in leaf.tolist() if a < b and (a, b) in near)
    assert len(met) >= 0.97 * len(near)


def test_rows_that_all_link_stay_together(monkeypatch):
    monkeypatch.setattr(forest, "LEAF", 16)
    near = np.array([1.0] + [0.0] * 7) + np.random.default_rng(2).normal(0, 0.01, (200, 8))
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    assert [len(leaf) for leaf in forest._leaves(near, 0, 0, 1, 0.98)] == [200]


def test_forest_of_nothing_and_of_equals(spark):
    assert forest.link_vectors(embeddings(spark, [])).count() == 0
    same = forest.link_vectors(embeddings(spark, [(k, [1.0, 2.0], 1) for k in range(5)])).collect()
    assert {(r.n_links, r.component_id) for r in same} == {(4, 0)}


def test_graph_search_recall_and_scores(spark):
    rows = grouped(1500, 4)
    table = embeddings(spark, rows + awkward(5000) + rows[:4])
    index = graph_search.build_index(table, shard=400)
    assert index.where("size = 32").count() == 4
    got = graph_search.search(table, index, F.col("vec_id") % 50 == 0).collect()
    vectors = np.array([v for _, v, _ in rows] + [[1.0] * 8], np.float64)
    ids = np.array([k for k, _, _ in rows] + [5006])
    hits = total = 0
    for query in range(0, 1500, 50):
        mine = sorted((r for r in got if r.query_id == query), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        scores = vectors @ vectors[query]
        order = [k for k in np.lexsort((ids, -scores)) if ids[k] != query][:20]
        for r in mine:
            at = int(np.flatnonzero(ids == r.vec_id)[0])
            assert math.isclose(r.score, scores[at], rel_tol=1e-12, abs_tol=1e-12) and r.vec_id != query
        assert [(r.score, -r.vec_id) for r in mine] == sorted(((r.score, -r.vec_id) for r in mine), reverse=True)
        hits += len({r.vec_id for r in mine} & {int(ids[k]) for k in order})
        total += 20
    assert hits >= 0.95 * total
    assert not [r for r in got if r.query_id >= 5000 and r.query_id not in (5000, 5006)]


def test_graph_search_ties_and_few_candidates(spark):
    table = embeddings(spark, [(k, [1.0, 0.0], 0) for k in range(40)] + [(99, [0.5, 0.5], 0)])
    index = graph_search.build_index(table)
    rows = graph_search.search(table, index, F.col("vec_id") == 7).orderBy("rank").collect()
    assert [r.vec_id for r in rows] == [k for k in range(21) if k != 7]
    few = embeddings(spark, [(0, [1.0, 0.0], 0), (20, [0.0, 1.0], 0)])
    assert graph_search.search(few, graph_search.build_index(few), F.col("vec_id") % 20 == 0).count() == 2
    none = embeddings(spark, [])
    assert graph_search.search(none, graph_search.build_index(none), F.lit(True)).count() == 0


def test_robust_pruning_keeps_different_directions():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [-3, 0]], np.float32)
    kept = graph_search.robust_prune(points, np.array([0]), np.array([[1, 2, 3, 4, 4, 0, -1]]), 3, 1.0)
    assert kept.tolist() == [[1, 3, 4]]


def test_gradient_of_the_block_labeller():
    page = leaves("<nav><a>Home</a></nav><article><h1>T</h1><p>Some text, it is.</p></article><footer>end</footer>")
    batch = block_labeller.encode_pages([page, page[:2]])
    wanted = [np.array([0.0, 1, 1, 0]), np.array([np.nan, 1])]
    model = block_labeller.Labeller()
    slopes = model.gradient(batch, wanted)

    def loss():
        chance = np.concatenate(model.chances(batch))
        y = np.concatenate(wanted)
        known = ~np.isnan(y)
        return -np.mean(np.where(y == 1, np.log(chance), np.log(1 - chance))[known])

    random = np.random.default_rng(0)
    for name, slope in slopes.items():
        for at in [np.unravel_index(k, slope.shape) for k in random.permutation(np.flatnonzero(slope))[:4]]:
            before = model.parts[name][at]
            model.parts[name][at] = before + 1e-5
            high = loss()
            model.parts[name][at] = before - 1e-5
            low = loss()
            model.parts[name][at] = before
            assert (high - low) / 2e-5 == pytest.approx(slope[at], rel=1e-3, abs=1e-7)


def test_leaves():
    def texts(page):
        return [leaf.text for leaf in leaves(page)]

    assert texts("") == texts("<p> </p><!-- x <p>y</p>") == texts("<script>a<p>b") == []
    assert texts("a <b>b</b>c<br>d<p>e<p>f &amp; g&nbsp; h</p>") == ["a bc d", "e", "f & g h"]
    assert texts("<ul><li>x<li>y</ul><table><tr><td>1<td>2</table>") == ["x", "y", "1", "2"]
    assert texts('<p title="a > b">t</p><p a=\'"\'>u</p>< 3 <p>v') == ["t", "u", "< 3", "v"]
    assert texts("<style>p{}</style><textarea>q</textarea><p>r<script>'</p>'</script>s</p>") == ["rs"]
    nav = leaves('<div class="Top-menu x" id=a><a href=1>go</a></div>')[0]
    assert nav.path == ("div", ".top", ".menu", ".x", ".a") and nav.linked == 2


def test_only_raw_text_elements_are_skipped():
    def texts(page):
        return [leaf.text for leaf in leaves(page)]

    assert texts('<p>a</p><svg class="i"/><p>b</p><p>c</p>') == ["a", "b", "c"]
    assert texts("<p>a</p><math/><p>b</p><video-player src=x></video-player><p>c<svg-icon></svg-icon></p>") == ["a", "b", "c"]
    assert texts("<p>x = <math><mi>y</mi></math> here</p><noscript><p>f</p></noscript><object>g</object>") == ["x = y here", "f", "g"]
    assert texts("<script-x>a</script-x><p>b<script>c</scripts>d</script >e</p><iframe>f</iframe><style\n>g</style/>h") == ["a", "be", "h"]


def page(k):
    article = "".join(f"<p>Part {n} of page {k}, with some words in it.</p>" for n in range(1 + k % 4))
    return f"<html><head><title>T {k}</title></head><body><nav><ul><li>Home<li>About</ul></nav><article><h1>Title {k}</h1>{article}</article><footer>&copy; all</footer></body></html>"


def test_extraction(spark):
    rows = [(k, f"http://h/{k}", page(k), "x", "y") for k in range(40)]
    rows += [(50, None, None, "x", "y"), (51, "u", "", "x", "y"), (None, "u", page(1), "x", "y"), (0, "http://h/0", page(0), "x", "y")]
    rows.append((52, "u", "<html><body><article>" + "<p>Long text, again and again.</p>" * 3000 + "</article></body></html>", "x", "y"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_blocks string")
    found = block_labeller.extract(pages, block_labeller.fit(pages)).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.page_id in (50, 51):
            assert r.text == ""
        elif r.page_id == 52:
            assert r.text == "\n".join(["Long text, again and again."] * 3000)
        elif r.page_id is not None:
            parts = [f"Part {n} of page {r.page_id}, with some words in it." for n in range(1 + r.page_id % 4)]
            assert r.text == "\n".join([f"Title {r.page_id}", *parts])
    assert block_labeller.extract(pages.limit(0), block_labeller.fit(pages.limit(0))).count() == 0


def test_markup_that_the_sample_lacks(spark):
    model = block_labeller.train([page(k) for k in range(60)], seed=9)
    other = (
        '<body><div class="menu">Home</div><main><h1>A title</h1><p>Real text of some length, as it is.</p><form><label>Your mail</label></form>'
        '<p>More of the text, and more.</p><div class="comments"><p>Nice one!</p></div></main><div class="cookie-notice">We use cookies.</div></body>'
    )
    split = leaves(other)
    kept = [leaf.text for leaf, c in zip(split, model.chances(block_labeller.encode_pages([split]))[0]) if c >= 0.5]
    assert kept == ["A title", "Real text of some length, as it is.", "More of the text, and more."]
