"""Main text of web pages by a bidirectional LSTM over their leaf blocks.

A block enters as the sum of learned vectors of its tag path (elements, and words of their
classes, ids and roles), the mean of learned vectors of its hashed words, and four numbers:
length, share of link text, share of marks, place in the page. One LSTM reads the page
forwards and one backwards, so the label of a block depends on the whole page.

No page comes labelled. The training pages, a bounded sample, are labelled by their markup
where it speaks: inside an article or main element and no part of it set aside (``ASIDE``), or
inside a set-aside part. Training hides the telling path entries of half the pages' blocks, so
that words and neighbours have to do, and gives other pages parts of each kind named in
``ASIDE``, and other names for the article, so that markup the sample lacks is known as well.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emiscope.llm import textbytes
from emiscope.llm.html_blocks import Leaf, leaves
from emiscope.llm.tables import bounded_sample, map_pieces, rows_of

#: Bound of the training pages.
SAMPLE = 240
STEPS = 240
RATE = 0.01
PATHS, WORDS, WIDTH, HIDDEN, NUMBERS = 1 << 10, 1 << 11, 12, 16, 4
BATCH = 16
PAGES = 256
THRESHOLD = 0.5
#: Markup of what is no main text: elements, and words of classes, ids or roles.
ASIDE_ELEMENTS = frozenset("nav footer aside form head title button select option menu dialog fieldset legend".split())
ASIDE_WORDS = (
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "footer header login masthead menu modal nav navbar navigation newsletter notice popup promo related reply "
    "respond share sidebar signup social sponsor sponsored subscribe toolbar widget"
).split()
MAIN_ELEMENTS = frozenset(("article", "main"))
MAIN_WORDS = "article content entry main post story".split()
ASIDE = ASIDE_ELEMENTS | {f".{w}" for w in ASIDE_WORDS}
MAIN = MAIN_ELEMENTS | {f".{w}" for w in MAIN_WORDS}


def marked_label(path: tuple[str, ...]) -> int | None:
    """1 or 0 where the markup tells main text from other blocks, else None."""
    if any(p in ASIDE for p in path):
        return 0
    if any(p in MAIN for p in path):
        return 1
    return 0 if "header" in path else None


def _path_bucket(part: str) -> int:
    return zlib.crc32(part.encode()) % PATHS


@dataclass
class Page:
    """Blocks as numbers: buckets per block, flat with counts, and four figures per block."""

    paths: list[np.ndarray]
    words: list[np.ndarray]
    numbers: np.ndarray


def encode_pages(pages: list[list[Leaf]]) -> list[Page]:
    blocks = [leaf for page in pages for leaf in page]
    found = textbytes.words([b.text.lower().encode() for b in blocks], textbytes.MARKS)
    buckets = (found.hashes() >> np.uint64(53)).astype(np.int64)  # 2048 buckets
    known: dict[tuple[str, ...], np.ndarray] = {}
    made, at = [], 0
    for page in pages:
        n = len(page)
        for leaf in page:
            if leaf.path not in known:
                known[leaf.path] = np.array([_path_bucket(p) for p in leaf.path] or [0])
        words = [buckets[found.first[k] : found.first[k + 1]] for k in range(at, at + n)]
        at += n
        size = np.array([len(leaf.text) for leaf in page], float)
        marks = np.array([sum(leaf.text.count(m) for m in ".,;:!?") for leaf in page], float)
        linked = np.array([leaf.linked for leaf in page], float)
        place = (np.arange(n) + 0.5) / max(n, 1)
        numbers = np.stack([np.log1p(size) / 8, np.minimum(linked / np.maximum(size, 1), 1), 10 * marks / np.maximum(size, 1), place], axis=1)
        made.append(Page([known[leaf.path] for leaf in page], words, numbers.reshape(n, NUMBERS)))
    return made


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _sums(table: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    """Sum of the vectors of each list of buckets; zero for an empty one."""
    sizes = np.array([len(b) for b in lists])
    out = np.zeros((len(lists), table.shape[1]))
    if sizes.sum():
        flat = np.concatenate(lists)
        some = sizes > 0
        starts = (np.cumsum(sizes) - sizes)[some]
        out[some] = np.add.reduceat(table[flat], starts, axis=0)
    return out


class Labeller:
    """Parameters of the network, its forward pass and its gradient."""

    def __init__(self, seed: int = 5):
        random = np.random.default_rng(seed)
        entry = 2 * WIDTH + NUMBERS
        self.parts = {
            "path": random.normal(0, 0.3, (PATHS, WIDTH)),
            "word": random.normal(0, 0.3, (WORDS, WIDTH)),
            "out": random.normal(0, 0.3, 2 * HIDDEN),
            "out_bias": np.zeros(1),
        }
        for way in ("ahead", "back"):
            self.parts[way] = random.normal(0, 1 / np.sqrt(entry + HIDDEN), (entry + HIDDEN, 4 * HIDDEN))
            self.parts[f"{way}_bias"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])

    def _entries(self, pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
        """Padded inputs (time, page, entry), and which of them are blocks."""
        longest = max(len(p.numbers) for p in pages)
        words = [b for p in pages for b in p.words]
        rows = np.concatenate(
            [
                _sums(self.parts["path"], [b for p in pages for b in p.paths]),
                _sums(self.parts["word"], words) / np.array([max(len(b), 1) for b in words])[:, None],
                np.concatenate([p.numbers for p in pages]),
            ],
            axis=1,
        )
        real = np.arange(longest)[:, None] < np.array([len(p.numbers) for p in pages])
        entries = np.zeros((len(pages), longest, rows.shape[1]))
        entries[real.T] = rows
        return entries.transpose(1, 0, 2), real

    def _read(self, way: str, entries: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, list]:
        """Hidden states in time order. Padding leaves the state as it is."""
        times = range(len(entries)) if way == "ahead" else range(len(entries) - 1, -1, -1)
        h = np.zeros((entries.shape[1], HIDDEN))
        c = np.zeros_like(h)
        states, steps = np.zeros((*entries.shape[:2], HIDDEN)), []
        for t in times:
            joined = np.concatenate([entries[t], h], axis=1)
            gates = joined @ self.parts[way] + self.parts[f"{way}_bias"]
            i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            new = f * c + i * g
            on = real[t][:, None]
            steps.append((t, joined, i, f, o, g, c, np.tanh(new), on))
            h, c = np.where(on, o * np.tanh(new), h), np.where(on, new, c)
            states[t] = h
        return states, steps

    def chances(self, pages: list[Page]) -> list[np.ndarray]:
        """Chance of being main text, per block of each page."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((k for k, p in enumerate(pages) if len(p.numbers)), key=lambda k: len(pages[k].numbers))
        for at in range(0, len(order), PAGES // 4):
            some = order[at : at + PAGES // 4]
            entries, real = self._entries([pages[k] for k in some])
            states = np.concatenate([self._read(way, entries, real)[0] for way in ("ahead", "back")], axis=2)
            chance = _sigmoid(states @ self.parts["out"] + self.parts["out_bias"])
            for column, k in enumerate(some):
                out[k] = chance[: len(pages[k].numbers), column]
        return out

    def gradient(self, pages: list[Page], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over blocks whose label is not NaN."""
        entries, real = self._entries(pages)
        read = {way: self._read(way, entries, real) for way in ("ahead", "back")}
        states = np.concatenate([read[way][0] for way in ("ahead", "back")], axis=2)
        chance = _sigmoid(states @ self.parts["out"] + self.parts["out_bias"])
        wanted = np.full(real.shape, np.nan)
        for k, given in enumerate(labels):
            wanted[: len(given), k] = given
        known = ~np.isnan(wanted)
        error = np.where(known, chance - np.nan_to_num(wanted), 0) / max(known.sum(), 1)
        slopes = {"out": np.einsum("tp,tph->h", error, states), "out_bias": np.array([error.sum()])}
        into = np.zeros_like(entries)
        for at, way in enumerate(("ahead", "back")):
            weight = self.parts[way]
            by_weight, by_bias = np.zeros_like(weight), np.zeros(4 * HIDDEN)
            dh = np.zeros((entries.shape[1], HIDDEN))
            dc = np.zeros_like(dh)
            for t, joined, i, f, o, g, c, squashed, on in reversed(read[way][1]):
                dh = dh + error[t][:, None] * self.parts["out"][at * HIDDEN : (at + 1) * HIDDEN]
                new = np.where(on, dh * o * (1 - squashed**2) + dc, 0)
                gates = np.concatenate(
                    [new * g * i * (1 - i), new * c * f * (1 - f), np.where(on, dh * squashed, 0) * o * (1 - o), new * i * (1 - g**2)],
                    axis=1,
                )
                by_weight += joined.T @ gates
                by_bias += gates.sum(axis=0)
                through = gates @ weight.T
                into[t] += through[:, : entries.shape[2]]
                dh = np.where(on, through[:, entries.shape[2] :], dh)
                dc = np.where(on, new * f, dc)
            slopes[way], slopes[f"{way}_bias"] = by_weight, by_bias
        rows = into.transpose(1, 0, 2)[real.T]
        for name, lists, span in (
            ("path", [b for p in pages for b in p.paths], slice(0, WIDTH)),
            ("word", [b for p in pages for b in p.words], slice(WIDTH, 2 * WIDTH)),
        ):
            slope = np.zeros_like(self.parts[name])
            sizes = np.array([len(b) for b in lists])
            if sizes.sum():
                share = rows[:, span] / (np.maximum(sizes, 1)[:, None] if name == "word" else 1)
                np.add.at(slope, np.concatenate(lists), np.repeat(share, sizes, axis=0))
            slopes[name] = slope
        return slopes


def _varied(page: list[Leaf], others: list[Leaf], random: np.random.Generator) -> tuple[list[Leaf], np.ndarray]:
    """A page with other markup of the same meaning, and its labels."""
    labels = [marked_label(leaf.path) for leaf in page]
    kind = random.integers(4)
    out: list[Leaf] = []
    if kind == 0:
        # Telling entries hidden for the blocks of one label or of both.
        hidden = random.integers(3)
        for leaf, label in zip(page, labels):
            path = leaf.path
            if label is not None and hidden in (label, 2):
                path = tuple("div" if p[0] != "." else ".x" for p in path if p in MAIN | ASIDE) + tuple(p for p in path if p not in MAIN | ASIDE)
            out.append(Leaf(path, leaf.text, leaf.linked))
        return out, np.array([np.nan if y is None else y for y in labels], float)
    name = ("article",) if kind == 1 else (("main",) if kind == 2 else ("div", f".{random.choice(MAIN_WORDS)}"))
    top = [p for leaf, y in zip(page, labels) if y == 1 for p in [leaf.path[: next(k for k, x in enumerate(leaf.path) if x in MAIN)]]]
    inserts = set(random.choice(len(page) + 1, size=min(5, len(page) + 1), replace=False).tolist()) if others else set()
    ys: list[float] = []
    for k in range(len(page) + 1):
        if k in inserts:
            what = "header" if random.integers(8) == 0 else str(random.choice(sorted(ASIDE)))
            own = (what,) if what[0] != "." else (str(random.choice(["div", "section", "ul", "aside"])), what)
            inner = top and what != "header" and random.integers(3)
            around = (top[0] + name) if inner else (top[0] if top else ("html", "body"))
            for _ in range(int(random.integers(1, 4))):
                source = others[int(random.integers(len(others)))]
                out.append(Leaf(around + own + (str(random.choice(["p", "li", "div", "h3"])),), source.text, 0))
                ys.append(0.0)
        if k < len(page):
            leaf, label = page[k], labels[k]
            path = leaf.path
            if label == 1:
                cut = next(n for n, x in enumerate(path) if x in MAIN)
                path = path[:cut] + name + path[cut + 1 :]
            out.append(Leaf(path, leaf.text, leaf.linked))
            ys.append(np.nan if label is None else float(label))
    return out, np.array(ys)


def train(htmls: list[str], seed: int = 9) -> Labeller:
    """The network after ``STEPS`` batches of differently varied pages, by gradient descent with running scales."""
    model = Labeller()
    random = np.random.default_rng(seed)
    pages = [page for page in map(leaves, htmls) if page]
    if not pages:
        return model
    others = [leaf for page in pages for leaf in page]
    mean = {k: np.zeros_like(v) for k, v in model.parts.items()}
    square = {k: np.zeros_like(v) for k, v in model.parts.items()}
    waiting: list[int] = []
    for step in range(1, STEPS + 1):
        while len(waiting) < BATCH:
            waiting.extend(random.permutation(len(pages)).tolist())
        batch, waiting = waiting[:BATCH], waiting[BATCH:]
        varied = [_varied(pages[k], others, random) for k in batch]
        slopes = model.gradient(encode_pages([p for p, _ in varied]), [y for _, y in varied])
        for k, slope in slopes.items():
            mean[k] += 0.1 * (slope - mean[k])
            square[k] += 0.01 * (slope**2 - square[k])
            model.parts[k] -= RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return model


def fit(pages: DataFrame) -> Labeller:
    """Train on at most ``SAMPLE`` pages, chosen by a hash of their id."""
    some = pages.select(F.col("page_id").cast("long"), "html").where("page_id is not null and html <> ''")
    sample = bounded_sample(some.select("page_id"), "page_id", SAMPLE)
    rows = some.join(F.broadcast(sample.distinct()), "page_id").toPandas().sort_values(["page_id", "html"])
    return train(rows["html"].tolist())


def extract(pages: DataFrame, model: Labeller) -> DataFrame:
    """``page_id, url, text, n_blocks, n_kept`` per row of ``pages``; main blocks joined by line ends.

    Null and empty html, and pages without a main block, give empty text. Rows do not depend on
    one another; repeated rows, null ids and null addresses stay as they are. Other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        each = ((h or "", i, u) for h, i, u in rows_of(frames, "html", "page_id", "url"))
        for group in textbytes.batches(each, 0):
            split = [leaves(h) for h, _, _ in group]
            main = [c >= THRESHOLD for c in shared.value.chances(encode_pages(split))]
            yield pd.DataFrame(
                {
                    "page_id": [i for _, i, _ in group],
                    "url": [u for _, _, u in group],
                    "text": ["\n".join(leaf.text for leaf, kept in zip(page, keep) if kept) for page, keep in zip(split, main)],
                    "n_blocks": [len(page) for page in split],
                    "n_kept": [int(keep.sum()) for keep in main],
                }
            ).astype({"page_id": "Int64"})

    source = pages.select(F.col("page_id").cast("long"), "url", "html")
    return map_pieces(source, run, "page_id long, url string, text string, n_blocks int, n_kept int")
