"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, class_id long, h string, label string, size string, vertex string, key string"


def documents(spark: SparkSession, texts: list[str | None], first: int = 0) -> DataFrame:
    """Documents with columns whose names the operators use inside."""
    rows = [(first + k, t, "en", "s", len(t or ""), 7, -1, "h", "l", "z", "v", "k") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(count: int, seed: int = 1, longest: int = 120) -> list[str]:
    """Texts of invented words, with near copies, exact copies and shared passages."""
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdefgé", k=draw.randint(2, 8))) for _ in range(400)]
    shared = " ".join(draw.choices(words, k=60))
    texts: list[str] = []
    for k in range(count):
        kind = draw.random()
        if texts and kind < 0.25:
            copy = draw.choice(texts).split(" ")
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            texts.append(" ".join(copy))
        elif kind < 0.35:
            texts.append(shared + " " + " ".join(draw.choices(words, k=draw.randint(1, 40))))
        else:
            texts.append(" ".join(draw.choices(words, k=draw.randint(1, longest))).capitalize() + ".\nEnd, of it.")
    return texts


AWKWARD: list[str | None] = [None, "", " ", "\n\t ", "one", "One two", "x" * 5000, "a b c d e", "A B C D E", "a b c d e", "é ß 日本 😀", "word " * 3000]
