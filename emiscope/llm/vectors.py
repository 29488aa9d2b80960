"""Vectors that take part in searches, each different one once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kind_of(embeddings: DataFrame) -> str:
    """How packed vectors are stored: as the column's own floating type, so that nothing is rounded."""
    return "<f4" if embeddings.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, vector`` (packed) of rows with an id and a vector to compare.

    Left out are vectors that are null, empty or zero, or hold a null or non-finite component.
    """
    kind = kind_of(embeddings)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            kept, packed = [], []
            for k, values in enumerate(frame["embedding"]):
                if values is None or len(values) == 0:
                    continue
                # A null component arrives as NaN or None.
                vector = np.array([np.nan if x is None else x for x in values] if values.dtype == object else values, kind)
                if np.isfinite(vector).all() and vector.any():
                    kept.append(k)
                    packed.append((vector + 0).tobytes())  # so that -0.0 equals 0.0
            frame = frame.iloc[kept]
            yield pd.DataFrame({"vec_id": frame["vec_id"], "label": frame["label"], "vector": packed})

    source = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
    return source.where("vec_id is not null").mapInPandas(run, "vec_id long, label long, vector binary")


def matrix(vectors: pd.Series, kind: str) -> np.ndarray:
    """Rows of equal length from packed vectors, as doubles."""
    return np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
