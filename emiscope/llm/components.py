"""Connected components of a link table, without gathering it anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emiscope.session import write_through


def _forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spanning forest of the links in each batch: at most one link per vertex but one."""
    for frame in frames:
        parent: dict = {}

        def root(v):
            path = []
            while (up := parent.setdefault(v, v)) != v:
                path.append(v)
                v = up
            for w in path:
                parent[w] = v
            return v

        for a, b in zip(frame["a"].tolist(), frame["b"].tolist()):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
        pairs = [(root(v), v) for v in list(parent)]
        kept = [(r, v) for r, v in pairs if r != v]
        yield pd.DataFrame(kept, columns=["a", "b"]).astype({"a": "int64", "b": "int64"})


def components(links: DataFrame) -> DataFrame:
    """``vertex, component`` for every vertex of ``links`` (``a``, ``b`` long).

    The component is its smallest vertex. Links are first thinned to a spanning forest
    within each Arrow batch. Then every round takes the smallest label among the
    neighbours and jumps to the label of the label, so that a chain halves per round;
    each round ends in a written table. Links with a null end and self links are left
    out; no links give no rows.
    """
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long"))
    links = links.where("a is not null and b is not null and a <> b")
    thin = links.mapInPandas(_forest, "a long, b long")
    both = thin.select("a", "b").unionAll(thin.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = write_through(both, "links")
    labels = write_through(
        edges.groupBy(F.col("a").alias("vertex")).agg(F.least(F.min("b"), F.col("vertex")).alias("component")),
        "labels",
    )
    while True:
        heard = (
            edges.join(labels, edges.a == labels.vertex)
            .groupBy(F.col("b").alias("heard_by"))
            .agg(F.min("component").alias("heard"))
        )
        better = labels.join(heard, labels.vertex == heard.heard_by, "left").select(
            "vertex", F.least("component", "heard").alias("nearer"), F.col("component").alias("before")
        )
        up = labels.select(F.col("vertex").alias("up_vertex"), F.col("component").alias("up"))
        jumped = better.join(up, better.nearer == up.up_vertex, "left").select(
            "vertex",
            F.least("nearer", "up").alias("component"),
            (F.least("nearer", "up") < F.col("before")).alias("moved"),
        )
        labels = write_through(jumped, "labels")
        if labels.where("moved").isEmpty():
            return labels.select("vertex", "component")
