"""Connected components of an edge table, by contraction in rounds.

In every round each vertex points at its smallest neighbour (or itself),
pointers are followed once more, and the edges are rewritten to the pointed
vertices; edges inside a component vanish. The number of vertices that still
have edges at least halves, so rounds grow with the logarithm of the number
of vertices. Tables are written to the shared folder each round; nothing is
collected to the driver but the number of edges left.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ship_by_value, stored


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A batch's edges as edges to their batch-local roots: at most one a vertex."""
    for b in batches:
        root: dict[int, int] = {}

        def find(v: int) -> int:
            while (p := root.setdefault(v, v)) != v:
                root[v] = v = root[p]
            return v

        for x, y in zip(b["a"].tolist(), b["b"].tolist()):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
        pairs = [(find(v), v) for v in root]
        yield pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["a", "b"], dtype="int64")


def components(edges: DataFrame) -> DataFrame:
    """``(v, label)`` for every vertex of the edges ``(a long, b long)``; the
    label is one of the component's own vertices."""
    e = stored(edges.where("a <> b").mapInPandas(_forest, "a long, b long").distinct(), "edges")
    labels = None
    while not e.isEmpty():
        both = e.select(F.col("a").alias("v"), F.col("b").alias("w")).union(e.select("b", "a"))
        point = stored(both.groupBy("v").agg(F.least(F.col("v"), F.min("w")).alias("p")), "points")
        up = point.select(F.col("v").alias("p"), F.col("p").alias("q"))
        point = stored(point.join(up, "p").select("v", F.col("q").alias("p")), "points")
        to_a = point.select(F.col("v").alias("a"), F.col("p").alias("pa"))
        to_b = point.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        e = stored(e.join(to_a, "a").join(to_b, "b").where("pa <> pb")
                    .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        if labels is None:
            labels = point.select("v", F.col("p").alias("label"))
        else:
            step = point.select(F.col("v").alias("label"), "p")
            labels = stored(labels.join(step, "label", "left")
                                  .select("v", F.coalesce("p", "label").alias("label")), "labels")
    if labels is None:
        labels = e.select(F.col("a").alias("v"), F.col("b").alias("label"))
    return labels


ship_by_value(__name__)
