"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import written
from tallyforge.scale import join_unique

EDGES_AT_ONCE = 1_000_000


def local_forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges (v, root), root < v, that connect what a task's edges connect: one for each v.

    The task forgets its forest when that has grown to EDGES_AT_ONCE vertices, so its memory is
    bounded; the forest only shortens the table.
    """
    parent: dict[int, int] = {}

    def find(v: int) -> int:
        while (up := parent.get(v, v)) != v:
            parent[v] = v = parent.get(up, up)
        return v

    def out() -> pd.DataFrame:
        pairs = [(v, find(v)) for v in list(parent)]
        return pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["v", "root"], dtype="int64")

    for batch in batches:
        for a, b in zip(batch["v"].tolist(), batch["root"].tolist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > EDGES_AT_ONCE:
            yield out()
            parent.clear()
    yield out()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for each linked id the smallest id it can reach.

    Every round joins each vertex's roots with one another and lets every vertex point to its
    root's root, until vertices have one root each and roots have none.  Rounds are written below
    ``spark.checkpoint.dir``; hubs are spread by ``join_unique``.
    """
    schema = "v long, root long"
    ends = links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("root")).where("v <> root")
    edges = written(ends.mapInPandas(local_forest, schema).distinct(), "forest")
    while True:
        best = edges.groupBy("v").agg(F.min("root").alias("best"), F.count(F.lit(1)).alias("n"))
        open_roots = edges.select("root").distinct().join(edges.select(F.col("v").alias("root")).distinct(), "root", "left_semi")
        if best.where("n > 1").isEmpty() and open_roots.isEmpty():
            return edges.select(F.col("v").alias("id"), F.col("root").alias("component"))
        best = written(best.select("v", "best"), "roots")
        tied = join_unique(edges, best, ["v"]).where("root <> best").select(F.col("root").alias("v"), F.col("best").alias("root"))
        ups = best.select(F.col("v").alias("best"), F.col("best").alias("top"))
        jumped = join_unique(best, ups, ["best"], "left").select("v", F.coalesce("top", "best").alias("root"))
        edges = written(tied.unionByName(jumped).mapInPandas(local_forest, schema).distinct(), "forest")
