"""Connected components by alternating large-star and small-star steps, all in joins and partial minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm._common import forget, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """edges (u, v), any direction, repeats and loops allowed -> (node, component): the smallest node reachable.

    Nodes without an edge to another node don't occur.  Nulls are ignored; no edges give no rows.
    Each round's edges are written to the shared folder, so lineage stays short and lost executors cost one round.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    e = stored(e, "edges")
    before = _state(e)
    for _ in range(most_rounds):
        if not before[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        new = stored(small, "edges")
        after = _state(new)
        forget(e)
        e = new
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components: not converged after {most_rounds} rounds")
    roots = e.groupBy("u").agg(F.min("v").alias("v"))
    nodes = roots.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
