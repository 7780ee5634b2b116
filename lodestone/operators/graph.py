"""Relations between rows: components, reachability, views at a cutoff, packets of change."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.sources.scratch import stored


def components(nodes: DataFrame, edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """node -> component: the least node reachable.  Stars are rebuilt until they stand still; each round is stored."""
    e = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    state = None
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = stored(large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        new = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == state or not new[0]:
            break
        state = new
    else:
        raise RuntimeError(f"components: not converged after {most_rounds} rounds")
    roots = e.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(roots, nodes["node"] == roots["u"], "left").select("node", F.coalesce("component", "node").alias("component"))


def equal_edges(rows: DataFrame, node: str, key: str) -> DataFrame:
    """A star per key: every row with the least node of its key."""
    known = rows.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    least = known.groupBy(key).agg(F.min(node).alias("v"))
    return known.join(least, key).select(F.col(node).alias("u"), "v")


def token_edges(rows: DataFrame, node: str, tokens: str, percent: int = 85, least: int = 6) -> DataFrame:
    """Pairs of token sets (both of `least` or more) with 100 * common >= percent * union, found by their rarest tokens.

    In the order of rarity, sets that alike share one of their first n - ceil(percent n / 100) + 1 tokens.
    """
    t = rows.select(F.col(node).alias("n"), F.array_distinct(tokens).alias("s")).filter(F.size("s") >= least)
    # Equal sets are one node here, with a star to it.
    every = t.select("n", F.array_sort("s").alias("s"))
    t = every.groupBy("s").agg(F.min("n").alias("n"))
    stars = every.withColumnRenamed("n", "u").join(t.withColumnRenamed("n", "v"), "s").filter("u <> v").select("u", "v")
    one = t.select("n", F.size("s").alias("k"), F.explode("s").alias("t"))
    often = one.groupBy("t").agg(F.count("*").alias("df"))
    order = Window.partitionBy("n").orderBy("df", "t")
    first = one.join(often, "t").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= F.col("k") - F.ceil(F.col("k") * percent / 100) + 1)
    a, b = first.select(F.col("n").alias("u"), F.col("k").alias("ku"), "t"), first.select(F.col("n").alias("v"), F.col("k").alias("kv"), "t")
    fits = F.least("ku", "kv") * 100 >= F.greatest("ku", "kv") * percent
    pairs = a.join(b, "t").filter((F.col("u") < F.col("v")) & fits).select("u", "v").distinct()
    both = pairs.join(t.select(F.col("n").alias("u"), F.col("s").alias("su")), "u").join(t.select(F.col("n").alias("v"), F.col("s").alias("sv")), "v")
    common = F.size(F.array_intersect("su", "sv"))
    return both.filter(common * 100 >= (F.size("su") + F.size("sv") - common) * percent).select("u", "v").unionByName(stars)


def reachable(spark, edges: DataFrame) -> DataFrame:
    """(u, v): v can be reached from u along edges (src, dst), by paths of any length.

    Paths are joined to twice their length each round, so rounds are as many as the logarithm of the longest one; a round
    is written, and the last one finds no new pair.
    """
    known = stored(edges.select(F.col("src").alias("u"), F.col("dst").alias("v")).distinct())
    before, count = -1, known.count()
    while count > before:
        further = known.select("u", F.col("v").alias("m")).join(known.select(F.col("u").alias("m"), "v"), "m").select("u", "v")
        known = stored(known.unionByName(further).distinct())
        before, count = count, known.count()
    return known


def effective(rows: DataFrame, key: str, supersedes: str) -> DataFrame:
    """Rows that no other row in view supersedes."""
    gone = rows.filter(F.col(supersedes).isNotNull()).select(F.col(supersedes).alias(key)).distinct()
    return rows.join(gone, key, "left_anti")


def knowledge_view(versions: DataFrame, sightings: DataFrame, cutoff: str, retrospective: bool = False) -> DataFrame:
    """Versions known by the cutoff: first known at the least, over sightings, of the later of observed and corrected.

    In retrospect a version counts from when it was published, whenever it was first seen.
    """
    at = F.lit(cutoff).cast("date")
    known = sightings.groupBy("version").agg(F.min(F.greatest("observed", "corrected")).alias("first_known"))
    v = versions.join(known, "version")
    return v.filter((F.col("published") if retrospective else F.col("first_known")) <= at)


def packet(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """What changed between two views: new, withdrawn, changed or unchanged claims."""
    a, b = before.select(key, F.col(value).alias("was"), F.lit(1).alias("_a")), after.select(key, F.col(value).alias("now"), F.lit(1).alias("_b"))
    state = F.when(F.col("_a").isNull(), "new").when(F.col("_b").isNull(), "withdrawn").when(~F.col("was").eqNullSafe(F.col("now")), "changed").otherwise("unchanged")
    return a.join(b, key, "full").select(key, "was", "now", state.alias("state"))
