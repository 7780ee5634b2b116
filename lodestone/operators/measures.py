"""Grouped measures: counts gated on themselves, intervals, votes, conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Z95 = 1.959963984540054


def wilson(successes: Column, n: Column) -> tuple[Column, Column]:
    """The 95 % Wilson interval of a proportion; NULL for n = 0."""
    n, p = n.cast("double"), successes.cast("double") / F.nullif(n, F.lit(0))
    mid, half, by = p + Z95 * Z95 / (2 * n), Z95 * F.sqrt(p * (1 - p) / n + Z95 * Z95 / (4 * n * n)), 1 + Z95 * Z95 / n
    return F.when(n > 0, F.greatest(F.lit(0.0), (mid - half) / by)), F.when(n > 0, F.least(F.lit(1.0), (mid + half) / by))


def precision_by_stratum(rows: DataFrame, strata: DataFrame, keys: list[str], correct: str) -> DataFrame:
    """Precision with its interval for every required stratum, those without rows included."""
    g = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col(correct)).alias("correct"))
    out = strata.join(g, keys, "left").fillna(0, ["n", "correct"])
    low, high = wilson(F.col("correct"), F.nullif(F.col("n"), F.lit(0)))
    return out.select(*keys, "n", "correct", F.try_divide(F.col("correct"), F.nullif(F.col("n"), F.lit(0))).alias("precision"), low.alias("low"), high.alias("high"))


def clusters_by_direction(trades: DataFrame) -> DataFrame:
    """issuer, filer, code (P, S, other) -> distinct buyers and sellers, direction, alert level, counts by code."""
    g = trades.groupBy("issuer").agg(F.count_distinct(F.when(F.col("code") == "P", F.col("filer"))).alias("buyers"), F.count_distinct(F.when(F.col("code") == "S", F.col("filer"))).alias("sellers"), *[F.count_if(F.col("code") == c).alias(f"n_{c.lower()}") for c in ("P", "S", "O")])
    direction = F.when((F.col("buyers") >= 2) & (F.col("sellers") >= 2), "mixed").when(F.col("buyers") >= 2, "buy").when(F.col("sellers") >= 2, "sell")
    alert = F.when(F.col("buyers") >= 3, "HIGH").when(F.col("buyers") >= 2, "MEDIUM")
    return g.withColumns({"direction": direction, "alert": alert}).filter("direction is not null")


def put_call(chain: DataFrame) -> DataFrame:
    """symbol, side (PUT, CALL), volume, interest -> both ratios; NULL without calls."""
    part = lambda side, c: F.sum(F.when(F.col("side") == side, F.col(c)).otherwise(0))
    g = chain.groupBy("symbol").agg(*[part(s, c).alias(f"{s.lower()}_{c}") for s in ("PUT", "CALL") for c in ("volume", "interest")])
    return g.select("symbol", *[F.try_divide(f"put_{c}", f"call_{c}").alias(f"{c}_ratio") for c in ("volume", "interest")])


def basket_return(returns: DataFrame, baskets: dict[str, list[str]]) -> DataFrame:
    """Equal-weight mean of a basket's returns, only with full membership."""
    pairs = F.explode(F.array(*[F.struct(F.lit(b).alias("basket"), F.lit(s).alias("symbol"), F.lit(len(m)).alias("size")) for b, m in baskets.items() for s in m]))
    members = returns.sparkSession.range(1).select(pairs.alias("p")).select("p.*")
    joined = members.join(returns, "symbol", "left")
    return joined.groupBy("basket", "size").agg(F.count("ret").alias("priced"), F.avg("ret").alias("_m")).select("basket", "priced", F.when(F.col("priced") == F.col("size"), F.col("_m")).alias("ret"))


def confluence(events: DataFrame, run_at: str, hours: int = 48, least: int = 2) -> DataFrame:
    """Keys with events of at least `least` families in the `hours` up to run_at, both ends included."""
    at = F.lit(run_at).cast(events.schema["at"].dataType)
    live = events.filter((F.col("at") <= at) & (F.col("at") >= at - F.expr(f"interval {hours} hours")))
    g = live.groupBy("key").agg(F.count_distinct("family").alias("n_families"), F.array_join(F.sort_array(F.collect_set("family")), "+").alias("families"), F.count("*").alias("n_events"), F.min("at").alias("first_seen"), F.max("at").alias("as_of"))
    return g.filter(F.col("n_families") >= least)


def families_within(events: DataFrame, hours: int = 48) -> DataFrame:
    """For every event, the families its key showed in the `hours` up to it (a sliding window)."""
    w = Window.partitionBy("key").orderBy(F.unix_micros(F.col("at").cast("timestamp"))).rangeBetween(-hours * 3_600_000_000, 0)
    return events.select("id", "key", "at", F.size(F.collect_set("family").over(w)).alias("n_families"))


def vote(rows: DataFrame, keys: list[str], flag: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.bool_and(flag).alias("_a"), F.bool_or(flag).alias("_o"), F.count("*").alias("votes")).select(*keys, "votes", F.when(F.col("_a"), "useful").when(~F.col("_o"), "negative").otherwise("contested").alias("state"))


def conflicts(claims: DataFrame, scope: list[str], value: str) -> DataFrame:
    """Scopes by how their values agree: attributed (one row), agreeing or conflicting."""
    g = claims.groupBy(*scope).agg(F.count_distinct(value).alias("n_values"), F.count("*").alias("n_claims"))
    return g.withColumn("state", F.when(F.col("n_values") > 1, "conflicting").when(F.col("n_claims") > 1, "agreeing").otherwise("attributed"))


def interval_gaps(spans: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Where the union of a key's intervals is interrupted: the gap after all that began before."""
    reach = F.max(end).over(Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1))
    return spans.withColumn("gap_from", reach).filter(F.col("gap_from") < F.col(start)).select(*keys, "gap_from", F.col(start).alias("gap_to")).distinct()


def contiguity(ranks: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """Whether a key's ranks are exactly 1 to their largest, each once."""
    g = ranks.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(rank).alias("_d"), F.max(rank).alias("_m"), F.min(rank).alias("_l"))
    return g.select(*keys, "n", ((F.col("n") == F.col("_m")) & (F.col("_d") == F.col("_m")) & (F.col("_l") == 1)).alias("contiguous"))


def retry_chain(attempts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, attempt, scope, started, completed: whether attempts are 1 to n, of one scope, and don't overlap."""
    w = Window.partitionBy(*keys).orderBy("attempt", "started")
    a = attempts.withColumns({"_k": F.row_number().over(w), "_p": F.lag("completed").over(w)})
    return a.groupBy(*keys).agg(F.count("*").alias("attempts"), F.bool_and(F.col("_k") == F.col("attempt")).alias("contiguous"), (F.count_distinct("scope") == 1).alias("one_scope"), F.bool_and(F.coalesce(F.col("_p") <= F.col("started"), F.lit(True))).alias("ordered"))


def keyword_ratio(posts: DataFrame, keys: list[str], words: list[str], threshold: float = 0.25) -> DataFrame:
    """Share of posts that hold any of the words."""
    hit = F.col("text").rlike("(?i)\\b(" + "|".join(words) + ")\\b")
    return posts.groupBy(*keys).agg(F.count("*").alias("posts"), F.avg(hit.cast("double")).alias("ratio")).withColumn("euphoric", F.col("ratio") > threshold)


def pool_accounting(rows: DataFrame, by: list[str]) -> DataFrame:
    """Counts by each of several columns in long form, with the largest share in its column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("(none)")).alias("value")) for c in by]))
    g = rows.select(pairs.alias("p")).groupBy("p.field", "p.value").agg(F.count("*").alias("n"))
    w = Window.partitionBy("field")
    return g.withColumns({"share": F.col("n") / F.sum("n").over(w), "largest": F.col("n") == F.max("n").over(w)})
