"""Lookahead-free forward outcomes and their gated statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(calendar: DataFrame) -> DataFrame:
    """session -> session, k: the trading calendar with positions.  One row per session, so one window serves."""
    return calendar.select("session").distinct().withColumn("k", F.row_number().over(Window.orderBy("session")))


def days_to_sessions(calendar: DataFrame, strict: bool = False) -> DataFrame:
    """Every day from the one before the first session to the last -> the next session on or (strict) after it: an as-of join becomes an equi-join."""
    n = numbered(calendar)
    before = F.coalesce(F.lag("session").over(Window.orderBy("session")), F.date_sub("session", 2))
    low, high = (before, F.date_sub("session", 1)) if strict else (F.date_add(before, 1), F.col("session"))
    return n.withColumns({"_low": low, "_high": high}).select(F.explode(F.sequence("_low", "_high")).alias("day"), "session", "k").filter("day >= date_sub(session, 1) or k > 1")


def forward_windows(signals: DataFrame, calendar: DataFrame, horizons: tuple[int, ...] = (1, 5, 20), strict: bool = False, delay: int = 0) -> DataFrame:
    """Signals with entry (first session on or after the day; strict: after it; delay: so many later) and exit sessions.

    Every signal stays, once for each horizon: one from before the calendar enters at its first session; one that no session
    follows has neither entry nor exit, and an exit that the calendar doesn't have yet is NULL.  Both are pending.
    """
    days, n = days_to_sessions(calendar, strict=strict), numbered(calendar)
    first = n.agg(F.date_sub(F.min("session"), 1).alias("_first"))  # one row
    at = signals.join(F.broadcast(first)).withColumn("_day", F.greatest("generated_on", "_first")).join(days.select(F.col("day").alias("_day"), F.col("k").alias("_k")), "_day", "left").drop("_day", "_first")
    at = at.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons]))).withColumn("_e", F.col("_k") + delay)
    entry, exit_ = n.select(F.col("k").alias("_e"), F.col("session").alias("entry")), n.select(F.col("k").alias("_x"), F.col("session").alias("exit"))
    out = at.join(entry, "_e", "left").withColumn("_x", F.col("_e") + F.col("horizon")).join(exit_, "_x", "left")
    return out.drop("_k", "_e", "_x").withColumn("status", F.when(F.col("exit").isNull(), "pending").otherwise("filled"))


def window_returns(windows: DataFrame, bars: DataFrame) -> DataFrame:
    """ret from the closes of both ends (NULL and `unpriceable` where one is missing)."""
    a = bars.select("symbol", F.col("session").alias("entry"), F.col("close").alias("_a"))
    b = bars.select("symbol", F.col("session").alias("exit"), F.col("close").alias("_b"))
    out = windows.join(a, ["symbol", "entry"], "left").join(b, ["symbol", "exit"], "left")
    ret = F.when((F.col("_a") > 0) & (F.col("_b") > 0), F.col("_b") / F.col("_a") - 1)
    status = F.when(F.col("status") == "pending", "pending").when(ret.isNull(), "unpriceable").otherwise("filled")
    return out.withColumns({"ret": ret, "status": status}).drop("_a", "_b")


def cohort_benchmark(windows: DataFrame, bars: DataFrame, members: list[str]) -> DataFrame:
    """(entry, exit) -> the frozen cohort's weighted return: complete, partial or unavailable; never renormalised."""
    spans = windows.filter("exit is not null").select("entry", "exit").distinct()
    fan = spans.withColumn("symbol", F.explode(F.array(*map(F.lit, members)))).withColumn("status", F.lit("filled"))
    r = window_returns(fan, bars)
    g = r.groupBy("entry", "exit").agg(F.count("ret").alias("priced"), F.sum(F.col("ret") / len(members)).alias("_w"))
    status = F.when(F.col("priced") == len(members), "complete").when(F.col("priced") > 0, "partial").otherwise("unavailable")
    return g.select("entry", "exit", "priced", F.when(F.col("priced") == len(members), F.col("_w")).alias("univ_ret"), status.alias("benchmark_status"))


def outcomes(signals: DataFrame, bars: DataFrame, members: list[str], horizons: tuple[int, ...] = (1, 5, 20)) -> DataFrame:
    w = forward_windows(signals, bars, horizons)
    return window_returns(w, bars).join(cohort_benchmark(w, bars, members), ["entry", "exit"], "left").withColumn("excess", F.col("ret") - F.col("univ_ret"))


def cell(rows: DataFrame, keys: list[str], least: int = 20) -> DataFrame:
    """Two-level statistics: means within (symbol, entry) clusters, then over clusters; NULL below `least` clusters.

    A cluster is a hit by the sign of its sum, which is exact: gains and losses that cancel are no hit in whatever order they come.
    """
    signed = F.when(F.col("direction") == "none", F.lit(None)).when(F.col("direction") == "short", -F.col("ret")).when(F.col("direction").isNotNull(), F.col("ret"))
    exact = signed.try_cast("decimal(38,20)")
    side = F.coalesce(F.when(F.count(exact) == F.count(signed), F.try_sum(exact).cast("double")), F.sum(signed))
    filled = rows.filter("ret is not null")
    clusters = filled.groupBy(*keys, "symbol", "entry").agg(F.avg("ret").alias("_r"), side.alias("_s"), F.count("*").alias("_n"))
    gate = lambda c, n=F.col("n_clusters"): F.when(n >= least, c)
    out = clusters.groupBy(*keys).agg(
        F.sum("_n").alias("n_rows"), F.count("*").alias("n_clusters"), F.count("_s").alias("n_directional"), F.avg("_r").alias("_m"), F.percentile("_r", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"),
        F.avg((F.col("_s") > 0).cast("double")).alias("_h"),
    )
    return out.select(*keys, "n_rows", "n_clusters", gate(F.col("_m")).alias("mean"), gate(F.col("_q")[0]).alias("p25"), gate(F.col("_q")[1]).alias("median"), gate(F.col("_q")[2]).alias("p75"), gate(F.col("_h"), F.col("n_directional")).alias("hit_rate"))


def energy(rows: DataFrame, keys: list[str], least: int = 20, zero: float = 1e-12) -> DataFrame:
    """Median size of the returns over that of the cohort's, on complete pairs only; undefined for a still cohort."""
    pairs = rows.filter("ret is not null and univ_ret is not null and benchmark_status = 'complete'")
    g = pairs.groupBy(*keys).agg(F.count("*").alias("pairs"), F.median(F.abs("ret")).alias("_a"), F.median(F.abs("univ_ret")).alias("_b"))
    return g.select(*keys, "pairs", F.when((F.col("pairs") >= least) & (F.col("_b") > zero), F.col("_a") / F.col("_b")).alias("energy"), F.when(F.col("_b") <= zero, "undefined_zero_benchmark").otherwise("defined").alias("state"))


def multi_grain(rows: DataFrame, grains: dict[str, Column]) -> DataFrame:
    """Each row once per grain whose key isn't NULL or empty: grain, key and the row."""
    pairs = F.array(*[F.struct(F.lit(g).alias("grain"), k.cast("string").alias("key")) for g, k in grains.items()])
    return rows.withColumn("_g", F.explode(pairs)).select("*", "_g.grain", "_g.key").drop("_g").filter("key is not null and key <> ''")


def partition_of(entry: Column, exit_: Column, holdout: str) -> Column:
    """development before the holdout, purged where a window reaches into it, holdout from it on."""
    start = F.lit(holdout).cast("date")
    return F.when(entry >= start, "holdout").when(exit_ >= start, "purged").otherwise("development")
