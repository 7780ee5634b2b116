"""Sequence operators over per-symbol history: every frame looks backwards only and is gated on its own count."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _history(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def rsi(bars: DataFrame, n: int = 14) -> DataFrame:
    """Relative strength by simple means of the last n gains and losses; no loss gives 100, no move gives NULL."""
    h = _history(["symbol"], ["session"])
    change = F.coalesce(F.col("close") - F.lag("close").over(h), F.lit(0.0))
    frame = h.rowsBetween(1 - n, 0)
    b = bars.withColumn("_d", change).withColumns({"_g": F.avg(F.greatest("_d", F.lit(0.0))).over(frame), "_l": F.avg(F.greatest(-F.col("_d"), F.lit(0.0))).over(frame), "_n": F.count("*").over(frame)})
    value = F.when(F.col("_n") < n, None).when((F.col("_l") == 0) & (F.col("_g") == 0), None).when(F.col("_l") == 0, 100.0).otherwise(100 - 100 / (1 + F.try_divide("_g", "_l")))
    return b.select("symbol", "session", value.alias("rsi"))


def volume_ratio(bars: DataFrame, n: int = 20) -> DataFrame:
    """A session's volume over the mean of the n before it."""
    frame = _history(["symbol"], ["session"]).rowsBetween(-n, -1)
    b = bars.withColumns({"_m": F.avg("volume").over(frame), "_n": F.count("volume").over(frame)})
    return b.select("symbol", "session", F.when(F.col("_n") == n, F.try_divide("volume", "_m")).alias("volume_ratio"))


def range_proximity(bars: DataFrame, days: int = 365) -> DataFrame:
    """How far the close lies from the highest and the lowest close of the last year, as shares of them."""
    h = Window.partitionBy("symbol").orderBy(F.datediff("session", F.lit("1970-01-01").cast("date"))).rangeBetween(-days, 0)
    b = bars.withColumns({"_h": F.max("close").over(h), "_l": F.min("close").over(h)})
    return b.select("symbol", "session", (F.col("close") / F.col("_h") - 1).alias("from_high"), (F.col("close") / F.col("_l") - 1).alias("from_low"))


def sma_cross(bars: DataFrame, short: int = 50, long: int = 200) -> DataFrame:
    """Moving averages, their trend, and a golden or death cross against the session before."""
    h = _history(["symbol"], ["session"])
    mean = lambda n: F.when(F.count("close").over(h.rowsBetween(1 - n, 0)) == n, F.avg("close").over(h.rowsBetween(1 - n, 0)))
    b = bars.withColumns({"sma_short": mean(short), "sma_long": mean(long)})
    b = b.withColumns({"_s": F.lag("sma_short").over(h), "_l": F.lag("sma_long").over(h)})
    cross = F.when((F.col("_s") <= F.col("_l")) & (F.col("sma_short") > F.col("sma_long")), "golden").when((F.col("_s") >= F.col("_l")) & (F.col("sma_short") < F.col("sma_long")), "death")
    trend = F.when(F.col("sma_short") > F.col("sma_long"), "up").when(F.col("sma_short") < F.col("sma_long"), "down")
    return b.select("symbol", "session", "sma_short", "sma_long", cross.alias("cross"), trend.alias("trend"))


def turning_points(bars: DataFrame) -> DataFrame:
    """Closes strictly above (peak) or below (trough) both neighbours on either side; the last two of each kind."""
    h = _history(["symbol"], ["session"])
    around = [F.lag("close", k).over(h) for k in (1, 2)] + [F.lead("close", k).over(h) for k in (1, 2)]
    b = bars.withColumns({f"_{k}": c for k, c in enumerate(around)})
    all_of = lambda op: op("_0") & op("_1") & op("_2") & op("_3")
    kind = F.when(all_of(lambda c: F.col("close") > F.col(c)), "peak").when(all_of(lambda c: F.col("close") < F.col(c)), "trough")
    found = b.withColumn("kind", kind).filter("kind is not null")
    newest = Window.partitionBy("symbol", "kind").orderBy(F.col("session").desc())
    return found.withColumn("recency", F.row_number().over(newest)).filter("recency <= 2").select("symbol", "kind", "recency", "session", "close")


def baseline_zscore(daily: DataFrame, window: int = 20, least: int = 15, mature: int = 20, cap: float = 8.0) -> DataFrame:
    """key, session, value -> z against up to `window` strictly earlier sessions.

    The population deviation is at least 5 % of the mean's size; before `mature` points the score is held to +-cap.
    """
    frame = _history(["key"], ["session"]).rowsBetween(-window, -1)
    b = daily.withColumns({"_n": F.count("value").over(frame), "_m": F.avg("value").over(frame), "_s": F.stddev_pop("value").over(frame)})
    spread = F.greatest("_s", 0.05 * F.abs("_m"))
    z = F.when((F.col("_n") >= least) & (spread > 1e-9), (F.col("value") - F.col("_m")) / spread)
    held = F.when((F.col("_n") < mature) & z.isNotNull(), F.greatest(F.lit(-cap), F.least(F.lit(cap), z))).otherwise(z)
    return b.select("key", "session", "value", F.col("_n").alias("points"), held.alias("z"))


def burst_ratio(daily: DataFrame, window: int = 20, least: int = 5) -> DataFrame:
    """key, session, value -> value over the median of up to `window` earlier values (at least 1)."""
    frame = _history(["key"], ["session"]).rowsBetween(-window, -1)
    b = daily.withColumn("_p", F.sort_array(F.collect_list("value").over(frame)))
    n = F.size("_p")
    middle = (F.get("_p", F.floor((n - 1) / 2).cast("int")) + F.get("_p", F.floor(n / 2).cast("int"))) / 2
    return b.select("key", "session", "value", F.when(n >= least, F.col("value") / F.greatest(middle, F.lit(1.0))).alias("burst"))


def wealth_index(returns: DataFrame) -> DataFrame:
    """key, session, factor (> 0) -> the running product of factors and the drawdown from its running peak (at least 1)."""
    h = _history(["key"], ["session"]).rowsBetween(Window.unboundedPreceding, 0)
    b = returns.withColumn("wealth", F.exp(F.sum(F.log("factor")).over(h)))
    return b.select("key", "session", "wealth", (F.col("wealth") / F.greatest(F.max("wealth").over(h), F.lit(1.0)) - 1).alias("drawdown"))


def aligned_return(bars: DataFrame, calendar: DataFrame, n: int = 5) -> DataFrame:
    """The return over the last n sessions of the calendar, only where all n + 1 closes are there; else NULL."""
    numbered = calendar.withColumn("_k", F.row_number().over(Window.orderBy(F.col("session").desc()))).filter(F.col("_k") <= n + 1)
    last = bars.join(F.broadcast(numbered), "session")  # n + 1 rows
    g = last.groupBy("symbol").agg(F.count("close").alias("points"), F.max_by("close", "session").alias("_b"), F.min_by("close", "session").alias("_a"))
    return g.select("symbol", "points", F.when(F.col("points") == n + 1, F.try_divide("_b", "_a") - 1).alias("aligned_return"))


def monthly_rule(bars: DataFrame, months: int = 10) -> DataFrame:
    """Invested when a month's last close is strictly above the mean of the last `months` month ends; silent before."""
    ends = bars.groupBy("symbol", F.trunc("session", "month").alias("month")).agg(F.max_by("close", "session").alias("close"))
    frame = _history(["symbol"], ["month"]).rowsBetween(1 - months, 0)
    e = ends.withColumns({"sma": F.avg("close").over(frame), "_n": F.count("close").over(frame)}).filter(F.col("_n") == months)
    return e.select("symbol", "month", "close", "sma", (F.col("close") > F.col("sma")).alias("invested"))


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an order that ends in something unique."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_k = 1").drop("_k")


def first_last(rows: DataFrame, keys: list[str], at: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.count("*").alias("sightings"))


def hash_chain(rows: DataFrame, keys: list[str], order: str, payload: Column) -> DataFrame:
    """Each row's link is the digest of the link before it and its own payload's digest, so a link covers all rows up to it.

    A chain can only be folded in its order: it is one group, of which a task gets the digests alone.
    """
    own = rows.select(*keys, order, F.sha2(payload, 256).alias("own"), F.lit("").alias("link"))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, link, links = pdf.sort_values([order, "own"]), "", []
        for digest in pdf["own"]:
            link = hashlib.sha256(f"{link}|{digest}".encode()).hexdigest()
            links.append(link)
        return pdf.assign(link=links)

    return own.groupBy(*keys).applyInPandas(fold, own.schema).drop("own")


def daily_counts(events: DataFrame, key: str) -> DataFrame:
    """One value per key and day: the tumbling daily grain."""
    return events.groupBy(F.col(key).cast("string").alias("key"), F.to_date("ts").alias("session")).agg(F.count("*").cast("double").alias("value"))
