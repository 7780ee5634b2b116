"""Claims' values, deliveries, poll windows and the slice of all sections that concerns one subject."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.operators import records as rc


def claim_faults(key: Column, value: Column, unit: Column, period: Column) -> Column:
    """Why a claim is refused, '' if it isn't: key of up to 64 lower-case characters, value a decimal string, unit and period given."""
    wrong = lambda c, pattern: ~F.coalesce(c.rlike(pattern), F.lit(False))
    return rc.reasons(key=wrong(key, r"\A[a-z][a-z0-9_]{0,63}\z"), value=wrong(value, r"\A-?(0|[1-9][0-9]*)(\.[0-9]+)?\z"), unit=F.coalesce(unit, F.lit("")) == "", period=F.coalesce(period, F.lit("")) == "")


def outbox(log: DataFrame, key: str, order: list[str], at: str, queued: Column, acknowledged: Column) -> DataFrame:
    """One row a delivery that was ever queued: pending, or acknowledged since the first acknowledgement after it was last queued."""
    when = F.struct(*order)
    last = F.max(F.when(queued, when)).over(Window.partitionBy(key))
    seen = log.withColumns({"_last": last, "_at": when}).filter("_last is not null")
    g = seen.groupBy(key).agg(F.min(F.when(acknowledged & (F.col("_at") > F.col("_last")), F.col(at))).alias("acknowledged_at"))
    return g.select(key, F.when(F.col("acknowledged_at").isNull(), "pending").otherwise("acknowledged").alias("state"), "acknowledged_at")


def poll_windows(cycles: DataFrame, source: str, cycle: str, previous: str, watermark: str, at: str, proven: Column) -> DataFrame:
    """Each poll's clock interval: from the latest earlier proven poll that ended where this one began, else from itself.

    A poll that isn't proven, or whose previous watermark is NULL, bounds nothing.  Askers and providers are unioned and
    sorted once in their source and watermark, so no pair of polls is listed.
    """
    common = [F.col(source).alias("_source"), F.col(at).alias("_at")]
    asks = cycles.select(*common, F.when(proven, F.col(previous)).alias("_mark"), F.lit(0).alias("_kind"), F.col(cycle).alias("_cycle"))
    gives = cycles.filter(proven & F.col(watermark).isNotNull()).select(*common, F.col(watermark).alias("_mark"), F.lit(1).alias("_kind"), F.lit(None).cast(cycles.schema[cycle].dataType).alias("_cycle"))
    before = Window.partitionBy("_source", "_mark").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = asks.filter("_mark is not null").unionByName(gives).withColumn("_from", F.max(F.when(F.col("_kind") == 1, F.col("_at"))).over(before)).filter("_kind = 0")
    rest = asks.filter("_mark is null").withColumn("_from", F.col("_at"))
    return known.unionByName(rest).select(F.col("_cycle").alias(cycle), F.coalesce("_from", "_at").alias("starts"), F.col("_at").alias("ends"))


def subject_slice(sections: dict[str, tuple[DataFrame, str, Column]]) -> DataFrame:
    """section, id of the rows of each section (rows, id column, condition) that concern a subject; conditions reach the scans."""
    parts = [rows.filter(concerns).select(F.lit(name).alias("section"), F.col(key).cast("long").alias("id")) for name, (rows, key, concerns) in sections.items()]
    return reduce(DataFrame.unionByName, parts)
