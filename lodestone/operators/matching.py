"""Joins by time, version and position; selections that are deterministic to the last key."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def visible(rows: DataFrame, known_by: str, on: str) -> DataFrame:
    """Rows known by one date and valid on another; valid_to is exclusive and NULL means open."""
    k, v = F.lit(known_by).cast("date"), F.lit(on).cast("date")
    return rows.filter((F.col("known_from") <= k) & (F.col("valid_from") <= v) & (F.col("valid_to").isNull() | (v < F.col("valid_to"))))


def resolve(symbols: DataFrame, versions: DataFrame) -> DataFrame:
    """symbol, on, known_by against versions (symbol, instrument, valid_from, valid_to, known_from): resolved, ambiguous or unknown."""
    asked = symbols.select("symbol", "on", "known_by").distinct()
    seen = versions.join(asked, "symbol").filter((F.col("known_from") <= F.col("known_by")) & (F.col("valid_from") <= F.col("on")) & (F.col("valid_to").isNull() | (F.col("on") < F.col("valid_to"))))
    g = seen.groupBy("symbol", "on", "known_by").agg(F.count_distinct("instrument").alias("n"), F.min("instrument").alias("_i"))
    out = symbols.join(g, ["symbol", "on", "known_by"], "left")
    n = F.coalesce("n", F.lit(0))
    return out.select("symbol", "on", "known_by", F.when(n == 1, F.col("_i")).alias("instrument"), F.when(n == 1, "resolved").when(n > 1, "ambiguous").otherwise("unknown").alias("state"))


def snapshot_diff(previous: DataFrame, current: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Full outer by key: added, missing, changed (which fields) or same."""
    p = previous.select(F.col(key), F.lit(True).alias("_p"), *[F.col(f).alias(f"_p_{f}") for f in fields])
    c = current.select(F.col(key), F.lit(True).alias("_c"), *[F.col(f).alias(f"_c_{f}") for f in fields])
    j = p.join(c, key, "full")
    changed = F.array_join(F.filter(F.array(*[F.when(~F.col(f"_p_{f}").eqNullSafe(F.col(f"_c_{f}")), F.lit(f)) for f in fields]), lambda x: x.isNotNull()), "+")
    state = F.when(F.col("_p").isNull(), "added").when(F.col("_c").isNull(), "missing").when(changed != "", "changed").otherwise("same")
    return j.select(key, state.alias("state"), F.when(state == "changed", changed).alias("fields"))


def multiset_match(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str) -> DataFrame:
    """One-to-one, first come first served: the nth left row of a key meets the nth right row of it."""
    number = lambda d, i: d.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(i)))
    return number(left, left_id).join(number(right, right_id), [*keys, "_n"], "full").select(*keys, left_id, right_id)


def freshness(rows: DataFrame, at: str, now: str, days: int) -> DataFrame:
    """drop_reason: undated, future, stale or none (fresh)."""
    t = F.lit(now).cast(rows.schema[at].dataType)
    return rows.withColumn("drop_reason", F.when(F.col(at).isNull(), "undated").when(F.col(at) > t, "future").when(F.col(at) < t - F.expr(f"interval {days} days"), "stale"))


def ladder(rows: DataFrame, rules: list[tuple[str, Column]], name: str = "drop_reason") -> DataFrame:
    """The first rule that holds, in the order given."""
    reason = F.lit(None).cast("string")
    for code, rule in reversed(rules):
        reason = F.when(F.coalesce(rule, F.lit(False)), code).otherwise(reason)
    return rows.withColumn(name, reason)


def version_at_least(version: Column, least: tuple[int, int, int]) -> Column:
    parts = [F.try_to_number(F.regexp_extract(version, r"^(\d+)\.(\d+)\.(\d+)$", k + 1), F.lit("9999")).cast("int") for k in range(3)]
    return F.coalesce(F.struct(*parts) >= F.struct(*map(F.lit, least)), F.lit(False))


def top_per(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= n)


def top(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def nearest(rows: DataFrame, keys: list[str], at: str, now: str, past_days: int) -> DataFrame:
    """Per key the soonest date from now on, else the latest of the last past_days."""
    t = F.lit(now).cast("date")
    kind = F.when(F.col(at) >= t, 0).when(F.col(at) >= F.date_sub(t, past_days), 1)
    gap = F.abs(F.datediff(F.col(at), t))
    return top_per(rows.withColumn("_kind", kind).filter("_kind is not null"), keys, [F.col("_kind"), gap, F.col(at)], 1).drop("_kind", "position")


def hash_bucket(seed: str, column: Column, modulus: int) -> Column:
    """The SHA-256 of seed and id, read as one big number, modulo a small one: digit by digit."""
    digest = F.sha2(F.concat(F.lit(seed + "|"), column.cast("string")), 256)
    digits = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda k: F.conv(F.substring(digest, k, F.lit(1)), 16, 10).cast("int"))
    return F.aggregate(digits, F.lit(0), lambda a, x: ((a * 16 + x) % modulus).cast("int"))


def ordered_distinct(rows: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min(ordinal).alias("first_ordinal"))


def greedy_caps(pool: DataFrame, caps: dict[tuple[str, ...], int], total: int) -> DataFrame:
    """run, rank and the capped columns -> the rows that a greedy walk by rank keeps.

    A row is kept if no cap it falls under is full; skipped rows use up no cap, so separate row numbers would not do.  A
    run's pool is one group, so it should be bounded first (see best_of_caps).
    """

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        used: dict[tuple, int] = {}
        kept = []
        for k, row in enumerate(pdf.sort_values("rank").to_dict("records")):
            under = [(c, tuple(row[x] for x in c)) for c in caps]
            if len(kept) < total and all(used.get(u, 0) < caps[u[0]] for u in under):
                kept.append(k)
                for u in under:
                    used[u] = used.get(u, 0) + 1
        return pdf.sort_values("rank").iloc[kept]

    return pool.groupBy("run").applyInPandas(walk, pool.schema)



def best_of_caps(pool: DataFrame, run: str, outer: str, inner: str, order: list[Column], caps: tuple[int, int], total: int) -> DataFrame:
    """The rows that a greedy walk of at most `total`, `caps` for each outer and inner value and one of both together can reach.

    A full cap stays full, so of one pair of values only the best row matters; and at most total // caps[1] inner values can be full, so
    of an outer value only its best caps[0] + total // caps[1] rows do.
    """
    return top_per(top_per(pool, [run, outer, inner], order, 1).drop("position"), [run, outer], order, caps[0] + total // caps[1]).drop("position")
