"""Records over time: decisions that supersede each other, kinds of change, validity, admission budgets and source choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reasons(**rules: Column) -> Column:
    """The names of the rules that hold, in order, joined; empty if none does."""
    return F.concat_ws("+", *[F.when(F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items()])


def judged_decisions(decisions: DataFrame, key: str, supersedes: str, scope: str, at: str) -> DataFrame:
    """Decisions with reasons against recording them.

    missing: what it supersedes is unknown; other_scope: that was about something else; not_later: that was decided at the
    same time or afterwards; fork: that is superseded by more than one.
    """
    before = decisions.select(F.col(key).alias("_key"), F.col(scope).alias("_scope"), F.col(at).alias("_at"))
    heirs = decisions.filter(F.col(supersedes).isNotNull()).groupBy(F.col(supersedes).alias("_heir_of")).agg(F.count("*").alias("_heirs"))
    j = decisions.join(before, F.col(supersedes) == F.col("_key"), "left").join(heirs, F.col(supersedes) == F.col("_heir_of"), "left")
    has = F.col(supersedes).isNotNull()
    why = reasons(missing=has & F.col("_key").isNull(), other_scope=F.col(scope) != F.col("_scope"), not_later=F.col(at) <= F.col("_at"), fork=F.col("_heirs") > 1)
    return j.select(*decisions.columns, why.alias("reasons"))


def anchors(filings: DataFrame, stored: DataFrame, accession: str, order: list[str]) -> DataFrame:
    """One event for each accession that isn't stored yet: its first filing by `order`."""
    fresh = filings.join(stored.select(accession), accession, "left_anti")
    rest = [c for c in filings.columns if c != accession]
    return fresh.groupBy(accession).agg(F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("m")).select(accession, *[F.col(f"m.{c}").alias(c) for c in rest])


def change_kinds(versions: DataFrame, keys: list[str], order: list[str], payload: str, sound: Column) -> DataFrame:
    """versions with kind and head.

    quarantined: not sound, and never compared with; new: the first sound one; same or changed against the sound one before;
    head is the last sound version of its keys.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    good = F.when(F.coalesce(sound, F.lit(False)), F.struct(F.col(payload).alias("p")))
    last = F.last(good, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    later = F.count(good).over(w.rowsBetween(1, Window.unboundedFollowing))
    kind = F.when(good.isNull(), "quarantined").when(last.isNull(), "new").when(last["p"].eqNullSafe(F.col(payload)), "same").otherwise("changed")
    return versions.withColumns({"kind": kind, "head": good.isNotNull() & (later == 0)})


def census(published: DataFrame, scope: DataFrame, day: str, stream: str) -> DataFrame:
    """What each day of the span should hold against what it holds: a row for every day and stream of scope (few rows), and for published streams outside it."""
    n = published.groupBy(day, stream).agg(F.count("*").alias("n"))
    span = published.agg(F.min(day).alias("a"), F.max(day).alias("b")).filter("a is not null")
    days = span.select(F.explode(F.sequence("a", "b")).alias(day))
    expected = days.join(F.broadcast(scope.select(stream)), how="cross").withColumn("_due", F.lit(True))
    j = expected.join(n, [day, stream], "full")
    state = F.when(F.col("_due").isNull(), "unexpected").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated").otherwise("published")
    return j.select(day, stream, F.coalesce("n", F.lit(0)).cast("long").alias("n"), state.alias("state"))


def valid_at(records: DataFrame, revocations: DataFrame, key: str, start: str, end: str, revoked: str, at: Column) -> DataFrame:
    """records with the state of each at `at`: revoked beats not_yet, that beats expired; reversed: it ends before it starts."""
    r = revocations.groupBy(key).agg(F.min(revoked).alias("_revoked"))
    j = records.join(r, key, "left")
    state = F.when(F.col(end) < F.col(start), "reversed").when(F.col("_revoked") <= at, "revoked").when(F.col(start) > at, "not_yet").when(F.col(end) < at, "expired").otherwise("valid")
    return j.select(*records.columns, state.alias("state"))


def admitted(rows: DataFrame, run: list[str], dedup: list[str], order: list[str], size: Column, budget: int) -> DataFrame:
    """rows with omitted: null (taken), duplicate (not the first of its dedup keys in the run) or budget (the run's first ones already fill it)."""
    first = F.row_number().over(Window.partitionBy(*run, *dedup).orderBy(*order)) == 1
    marked = rows.withColumn("_first", first).withColumn("_size", F.when(F.col("_first"), size).otherwise(0))
    used = F.sum("_size").over(Window.partitionBy(*run).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    omitted = F.when(~F.col("_first"), "duplicate").when(used > budget, "budget")
    return marked.withColumn("omitted", omitted).drop("_first", "_size")


def by_priority(rows: DataFrame, keys: list[str], source: str, priority: list[str], order: list[str]) -> DataFrame:
    """One row of each keys: of the source named first; sources that aren't named come last; ties by order."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col(source))
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(F.when(rank == 0, len(priority) + 1).otherwise(rank), *order))
    return rows.withColumn("_n", n).filter("_n = 1").drop("_n")


def index_merge(old: DataFrame, new: DataFrame, key: str, fields: list[str], clock: str) -> DataFrame:
    """Two index snapshots by key: state (added, removed, changed, same), the changed fields, and the more precise clock (one with a time of day)."""
    a = old.select(key, F.struct(*fields).alias("a"), F.col(clock).alias("_at_a"))
    b = new.select(key, F.struct(*fields).alias("b"), F.col(clock).alias("_at_b"))
    j = a.join(b, key, "full")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    changed = F.concat_ws("+", *[F.when(both & ~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), f) for f in fields])
    state = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(changed != "", "changed").otherwise("same")
    precise = F.col("_at_a").isNotNull() & (F.col("_at_a") != F.date_trunc("day", "_at_a"))
    return j.select(key, state.alias("state"), changed.alias("changed"), F.when(precise, F.col("_at_a")).otherwise(F.coalesce("_at_b", "_at_a")).alias(clock))


def late_rows(rows: DataFrame, keys: list[str], arrival: str, at: str, hours: int) -> DataFrame:
    """rows with late: more than `hours` behind the newest event time that had arrived for its keys before it."""
    seen = F.max(at).over(Window.partitionBy(*keys).orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("late", F.coalesce(F.col(at) < seen - F.expr(f"interval {hours} hours"), F.lit(False)))


def breadth(rows: DataFrame, key: str, order: list[str], aliases: str, most: int) -> DataFrame:
    """For each key how many rows, in order, name only aliases that no counted row before named, up to `most`."""
    listed = rows.groupBy(key).agg(F.array_sort(F.collect_set(F.struct(*order, aliases))).alias("r"))
    start = F.struct(F.array().cast("array<string>").alias("seen"), F.lit(0).alias("n"))
    step = lambda s, r: F.when(F.arrays_overlap(s["seen"], r[aliases]), s).otherwise(F.struct(F.array_union(s["seen"], r[aliases]).alias("seen"), (s["n"] + 1).alias("n")))
    return listed.select(key, F.least(F.aggregate("r", start, step)["n"], F.lit(most)).alias("breadth"))
