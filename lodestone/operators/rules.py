"""Rules over nested documents, as data, compiled into one projection that names every violation and its place.

A rule holds for a document, or for every element of one of its arrays.  All rules of a set are one column: a document is
read once, whatever the number of rules.  What a rule looks at may be missing: a condition that is null is no violation,
so a rule that wants a value there says so.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """code: what is violated; path: where; holds: the condition on the document, or on an element of the array `each` (and the document)."""

    code: str
    path: str
    holds: Callable[..., Column]
    each: str | None = None
    when: Callable[[], Column] | None = None


KIND = "array<struct<code:string,path:string>>"


def _failures(rule: Rule) -> Column:
    """A rule's violations, with nulls where it holds."""
    applies = rule.when() if rule.when else F.lit(True)
    at = lambda ok, place: F.when(applies & ~ok, F.struct(F.lit(rule.code).alias("code"), place.alias("path")))
    if rule.each is None:
        return F.array(at(rule.holds(), F.lit(rule.path))).cast(KIND)
    place = lambda i: F.concat(F.lit(f"{rule.each}["), i.cast("string"), F.lit(f"].{rule.path}" if rule.path else "]"))
    return F.coalesce(F.transform(F.col(rule.each), lambda x, i: at(rule.holds(x), place(i))).cast(KIND), F.array().cast(KIND))


def violations(rules: list[Rule]) -> Column:
    """array of (code, path) of all violations, in the order of the rules and elements."""
    return F.array_compact(F.concat(*map(_failures, rules))) if rules else F.array().cast(KIND)


def checked(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """docs with their violations."""
    return docs.withColumn("violations", violations(rules))


def counts_by(values: Column, keys: tuple[str, ...]) -> list[Column]:
    """How often each key occurs in an array."""
    return [F.size(values) - F.size(F.array_remove(values, k)) for k in keys]


# Lanes of headlines, groups of a profile and the most that one may hold.
LANES = ("universe", "macro", "discovery")
MOST_SYMBOLS, MOST_ALIASES, MOST_PAIRS = 128, 12, 16
SLUG, SYMBOL = "^[a-z0-9][a-z0-9_-]{0,63}$", r"^[A-Z][A-Z0-9.]{0,9}$"


def export_rules() -> list[Rule]:
    """Of an export: universe (tickers, instrumented, editorial, focus, configured, mode), sections.headlines (id, provider, source,
    lane, tickers), sections.focus (status, ticker, mode, requested, rejection, entity_ids, headline_ids), quality.pool (selected,
    accounted, fetched, lanes: universe, macro, discovery) and quality.dropped (id, reason, kept)."""
    c = F.col
    heads, dropped, pool = c("sections.headlines"), c("quality.dropped"), "quality.pool"
    focus, universe = "sections.focus", "universe"
    selected, none = lambda: c(f"{focus}.status") == "selected", lambda: c(f"{focus}.status") == "no_focus"
    lanes_known = F.forall(heads, lambda h: F.coalesce(h["lane"].isin(*LANES), F.lit(False)))
    lane_counts = counts_by(F.transform(heads, lambda h: h["lane"]), LANES)
    same_lanes = lambda: F.forall(F.arrays_zip(F.array(*[F.coalesce(c(f"{pool}.lanes.{k}"), F.lit(0)) for k in LANES]).alias("a"), F.array(*lane_counts).alias("b")), lambda x: x["a"] == x["b"])
    ids = F.transform(heads, lambda h: h["id"])
    focus_heads = F.filter(heads, lambda h: F.array_contains(h["tickers"], c(f"{focus}.ticker")))
    # A copy of a selected headline that was dropped as such is no rejection of it.
    vetoed = F.transform(F.filter(dropped, lambda x: ~F.coalesce((x["reason"] == "duplicate") & (x["kept"] == x["id"]) & F.array_contains(ids, x["id"]), F.lit(False))), lambda x: x["id"])
    return [
        Rule("source_is_not_provider", "source", lambda h: h["source"] == h["provider"], each="sections.headlines"),
        Rule("unknown_lane", "lane", lambda h: F.coalesce(h["lane"].isin(*LANES), F.lit(False)), each="sections.headlines"),
        Rule("ticker_outside_universe", "tickers", lambda h: F.size(F.array_except(h["tickers"], c(f"{universe}.tickers"))) == 0, each="sections.headlines"),
        Rule("headline_repeated", "", lambda h: F.size(F.filter(ids, lambda x: x == h["id"])) == 1, each="sections.headlines"),
        Rule("selected_count_differs", f"{pool}.selected", lambda: c(f"{pool}.selected") == F.size(heads)),
        Rule("lane_counts_differ", f"{pool}.lanes", same_lanes, when=lambda: lanes_known),
        Rule("accounted_is_not_fetched", f"{pool}.accounted", lambda: c(f"{pool}.accounted") == c(f"{pool}.fetched")),
        Rule("selected_and_dropped_differ", f"{pool}.accounted", lambda: c(f"{pool}.selected") + F.size(dropped) == c(f"{pool}.accounted")),
        Rule("dropped_without_reason", "reason", lambda x: F.coalesce(F.trim(x["reason"]) != "", F.lit(False)), each="quality.dropped"),
        Rule("tickers_repeat", f"{universe}.tickers", lambda: F.size(F.array_distinct(c(f"{universe}.tickers"))) == F.size(c(f"{universe}.tickers"))),
        Rule("tiers_overlap", f"{universe}.editorial", lambda: ~F.arrays_overlap(c(f"{universe}.instrumented"), c(f"{universe}.editorial"))),
        Rule("tiers_are_not_the_universe", f"{universe}.tickers", lambda: F.concat(c(f"{universe}.instrumented"), c(f"{universe}.editorial")) == c(f"{universe}.tickers")),
        Rule("requested_is_not_configured", f"{focus}.requested", lambda: c(f"{focus}.requested").eqNullSafe(c(f"{universe}.configured"))),
        Rule("focus_without_selection", f"{universe}.focus", lambda: c(f"{universe}.focus").isNull(), when=none),
        Rule("mode_without_selection", f"{universe}.mode", lambda: F.coalesce(c(f"{universe}.mode") == "none", F.lit(False)), when=none),
        Rule("rejection_unasked", f"{focus}.rejection", lambda: c(f"{focus}.rejection").isNull(), when=lambda: none() & c(f"{focus}.requested").isNull()),
        Rule("rejection_untold", f"{focus}.rejection", lambda: c(f"{focus}.rejection").isNotNull(), when=lambda: none() & c(f"{focus}.requested").isNotNull()),
        Rule("focus_differs", f"{universe}.focus", lambda: c(f"{focus}.ticker").eqNullSafe(c(f"{universe}.focus")), when=selected),
        Rule("mode_differs", f"{universe}.mode", lambda: c(f"{focus}.mode").eqNullSafe(c(f"{universe}.mode")), when=selected),
        Rule("focus_outside_universe", f"{focus}.ticker", lambda: F.coalesce(F.array_contains(c(f"{universe}.tickers"), c(f"{focus}.ticker")), F.lit(False)), when=selected),
        Rule("entities_differ", f"{focus}.entity_ids", lambda: F.coalesce(c(f"{focus}.entity_ids") == F.array(F.concat(F.lit("ticker:"), c(f"{focus}.ticker"))), F.lit(False)), when=selected),
        Rule("evidence_is_not_selected", "", lambda e: F.exists(focus_heads, lambda h: h["id"] == e), each="sections.focus.headline_ids", when=selected),
        Rule("evidence_was_dropped", "", lambda e: ~F.array_contains(vetoed, e), each="sections.focus.headline_ids", when=selected),
        Rule("evidence_repeats", f"{focus}.headline_ids", lambda: F.size(F.array_distinct(c(f"{focus}.headline_ids"))) == F.size(c(f"{focus}.headline_ids")), when=selected),
    ]


def profile_rules() -> list[Rule]:
    """Of a profile: version, name, equities (symbol, aliases), funds, futures, indices, focus, groups (name, symbols), baskets (name, symbols), pairs (physical, paper, label)."""
    c = F.col
    none = F.array().cast("array<string>")
    own = F.coalesce(F.transform(c("equities"), lambda e: e["symbol"]), none)
    every = F.concat(own, *[F.coalesce(c(k), none) for k in ("funds", "futures", "indices")])
    known = lambda s: F.coalesce(F.array_contains(every, s), F.lit(False))
    there = lambda x: F.coalesce(x, F.lit(False))
    unique = lambda g: F.size(F.array_distinct(g["symbols"])) == F.size(g["symbols"])
    return [
        Rule("version", "version", lambda: there(c("version") == 1)),
        Rule("name", "name", lambda: there(c("name").rlike(SLUG))),
        Rule("symbol", "symbol", lambda e: there(e["symbol"].rlike(SYMBOL)), each="equities"),
        Rule("too_many_aliases", "aliases", lambda e: F.size(e["aliases"]) <= MOST_ALIASES, each="equities"),
        Rule("alias_length", "aliases", lambda e: F.forall(e["aliases"], lambda a: there(F.char_length(F.trim(a)).between(3, 100))), each="equities"),
        Rule("symbols_repeat", "equities", lambda: F.size(F.array_distinct(every)) == F.size(every)),
        Rule("number_of_symbols", "equities", lambda: F.size(every).between(1, MOST_SYMBOLS)),
        Rule("focus_inactive", "focus", lambda: c("focus").isNull() | known(c("focus"))),
        Rule("group_symbol_inactive", "symbols", lambda g: F.forall(g["symbols"], lambda s: F.array_contains(F.when(g["name"] == "defense", F.concat(own, F.coalesce("funds", none))).otherwise(own), s)), each="groups"),
        Rule("group_repeats", "symbols", unique, each="groups"),
        Rule("basket_symbol_inactive", "symbols", lambda b: F.forall(b["symbols"], known), each="baskets"),
        Rule("basket_unknown", "name", lambda b: there(b["name"].isin("growth", "defensive")), each="baskets"),
        Rule("basket_repeats", "symbols", unique, each="baskets"),
        Rule("pair_inactive", "", lambda p: known(p["physical"]) & known(p["paper"]) & there(p["physical"] != p["paper"]), each="pairs"),
        Rule("pair_label", "label", lambda p: there(F.char_length(F.trim(p["label"])).between(1, 80)), each="pairs"),
        Rule("too_many_pairs", "pairs", lambda: F.size("pairs") <= MOST_PAIRS),
    ]
