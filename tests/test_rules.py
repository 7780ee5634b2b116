"""Rules over nested documents, each broken once, and version binding against a nested loop."""

import copy
import datetime as dt
import random

import pytest

from lodestone.operators import rules as r
from lodestone.operators import scopes as sc

EXPORT = """id int, universe struct<tickers:array<string>,instrumented:array<string>,editorial:array<string>,focus:string,configured:string,mode:string>,
    sections struct<headlines:array<struct<id:string,provider:string,source:string,lane:string,tickers:array<string>>>,focus:struct<status:string,ticker:string,mode:string,requested:string,rejection:string,entity_ids:array<string>,headline_ids:array<string>>>,
    quality struct<pool:struct<selected:int,accounted:int,fetched:int,lanes:struct<universe:int,macro:int,discovery:int>>,dropped:array<struct<id:string,reason:string,kept:string>>>"""
SOUND = {
    "universe": {"tickers": ["A", "B", "C"], "instrumented": ["A", "B"], "editorial": ["C"], "focus": "A", "configured": "A", "mode": "pinned"},
    "sections": {
        "headlines": [{"id": "h1", "provider": "p", "source": "p", "lane": "universe", "tickers": ["A"]}, {"id": "h2", "provider": "q", "source": "q", "lane": "macro", "tickers": []}],
        "focus": {"status": "selected", "ticker": "A", "mode": "pinned", "requested": "A", "rejection": None, "entity_ids": ["ticker:A"], "headline_ids": ["h1"]},
    },
    "quality": {"pool": {"selected": 2, "accounted": 4, "fetched": 4, "lanes": {"universe": 1, "macro": 1, "discovery": 0}}, "dropped": [{"id": "h3", "reason": "stale", "kept": None}, {"id": "h1", "reason": "duplicate", "kept": "h1"}]},
}
QUIET = {"universe.focus": None, "universe.mode": "none", "universe.configured": None, "sections.focus": {"status": "no_focus", "ticker": None, "mode": None, "requested": None, "rejection": None, "entity_ids": None, "headline_ids": None}}
BROKEN = [
    ({}, []), (QUIET, []), ({"sections.headlines.1.source": "x"}, [("source_is_not_provider", "sections.headlines[1].source")]), ({"sections.headlines.0.lane": "none"}, [("unknown_lane", "sections.headlines[0].lane")]), ({"sections.headlines.1.tickers": ["Z"]}, [("ticker_outside_universe", "sections.headlines[1].tickers")]),
    ({"sections.headlines.1.id": "h1"}, [("headline_repeated", "sections.headlines[0]"), ("headline_repeated", "sections.headlines[1]")]), ({"quality.pool.selected": 3}, [("selected_count_differs", "quality.pool.selected"), ("selected_and_dropped_differ", "quality.pool.accounted")]),
    ({"quality.pool.lanes.macro": 2}, [("lane_counts_differ", "quality.pool.lanes")]), ({"quality.pool.fetched": 5}, [("accounted_is_not_fetched", "quality.pool.accounted")]), ({"quality.dropped.0.reason": " "}, [("dropped_without_reason", "quality.dropped[0].reason")]),
    ({"universe.tickers": ["A", "A", "B", "C"]}, [("tickers_repeat", "universe.tickers"), ("tiers_are_not_the_universe", "universe.tickers")]), ({"universe.editorial": ["A", "C"], "universe.tickers": ["A", "B", "A", "C"]}, [("tickers_repeat", "universe.tickers"), ("tiers_overlap", "universe.editorial")]),
    ({"universe.configured": "B"}, [("requested_is_not_configured", "sections.focus.requested")]), ({**QUIET, "universe.focus": "A"}, [("focus_without_selection", "universe.focus")]), ({**QUIET, "universe.mode": None}, [("mode_without_selection", "universe.mode")]),
    ({**QUIET, "sections.focus": {**QUIET["sections.focus"], "rejection": "x"}}, [("rejection_unasked", "sections.focus.rejection")]), ({**QUIET, "universe.configured": "B", "sections.focus": {**QUIET["sections.focus"], "requested": "B"}}, [("rejection_untold", "sections.focus.rejection")]),
    ({"universe.focus": "B"}, [("focus_differs", "universe.focus")]), ({"universe.mode": "dynamic"}, [("mode_differs", "universe.mode")]), ({"sections.focus.entity_ids": ["ticker:B"]}, [("entities_differ", "sections.focus.entity_ids")]),
    ({"sections.focus.headline_ids": ["h2"]}, [("evidence_is_not_selected", "sections.focus.headline_ids[0]")]), ({"quality.dropped.1.reason": "stale"}, [("evidence_was_dropped", "sections.focus.headline_ids[0]")]), ({"sections.focus.headline_ids": ["h1", "h1"]}, [("evidence_repeats", "sections.focus.headline_ids")]),
    ({"universe.focus": "Z", "sections.focus.ticker": "Z", "sections.focus.entity_ids": ["ticker:Z"], "sections.focus.headline_ids": []}, [("focus_outside_universe", "sections.focus.ticker")]), ({"sections.headlines": None, "quality.pool.selected": None}, [("evidence_is_not_selected", None)]),
]


def changed(base, changes):
    out = copy.deepcopy(base)
    for path, value in changes.items():
        *way, last = [int(k) if k.isdigit() else k for k in path.split(".")]
        at = out
        for k in way:
            at = at[k]
        at[last] = value
    return out


def shaped(value, kind):
    """A dict as the tuple that a struct type wants."""
    from pyspark.sql import types as T

    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return tuple(shaped(value[f.name], f.dataType) for f in kind)
    return [shaped(v, kind.elementType) for v in value] if isinstance(kind, T.ArrayType) else value


def verdicts(spark, schema, base, cases, rules):
    from pyspark.sql.types import _parse_datatype_string

    kind = _parse_datatype_string(schema)
    docs = spark.createDataFrame([shaped({"id": k, **changed(base, c)}, kind) for k, (c, _) in enumerate(cases)], kind)
    return {x.id: [tuple(v) for v in x.violations] for x in r.checked(docs, rules).collect()}


def test_exports(spark):
    got = verdicts(spark, EXPORT, SOUND, BROKEN[:-1], r.export_rules())
    assert [got[k] for k in range(len(BROKEN) - 1)] == [sorted(w, key=lambda v: [x.code for x in r.export_rules()].index(v[0])) for _, w in BROKEN[:-1]]
    assert {v[0] for vs in got.values() for v in vs} == {x.code for x in r.export_rules()}
    missing = verdicts(spark, EXPORT, SOUND, BROKEN[-1:], r.export_rules())
    assert missing[0] is not None


PROFILE = "id int, version int, name string, equities array<struct<symbol:string,aliases:array<string>>>, funds array<string>, futures array<string>, indices array<string>, focus string, groups array<struct<name:string,symbols:array<string>>>, baskets array<struct<name:string,symbols:array<string>>>, pairs array<struct<physical:string,paper:string,label:string>>"
FINE = {"version": 1, "name": "core-1", "equities": [{"symbol": "AA", "aliases": ["alpha"]}, {"symbol": "BB", "aliases": []}], "funds": ["FF"], "futures": None, "indices": [], "focus": "AA", "groups": [{"name": "defense", "symbols": ["AA", "FF"]}], "baskets": [{"name": "growth", "symbols": ["AA", "FF"]}], "pairs": [{"physical": "AA", "paper": "FF", "label": "gold"}]}
FAULTS = [
    ({}, []), ({"version": None}, [("version", "version")]), ({"name": "Core"}, [("name", "name")]), ({"equities.1.symbol": "b"}, [("symbol", "equities[1].symbol")]), ({"equities.0.aliases": ["abc"] * 13}, [("too_many_aliases", "equities[0].aliases")]), ({"equities.0.aliases": ["ab"]}, [("alias_length", "equities[0].aliases")]),
    ({"funds": ["FF", "BB"]}, [("symbols_repeat", "equities")]), ({"focus": "ZZ"}, [("focus_inactive", "focus")]), ({"groups.0.symbols": ["ZZ"]}, [("group_symbol_inactive", "groups[0].symbols")]), ({"groups.0.name": "other"}, [("group_symbol_inactive", "groups[0].symbols")]), ({"groups.0.symbols": ["AA", "AA"]}, [("group_repeats", "groups[0].symbols")]),
    ({"baskets.0.symbols": ["ZZ"]}, [("basket_symbol_inactive", "baskets[0].symbols")]), ({"baskets.0.name": "x"}, [("basket_unknown", "baskets[0].name")]), ({"baskets.0.symbols": ["AA", "AA"]}, [("basket_repeats", "baskets[0].symbols")]), ({"pairs.0.paper": "AA"}, [("pair_inactive", "pairs[0]")]), ({"pairs.0.label": " "}, [("pair_label", "pairs[0].label")]),
    ({"pairs": [FINE["pairs"][0]] * 17}, [("too_many_pairs", "pairs")]), ({"equities": [], "funds": None, "focus": None, "groups": [], "baskets": [], "pairs": []}, [("number_of_symbols", "equities")]),
]


def test_profiles(spark):
    got = verdicts(spark, PROFILE, FINE, FAULTS, r.profile_rules())
    assert [got[k] for k in range(len(FAULTS))] == [w for _, w in FAULTS]


@pytest.mark.parametrize("days", [3, 64])
def test_versions(spark, days):
    rng = random.Random(days)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)
    versions = []
    for k in range(120):
        low, known = rng.randrange(300), rng.randrange(-40, 320)
        versions.append((f"s{rng.randrange(12)}", f"v{k}", k, low, None if rng.random() < 0.3 else low + rng.randrange(1, 150), known, known + rng.randrange(3), rng.random() < 0.8))
    asked = [(k, f"s{rng.randrange(14)}", low := rng.randrange(350), low + rng.choice([0, 1, 30])) for k in range(300)] + [(900, None, 5, 6)]
    wanted = {}
    for i, subject, lo, hi in asked:
        own = [v for v in versions if v[0] == subject]
        good = [v for v in own if v[7] and v[3] <= lo and (v[4] is None or hi < v[4] or hi == v[4] and lo < hi) and v[6] <= lo]
        state, version = "version_unavailable_at_disclosure", None
        if len(good) > 1:
            state = "version_ambiguous"
        elif good:
            state, version = "bound", good[0][1]
            for v in own:
                late = v[7] and (v[5] > hi or lo < hi and v[5] == hi)
                if v is not good[0] and not late and (v[3] <= lo or v[3] < hi) and (v[4] is None or lo < v[4]):
                    state, version = ("version_ambiguous" if v[7] else "competing_version_review_required"), None
                    break
        wanted[i] = (state, version)
    wanted[901] = ("disclosure_time_unknown", None)
    d = spark.createDataFrame([(i, s, day(a), day(b)) for i, s, a, b in asked] + [(901, "s1", None, day(3))], "id int, subject string, low date, high date")
    v = spark.createDataFrame([(s, n, p, day(a), b and day(b), day(x), day(y), ok) for s, n, p, a, b, x, y, ok in versions], "subject string, version_id string, position int, valid_from date, valid_to date, available_from date, available_to date, approved boolean")
    assert {x.id: (x.state, x.version_id) for x in sc.bind_versions(d, v, days).collect()} == wanted
    assert {s for s, _ in wanted.values()} == {"bound", "version_ambiguous", "version_unavailable_at_disclosure", "competing_version_review_required", "disclosure_time_unknown"}
    plan = sc.bind_versions(d, v, days)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and plan.count("BroadcastNestedLoopJoin") <= 1  # with the one row of the last day


def test_versions_of_long_spans_meet_once(spark):
    """Stretches are as long as versions are; a pair that shares many of them counts once, and no rows are made distinct for it."""
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)
    v = spark.createDataFrame([("s", "v", 1, day(0), None, day(0), day(0), True), ("s", "w", 2, day(2000), day(2010), day(0), day(0), True)], "subject string, version_id string, position int, valid_from date, valid_to date, available_from date, available_to date, approved boolean")
    d = spark.createDataFrame([("s", day(10), day(1500)), ("s", day(1990), day(2001)), (None, day(1), day(2))], "subject string, low date, high date")
    assert sc.stretch_days(v) == 1005
    for days in (16, None):
        out = sc.bind_versions(d, v, days, key=("subject", "low", "high"))
        assert {(x.subject, x.low): (x.state, x.version_id) for x in out.collect()} == {("s", day(10)): ("bound", "v"), ("s", day(1990)): ("version_ambiguous", None), (None, day(1)): ("version_unavailable_at_disclosure", None)}
        assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2  # the last day, and each disclosure's versions
