"""Exports and profiles assembled from orders and parts, checked by rules; versions of definitions bound to disclosures."""

from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.operators import rules as r
from lodestone.operators import scopes as sc
from lodestone.sources.tables import scan


def said():
    return F.array_join(F.transform("violations", lambda v: F.concat_ws("@", v["code"], v["path"])), " ").alias("violations")


def exports(spark, d):
    """An export for each customer: dear orders are headlines, others were dropped; what it declares comes from the order book."""
    key, k = F.col("o_orderkey"), F.col("o_custkey")
    lane = F.when(key % 29 == 0, "other").otherwise(F.element_at(F.create_map(*map(F.lit, ("F", "universe", "O", "macro", "P", "discovery"))), F.col("o_orderstatus")))
    row = F.struct(
        F.concat(F.lit("o"), key.cast("string")).alias("id"), F.col("o_orderpriority").alias("provider"), F.when(key % 13 == 0, "desk").otherwise(F.col("o_orderpriority")).alias("source"), lane.alias("lane"), F.array(F.concat(F.lit("T"), (key % 7).cast("string"))).alias("tickers"),
        F.when(key % 17 != 0, F.when(key % 4 == 0, "duplicate").otherwise("stale")).alias("reason"), (F.col("o_totalprice") > 200_000).alias("dear"), key.alias("key"),
    )
    book = scan(spark, d, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct(key, row.alias("x")))).alias("rows")).select("o_custkey", F.transform("rows", lambda x: x["x"]).alias("rows"))
    heads, rest = F.filter("rows", lambda x: x["dear"]), F.filter("rows", lambda x: ~x["dear"])
    book = book.withColumns({"heads": heads, "rest": rest})
    told = F.when(k % 6 == 0, F.col("rows")).otherwise(F.col("heads"))
    lanes = F.struct(*[c.cast("int").alias(n) for n, c in zip(r.LANES, r.counts_by(F.transform(told, lambda x: x["lane"]), r.LANES), strict=True)])
    ticker = F.when(k % 3 != 0, F.concat(F.lit("T"), (k % 8).cast("string")))
    universe = F.struct(
        F.array(*map(F.lit, ("T0", "T1", "T2", "T3", "T4", "T5"))).alias("tickers"), F.array(*map(F.lit, ("T0", "T1", "T2"))).alias("instrumented"), F.array(*map(F.lit, ("T3", "T4", "T5"))).alias("editorial"),
        F.when(k % 10 != 0, F.concat(F.lit("T"), (k % 8).cast("string"))).alias("focus"), F.when(k % 9 != 0, ticker).alias("configured"), F.when(k % 3 == 0, "none").otherwise("pinned").alias("mode"),
    )
    mine = F.transform(F.filter("heads", lambda x: F.array_contains(x["tickers"], ticker)), lambda x: x["id"])
    evidence = F.when(k % 4 == 0, F.concat(mine, F.transform(F.slice("rest", 1, 1), lambda x: x["id"]))).otherwise(mine)
    focus = F.struct(F.when(k % 3 == 0, "no_focus").otherwise("selected").alias("status"), ticker.alias("ticker"), F.lit("pinned").alias("mode"), ticker.alias("requested"), F.when(k % 12 == 0, "outside").alias("rejection"), F.array(F.concat(F.lit("ticker:"), ticker)).alias("entity_ids"), evidence.alias("headline_ids"))
    pool = F.struct(F.when(k % 5 == 0, F.size("rows")).otherwise(F.size("heads")).alias("selected"), F.size("rows").alias("accounted"), (F.size("rows") + (k % 11 == 0).cast("int")).alias("fetched"), lanes.alias("lanes"))
    dropped = F.transform("rest", lambda x: F.struct(x["id"].alias("id"), x["reason"].alias("reason"), x["id"].alias("kept")))
    return book.select("o_custkey", universe.alias("universe"), F.struct(F.col("heads").alias("headlines"), focus.alias("focus")).alias("sections"), F.struct(pool.alias("pool"), dropped.alias("dropped")).alias("quality"))


@query("v03_export_rules", """WITH o AS (SELECT o_custkey AS k, o_orderkey AS key, 'o' || o_orderkey AS id, o_orderkey % 13 = 0 AS desk, CASE WHEN o_orderkey % 29 = 0 THEN 'other' WHEN o_orderstatus = 'F' THEN 'universe' WHEN o_orderstatus = 'O' THEN 'macro' ELSE 'discovery' END AS lane, o_orderkey % 7 AS t, o_orderkey % 17 = 0 AS untold, o_totalprice > 200000 AS dear FROM orders),
    g AS (SELECT k, coalesce(list({'id': id, 'desk': desk, 'lane': lane, 't': t} ORDER BY key) FILTER (dear), []) AS h, coalesce(list({'id': id, 'untold': untold} ORDER BY key) FILTER (NOT dear), []) AS d, list({'lane': lane} ORDER BY key) AS r FROM o GROUP BY 1),
    f AS (SELECT *, k % 3 <> 0 AS sel, len(h)::INTEGER AS nh, len(d)::INTEGER AS nd, len(r)::INTEGER AS nr, list_concat(list_transform(list_filter(h, lambda x: x.t = k % 8), lambda x: x.id), CASE WHEN k % 4 = 0 THEN list_transform(d[1:1], lambda x: x.id) ELSE [] END) AS e FROM g)
    SELECT k AS o_custkey, array_to_string(list_concat(
        list_filter(list_transform(h, lambda x, i: CASE WHEN x.desk THEN 'source_is_not_provider@sections.headlines[' || (i - 1) || '].source' END), lambda x: x IS NOT NULL),
        list_filter(list_transform(h, lambda x, i: CASE WHEN x.lane = 'other' THEN 'unknown_lane@sections.headlines[' || (i - 1) || '].lane' END), lambda x: x IS NOT NULL),
        list_filter(list_transform(h, lambda x, i: CASE WHEN x.t = 6 THEN 'ticker_outside_universe@sections.headlines[' || (i - 1) || '].tickers' END), lambda x: x IS NOT NULL),
        CASE WHEN k % 5 = 0 AND nr <> nh THEN ['selected_count_differs@quality.pool.selected'] ELSE [] END,
        CASE WHEN k % 6 = 0 AND len(list_filter(h, lambda x: x.lane = 'other')) = 0 AND len(list_filter(r, lambda x: x.lane <> 'other')) <> nh THEN ['lane_counts_differ@quality.pool.lanes'] ELSE [] END,
        CASE WHEN k % 11 = 0 THEN ['accounted_is_not_fetched@quality.pool.accounted'] ELSE [] END,
        CASE WHEN k % 5 = 0 AND nd > 0 THEN ['selected_and_dropped_differ@quality.pool.accounted'] ELSE [] END,
        list_filter(list_transform(d, lambda x, i: CASE WHEN x.untold THEN 'dropped_without_reason@quality.dropped[' || (i - 1) || '].reason' END), lambda x: x IS NOT NULL),
        CASE WHEN sel AND k % 9 = 0 THEN ['requested_is_not_configured@sections.focus.requested'] ELSE [] END,
        CASE WHEN NOT sel AND k % 10 <> 0 THEN ['focus_without_selection@universe.focus'] ELSE [] END,
        CASE WHEN NOT sel AND k % 12 = 0 THEN ['rejection_unasked@sections.focus.rejection'] ELSE [] END,
        CASE WHEN sel AND k % 10 = 0 THEN ['focus_differs@universe.focus'] ELSE [] END,
        CASE WHEN sel AND k % 8 > 5 THEN ['focus_outside_universe@sections.focus.ticker'] ELSE [] END,
        CASE WHEN sel AND k % 4 = 0 AND nd > 0 THEN ['evidence_is_not_selected@sections.focus.headline_ids[' || (len(e) - 1) || ']', 'evidence_was_dropped@sections.focus.headline_ids[' || (len(e) - 1) || ']'] ELSE [] END), ' ') AS violations FROM f""")
def v03(spark, d):
    """Every rule that a customer's export breaks, with its place."""
    return r.checked(exports(spark, d), r.export_rules()).select("o_custkey", said())


@query("v02_profile_rules", r"""WITH s AS (SELECT s_suppkey AS k, s_nationkey AS n FROM supplier), p AS (SELECT k, n, list(l_partkey ORDER BY l_partkey) AS a FROM s JOIN (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_quantity >= 45) ON l_suppkey = k GROUP BY 1, 2),
    e AS (SELECT *, len(a) + 1 AS total, 'P' || a[1] AS one FROM p)
    SELECT k AS s_suppkey, array_to_string(list_concat(
        CASE WHEN n % 6 = 0 THEN ['version@version'] ELSE [] END, CASE WHEN n % 5 = 0 THEN ['name@name'] ELSE [] END,
        list_filter(list_transform(a, lambda x, i: CASE WHEN x % 9 = 0 THEN 'symbol@equities[' || (i - 1) || '].symbol' END), lambda x: x IS NOT NULL),
        list_filter(list_transform(a, lambda x, i: CASE WHEN x % 7 = 0 THEN 'alias_length@equities[' || (i - 1) || '].aliases' END), lambda x: x IS NOT NULL),
        CASE WHEN k % 4 = 0 THEN ['symbols_repeat@equities'] ELSE [] END, CASE WHEN total > 128 THEN ['number_of_symbols@equities'] ELSE [] END, CASE WHEN NOT list_contains(a, k) OR k % 9 = 0 THEN ['focus_inactive@focus'] ELSE [] END,
        CASE WHEN n % 2 = 0 AND k % 4 <> 0 THEN ['group_symbol_inactive@groups[0].symbols'] ELSE [] END, CASE WHEN k % 3 = 0 THEN ['basket_unknown@baskets[0].name'] ELSE [] END,
        CASE WHEN len(a) < 2 THEN ['pair_inactive@pairs[0]'] ELSE [] END), ' ') AS violations FROM e""")
def v02(spark, d):
    """A profile for each supplier: the parts it ships much of are its equities, and a fund."""
    much = scan(spark, d, "lineitem").filter("l_quantity >= 45").select("l_suppkey", "l_partkey").distinct()
    parts = much.groupBy("l_suppkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("a"))
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    symbol = lambda x: F.concat(F.when(x % 9 == 0, "p").otherwise("P"), x.cast("string"))
    equity = F.transform("a", lambda x: F.struct(symbol(x).alias("symbol"), F.array(F.when(x % 7 == 0, "xy").otherwise("alias")).alias("aliases")))
    first, fund = symbol(F.col("a")[0]), F.when(k % 4 == 0, symbol(F.col("a")[0])).otherwise(F.lit("FUND"))
    held = scan(spark, d, "supplier").join(parts, k == F.col("l_suppkey")).select(
        "s_suppkey", F.when(n % 6 != 0, 1).alias("version"), F.when(n % 5 == 0, "Main").otherwise(F.concat(F.lit("main-"), n.cast("string"))).alias("name"), equity.alias("equities"), F.array(fund).alias("funds"), F.array().cast("array<string>").alias("futures"), F.lit(None).cast("array<string>").alias("indices"),
        F.concat(F.lit("P"), k.cast("string")).alias("focus"), F.array(F.struct(F.when(n % 2 == 0, "macro").otherwise("defense").alias("name"), F.array(fund).alias("symbols"))).alias("groups"), F.array(F.struct(F.when(k % 3 == 0, "other").otherwise("growth").alias("name"), F.array(first).alias("symbols"))).alias("baskets"),
        F.array(F.struct(first.alias("physical"), symbol(F.coalesce(F.get("a", F.lit(1)), F.col("a")[0])).alias("paper"), F.lit("x").alias("label"))).alias("pairs"),
    )
    return r.checked(held, r.profile_rules()).select("s_suppkey", said())


@query("e07_scope_versions", """WITH v AS (SELECT o_custkey AS s, o_orderkey AS version_id, o_orderdate::DATE AS a, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate::DATE + (o_orderkey % 400 + 30)::INTEGER END AS b, o_orderdate::DATE + (o_orderkey % 60 - 30)::INTEGER AS x, o_orderdate::DATE + (o_orderkey % 60 - 29)::INTEGER AS y, o_orderstatus <> 'P' AS ok FROM orders),
    t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey AS s, l_shipdate::DATE AS lo, l_shipdate::DATE + CASE WHEN l_linestatus = 'F' THEN 1 ELSE 31 END::INTEGER AS hi FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
    d AS (SELECT DISTINCT s, lo, hi FROM t),
    j AS (SELECT d.s, lo, hi, version_id, ok, ok AND a <= lo AND (b IS NULL OR hi < b OR hi = b AND lo < hi) AND y <= lo AS holds, ok AND (x > hi OR lo < hi AND x = hi) AS later FROM d JOIN v ON v.s = d.s AND (a <= lo OR a < hi) AND (b IS NULL OR lo < b)),
    g AS (SELECT s, lo, hi, count(*) FILTER (holds) AS n, min(version_id) FILTER (holds) AS version_id, arg_min(ok, version_id) FILTER (NOT holds AND NOT later) AS rival FROM j GROUP BY 1, 2, 3),
    e AS (SELECT d.*, CASE WHEN coalesce(n, 0) = 0 THEN 'version_unavailable_at_disclosure' WHEN n > 1 OR rival THEN 'version_ambiguous' WHEN rival IS NOT NULL THEN 'competing_version_review_required' ELSE 'bound' END AS state, version_id FROM d LEFT JOIN g USING (s, lo, hi))
    SELECT s AS o_custkey, lo AS low, hi AS high, CASE WHEN state = 'bound' THEN version_id END AS version_id, state FROM e""")
def e07(spark, d):
    """Shipments as disclosures about a customer, its orders as versions of what is said of it."""
    o = scan(spark, d, "orders")
    start, at = F.to_date("o_orderdate"), F.col("o_orderkey")
    versions = o.select(F.col("o_custkey").alias("subject"), at.alias("version_id"), at.alias("position"), start.alias("valid_from"), F.when(at % 7 != 0, F.date_add(start, (at % 400 + 30).cast("int"))).alias("valid_to"), F.date_add(start, (at % 60 - 30).cast("int")).alias("available_from"), F.date_add(start, (at % 60 - 29).cast("int")).alias("available_to"), (F.col("o_orderstatus") != "P").alias("approved"))
    low = F.to_date("l_shipdate")
    told = scan(spark, d, "lineitem").join(o.select(at.alias("l_orderkey"), "o_custkey"), "l_orderkey").select(F.col("o_custkey").alias("subject"), low.alias("low"), F.date_add(low, F.when(F.col("l_linestatus") == "F", 1).otherwise(31)).alias("high")).distinct()
    return sc.bind_versions(told, versions, key=("subject", "low", "high")).select(F.col("subject").alias("o_custkey"), "low", "high", "version_id", "state")
