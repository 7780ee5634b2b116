"""Measures, joins and selections on the driver's tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.operators import matching as m
from lodestone.operators import measures as g
from lodestone.plans.technicals import rounded
from lodestone.sources.tables import BARS_SQL, bars, scan

W = "1.959963984540054"
WILSON = f"""round(CASE WHEN n > 0 THEN greatest(0, (p + {W} * {W} / (2 * n) - {W} * sqrt(p * (1 - p) / n + {W} * {W} / (4 * n * n))) / (1 + {W} * {W} / n)) END, 6) AS low,
    round(CASE WHEN n > 0 THEN least(1, (p + {W} * {W} / (2 * n) + {W} * sqrt(p * (1 - p) / n + {W} * {W} / (4 * n * n))) / (1 + {W} * {W} / n)) END, 6) AS high"""


@query("a07_wilson", f"""WITH c AS (SELECT source, count(*)::DOUBLE AS n, sum(quality)::DOUBLE AS k FROM documents JOIN labels USING (doc_id) GROUP BY 1), d AS (SELECT *, k / n AS p FROM c)
    SELECT source, {WILSON} FROM d""")
def a07(spark, d):
    t = scan(spark, d, "documents").select("doc_id", "source").join(scan(spark, d, "labels"), "doc_id").groupBy("source").agg(F.count("*").alias("n"), F.sum("quality").alias("k"))
    low, high = g.wilson(F.col("k"), F.col("n"))
    return rounded(t.select("source", low.alias("low"), high.alias("high")), "low", "high")


@query("a08_precision_strata", f"""WITH s AS (SELECT a.source, b.lang FROM (SELECT DISTINCT source FROM documents) a CROSS JOIN (SELECT DISTINCT lang FROM documents) b),
    c AS (SELECT source, lang, count(*) AS n, sum(quality) AS k FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2), d AS (SELECT source, lang, coalesce(n, 0)::BIGINT AS n, coalesce(k, 0)::BIGINT AS correct, k / nullif(n, 0)::DOUBLE AS p FROM s LEFT JOIN c USING (source, lang))
    SELECT source, lang, n, correct, round(p, 6) AS precision, {WILSON} FROM d""")
def a08(spark, d):
    docs = scan(spark, d, "documents").select("doc_id", "source", "lang")
    # Two short lists of names: every stratum is asked for, seen or not.
    strata = docs.select("source").distinct().join(docs.select("lang").distinct(), how="cross")
    rows = docs.join(scan(spark, d, "labels"), "doc_id").withColumn("ok", F.col("quality") == 1)
    return rounded(g.precision_by_stratum(rows, strata, ["source", "lang"], "ok"), "precision", "low", "high")


@query("a06_p95_nearest_rank", "SELECT event_type, quantile_disc(value, 0.95) AS p95 FROM events GROUP BY 1")
def a06(spark, d):
    return scan(spark, d, "events").groupBy("event_type").agg(F.expr("percentile_disc(0.95) within group (order by value)").alias("p95"))


@query("a05_percentiles", "SELECT event_type, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75 FROM events GROUP BY 1")
def a05(spark, d):
    q = F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return rounded(scan(spark, d, "events").groupBy("event_type").agg(q.alias("q")).select("event_type", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75")), "p25", "p50", "p75")


@query("a12_insider_cluster", """WITH t AS (SELECT l_partkey AS issuer, l_suppkey AS filer, CASE l_returnflag WHEN 'R' THEN 'P' WHEN 'A' THEN 'S' ELSE 'O' END AS code FROM lineitem),
    c AS (SELECT issuer, count(DISTINCT filer) FILTER (code = 'P') AS buyers, count(DISTINCT filer) FILTER (code = 'S') AS sellers, count(*) FILTER (code = 'P') AS n_p, count(*) FILTER (code = 'S') AS n_s, count(*) FILTER (code = 'O') AS n_o FROM t GROUP BY 1)
    SELECT *, CASE WHEN buyers >= 2 AND sellers >= 2 THEN 'mixed' WHEN buyers >= 2 THEN 'buy' ELSE 'sell' END AS direction, CASE WHEN buyers >= 3 THEN 'HIGH' WHEN buyers >= 2 THEN 'MEDIUM' END AS alert FROM c WHERE buyers >= 2 OR sellers >= 2""")
def a12(spark, d):
    code = F.when(F.col("l_returnflag") == "R", "P").when(F.col("l_returnflag") == "A", "S").otherwise("O")
    return g.clusters_by_direction(scan(spark, d, "lineitem").select(F.col("l_partkey").alias("issuer"), F.col("l_suppkey").alias("filer"), code.alias("code")))


@query("a13_put_call", """SELECT l_returnflag AS symbol, round(sum(CASE l_linestatus WHEN 'F' THEN l_quantity ELSE 0 END) / nullif(sum(CASE l_linestatus WHEN 'O' THEN l_quantity ELSE 0 END), 0), 6) AS volume_ratio,
    round(sum(CASE l_linestatus WHEN 'F' THEN round(l_tax * 100) ELSE 0 END) / nullif(sum(CASE l_linestatus WHEN 'O' THEN round(l_tax * 100) ELSE 0 END), 0), 6) AS interest_ratio FROM lineitem GROUP BY 1""")
def a13(spark, d):
    chain = scan(spark, d, "lineitem").select(F.col("l_returnflag").alias("symbol"), F.when(F.col("l_linestatus") == "F", "PUT").otherwise("CALL").alias("side"), F.col("l_quantity").alias("volume"), F.round(F.col("l_tax") * 100).alias("interest"))
    return rounded(g.put_call(chain), "volume_ratio", "interest_ratio")


@query("a14_basket_return", f"""WITH {BARS_SQL}, c AS (SELECT session FROM (SELECT DISTINCT session FROM bars) ORDER BY session DESC LIMIT 21),
    r AS (SELECT symbol, CASE WHEN count(close) = 21 THEN arg_max(close, session) / arg_min(close, session) - 1 END AS ret FROM bars JOIN c USING (session) GROUP BY symbol),
    k AS (SELECT * FROM (VALUES ('growth', 'AF'), ('growth', 'NO'), ('defensive', 'RF'), ('defensive', 'ZZ')) t(basket, symbol))
    SELECT basket, count(ret) AS priced, round(CASE WHEN count(ret) = 2 THEN avg(ret) END, 6) AS ret FROM k LEFT JOIN r USING (symbol) GROUP BY basket""")
def a14(spark, d):
    from lodestone.operators.windows import aligned_return

    b = bars(spark, d)
    r = aligned_return(b, b.select("session").distinct(), 20).select("symbol", F.col("aligned_return").alias("ret"))
    return rounded(g.basket_return(r, {"growth": ["AF", "NO"], "defensive": ["RF", "ZZ"]}), "ret")


EVENTS = "e AS (SELECT event_id AS id, user_id AS key, event_type AS family, ts AS at FROM events)"


def events(spark, d):
    return scan(spark, d, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("key"), F.col("event_type").alias("family"), F.col("ts").alias("at"))


@query("a18_confluence", f"""WITH {EVENTS} SELECT key, count(DISTINCT family) AS n_families, string_agg(DISTINCT family, '+' ORDER BY family) AS families, count(*) AS n_events, min(e."at") AS first_seen, max(e."at") AS as_of
    FROM e WHERE e."at" <= TIMESTAMP '2024-01-30 00:00:00' AND e."at" >= TIMESTAMP '2024-01-28 00:00:00' GROUP BY key HAVING count(DISTINCT family) >= 2""")
def a18(spark, d):
    return g.confluence(events(spark, d), "2024-01-30 00:00:00")


@query("j06_range_48h", f"""WITH {EVENTS} SELECT id, key, e."at" AS "at", len(list_distinct(list(family) OVER w))::INT AS n_families FROM e WINDOW w AS (PARTITION BY key ORDER BY e."at" RANGE BETWEEN INTERVAL 48 HOURS PRECEDING AND CURRENT ROW)""")
def j06(spark, d):
    return g.families_within(events(spark, d))


@query("a21_vote", "SELECT source, count(*) AS votes, CASE WHEN bool_and(quality = 1) THEN 'useful' WHEN NOT bool_or(quality = 1) THEN 'negative' ELSE 'contested' END AS state FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def a21(spark, d):
    return g.vote(scan(spark, d, "documents").join(scan(spark, d, "labels"), "doc_id").withColumn("ok", F.col("quality") == 1), ["source"], "ok")


@query("a28_claim_conflicts", "SELECT l_partkey, l_suppkey, count(DISTINCT l_discount) AS n_values, count(*) AS n_claims, CASE WHEN count(DISTINCT l_discount) > 1 THEN 'conflicting' WHEN count(*) > 1 THEN 'agreeing' ELSE 'attributed' END AS state FROM lineitem GROUP BY 1, 2")
def a28(spark, d):
    return g.conflicts(scan(spark, d, "lineitem"), ["l_partkey", "l_suppkey"], "l_discount")


@query("a33_interval_gaps", """WITH s AS (SELECT user_id, ts::DATE AS day, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1, 2), r AS (SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s)
    SELECT DISTINCT user_id, reach AS gap_from, a AS gap_to FROM r WHERE reach < a""")
def a33(spark, d):
    spans = scan(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return g.interval_gaps(spans, ["user_id"], "a", "b")


@query("a34_rank_contiguity", "SELECT l_orderkey, count(*) AS n, count(*) = max(l_linenumber) AND count(DISTINCT l_linenumber) = max(l_linenumber) AND min(l_linenumber) = 1 AS contiguous FROM lineitem GROUP BY 1")
def a34(spark, d):
    return g.contiguity(scan(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("a22_retry_chain", """WITH a AS (SELECT conv_id, turn + 1 AS attempt, role AS scope, turn AS started, turn + 1 AS completed FROM conversations), k AS (SELECT *, row_number() OVER h AS k, lag(completed) OVER h AS p FROM a WINDOW h AS (PARTITION BY conv_id ORDER BY attempt, started))
    SELECT conv_id, count(*) AS attempts, bool_and(k = attempt) AS contiguous, count(DISTINCT scope) = 1 AS one_scope, bool_and(coalesce(p <= started, true)) AS ordered FROM k GROUP BY 1""")
def a22(spark, d):
    a = scan(spark, d, "conversations").select("conv_id", (F.col("turn") + 1).alias("attempt"), F.col("role").alias("scope"), F.col("turn").alias("started"), (F.col("turn") + 1).alias("completed"))
    return g.retry_chain(a, ["conv_id"])


@query("a16_keyword_ratio", "SELECT lang, count(*) AS posts, round(avg(regexp_matches(text, '(?i)\\b(the|and|token)\\b')::INT), 6) AS ratio, avg(regexp_matches(text, '(?i)\\b(the|and|token)\\b')::INT) > 0.25 AS euphoric FROM documents GROUP BY 1")
def a16(spark, d):
    return rounded(g.keyword_ratio(scan(spark, d, "documents"), ["lang"], ["the", "and", "token"]), "ratio")


@query("a17_pool_accounting", """WITH p AS (SELECT 'source' AS field, coalesce(source, '(none)') AS value FROM documents UNION ALL SELECT 'lang', coalesce(lang, '(none)') FROM documents), c AS (SELECT field, value, count(*) AS n FROM p GROUP BY 1, 2)
    SELECT field, value, n, round(n / sum(n) OVER w, 6) AS share, n = max(n) OVER w AS largest FROM c WINDOW w AS (PARTITION BY field)""")
def a17(spark, d):
    return rounded(g.pool_accounting(scan(spark, d, "documents"), ["source", "lang"]), "share")


@query("a20_category_costs", "SELECT p_type AS category, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS cost, count(DISTINCT l_orderkey) AS units, round(sum(l_extendedprice::DECIMAL(18,2))::DOUBLE / count(DISTINCT l_orderkey), 6) AS unit_cost FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1")
def a20(spark, d):
    j = scan(spark, d, "lineitem").join(scan(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    out = j.groupBy(F.col("p_type").alias("category")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("cost"), F.count_distinct("l_orderkey").alias("units"))
    return rounded(out.withColumn("unit_cost", F.col("cost") / F.col("units")), "unit_cost")


@query("a32_income_scenarios", "SELECT c_custkey, rate, round(c_acctbal * rate, 6) AS income, round(CASE WHEN c_acctbal > 0 THEN 1000 / c_acctbal END, 6) AS break_even FROM customer CROSS JOIN (SELECT unnest([0.01, 0.03, 0.05])::DOUBLE AS rate)")
def a32(spark, d):
    c = scan(spark, d, "customer").withColumn("rate", F.explode(F.array(*map(F.lit, (0.01, 0.03, 0.05)))))
    return rounded(c.select("c_custkey", "rate", (F.col("c_acctbal") * F.col("rate")).alias("income"), F.when(F.col("c_acctbal") > 0, F.lit(1000) / F.col("c_acctbal")).alias("break_even")), "income", "break_even")


VERSIONS = "v AS (SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate::DATE AS valid_from, (o_orderdate + INTERVAL 400 DAYS)::DATE AS valid_to, l_shipdate::DATE AS known_from FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"


def versions(spark, d):
    o = scan(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("valid_from"))
    return scan(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("known_from")).join(o, "l_orderkey").withColumn("valid_to", F.date_add("valid_from", 400))


@query("f14_bitemporal_visibility", f"WITH {VERSIONS} SELECT l_orderkey, l_linenumber, valid_from, known_from FROM v WHERE known_from <= DATE '1998-01-01' AND valid_from <= DATE '1997-12-01' AND DATE '1997-12-01' < valid_to")
def f14(spark, d):
    return m.visible(versions(spark, d), "1998-01-01", "1997-12-01").select("l_orderkey", "l_linenumber", "valid_from", "known_from")


@query("j14_symbol_resolve", f"""WITH {VERSIONS}, s AS (SELECT p_partkey AS symbol FROM part), n AS (SELECT l_partkey AS symbol, count(DISTINCT l_orderkey) AS n, min(l_orderkey) AS i FROM v
    WHERE known_from <= DATE '1998-01-01' AND valid_from <= DATE '1997-12-01' AND DATE '1997-12-01' < valid_to GROUP BY 1)
    SELECT symbol, CASE WHEN n = 1 THEN i END AS instrument, CASE WHEN n = 1 THEN 'resolved' WHEN n > 1 THEN 'ambiguous' ELSE 'unknown' END AS state FROM s LEFT JOIN n USING (symbol)""")
def j14(spark, d):
    s = scan(spark, d, "part").select(F.col("p_partkey").alias("symbol"), F.lit("1997-12-01").cast("date").alias("on"), F.lit("1998-01-01").cast("date").alias("known_by"))
    v = versions(spark, d).select(F.col("l_partkey").alias("symbol"), F.col("l_orderkey").alias("instrument"), "valid_from", "valid_to", "known_from")
    return m.resolve(s, v).select("symbol", "instrument", "state")


@query("j15_snapshot_diff", """WITH p AS (SELECT o_custkey, max(o_orderpriority) AS a, count(*) AS b FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1), c AS (SELECT o_custkey, max(o_orderpriority) AS a, count(*) AS b FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY 1),
    j AS (SELECT coalesce(p.o_custkey, c.o_custkey) AS o_custkey, p.b AS pb, c.b AS cb, concat_ws('+', CASE WHEN p.a IS DISTINCT FROM c.a THEN 'priority' END, CASE WHEN p.b IS DISTINCT FROM c.b THEN 'n' END) AS f FROM p FULL JOIN c ON p.o_custkey = c.o_custkey)
    SELECT o_custkey, CASE WHEN pb IS NULL THEN 'added' WHEN cb IS NULL THEN 'missing' WHEN f <> '' THEN 'changed' ELSE 'same' END AS state, CASE WHEN pb IS NOT NULL AND cb IS NOT NULL AND f <> '' THEN f END AS fields FROM j""")
def j15(spark, d):
    o = scan(spark, d, "orders")
    snap = lambda rows: rows.groupBy("o_custkey").agg(F.max("o_orderpriority").alias("priority"), F.count("*").alias("n"))
    return m.snapshot_diff(snap(o.filter("o_orderdate < timestamp_ntz'1996-01-01'")), snap(o.filter("o_orderdate >= timestamp_ntz'2001-01-01'")), "o_custkey", ["priority", "n"])


@query("j17_anti_diff", "SELECT 'added' AS side, user_id FROM (SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-29' EXCEPT SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-02') UNION ALL SELECT 'removed', user_id FROM (SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-02' EXCEPT SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-29')")
def j17(spark, d):
    e = scan(spark, d, "events")
    old, new = e.filter("ts < timestamp_ntz'2024-01-02'").select("user_id").distinct(), e.filter("ts >= timestamp_ntz'2024-01-29'").select("user_id").distinct()
    one = lambda a, b, side: a.join(b, "user_id", "left_anti").select(F.lit(side).alias("side"), "user_id")
    return one(new, old, "added").unionByName(one(old, new, "removed"))


@query("j19_multiset_match", """WITH l AS (SELECT user_id, event_id AS intake, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events WHERE event_type = 'view'), r AS (SELECT user_id, event_id AS outcome, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events WHERE event_type = 'purchase')
    SELECT user_id, intake, outcome FROM l FULL JOIN r USING (user_id, n)""")
def j19(spark, d):
    e = scan(spark, d, "events")
    side = lambda kind, name: e.filter(F.col("event_type") == kind).select("user_id", F.col("event_id").alias(name))
    return m.multiset_match(side("view", "intake"), side("purchase", "outcome"), ["user_id"], "intake", "outcome")


@query("f01_freshness_split", "SELECT event_id, CASE WHEN ts > TIMESTAMP '2024-01-20' THEN 'future' WHEN ts < TIMESTAMP '2024-01-20' - INTERVAL 7 DAYS THEN 'stale' END AS drop_reason FROM events")
def f01(spark, d):
    return m.freshness(scan(spark, d, "events"), "ts", "2024-01-20 00:00:00", 7).select("event_id", "drop_reason")


@query("f09_drop_ladder", """SELECT drop_reason, count(*) AS n FROM (SELECT CASE WHEN l_returnflag = 'N' THEN 'stale' WHEN l_shipdate > TIMESTAMP '2000-01-01' THEN 'future' WHEN l_shipdate < TIMESTAMP '1996-01-01' THEN 'out_of_window' WHEN l_suppkey % 10 = 0 THEN 'off_watchlist' ELSE 'eligible' END AS drop_reason FROM lineitem) GROUP BY 1""")
def f09(spark, d):
    t = scan(spark, d, "lineitem")
    rules = [("stale", F.col("l_returnflag") == "N"), ("future", F.col("l_shipdate") > F.lit("2000-01-01").cast("timestamp_ntz")), ("out_of_window", F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")), ("off_watchlist", F.col("l_suppkey") % 10 == 0)]
    return m.ladder(t, rules).groupBy(F.coalesce("drop_reason", F.lit("eligible")).alias("drop_reason")).agg(F.count("*").alias("n"))


@query("f10_version_gate", "SELECT p_partkey, (p_size // 10, p_size % 10, p_partkey % 5) >= (2, 6, 3) AS strict FROM part")
def f10(spark, d):
    v = F.concat_ws(".", F.floor(F.col("p_size") / 10).cast("int").cast("string"), (F.col("p_size") % 10).cast("string"), (F.col("p_partkey") % 5).cast("string"))
    return scan(spark, d, "part").select("p_partkey", m.version_at_least(v, (2, 6, 3)).alias("strict"))


@query("f12_coverage_tier", """WITH t AS (SELECT l_orderkey, bool_or(l_returnflag = 'A') AS a, bool_or(l_returnflag = 'R') AS r FROM lineitem GROUP BY 1) SELECT l_orderkey, CASE WHEN a AND r THEN 'mixed' WHEN a THEN 'instrumented' WHEN r THEN 'editorial' ELSE 'none' END AS tier FROM t""")
def f12(spark, d):
    t = scan(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("tickers"))
    has = lambda *names: F.arrays_overlap("tickers", F.array(*map(F.lit, names)))
    return t.select("l_orderkey", F.when(has("A") & has("R"), "mixed").when(has("A"), "instrumented").when(has("R"), "editorial").otherwise("none").alias("tier"))


@query("f17_repeat_suppression", """WITH h AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'), i AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1995-06-01')
    SELECT o_orderkey, CASE WHEN i.o_custkey IS NOT NULL THEN 'same_record' WHEN h.o_custkey IS NOT NULL THEN 'same_subject' ELSE 'published' END AS decision FROM (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01') o LEFT JOIN h ON h.o_custkey = o.o_custkey LEFT JOIN i ON i.o_custkey = o.o_custkey AND i.o_orderpriority = o.o_orderpriority""")
def f17(spark, d):
    o = scan(spark, d, "orders")
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    h = o.filter(F.col("o_orderdate") < at("1996-01-01")).select("o_custkey", F.lit(True).alias("_h")).distinct()
    i = o.filter(F.col("o_orderdate") < at("1995-06-01")).select("o_custkey", "o_orderpriority", F.lit(True).alias("_i")).distinct()
    new = o.filter(F.col("o_orderdate") >= at("2001-01-01")).join(h, "o_custkey", "left").join(i, ["o_custkey", "o_orderpriority"], "left")
    return m.ladder(new, [("same_record", F.col("_i")), ("same_subject", F.col("_h"))], "decision").select("o_orderkey", F.coalesce("decision", F.lit("published")).alias("decision"))


@query("o02_topn", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 50")
def o02(spark, d):
    return m.top(scan(spark, d, "lineitem"), [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")], 50).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("o07_per_group_limit", "SELECT user_id, event_id, position FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id)::INT AS position FROM events) WHERE position <= 5")
def o07(spark, d):
    return m.top_per(scan(spark, d, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id")], 5).select("user_id", "event_id", "position")


@query("o08_nearest", """SELECT o_custkey, d AS nearest FROM (SELECT o_custkey, o_orderdate::DATE AS d, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderdate::DATE >= DATE '1998-06-01' THEN 0 ELSE 1 END, abs(o_orderdate::DATE - DATE '1998-06-01'), o_orderdate) AS k
    FROM orders WHERE o_orderdate::DATE >= DATE '1998-06-01' - INTERVAL 7 DAYS) WHERE k = 1""")
def o08(spark, d):
    o = scan(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("nearest"))
    return m.nearest(o, ["o_custkey"], "nearest", "1998-06-01", 7)


@query("o13_hash_sample", """WITH h AS (SELECT doc_id, sha256('seed|' || doc_id::VARCHAR) AS x FROM documents), b AS (SELECT doc_id, list_reduce(list_transform(range(1, 65), lambda k: strpos('0123456789abcdef', substr(x, k, 1)) - 1), lambda a, v: (a * 16 + v) % 97) AS bucket FROM h)
    SELECT doc_id, bucket::INT AS bucket FROM b WHERE bucket < 20""")
def o13(spark, d):
    return scan(spark, d, "documents").select("doc_id", m.hash_bucket("seed", F.col("doc_id"), 97).alias("bucket")).filter("bucket < 20")


@query("d01_ordered_distinct", "SELECT event_type, user_id, min(event_id) AS first_ordinal FROM events GROUP BY 1, 2")
def d01(spark, d):
    return m.ordered_distinct(scan(spark, d, "events"), ["event_type", "user_id"], "event_id")


@query("d02_union_events", "SELECT 'order' AS section, o_custkey AS key, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'event', user_id, count(*) FROM events GROUP BY 2")
def d02(spark, d):
    a = scan(spark, d, "orders").select(F.lit("order").alias("section"), F.col("o_custkey").alias("key"))
    b = scan(spark, d, "events").select(F.lit("event").alias("section"), F.col("user_id").alias("key"))
    return a.unionByName(b).groupBy("section", "key").agg(F.count("*").alias("n"))


@query("d04_strict_superset", """WITH a AS (SELECT user_id, list(DISTINCT event_type) AS s FROM events WHERE ts < TIMESTAMP '2024-01-03' GROUP BY 1), b AS (SELECT user_id, list(DISTINCT event_type) AS s FROM events WHERE ts < TIMESTAMP '2024-01-05' GROUP BY 1)
    SELECT user_id, list_has_all(b.s, a.s) AND len(b.s) > len(a.s) AS larger FROM a JOIN b USING (user_id)""")
def d04(spark, d):
    e = scan(spark, d, "events")
    of = lambda day: e.filter(F.col("ts") < F.lit(day).cast("timestamp_ntz")).groupBy("user_id").agg(F.collect_set("event_type").alias(f"s{day[-1]}"))
    return of("2024-01-03").join(of("2024-01-05"), "user_id").select("user_id", ((F.size(F.array_except("s3", "s5")) == 0) & (F.size("s5") > F.size("s3"))).alias("larger"))


@query("o05_greedy_caps")
def o05(spark, d):
    order = [F.col("value").desc(), F.col("event_id")]
    pool = scan(spark, d, "events").select(F.to_date("ts").alias("run"), "event_id", "event_type", "user_id", "value")
    few = m.best_of_caps(pool, "run", "event_type", "user_id", order, (3, 2), 5)
    ranked = few.select("run", F.row_number().over(Window.partitionBy("run").orderBy(*order)).alias("rank"), "event_id", "event_type", "user_id")
    return m.greedy_caps(ranked, {("event_type",): 3, ("event_type", "user_id"): 1, ("user_id",): 2}, 5).drop("rank")
