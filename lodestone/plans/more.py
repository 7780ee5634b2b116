"""Further measures of the inventory on the driver's tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.functions import scalars as s
from lodestone.operators import matching as m
from lodestone.plans.technicals import rounded
from lodestone.sources.tables import BARS_SQL, bars, scan


@query("f02_eligible_membership", "SELECT event_id FROM events WHERE upper(trim(event_type)) IN ('VIEW', 'CLICK')")
def f02(spark, d):
    return scan(spark, d, "events").filter(F.upper(F.trim("event_type")).isin("VIEW", "CLICK")).select("event_id")


@query("f03_leak_audit", "SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40) GROUP BY 1")
def f03(spark, d):
    core = scan(spark, d, "part").filter("p_size <= 40").select(F.col("p_partkey").alias("l_partkey"))
    return scan(spark, d, "lineitem").join(core, "l_partkey", "left_anti").groupBy("l_partkey").agg(F.count("*").alias("n"))


@query("f06_completed_sessions", f"WITH {BARS_SQL} SELECT symbol, max(session) AS latest, count(*) AS n FROM bars WHERE session <= DATE '2000-06-30' GROUP BY 1")
def f06(spark, d):
    b = bars(spark, d).filter(F.col("session") <= F.lit("2000-06-30").cast("date"))
    return b.groupBy("symbol").agg(F.max("session").alias("latest"), F.count("*").alias("n"))


@query("f07_typed_count", "SELECT event_id, CASE WHEN value IS NULL THEN 'missing' WHEN value < 0 THEN 'negative' WHEN value = 0 THEN 'explicit_zero' ELSE 'observed' END AS state FROM events")
def f07(spark, d):
    rules = [("missing", F.col("value").isNull()), ("negative", F.col("value") < 0), ("explicit_zero", F.col("value") == 0)]
    return m.ladder(scan(spark, d, "events"), rules, "state").select("event_id", F.coalesce("state", F.lit("observed")).alias("state"))


@query("f11_source_rights", """WITH p AS (SELECT n_nationkey, n_nationkey % 3 = 0 AS allowed, CASE WHEN n_nationkey % 3 = 1 THEN 'revoked' WHEN n_nationkey % 3 = 0 THEN 'approved' END AS why FROM nation WHERE n_nationkey < 20)
    SELECT c_custkey, coalesce(allowed, false) AS allowed, coalesce(why, 'no_policy') AS reason FROM customer LEFT JOIN p ON n_nationkey = c_nationkey""")
def f11(spark, d):
    k = F.col("n_nationkey")
    p = scan(spark, d, "nation").filter(k < 20).select(k.alias("c_nationkey"), (k % 3 == 0).alias("a"), F.when(k % 3 == 1, "revoked").when(k % 3 == 0, "approved").alias("w"))
    return scan(spark, d, "customer").join(p, "c_nationkey", "left").select("c_custkey", F.coalesce("a", F.lit(False)).alias("allowed"), F.coalesce("w", F.lit("no_policy")).alias("reason"))


@query("f13_priority_merge", """WITH u AS (SELECT o_custkey, o_orderdate::DATE AS day, 0 AS priority, o_orderkey AS id FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_custkey, o_orderdate::DATE, 1, o_orderkey FROM orders WHERE o_orderstatus = 'O')
    SELECT o_custkey, day, priority, id FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY priority, day, id) AS k FROM u) WHERE k = 1""")
def f13(spark, d):
    o = scan(spark, d, "orders").filter("o_orderstatus in ('F', 'O')")
    u = o.select("o_custkey", F.to_date("o_orderdate").alias("day"), F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("priority"), F.col("o_orderkey").alias("id"))
    return m.top_per(u, ["o_custkey"], [F.col("priority"), F.col("day"), F.col("id")], 1).drop("position")


@query("f16_any_threshold", "SELECT l_orderkey, bool_or(l_discount >= 0.09 OR l_tax >= 0.08) AS hit FROM lineitem GROUP BY 1")
def f16(spark, d):
    return scan(spark, d, "lineitem").groupBy("l_orderkey").agg(F.bool_or((F.col("l_discount") >= 0.09) | (F.col("l_tax") >= 0.08)).alias("hit"))


@query("f18_admission_ladder", """WITH j AS (SELECT d.doc_id, d.source, d.n_chars, quality, row_number() OVER (PARTITION BY source, n_chars ORDER BY d.doc_id) AS k FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
    SELECT doc_id, CASE WHEN quality IS NULL THEN 'unlabelled' WHEN n_chars < 100 THEN 'too_short' WHEN k > 1 THEN 'duplicate_key' ELSE 'included' END AS state FROM j""")
def f18(spark, d):
    j = scan(spark, d, "documents").select("doc_id", "source", "n_chars").join(scan(spark, d, "labels"), "doc_id", "left").withColumn("k", F.row_number().over(Window.partitionBy("source", "n_chars").orderBy("doc_id")))
    out = m.ladder(j, [("unlabelled", F.col("quality").isNull()), ("too_short", F.col("n_chars") < 100), ("duplicate_key", F.col("k") > 1)], "state")
    return out.select("doc_id", F.coalesce("state", F.lit("included")).alias("state"))


@query("f19_size_budget", "SELECT source, doc_id, held::BIGINT AS held FROM (SELECT *, sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id) AS held FROM documents) WHERE held <= 30000")
def f19(spark, d):
    w = Window.partitionBy("source").orderBy("doc_id")
    return scan(spark, d, "documents").withColumn("held", F.sum("n_chars").over(w)).filter("held <= 30000").select("source", "doc_id", "held")


@query("j01_three_way", "SELECT c_mktsegment, n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2")
def j01(spark, d):
    j = scan(spark, d, "orders").join(scan(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(scan(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("c_mktsegment", "n_name").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("j05_backward_baseline", """WITH t AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'), h AS (SELECT event_id AS hid, user_id, ts AS hts, value FROM events WHERE event_type <> 'error'),
    j AS (SELECT t.event_id, h.value, row_number() OVER (PARTITION BY t.event_id ORDER BY hts DESC, hid) AS k FROM t JOIN h ON h.user_id = t.user_id AND h.hts < t.ts) SELECT event_id, count(*) AS points, round(avg(value), 6) AS mean FROM j WHERE k <= 20 GROUP BY 1""")
def j05(spark, d):
    """The latest 20 values strictly before each target: running counts and sums of the history, and what they were 20 earlier."""
    e = scan(spark, d, "events").withColumn("target", F.col("event_type") == "error")
    # At one instant targets come before history, which is then not strictly earlier.
    w = Window.partitionBy("user_id").orderBy("ts", F.col("target").desc(), F.col("event_id").desc()).rowsBetween(Window.unboundedPreceding, 0)
    past = F.when(~F.col("target"), F.col("value").cast("decimal(28,10)"))
    run = e.select("event_id", "user_id", "target", F.count(past).over(w).alias("n"), F.coalesce(F.sum(past).over(w), F.lit(0)).cast("decimal(38,10)").alias("s"))
    before = run.filter(~F.col("target")).select("user_id", (F.col("n") + 20).alias("n"), F.col("s").alias("earlier"))
    t = run.filter("target and n > 0").join(before, ["user_id", "n"], "left")
    points = F.least("n", F.lit(20))
    return t.select("event_id", points.alias("points"), F.round((F.col("s") - F.coalesce("earlier", F.lit(0).cast("decimal(38,10)"))).cast("double") / points, 6).alias("mean"))


@query("j08_history_semi", """WITH h AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-10') SELECT event_id, h.user_id IS NOT NULL AS seen FROM (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-29') e LEFT JOIN h ON h.user_id = e.user_id AND h.event_type = e.event_type""")
def j08(spark, d):
    e = scan(spark, d, "events")
    h = e.filter("ts < timestamp_ntz'2024-01-10'").select("user_id", "event_type", F.lit(True).alias("h")).distinct()
    return e.filter("ts >= timestamp_ntz'2024-01-29'").join(h, ["user_id", "event_type"], "left").select("event_id", F.coalesce("h", F.lit(False)).alias("seen"))


@query("j11_priority_fallback", """WITH a AS (SELECT o_custkey, max(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'P' GROUP BY 1), b AS (SELECT o_custkey, max(o_totalprice) AS v FROM orders GROUP BY 1)
    SELECT c_custkey, coalesce(a.v, b.v, c_acctbal) AS cap, CASE WHEN a.v IS NOT NULL THEN 'primary' WHEN b.v IS NOT NULL THEN 'fallback' ELSE 'own' END AS origin FROM customer LEFT JOIN a ON a.o_custkey = c_custkey LEFT JOIN b ON b.o_custkey = c_custkey""")
def j11(spark, d):
    o = scan(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice"))).alias("a"), F.max("o_totalprice").alias("b"))
    j = scan(spark, d, "customer").join(o, "c_custkey", "left")
    return j.select("c_custkey", F.coalesce("a", "b", "c_acctbal").alias("cap"), F.when(F.col("a").isNotNull(), "primary").when(F.col("b").isNotNull(), "fallback").otherwise("own").alias("origin"))


@query("j21_token_name_key", "SELECT p_partkey, array_to_string(list_filter(string_split(lower(p_name), ' '), lambda t: t NOT IN ('small', 'large', ''))[1:2], ' ') AS key FROM part")
def j21(spark, d):
    tokens = F.filter(F.split(F.lower("p_name"), " "), lambda t: ~t.isin("small", "large", ""))
    return scan(spark, d, "part").select("p_partkey", F.array_join(F.slice(tokens, 1, 2), " ").alias("key"))


@query("a09_filtered_recall", "SELECT lang, count(*) FILTER (quality = 1) AS gold, count(*) FILTER (quality = 1 AND toxic = 0) AS found, round(count(*) FILTER (quality = 1 AND toxic = 0) / nullif(count(*) FILTER (quality = 1), 0), 6) AS recall FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def a09(spark, d):
    j = scan(spark, d, "documents").select("doc_id", "lang").join(scan(spark, d, "labels"), "doc_id")
    gold, found = F.count_if(F.col("quality") == 1), F.count_if((F.col("quality") == 1) & (F.col("toxic") == 0))
    return rounded(j.groupBy("lang").agg(gold.alias("gold"), found.alias("found")).withColumn("recall", F.try_divide("found", "gold")), "recall")


@query("a27_first_of_key", "SELECT user_id, event_type, day, event_id FROM (SELECT user_id, event_type, ts::DATE AS day, event_id, row_number() OVER (PARTITION BY user_id, event_type, ts::DATE ORDER BY event_id) AS k FROM events) WHERE k = 1")
def a27(spark, d):
    return scan(spark, d, "events").groupBy("user_id", "event_type", F.to_date("ts").alias("day")).agg(F.min("event_id").alias("event_id"))


@query("a31_missing_coverage", "SELECT user_id, 5 - count(DISTINCT event_type) AS missing, count(DISTINCT event_type) AS received FROM events WHERE ts < TIMESTAMP '2024-01-04' GROUP BY 1")
def a31(spark, d):
    expected = F.array(*map(F.lit, ("click", "error", "purchase", "signup", "view")))
    g = scan(spark, d, "events").filter("ts < timestamp_ntz'2024-01-04'").groupBy("user_id").agg(F.collect_set("event_type").alias("got"))
    return g.select("user_id", F.size(F.array_except(expected, "got")).cast("long").alias("missing"), F.size("got").cast("long").alias("received"))


@query("k06_partial_dates", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_orderdate::DATE WHEN 1 THEN date_trunc('month', o_orderdate)::DATE ELSE date_trunc('year', o_orderdate)::DATE END AS day FROM orders")
def k06(spark, d):
    o = scan(spark, d, "orders")
    k = F.col("o_orderkey") % 3
    said = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM")).otherwise(F.date_format("o_orderdate", "yyyy"))
    parsed = F.coalesce(*[F.try_to_timestamp(said, F.lit(f)) for f in ("yyyy-MM-dd", "yyyy-MM", "yyyy")])
    return o.select("o_orderkey", F.to_date(parsed).alias("day"))


@query("k12_lane", "SELECT doc_id, CASE WHEN contains(lower(text), 'token') THEN 'universe' WHEN lang = 'en' THEN 'macro' ELSE 'discovery' END AS lane FROM documents")
def k12(spark, d):
    rules = [("universe", F.lower("text").contains("token")), ("macro", F.col("lang") == "en")]
    return m.ladder(scan(spark, d, "documents"), rules, "lane").select("doc_id", F.coalesce("lane", F.lit("discovery")).alias("lane"))


@query("k19_change_spread", f"WITH {BARS_SQL} SELECT session, round(max(close / open - 1) - min(close / open - 1), 6) AS spread, count(*) AS n FROM bars GROUP BY 1")
def k19(spark, d):
    change = F.try_divide("close", "open") - 1
    return rounded(bars(spark, d).groupBy("session").agg((F.max(change) - F.min(change)).alias("spread"), F.count("*").alias("n")), "spread")


@query("k22_ratio_regime", f"""WITH {BARS_SQL}, p AS (SELECT a.session, a.close / b.close AS ratio FROM bars a JOIN bars b ON a.session = b.session AND a.symbol = 'AF' AND b.symbol = 'RF')
    SELECT session, round(ratio, 6) AS ratio, CASE WHEN ratio > 1.5 THEN 'RISK_OFF' WHEN ratio > 1 THEN 'CAUTIOUS' WHEN ratio < 0.5 THEN 'RISK_ON' ELSE 'NEUTRAL' END AS regime FROM p""")
def k22(spark, d):
    p = bars(spark, d).filter(F.col("symbol").isin("AF", "RF")).groupBy("session").agg(F.max(F.when(F.col("symbol") == "AF", F.col("close"))).alias("a"), F.max(F.when(F.col("symbol") == "RF", F.col("close"))).alias("b")).filter("a is not null and b is not null")
    ratio = F.col("a") / F.col("b")
    return p.select("session", F.round(ratio, 6).alias("ratio"), F.when(ratio > 1.5, "RISK_OFF").when(ratio > 1, "CAUTIOUS").when(ratio < 0.5, "RISK_ON").otherwise("NEUTRAL").alias("regime"))


@query("k24_sorted_join", "SELECT l_orderkey, string_agg(DISTINCT l_returnflag, '+' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY 1")
def k24(spark, d):
    return scan(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_set("l_returnflag")), "+").alias("flags"))


@query("k30_content_seen", "SELECT md5(text) AS digest, count(*) AS seen, min(doc_id) AS first FROM documents GROUP BY 1")
def k30(spark, d):
    return scan(spark, d, "documents").groupBy(F.md5("text").alias("digest")).agg(F.count("*").alias("seen"), F.min("doc_id").alias("first"))


@query("o06_dominant", "SELECT l_suppkey, l_partkey AS dominant, notional FROM (SELECT l_suppkey, l_partkey, round(sum(l_extendedprice), 2) AS notional, row_number() OVER (PARTITION BY l_suppkey ORDER BY round(sum(l_extendedprice), 2) DESC, l_partkey) AS k FROM lineitem GROUP BY 1, 2) WHERE k = 1")
def o06(spark, d):
    g = scan(spark, d, "lineitem").groupBy("l_suppkey", F.col("l_partkey").alias("dominant")).agg(F.round(F.sum("l_extendedprice"), 2).alias("notional"))
    return m.top_per(g, ["l_suppkey"], [F.col("notional").desc(), F.col("dominant")], 1).drop("position")


@query("v01_violations", "SELECT rule, count(*) AS n FROM (SELECT 'negative_balance' AS rule FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'zero_quantity' FROM lineitem WHERE l_quantity <= 0 UNION ALL SELECT 'high_discount' FROM lineitem WHERE l_discount > 0.05) GROUP BY 1")
def v01(spark, d):
    rule = lambda rows, cond, name: rows.filter(cond).select(F.lit(name).alias("rule"))
    li = scan(spark, d, "lineitem")
    every = rule(scan(spark, d, "customer"), "c_acctbal < 0", "negative_balance").unionByName(rule(li, "l_quantity <= 0", "zero_quantity")).unionByName(rule(li, "l_discount > 0.05", "high_discount"))
    return every.groupBy("rule").agg(F.count("*").alias("n"))


@query("v04_conflicting_import", "SELECT l_partkey, count(DISTINCT l_tax) AS versions FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_tax) > 5")
def v04(spark, d):
    return scan(spark, d, "lineitem").groupBy("l_partkey").agg(F.count_distinct("l_tax").alias("versions")).filter("versions > 5")


@query("v06_quality_reasons", "SELECT doc_id, concat_ws('+', CASE WHEN n_chars < 200 THEN 'short' END, CASE WHEN lang <> 'en' THEN 'foreign' END, CASE WHEN source IN ('src0', 'src1') THEN 'suspect_source' END) AS reasons FROM documents")
def v06(spark, d):
    why = F.concat_ws("+", F.when(F.col("n_chars") < 200, "short"), F.when(F.col("lang") != "en", "foreign"), F.when(F.col("source").isin("src0", "src1"), "suspect_source"))
    return scan(spark, d, "documents").select("doc_id", why.alias("reasons"))


@query("x07_health_rollup", "SELECT event_type AS source, CASE WHEN max(value) > 400 THEN 'ERROR' WHEN avg(value) > 51 THEN 'WARN' ELSE 'OK' END AS status FROM events GROUP BY 1")
def x07(spark, d):
    g = scan(spark, d, "events").groupBy(F.col("event_type").alias("source")).agg(F.max("value").alias("a"), F.avg("value").alias("b"))
    return g.select("source", F.when(F.col("a") > 400, "ERROR").when(F.col("b") > 51, "WARN").otherwise("OK").alias("status"))


@query("x18_newest_context", "SELECT source, doc_id, kind FROM (SELECT source, doc_id, CASE WHEN quality = 1 THEN 'signal' ELSE 'context' END AS kind, row_number() OVER (PARTITION BY source, quality ORDER BY doc_id DESC) AS k FROM documents JOIN labels USING (doc_id)) WHERE kind = 'signal' OR k <= 3")
def x18(spark, d):
    j = scan(spark, d, "documents").select("doc_id", "source").join(scan(spark, d, "labels"), "doc_id").withColumn("kind", F.when(F.col("quality") == 1, "signal").otherwise("context"))
    j = j.withColumn("k", F.row_number().over(Window.partitionBy("source", "kind").orderBy(F.col("doc_id").desc())))
    return j.filter("kind = 'signal' or k <= 3").select("source", "doc_id", "kind")


@query("x26_document_identity", "SELECT doc_id, substr(sha256('documents|' || doc_id), 1, 16) AS evidence_id, sha256(text) AS revision_id FROM documents")
def x26(spark, d):
    return scan(spark, d, "documents").select("doc_id", s.record_id("documents", F.col("doc_id")).alias("evidence_id"), F.sha2("text", 256).alias("revision_id"))


@query("x53_recent_log", "SELECT event_id, event_type FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS ORDER BY ts DESC, event_id LIMIT 100")
def x53(spark, d):
    e = scan(spark, d, "events")
    latest = e.agg(F.max("ts").alias("m"))
    return e.join(F.broadcast(latest), F.col("ts") >= F.col("m") - F.expr("interval 24 hours")).orderBy(F.col("ts").desc(), "event_id").limit(100).select("event_id", "event_type")


@query("session_windows_extension")
def session_windows(spark, d):
    e = scan(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n")).select("user_id", "w.start", "w.end", "n")
