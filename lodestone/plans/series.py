"""Further measures over series, groups and queues on the driver's tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.functions import scalars as sc
from lodestone.operators import graph as gr
from lodestone.operators import matching as m
from lodestone.operators import windows as w
from lodestone.plans.identity import STORY, stories
from lodestone.plans.technicals import DAILY, rounded
from lodestone.sources.tables import BARS_SQL, bars, scan


@query("w06_known_baseline", """WITH s AS (SELECT l_partkey AS key, l_shipdate::DATE AS session, (l_shipdate + INTERVAL 10 DAYS)::DATE AS observed, l_quantity AS value FROM lineitem WHERE (l_shipdate + INTERVAL 10 DAYS)::DATE <= DATE '2000-01-01'), g AS (SELECT key, session, sum(value) AS value FROM s GROUP BY 1, 2)
    SELECT key, session, value, count(value) OVER f AS points, round(avg(value) OVER f, 6) AS mean FROM g WINDOW f AS (PARTITION BY key ORDER BY session ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)""")
def w06(spark, d):
    """Up to 20 strictly earlier sessions of what was observed by the run's clock; what came in later doesn't count."""
    seen = scan(spark, d, "lineitem").select(F.col("l_partkey").alias("key"), F.to_date("l_shipdate").alias("session"), F.col("l_quantity").alias("value")).withColumn("observed", F.date_add("session", 10)).filter("observed <= date'2000-01-01'")
    g = seen.groupBy("key", "session").agg(F.sum("value").alias("value"))
    f = Window.partitionBy("key").orderBy("session").rowsBetween(-20, -1)
    return g.select("key", "session", "value", F.count("value").over(f).alias("points"), F.round(F.avg("value").over(f), 6).alias("mean"))


@query("w07_typed_burst", """WITH t AS (SELECT user_id::VARCHAR AS key, ts::DATE AS session, count(*)::DOUBLE AS value FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2), b AS (SELECT *, list(value) OVER f AS p FROM t WINDOW f AS (PARTITION BY key ORDER BY session ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
    SELECT key, session, value, round(CASE WHEN len(p) >= 5 THEN value / greatest(list_aggregate(p, 'median'), 1.0) END, 6) AS burst FROM b""")
def w07(spark, d):
    typed = scan(spark, d, "events").filter(F.col("event_type").isin("view", "click", "purchase"))
    return rounded(w.burst_ratio(w.daily_counts(typed, "user_id")), "burst")


POINTS = f"""{BARS_SQL}, x AS (SELECT symbol, session, unnest([1, 2, 3]) AS seq, unnest([open, (open + close) / 2, close]) AS value FROM bars), base AS (SELECT symbol, arg_min(open, session) AS b FROM bars GROUP BY 1),
    n AS (SELECT symbol, session, seq, value / b AS wealth FROM x JOIN base USING (symbol)), dd AS (SELECT *, wealth / greatest(max(wealth) OVER (PARTITION BY symbol ORDER BY session, seq), 1) - 1 AS drawdown FROM n)"""


def three_points(spark, d):
    """Wealth at a session's open, middle and close, in order, over its first open, and the drawdown from its running peak."""
    b = bars(spark, d)
    base = b.groupBy("symbol").agg(F.min_by("open", "session").alias("b"))
    x = b.select("symbol", "session", F.explode(F.array(*[F.struct(F.lit(k).alias("seq"), v.alias("value")) for k, v in ((1, F.col("open")), (2, (F.col("open") + F.col("close")) / 2), (3, F.col("close")))])).alias("x"))
    n = x.join(F.broadcast(base), "symbol").select("symbol", "session", "x.seq", (F.col("x.value") / F.col("b")).alias("wealth"))
    peak = F.greatest(F.max("wealth").over(Window.partitionBy("symbol").orderBy("session", "seq").rowsBetween(Window.unboundedPreceding, 0)), F.lit(1.0))
    return n.withColumn("drawdown", F.col("wealth") / peak - 1)


@query("w10_three_point_drawdown", f"WITH {POINTS} SELECT symbol, session, seq, round(drawdown, 6) AS drawdown FROM dd")
def w10(spark, d):
    return rounded(three_points(spark, d).select("symbol", "session", "seq", "drawdown"), "drawdown")


@query("a24_path_metrics", f"""WITH {POINTS} SELECT symbol, count(DISTINCT session) AS sessions, round(min(drawdown), 6) AS max_drawdown, round(arg_max(wealth, (session, seq)) - 1, 6) AS twr,
    round(CASE WHEN count(DISTINCT session) >= 252 THEN pow(arg_max(wealth, (session, seq)), 252.0 / count(DISTINCT session)) - 1 END, 6) AS annualised FROM dd GROUP BY 1""")
def a24(spark, d):
    g = three_points(spark, d).groupBy("symbol").agg(F.count_if(F.col("seq") == 3).alias("sessions"), F.min("drawdown").alias("max_drawdown"), F.max_by("wealth", F.struct("session", "seq")).alias("last"))
    return rounded(g.select("symbol", "sessions", "max_drawdown", (F.col("last") - 1).alias("twr"), F.when(F.col("sessions") >= 252, F.pow("last", 252.0 / F.col("sessions")) - 1).alias("annualised")), "max_drawdown", "twr", "annualised")


@query("w12_first_publication", "SELECT l_partkey, l_returnflag AS basis, min(l_shipdate::DATE) AS published, arg_min(l_orderkey, (l_shipdate, l_orderkey, l_linenumber)) AS record FROM lineitem GROUP BY 1, 2")
def w12(spark, d):
    return scan(spark, d, "lineitem").groupBy("l_partkey", F.col("l_returnflag").alias("basis")).agg(F.min(F.to_date("l_shipdate")).alias("published"), F.min_by("l_orderkey", F.struct("l_shipdate", "l_orderkey", "l_linenumber")).alias("record"))


@query("w15_velocity", f"""WITH {DAILY}, r AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY value DESC, key) AS rank FROM daily)
    SELECT key, session, value - lag(value) OVER h AS velocity, lag(rank) OVER h - rank AS rank_delta FROM r WINDOW h AS (PARTITION BY key ORDER BY session)""")
def w15(spark, d):
    daily = w.daily_counts(scan(spark, d, "events"), "user_id")
    ranked = daily.withColumn("rank", F.row_number().over(Window.partitionBy("session").orderBy(F.col("value").desc(), "key")).cast("long"))
    h = Window.partitionBy("key").orderBy("session")
    return ranked.select("key", "session", (F.col("value") - F.lag("value").over(h)).alias("velocity"), (F.lag("rank").over(h) - F.col("rank")).alias("rank_delta"))


@query("w17_monotone_watermark", """SELECT o_custkey AS source, o_orderkey, max(o_orderdate::DATE) OVER f AS watermark, coalesce(o_orderdate::DATE < max(o_orderdate::DATE) OVER p, false) AS behind FROM orders
    WINDOW f AS (PARTITION BY o_custkey ORDER BY o_orderkey), p AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def w17(spark, d):
    """Records in the order they came in: the source's watermark never goes back, and a record may be behind it."""
    h = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    at = F.to_date("o_orderdate")
    return scan(spark, d, "orders").select(F.col("o_custkey").alias("source"), "o_orderkey", F.max(at).over(h.rowsBetween(Window.unboundedPreceding, 0)).alias("watermark"), F.coalesce(at < F.max(at).over(h.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)).alias("behind"))


@query("a23_expansion_buckets", """WITH u AS (SELECT user_id, bool_or(event_type IN ('view', 'click')) AS base, bool_or(event_type IN ('purchase', 'signup')) AS added, sum(value) AS cost FROM events GROUP BY 1),
    b AS (SELECT CASE WHEN base AND added THEN 'shared' WHEN base THEN 'baseline' WHEN added THEN 'incremental' ELSE 'unknown' END AS bucket, cost FROM u)
    SELECT bucket, count(*) AS n, round(count(*) / (SELECT count(*) FROM b), 6) AS share, round(sum(cost), 2) AS cost FROM b GROUP BY 1""")
def a23(spark, d):
    """Whom only the base sources show, only the added ones, both or neither."""
    u = scan(spark, d, "events").groupBy("user_id").agg(F.bool_or(F.col("event_type").isin("view", "click")).alias("base"), F.bool_or(F.col("event_type").isin("purchase", "signup")).alias("added"), F.sum("value").alias("cost"))
    b = u.select(F.when(F.col("base") & F.col("added"), "shared").when(F.col("base"), "baseline").when(F.col("added"), "incremental").otherwise("unknown").alias("bucket"), "cost")
    g = b.groupBy("bucket").agg(F.count("*").alias("n"), F.round(F.sum("cost"), 2).alias("cost"))
    total = g.agg(F.sum("n").alias("total"))  # one row
    return g.join(F.broadcast(total)).select("bucket", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"), "cost")


@query("a25_study_gates", """WITH s AS (SELECT o_orderpriority AS arm, median(o_totalprice) AS med, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) AS n FROM orders GROUP BY 1), c AS (SELECT med AS control FROM s WHERE arm = '1-URGENT')
    SELECT arm, round(1 - med / control, 6) AS reduction, CASE WHEN n < 20 THEN 'pending' WHEN 1 - med / control >= 0 THEN 'pass' ELSE 'fail' END AS gate FROM s, c""")
def a25(spark, d):
    """Each arm's median against the control arm's: pending below 20 cases."""
    s = scan(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("arm")).agg(F.median("o_totalprice").alias("med"), F.count("*").alias("n"))
    control = s.filter("arm = '1-URGENT'").select(F.col("med").alias("control"))  # one row
    cut = 1 - F.col("med") / F.col("control")
    return s.join(F.broadcast(control)).select("arm", F.round(cut, 6).alias("reduction"), F.when(F.col("n") < 20, "pending").when(cut >= 0, "pass").otherwise("fail").alias("gate"))


@query("a26_inventory", "SELECT o_orderstatus AS state, year(o_orderdate)::INT AS year, count(*) AS n, min(o_orderkey) AS oldest FROM orders GROUP BY 1, 2")
def a26(spark, d):
    return scan(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("state"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("oldest"))


@query("a29_origin_summary", "SELECT l_partkey, count(DISTINCT l_suppkey) AS origins, string_agg(DISTINCT l_suppkey::VARCHAR, '+' ORDER BY l_suppkey::VARCHAR) AS names, count(*) AS reports FROM lineitem GROUP BY 1")
def a29(spark, d):
    g = scan(spark, d, "lineitem").groupBy("l_partkey").agg(F.array_sort(F.collect_set(F.col("l_suppkey").cast("string"))).alias("s"), F.count("*").alias("reports"))
    return g.select("l_partkey", F.size("s").cast("long").alias("origins"), F.array_join("s", "+").alias("names"), "reports")


@query("a30_source_conflicts", "SELECT l_partkey, l_suppkey, count(DISTINCT l_returnflag) AS versions, min(l_returnflag) AS low, max(l_returnflag) AS high FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_returnflag) > 1")
def a30(spark, d):
    return scan(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count_distinct("l_returnflag").alias("versions"), F.min("l_returnflag").alias("low"), F.max("l_returnflag").alias("high")).filter("versions > 1")


@query("j09_newest_packet", """WITH p AS (SELECT l_orderkey, arg_max(l_shipmode, (l_shipdate, l_linenumber, l_shipmode)) AS packet FROM (SELECT *, l_linestatus AS l_shipmode FROM lineitem WHERE l_discount >= 0.05) GROUP BY 1), f AS (SELECT l_orderkey, min(l_linestatus) AS packet FROM lineitem WHERE l_discount < 0.02 GROUP BY 1)
    SELECT o_orderkey, coalesce(p.packet, f.packet, 'none') AS packet FROM orders LEFT JOIN p ON p.l_orderkey = o_orderkey LEFT JOIN f ON f.l_orderkey = o_orderkey""")
def j09(spark, d):
    """Every event head with its newest packet, else its fallback."""
    li = scan(spark, d, "lineitem")
    p = li.filter("l_discount >= 0.05").groupBy("l_orderkey").agg(F.max_by("l_linestatus", F.struct("l_shipdate", "l_linenumber", "l_linestatus")).alias("p"))
    f = li.filter("l_discount < 0.02").groupBy("l_orderkey").agg(F.min("l_linestatus").alias("f"))
    o = scan(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return o.join(p, "l_orderkey", "left").join(f, "l_orderkey", "left").select(F.col("l_orderkey").alias("o_orderkey"), F.coalesce("p", "f", F.lit("none")).alias("packet"))


@query("j10_dependents", """SELECT DISTINCT s_suppkey AS evidence, o_orderkey AS event FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN orders ON o_orderkey = l_orderkey WHERE s_acctbal < 0 AND starts_with(o_orderpriority, '1')""")
def j10(spark, d):
    """Events that rest on withdrawn evidence, through the lines that name both."""
    s = scan(spark, d, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("evidence"))
    o = scan(spark, d, "orders").filter(F.col("o_orderpriority").startswith("1")).select(F.col("o_orderkey").alias("event"))
    li = scan(spark, d, "lineitem").select(F.col("l_suppkey").alias("evidence"), F.col("l_orderkey").alias("event"))
    return li.join(s, "evidence").join(o, "event").select("evidence", "event").distinct()


@query("j12_alias_join", """WITH a AS (SELECT item_id, list_transform(string_split(lower(regexp_extract(text, '^([^ ]+ [^ ]+)')), ' '), lambda x: x) AS w, lower(regexp_extract(text, '^([^ ]+ [^ ]+)')) AS alias FROM benchmark WHERE regexp_matches(text, '^[a-z]+ [a-z]+ ', 'i')),
    t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL), b AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram FROM t WHERE len(w) > 1)
    SELECT DISTINCT doc_id, min(item_id) OVER (PARTITION BY doc_id, alias) AS item_id, alias FROM b JOIN a ON alias = bigram""")
def j12(spark, d):
    """Documents by the two-word aliases they name: texts become word pairs, which meet the aliases by equality, not by a pattern for each."""
    named = scan(spark, d, "benchmark").filter(F.col("text").rlike("(?i)^[a-z]+ [a-z]+ ")).select("item_id", F.lower(F.regexp_extract("text", "^([^ ]+ [^ ]+)", 1)).alias("alias")).groupBy("alias").agg(F.min("item_id").alias("item_id"))
    words = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda x: x != "")
    t = scan(spark, d, "documents").select("doc_id", words.alias("w")).filter(F.size("w") > 1)
    pairs = t.select("doc_id", F.explode(F.array_distinct(F.zip_with(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w") - 1), lambda a, b: F.concat_ws(" ", a, b)))).alias("alias"))
    return pairs.join(F.broadcast(named), "alias").select("doc_id", "item_id", "alias").distinct()


@query("j18_ownership", """WITH o AS (SELECT l_partkey, count(DISTINCT l_suppkey) AS owners, max(l_quantity) / sum(l_quantity) AS stake FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), c AS (SELECT count(*) FILTER (l_suppkey IS NULL) = 0 AS complete FROM lineitem)
    SELECT p_partkey, CASE WHEN owners IS NOT NULL THEN round(100 * stake, 4) WHEN complete THEN 100.0 END AS percent, CASE WHEN owners IS NOT NULL THEN 'stated' WHEN complete THEN 'documented_absence' ELSE 'unknown' END AS basis FROM part LEFT JOIN o ON l_partkey = p_partkey, c""")
def j18(spark, d):
    """A stated stake, or, where none is and the table of owners is complete, all of it."""
    li = scan(spark, d, "lineitem")
    o = li.filter("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("p_partkey")).agg((F.max("l_quantity") / F.sum("l_quantity")).alias("stake"))
    c = li.agg((F.count_if(F.col("l_suppkey").isNull()) == 0).alias("complete"))  # one row
    j = scan(spark, d, "part").select("p_partkey").join(o, "p_partkey", "left").join(F.broadcast(c))
    return j.select("p_partkey", F.when(F.col("stake").isNotNull(), F.round(100 * F.col("stake"), 4)).when(F.col("complete"), 100.0).alias("percent"), F.when(F.col("stake").isNotNull(), "stated").when(F.col("complete"), "documented_absence").otherwise("unknown").alias("basis"))


@query("o04_focus", """WITH e AS (SELECT user_id, event_type, event_id, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS k FROM events WHERE value >= 1 AND ts >= TIMESTAMP '2024-01-05' AND event_type <> 'error'),
    g AS (SELECT user_id, count(*) AS breadth, sum(value) AS impact, max(value) AS best FROM e WHERE k = 1 GROUP BY 1 HAVING count(*) >= 2) SELECT user_id, breadth, round(impact, 2) AS impact, row_number() OVER (ORDER BY breadth DESC, round(impact, 2) DESC, user_id)::INT AS rank FROM g ORDER BY rank LIMIT 20""")
def o04(spark, d):
    """Subjects over the floors (relevance, timeliness, authority, two kinds of evidence), by their best evidence of each kind; the first twenty."""
    e = scan(spark, d, "events").filter("value >= 1 and ts >= timestamp_ntz'2024-01-05' and event_type <> 'error'")
    best = m.top_per(e, ["user_id", "event_type"], [F.col("value").desc(), F.col("event_id")], 1)
    g = best.groupBy("user_id").agg(F.count("*").alias("breadth"), F.round(F.sum("value"), 2).alias("impact")).filter("breadth >= 2")
    order = [F.col("breadth").desc(), F.col("impact").desc(), F.col("user_id")]
    return g.orderBy(*order).limit(20).withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # over twenty rows


@query("o09_catalyst_order", """SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 0 ELSE 1 END, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN epoch(o_orderdate) ELSE -epoch(o_orderdate) END, o_orderkey)::INT AS position FROM orders""")
def o09(spark, d):
    """Coming dates first, the soonest ahead; past ones after them, the latest ahead."""
    days = F.datediff("o_orderdate", F.lit("1998-01-01").cast("date"))
    order = Window.partitionBy("o_custkey").orderBy((days < 0), F.abs(days), "o_orderkey")
    return scan(spark, d, "orders").select("o_custkey", "o_orderkey", F.row_number().over(order).alias("position"))


@query("o11_brief_cards", """WITH c AS (SELECT ts::DATE AS run, md5(user_id || '|' || event_type) AS digest, max(value) AS materiality, min(event_id) AS event_id FROM events GROUP BY 1, 2)
    SELECT run, position, event_id, materiality FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY materiality DESC, event_id)::INT AS position FROM c) WHERE position <= 5""")
def o11(spark, d):
    """Cards of a run: one for each semantic digest, the five most material."""
    c = scan(spark, d, "events").groupBy(F.to_date("ts").alias("run"), F.md5(F.concat(F.col("user_id").cast("string"), F.lit("|"), "event_type")).alias("digest")).agg(F.max("value").alias("materiality"), F.min("event_id").alias("event_id"))
    return m.top_per(c, ["run"], [F.col("materiality").desc(), F.col("event_id")], 5).select("run", "position", "event_id", "materiality")


@query("o12_work_queue", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderdate, o_orderkey LIMIT 1000")
def o12(spark, d):
    return m.top(scan(spark, d, "orders").filter("o_orderstatus = 'P'"), [F.col("o_orderdate"), F.col("o_orderkey")], 1000).select("o_orderkey")


@query("d05_same_headline", f"""WITH RECURSIVE {STORY}, kept AS (SELECT doc_id, first_value(doc_id) OVER (PARTITION BY component ORDER BY n_chars DESC, doc_id) AS kept FROM g JOIN documents USING (doc_id)) SELECT doc_id, kept FROM kept WHERE doc_id <> kept""")
def d05(spark, d):
    """Headlines that go, and the one of their story that stays."""
    j = stories(spark, d).withColumnRenamed("node", "doc_id").join(scan(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    best = j.groupBy("component").agg(F.max(F.struct("n_chars", (-F.col("doc_id")).alias("back"))).alias("x")).select("component", (-F.col("x.back")).alias("kept"))
    return j.join(best, "component").filter("doc_id <> kept").select("doc_id", "kept")


@query("g11_origin_count", """WITH RECURSIVE e AS (SELECT DISTINCT a.l_suppkey AS x, b.l_suppkey AS y FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey AND a.l_suppkey <> b.l_suppkey),
    r(node, reach) AS (SELECT s_suppkey, s_suppkey FROM supplier UNION SELECT r.node, e.y FROM r JOIN e ON e.x = r.reach), c AS (SELECT node, min(reach) AS origin FROM r GROUP BY 1) SELECT l_partkey, count(DISTINCT origin) AS origins FROM lineitem JOIN c ON node = l_suppkey GROUP BY 1""")
def g11(spark, d):
    """Independent origins of each claim: sources that reviewed edges join are one."""
    li = scan(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    star = li.groupBy("l_orderkey", "l_partkey").agg(F.min("l_suppkey").alias("v"))
    edges = li.join(star, ["l_orderkey", "l_partkey"]).select(F.col("l_suppkey").alias("u"), "v").filter("u <> v").distinct()
    c = gr.components(scan(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("node")), edges)
    return li.join(c, F.col("node") == F.col("l_suppkey")).groupBy("l_partkey").agg(F.count_distinct("component").alias("origins"))


@query("g06_event_members", """SELECT conv_id, string_agg(turn::VARCHAR, '+' ORDER BY turn) AS members, count(DISTINCT role) AS links FROM conversations WHERE turn < 6 GROUP BY 1""")
def g06(spark, d):
    """Events with those of their members that are in view."""
    g = scan(spark, d, "conversations").filter("turn < 6").groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("t"), F.count_distinct("role").alias("links"))
    return g.select("conv_id", F.array_join(F.transform("t", lambda x: x.cast("string")), "+").alias("members"), "links")


@query("k01_to_utc", """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 3 THEN date_trunc('day', o_orderdate) WHEN 4 THEN NULL ELSE date_trunc('second', o_orderdate) END AS at FROM orders""")
def k01(spark, d):
    """Dates as publishers write them: ISO with Z and with an offset, RFC-2822, without an offset, nonsense, epoch seconds."""
    at = F.col("o_orderdate").cast("timestamp")
    east = at + F.expr("interval 2 hours")
    texts = [F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.concat(F.date_format(east, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")), F.concat(F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")), F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit("soon"), F.unix_timestamp(at).cast("string")]
    text = F.get(F.array(*texts), (F.col("o_orderkey") % 6).cast("int"))
    return scan(spark, d, "orders").select("o_orderkey", sc.to_utc(text).cast("timestamp_ntz").alias("at"))


@query("k04_precision_intervals", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN date_trunc('day', o_orderdate) WHEN 1 THEN date_trunc('month', o_orderdate) WHEN 2 THEN date_trunc('quarter', o_orderdate) ELSE date_trunc('year', o_orderdate) END::DATE AS low,
    CASE o_orderkey % 4 WHEN 0 THEN date_trunc('day', o_orderdate) + INTERVAL 1 DAY WHEN 1 THEN date_trunc('month', o_orderdate) + INTERVAL 1 MONTH WHEN 2 THEN date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH ELSE date_trunc('year', o_orderdate) + INTERVAL 1 YEAR END::DATE AS high FROM orders""")
def k04(spark, d):
    """Dates of day, month, quarter and year precision, as text, to half-open intervals."""
    at = F.col("o_orderdate")
    texts = [F.date_format(at, "yyyy-MM-dd"), F.date_format(at, "yyyy-MM"), F.concat(F.year(at).cast("string"), F.lit("-Q"), F.quarter(at).cast("string")), F.year(at).cast("string")]
    text = F.get(F.array(*texts), (F.col("o_orderkey") % 4).cast("int"))
    low, high = sc.precision_interval(text)
    return scan(spark, d, "orders").select("o_orderkey", low.alias("low"), high.alias("high"))


@query("k11_keyword_plural", """SELECT doc_id, least(3, regexp_matches(text, '\\b(?:the)s?\\b', 'i')::INT + regexp_matches(text, '\\b(?:and)s?\\b', 'i')::INT + regexp_matches(text, '\\b(?:of)s?\\b', 'i')::INT + regexp_matches(text, '\\b(?:password)s?\\b', 'i')::INT) AS score FROM documents WHERE text IS NOT NULL""")
def k11(spark, d):
    """Keywords at word boundaries, each with an optional plural s, once each and three at most."""
    hits = sum((F.col("text").rlike(rf"(?i)\b(?:{k})s?\b").cast("int") for k in ("the", "and", "of", "password")), F.lit(0))
    return scan(spark, d, "documents").filter("text is not null").select("doc_id", F.least(F.lit(3), hits).alias("score"))


@query("k17_name_key", """SELECT c_custkey, list_aggregate(list_slice(list_filter(string_split(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '' AND x NOT IN ('inc', 'corp', 'the', 'co', 'customer')), 1, 2), 'string_agg', ' ') AS key FROM customer""")
def k17(spark, d):
    return scan(spark, d, "customer").select("c_custkey", sc.name_key(F.col("c_name"), ("inc", "corp", "the", "co", "customer")).alias("key"))


@query("k23_decimal", "SELECT o_orderkey, (o_totalprice::DECIMAL(38, 4) * 3)::VARCHAR AS thrice, CASE WHEN o_orderkey % 5 <> 0 THEN (o_totalprice::DECIMAL(18, 2))::VARCHAR END AS parsed FROM orders")
def k23(spark, d):
    """Decimal text, strictly: what isn't a plain number is NULL; arithmetic doesn't round."""
    text = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("x"))).otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    return scan(spark, d, "orders").select("o_orderkey", (F.col("o_totalprice").cast("decimal(38,4)") * 3).cast("decimal(38,4)").cast("string").alias("thrice"), F.when(text.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), text).try_cast("decimal(18,2)").cast("string").alias("parsed"))


@query("k25_nested", """WITH g AS (SELECT l_orderkey, list(l_quantity) AS q, list(l_discount) AS x FROM lineitem GROUP BY 1) SELECT l_orderkey, list_max(q) AS most, list_min(q) AS least, list_aggregate(list_transform(x, lambda v: v >= 0.05), 'bool_or') AS any_high, list_aggregate(list_transform(x, lambda v: v >= 0.05), 'bool_and') AS all_high FROM g""")
def k25(spark, d):
    """Over nested values; folded while they are grouped, so no list is built."""
    high = F.col("l_discount") >= 0.05
    return scan(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_quantity").alias("most"), F.min("l_quantity").alias("least"), F.bool_or(high).alias("any_high"), F.bool_and(high).alias("all_high"))


@query("k26_code_counts", """WITH c AS (SELECT l_suppkey, l_returnflag AS code, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT l_suppkey, string_agg(code || '=' || n, ',' ORDER BY code) AS codes FROM c GROUP BY 1""")
def k26(spark, d):
    c = scan(spark, d, "lineitem").groupBy("l_suppkey", F.col("l_returnflag").alias("code")).agg(F.count("*").alias("n"))
    g = c.groupBy("l_suppkey").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "n")))).alias("m"))
    return g.select("l_suppkey", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("codes"))


@query("k27_canonical_json", """SELECT c_custkey, sha256('{"balance":"' || c_acctbal::DECIMAL(18, 2)::VARCHAR || '","name":"' || c_name || '","nation":' || c_nationkey || '}') AS digest FROM customer""")
def k27(spark, d):
    """Keys in alphabetical order, no spaces, numbers as exact text: equal records have equal digests."""
    return scan(spark, d, "customer").select("c_custkey", F.sha2(sc.canonical_json(nation=F.col("c_nationkey"), name=F.col("c_name"), balance=F.col("c_acctbal").cast("decimal(18,2)").cast("string")), 256).alias("digest"))


@query("f05_non_finite", """SELECT event_id, CASE WHEN event_id % 5 IN (1, 2) THEN NULL ELSE value END AS value, CASE WHEN event_id % 7 = 3 THEN NULL ELSE value * 2 END AS twice, concat_ws('+', CASE WHEN event_id % 5 IN (1, 2) THEN 'value' END, CASE WHEN event_id % 7 = 3 THEN 'twice' END) AS nulled FROM events""")
def f05(spark, d):
    """Numbers that JSON doesn't know become NULL, and the row says where."""
    i = F.col("event_id")
    rows = scan(spark, d, "events").select("event_id", F.when(i % 5 == 1, float("nan")).when(i % 5 == 2, float("inf")).otherwise(F.col("value")).alias("value"), F.when(i % 7 == 3, float("-inf")).otherwise(F.col("value") * 2).alias("twice"))
    return sc.finite_columns(rows, ["value", "twice"])


@query("t04_future_dated", "SELECT event_id, ts FROM events WHERE ts <= TIMESTAMP '2024-01-20'")
def t04(spark, d):
    """Nothing dated after the run's clock is taken in."""
    return m.freshness(scan(spark, d, "events"), "ts", "2024-01-20", 36500).filter("drop_reason is null or drop_reason <> 'future'").select("event_id", "ts")


@query("t05_trimmed_state", "SELECT key, session, value FROM (SELECT user_id AS key, ts::DATE AS session, count(*) AS value, row_number() OVER (PARTITION BY user_id ORDER BY ts::DATE DESC) AS k FROM events GROUP BY 1, 2) WHERE k <= 20")
def t05(spark, d):
    """The newest 20 rows of each key's rolling state."""
    daily = scan(spark, d, "events").groupBy(F.col("user_id").alias("key"), F.to_date("ts").alias("session")).agg(F.count("*").alias("value"))
    return m.top_per(daily, ["key"], [F.col("session").desc()], 20).drop("position")


@query("t06_same_day_rerun", "SELECT o_custkey, o_orderdate::DATE AS run, arg_max(o_totalprice, o_orderkey) AS value FROM orders GROUP BY 1, 2")
def t06(spark, d):
    """A key's value of a day is that of the day's last run."""
    return scan(spark, d, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("run")).agg(F.max_by("o_totalprice", "o_orderkey").alias("value"))
