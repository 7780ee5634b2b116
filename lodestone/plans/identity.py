"""Identities, graphs, views and ladders on the driver's tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.functions import scalars as s
from lodestone.operators import graph as gr
from lodestone.operators import matching as m
from lodestone.plans.technicals import rounded
from lodestone.sources.tables import BARS_SQL, bars, scan

TITLES = """t AS (SELECT doc_id, regexp_replace(trim(regexp_replace(lower(split_part(text, chr(10), 1)), '[^\\p{L}\\p{N}]+', ' ', 'g')), '^((breaking|update|exclusive) )+', '') AS key FROM documents)"""
STORY = f"""{TITLES}, k AS (SELECT doc_id, key, list_distinct(string_split(key, ' ')) AS s FROM t), o AS (SELECT doc_id, len(s) AS n, unnest(s) AS w FROM k WHERE len(s) >= 6),
    c AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS n, any_value(b.n) AS q, count(*) AS c FROM o a JOIN o b ON a.w = b.w AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    e AS (SELECT x, y FROM c WHERE least(n, q) * 100 >= greatest(n, q) * 85 AND c * 100 >= (n + q - c) * 85 UNION SELECT a.doc_id, b.doc_id FROM t a JOIN t b ON a.key = b.key AND a.key <> '' AND a.doc_id <> b.doc_id),
    r(node, reach) AS (SELECT doc_id, doc_id FROM t UNION SELECT r.node, e.y FROM r JOIN e ON e.x = r.reach), g AS (SELECT node AS doc_id, min(reach) AS component FROM r GROUP BY 1)"""


def stories(spark, d):
    title = s.title_key(F.substring_index("text", "\n", 1))
    docs = gr.stored(scan(spark, d, "documents").select(F.col("doc_id").alias("node"), title.alias("key")))
    edges = gr.equal_edges(docs, "node", "key").unionByName(gr.token_edges(docs.withColumn("s", F.split("key", " ")), "node", "s"))
    return gr.components(docs.select("node"), edges)


@query("g01_components", f"WITH RECURSIVE {STORY} SELECT * FROM g")
def g01(spark, d):
    return stories(spark, d).select(F.col("node").alias("doc_id"), "component")


@query("g02_novelty", f"WITH RECURSIVE {STORY}, n AS (SELECT component, count(*) AS n FROM g GROUP BY 1) SELECT doc_id, n = 1 AS novel FROM g JOIN n USING (component)")
def g02(spark, d):
    c = stories(spark, d)
    return c.join(c.groupBy("component").agg(F.count("*").alias("n")), "component").select(F.col("node").alias("doc_id"), (F.col("n") == 1).alias("novel"))


@query("o03_representative", f"""WITH RECURSIVE {STORY} SELECT doc_id, component, n_chars FROM (SELECT g.*, n_chars, row_number() OVER (PARTITION BY component ORDER BY n_chars DESC, doc_id) AS k FROM g JOIN documents USING (doc_id)) WHERE k = 1""")
def o03(spark, d):
    j = stories(spark, d).withColumnRenamed("node", "doc_id").join(scan(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return m.top_per(j, ["component"], [F.col("n_chars").desc(), F.col("doc_id")], 1).select("doc_id", "component", "n_chars")


@query("g03_cycle_reach", "WITH RECURSIVE e AS (SELECT n_nationkey AS src, ((n_nationkey * 7 + 3) % 25)::INT AS dst FROM nation), r(u, v) AS (SELECT src, dst FROM e UNION SELECT r.u, e.dst FROM r JOIN e ON e.src = r.v) SELECT u, v FROM r")
def g03(spark, d):
    edges = scan(spark, d, "nation").select(F.col("n_nationkey").alias("src"), ((F.col("n_nationkey") * 7 + 3) % 25).cast("int").alias("dst"))
    return gr.reachable(spark, edges)


@query("g04_effective_rows", """WITH v AS (SELECT event_id, lag(event_id) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS sup, ts FROM events), i AS (SELECT * FROM v WHERE ts < TIMESTAMP '2024-01-15') SELECT event_id FROM i WHERE event_id NOT IN (SELECT sup FROM i WHERE sup IS NOT NULL)""")
def g04(spark, d):
    w = Window.partitionBy("user_id", "event_type").orderBy("event_id")
    v = scan(spark, d, "events").withColumn("sup", F.lag("event_id").over(w)).filter("ts < timestamp_ntz'2024-01-15'")
    return gr.effective(v.select("event_id", "sup"), "event_id", "sup").select("event_id")


KNOWN = """s AS (SELECT l_orderkey AS version, min(greatest(l_shipdate::DATE, (o_orderdate + INTERVAL 30 DAYS)::DATE)) AS first_known, any_value(o_orderdate::DATE) AS published, any_value(o_custkey) AS cust FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)"""


def view(spark, d, cutoff, retrospective=False):
    o = scan(spark, d, "orders").select(F.col("o_orderkey").alias("version"), F.to_date("o_orderdate").alias("published"), F.col("o_custkey").alias("cust"))
    seen = scan(spark, d, "lineitem").select(F.col("l_orderkey").alias("version"), F.to_date("l_shipdate").alias("observed")).join(o, "version").withColumn("corrected", F.date_add("published", 30)).select("version", "observed", "corrected")
    return gr.knowledge_view(o, seen, cutoff, retrospective)


@query("g05_knowledge_view", f"WITH {KNOWN} SELECT version, first_known, 'as_operated' AS mode FROM s WHERE first_known <= DATE '1997-01-01' UNION ALL SELECT version, first_known, 'retrospective' FROM s WHERE published <= DATE '1997-01-01'")
def g05(spark, d):
    one = lambda r, name: view(spark, d, "1997-01-01", r).select("version", "first_known", F.lit(name).alias("mode"))
    return one(False, "as_operated").unionByName(one(True, "retrospective"))


@query("g09_packet_diff", f"""WITH {KNOWN}, a AS (SELECT cust, max(version) AS was FROM s WHERE first_known <= DATE '1997-01-01' GROUP BY 1), b AS (SELECT cust, max(version) AS now FROM s WHERE first_known <= DATE '1997-03-01' GROUP BY 1)
    SELECT cust, was, now, CASE WHEN was IS NULL THEN 'new' WHEN now IS NULL THEN 'withdrawn' WHEN was <> now THEN 'changed' ELSE 'unchanged' END AS state FROM a FULL JOIN b USING (cust)""")
def g09(spark, d):
    claims = lambda c: view(spark, d, c).groupBy("cust").agg(F.max("version").alias("v"))
    return gr.packet(claims("1997-01-01"), claims("1997-03-01"), "cust", "v")


@query("g12_ref_integrity", """SELECT l_orderkey, l_linenumber, l_partkey, concat_ws('+', CASE WHEN o_orderkey IS NULL THEN 'missing' END, CASE WHEN l_shipdate < o_orderdate THEN 'from_future' END, CASE WHEN p_partkey IS NULL THEN 'unknown_part' END) AS reasons
    FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey AND p_size <= 45 WHERE o_orderkey IS NULL OR l_shipdate < o_orderdate OR p_partkey IS NULL""")
def g12(spark, d):
    o, p = scan(spark, d, "orders").select("o_orderkey", "o_orderdate"), scan(spark, d, "part").filter("p_size <= 45").select("p_partkey")
    j = scan(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
    why = F.concat_ws("+", F.when(F.col("o_orderkey").isNull(), "missing"), F.when(F.col("l_shipdate") < F.col("o_orderdate"), "from_future"), F.when(F.col("p_partkey").isNull(), "unknown_part"))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", why.alias("reasons")).filter("reasons <> ''")


@query("g18_latency", "SELECT o_orderpriority AS stratum, count(*) AS n, quantile_disc(l_shipdate::DATE - o_orderdate::DATE, 0.95)::INT AS p95_days FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1")
def g18(spark, d):
    o = scan(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", F.col("o_orderpriority").alias("stratum"))
    j = scan(spark, d, "lineitem").join(o, "l_orderkey").withColumn("days", F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")))
    return j.groupBy("stratum").agg(F.count("*").alias("n"), F.expr("percentile_disc(0.95) within group (order by days)").cast("int").alias("p95_days"))


@query("k10_asset_class", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'index' WHEN p_partkey % 4 = 1 THEN 'future' WHEN p_partkey % 4 = 2 THEN 'etf' ELSE 'equity' END AS class FROM part")
def k10(spark, d):
    symbol = F.when(F.col("p_partkey") % 4 == 0, "^VIX").when(F.col("p_partkey") % 4 == 1, "ES=F").when(F.col("p_partkey") % 4 == 2, "SPY").otherwise("ABC")
    return scan(spark, d, "part").select("p_partkey", s.asset_class(symbol, ("SPY",)).alias("class"))


@query("k18_bucket", "SELECT c_custkey, CASE WHEN abs(c_acctbal) < 3000 THEN 'low' WHEN abs(c_acctbal) < 5000 THEN 'mid' ELSE 'high' END AS bucket FROM customer")
def k18(spark, d):
    return scan(spark, d, "customer").select("c_custkey", s.bucket(F.col("c_acctbal"), (3000, 5000), ("low", "mid", "high")).alias("bucket"))


@query("k20_runway_ladder", """WITH b AS (SELECT c_custkey, c_acctbal, coalesce(sum(o_totalprice) / 1e4 / 4, 0) AS burn FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY 1, 2), q AS (SELECT *, CASE WHEN c_acctbal > 0 AND burn > 0 THEN c_acctbal / burn END AS q FROM b)
    SELECT c_custkey, round(q, 4) AS quarters, CASE WHEN q < 4 THEN 'RED' WHEN q <= 6 THEN 'YELLOW' WHEN q > 6 THEN 'GREEN' WHEN burn <= 0 THEN 'not_burning' ELSE 'unknown' END AS risk FROM q""")
def k20(spark, d):
    o = scan(spark, d, "orders").filter("o_orderdate >= timestamp_ntz'2001-01-01'").groupBy(F.col("o_custkey").alias("c_custkey")).agg((F.sum("o_totalprice") / 1e4 / 4).alias("burn"))
    j = scan(spark, d, "customer").join(o, "c_custkey", "left").fillna(0.0, ["burn"])
    quarters, risk = s.runway(F.col("c_acctbal"), F.col("burn"))
    return j.select("c_custkey", F.round(quarters, 4).alias("quarters"), risk.alias("risk"))


@query("k21_trade_cost", "SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * CASE l_returnflag WHEN 'R' THEN 10 ELSE 12 END / 10000 + 1, 6) AS cost FROM lineitem")
def k21(spark, d):
    side = F.when(F.col("l_returnflag") == "R", "buy").otherwise("sell")
    return rounded(scan(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", s.trade_cost(F.col("l_extendedprice"), side, 10, 12, 1.0).alias("cost")), "cost")


@query("k28_record_id", "SELECT event_id, substr(sha256('events|' || user_id || '|' || event_type), 1, 16) AS record_id FROM events")
def k28(spark, d):
    return scan(spark, d, "events").select("event_id", s.record_id("events", F.col("user_id"), F.col("event_type")).alias("record_id"))


@query("k02_oldest_newest", "WITH o AS (SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS a, max(CASE WHEN o_orderstatus = 'P' THEN o_orderdate END) AS b FROM orders GROUP BY 1) SELECT o_custkey, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN least(a, b) END AS oldest, greatest(a, b) AS newest FROM o")
def k02(spark, d):
    of = lambda status: F.max(F.when(F.col("o_orderstatus") == status, F.col("o_orderdate")))
    o = scan(spark, d, "orders").groupBy("o_custkey").agg(of("F").alias("a"), of("P").alias("b"))
    return o.select("o_custkey", s.oldest(F.col("a"), F.col("b")).alias("oldest"), s.newest(F.col("a"), F.col("b")).alias("newest"))


@query("k05_interval_order", """WITH i AS (SELECT user_id, event_type, min(ts) AS a, max(ts) AS b FROM events WHERE ts < TIMESTAMP '2024-01-04' GROUP BY 1, 2) SELECT x.user_id, x.event_type, y.event_type AS other, CASE WHEN x.b < y.a THEN 'before' WHEN x.a >= y.b THEN 'not_before' ELSE 'undetermined' END AS state FROM i x JOIN i y ON x.user_id = y.user_id AND x.event_type < y.event_type""")
def k05(spark, d):
    i = scan(spark, d, "events").filter("ts < timestamp_ntz'2024-01-04'").groupBy("user_id", "event_type").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    y = i.select("user_id", F.col("event_type").alias("other"), F.col("a").alias("c"), F.col("b").alias("e"))
    return i.join(y, "user_id").filter("event_type < other").select("user_id", "event_type", "other", s.interval_order(F.col("a"), F.col("b"), F.col("c"), F.col("e")).alias("state"))


#: Page addresses as they come: upper-case schemes, ports, fragments, doubled slashes, campaign tags, and some that are none.
_COME = ["{u}", "HTTP://User@WWW.{h}:8080//{p}//?b=2&UTM_Source=x&a=1&A=0&c#top", "https://m.{h}/?fbclid=1&amp;z=&y=3", "https://amp.{h}", "{h}/{p}", "  ", "https://news.{h}/{p}/?utm_term=q#x"]
_COME_SQL = """raw AS (SELECT page_id, regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1) AS h, url FROM pages),
    come AS (SELECT page_id, CASE page_id % 7 WHEN 0 THEN url WHEN 1 THEN 'HTTP://User@WWW.' || h || ':8080//p' || page_id || '//?b=2&UTM_Source=x&a=1&A=0&c#top' WHEN 2 THEN 'https://m.' || h || '/?fbclid=1&amp;z=&y=3' WHEN 3 THEN 'https://amp.' || h WHEN 4 THEN h || '/p' || page_id WHEN 5 THEN '  ' ELSE 'https://news.' || h || '/p' || page_id || '/?utm_term=q#x' END AS url FROM raw)"""


def _addresses(spark, d):
    host = F.regexp_extract("url", "^[a-zA-Z]+://([^/?#]*)", 1)
    text = F.get(F.array(*map(F.lit, _COME)), (F.col("page_id") % 7).cast("int"))
    text = F.replace(F.replace(F.replace(text, F.lit("{u}"), F.col("url")), F.lit("{h}"), host), F.lit("{p}"), F.concat(F.lit("p"), F.col("page_id").cast("string")))
    return scan(spark, d, "pages").select("page_id", text.alias("url"))


@query("f15_canonical_url", f"""WITH {_COME_SQL}, u AS (SELECT page_id, trim(url) AS raw, lower(regexp_extract(url, '^([a-zA-Z]+)://', 1)) AS s, lower(regexp_extract(url, '^[a-zA-Z]+://(?:[^/?#@]*@)?([^/?#]*)', 1)) AS h, regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '/+', '/', 'g') AS p,
        list_transform(list_filter(string_split(regexp_extract(replace(url, '&amp;', '&'), '\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_') AND lower(split_part(x, '=', 1)) NOT IN ('ref', 'fbclid', 'gclid')), lambda x: CASE WHEN contains(x, '=') THEN x ELSE x || '=' END) AS q FROM come),
    o AS (SELECT *, array_to_string(list_transform(list_sort(list_transform(q, lambda x: {{'k': lower(split_part(x, '=', 1)), 'v': regexp_replace(x, '^[^=]*=', ''), 'p': x}})), lambda x: x.p), '&') AS asked FROM u)
    SELECT page_id, CASE WHEN raw = '' THEN NULL WHEN h = '' THEN raw ELSE s || '://' || h || CASE WHEN p = '/' THEN p ELSE regexp_replace(p, '/$', '') END || CASE WHEN asked <> '' THEN '?' || asked ELSE '' END END AS url FROM o""")
def f15(spark, d):
    return _addresses(spark, d).select("page_id", s.canonical_url(F.col("url")).alias("url"))


@query("k09_domain", f"""WITH {_COME_SQL}, d AS (SELECT regexp_replace(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://(?:[^/?#@]*@)?([^/?#]*)', 1)), ':\\d+$', ''), '^(www|m|amp)\\.', '') AS h FROM come)
    SELECT CASE WHEN h = 'example.org' OR ends_with(h, '.example.org') THEN 'example.org' ELSE h END AS domain, count(*) AS n FROM d GROUP BY 1""")
def k09(spark, d):
    return _addresses(spark, d).groupBy(s.domain(F.col("url"), ("example.org",)).alias("domain")).agg(F.count("*").alias("n"))


@query("f04_finite_price", f"WITH {BARS_SQL} SELECT symbol, count(CASE WHEN close - 50000 > 0 THEN 1 END) AS priced, count(*) AS n FROM bars GROUP BY 1")
def f04(spark, d):
    return bars(spark, d).groupBy("symbol").agg(F.count(s.finite_positive(F.col("close") - 50000)).alias("priced"), F.count("*").alias("n"))


@query("x01_latest_bar", f"WITH {BARS_SQL} SELECT symbol, session, close, round(close / open - 1, 6) AS change FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY session DESC) AS k FROM bars) WHERE k = 1")
def x01(spark, d):
    t = m.top_per(bars(spark, d), ["symbol"], [F.col("session").desc()], 1)
    return rounded(t.select("symbol", "session", "close", (F.col("close") / F.col("open") - 1).alias("change")), "change")


@query("x14_cache_lookup", """WITH c AS (SELECT o_custkey, o_orderdate::DATE AS cached, max(o_totalprice) AS cap FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1, 2), q AS (SELECT o_orderkey, o_custkey, o_orderdate::DATE AS day FROM orders WHERE o_orderkey % 2 = 1)
    SELECT o_orderkey, cap FROM (SELECT q.o_orderkey, cap, row_number() OVER (PARTITION BY q.o_orderkey ORDER BY cached DESC NULLS LAST) AS k FROM q LEFT JOIN c ON c.o_custkey = q.o_custkey AND q.day - cached BETWEEN 0 AND 7) WHERE k = 1""")
def x14(spark, d):
    o = scan(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    c = o.filter("o_orderkey % 2 = 0").groupBy("o_custkey", F.col("day").alias("cached")).agg(F.max("o_totalprice").alias("cap"))
    # An age bound makes the as-of join an equi-join: each cached value serves the eight days from its own on.
    serves = c.withColumn("day", F.explode(F.sequence("cached", F.date_add("cached", 7))))
    newest = serves.groupBy("o_custkey", "day").agg(F.max_by("cap", "cached").alias("cap"))
    return o.filter("o_orderkey % 2 = 1").select("o_orderkey", "o_custkey", "day").join(newest, ["o_custkey", "day"], "left").select("o_orderkey", "cap")


@query("x15_universe_censoring", """WITH u AS (SELECT c_custkey FROM customer), r AS (SELECT user_id, count(*) AS n FROM events WHERE ts::DATE = DATE '2024-01-10' GROUP BY 1) SELECT c_custkey, coalesce(n, 0)::BIGINT AS n, CASE WHEN n IS NOT NULL THEN 'observed' WHEN c_custkey < 150 THEN 'censored' ELSE 'unavailable' END AS state FROM u LEFT JOIN r ON user_id = c_custkey""")
def x15(spark, d):
    r = scan(spark, d, "events").filter(F.to_date("ts") == F.lit("2024-01-10").cast("date")).groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("n"))
    state = F.when(F.col("n").isNotNull(), "observed").when(F.col("c_custkey") < 150, "censored").otherwise("unavailable")
    return scan(spark, d, "customer").select("c_custkey").join(r, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"), state.alias("state"))


@query("x58_poll_gap", "SELECT event_type, round(max(epoch_us(n) - epoch_us(ts)) / 1e6, 3) AS gap_s FROM (SELECT event_type, ts, lead(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events) GROUP BY 1")
def x58(spark, d):
    w = Window.partitionBy("event_type").orderBy("ts", "event_id")
    e = scan(spark, d, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    return e.withColumn("gap", F.lead("us").over(w) - F.col("us")).groupBy("event_type").agg(F.round(F.max("gap") / 1e6, 3).alias("gap_s"))


@query("d03_set_difference", "SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-06-01'")
def d03(spark, d):
    return scan(spark, d, "part").select("p_partkey").subtract(scan(spark, d, "lineitem").filter("l_shipdate < timestamp_ntz'1995-06-01'").select("l_partkey"))


@query("j16_state_diff", """WITH s AS (SELECT user_id, ts::DATE AS day, arg_max(event_type, event_id) AS state, count(*) AS n FROM events GROUP BY 1, 2), p AS (SELECT *, lag(state) OVER h AS was, lag(n) OVER h AS wn FROM s WINDOW h AS (PARTITION BY user_id ORDER BY day))
    SELECT user_id, day, was, state, state IS DISTINCT FROM was AS flipped, abs(n - wn) > 0.1 * wn AS moved FROM p WHERE was IS NOT NULL""")
def j16(spark, d):
    day = scan(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max_by("event_type", "event_id").alias("state"), F.count("*").alias("n"))
    h = Window.partitionBy("user_id").orderBy("day")
    p = day.withColumns({"was": F.lag("state").over(h), "wn": F.lag("n").over(h)}).filter("was is not null")
    return p.select("user_id", "day", "was", "state", (F.col("state") != F.col("was")).alias("flipped"), (F.abs(F.col("n") - F.col("wn")) > 0.1 * F.col("wn")).alias("moved"))


@query("w08_top_entrance", """WITH d AS (SELECT ts::DATE AS day, user_id, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY n DESC, user_id) AS rank FROM d), t AS (SELECT * FROM r WHERE rank <= 40), k AS (SELECT day, row_number() OVER (ORDER BY day) AS run FROM (SELECT DISTINCT day FROM t)),
    x AS (SELECT user_id, run, day, run - lag(run) OVER (PARTITION BY user_id ORDER BY run) AS gap FROM t JOIN k USING (day)) SELECT user_id, day FROM x WHERE run > 5 AND (gap IS NULL OR gap > 5)""")
def w08(spark, d):
    day = scan(spark, d, "events").groupBy(F.to_date("ts").alias("day"), "user_id").agg(F.count("*").alias("n"))
    t = m.top_per(day, ["day"], [F.col("n").desc(), F.col("user_id")], 40)
    runs = t.select("day").distinct().withColumn("run", F.row_number().over(Window.orderBy("day")))  # a row per run
    x = t.join(F.broadcast(runs), "day").withColumn("gap", F.col("run") - F.lag("run").over(Window.partitionBy("user_id").orderBy("run")))
    return x.filter("run > 5 and (gap is null or gap > 5)").select("user_id", "day")


@query("j20_substring_map", "SELECT p_partkey, CASE WHEN p_name LIKE '%red%' THEN 'RED' WHEN p_name LIKE '%blue%' THEN 'BLU' WHEN p_name LIKE '%ring%' THEN 'RNG' END AS ticker FROM part")
def j20(spark, d):
    rules = [("RED", F.col("p_name").contains("red")), ("BLU", F.col("p_name").contains("blue")), ("RNG", F.col("p_name").contains("ring"))]
    return m.ladder(scan(spark, d, "part"), rules, "ticker").select("p_partkey", "ticker")


@query("o10_cluster_order", "SELECT n_name, row_number() OVER (ORDER BY CASE r_name WHEN 'ASIA' THEN 0 WHEN 'EUROPE' THEN 1 ELSE 2 END, n_name)::INT AS position FROM nation JOIN region ON r_regionkey = n_regionkey")
def o10(spark, d):
    j = scan(spark, d, "nation").join(scan(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rank = F.when(F.col("r_name") == "ASIA", 0).when(F.col("r_name") == "EUROPE", 1).otherwise(2)
    return j.select("n_name", F.row_number().over(Window.orderBy(rank, "n_name")).alias("position"))  # a small dimension


@query("o14_text_search", "SELECT doc_id FROM documents WHERE contains(lower(text), 'token') ORDER BY doc_id LIMIT 25")
def o14(spark, d):
    return m.top(scan(spark, d, "documents").filter(F.lower("text").contains("token")), [F.col("doc_id")], 25).select("doc_id")


@query("x10_replay_compare", "WITH a AS (SELECT user_id, event_type FROM events WHERE event_id % 10 <> 3), b AS (SELECT user_id, event_type FROM events WHERE event_id % 10 <> 7) SELECT 'missing' AS side, count(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'extra', count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)")
def x10(spark, d):
    e = scan(spark, d, "events")
    a, b = (e.filter(F.col("event_id") % 10 != k).select("user_id", "event_type") for k in (3, 7))
    one = lambda x, y, side: x.exceptAll(y).agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "n")
    return one(a, b, "missing").unionByName(one(b, a, "extra"))
