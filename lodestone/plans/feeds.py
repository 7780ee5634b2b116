"""Feeds, filings and pages: documents written from the driver's tables as XML, parsed and compared with the tables."""

from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.sources import feeds as fd
from lodestone.sources.tables import scan


def _joined(rows, part, *keys):
    """One document body for each key: its parts in order."""
    return rows.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(part)), "").alias("inside"))


def order_feeds(spark, d):
    """A feed for each order; an entry for each line, by part and day."""
    li = scan(spark, d, "lineitem")
    entry = fd.element("entry", fd.element("id", F.col("l_partkey").cast("string")), fd.element("title", fd.escaped(F.concat("l_returnflag", F.lit(" & <"), "l_linestatus", F.lit(">")))), fd.element("updated", F.date_format("l_shipdate", "yyyy-MM-dd")))
    return _joined(li, entry, "l_orderkey").select("l_orderkey", fd.element("feed", F.col("inside")).alias("body"))


@query("s09_atom_entries", """SELECT l_orderkey, l_partkey::VARCHAR AS id, max((l_shipdate::DATE, l_returnflag || ' & <' || l_linestatus || '>'))[2] AS title, max(l_shipdate::DATE) AS updated FROM lineitem GROUP BY l_orderkey, l_partkey""")
def s09(spark, d):
    return fd.atom(order_feeds(spark, d), "l_orderkey", "body", 6)[0]


@query("s09_atom_gaps", """WITH f AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_partkey) AS ids FROM lineitem GROUP BY 1)
    SELECT l_orderkey, 'capped' AS code FROM f WHERE n >= 6 UNION ALL SELECT l_orderkey, 'duplicate' FROM f WHERE ids < n""")
def s09_gaps(spark, d):
    return fd.atom(order_feeds(spark, d), "l_orderkey", "body", 6)[1]


@query("s10_issuer_feed", """SELECT o_custkey, o_orderpriority AS title, 'https://example.org/' || o_orderkey AS link, o_orderdate AS published FROM orders WHERE o_orderstatus <> 'P'""")
def s10(spark, d):
    """A channel for each customer and day; orders in progress have no link and are no records."""
    o = scan(spark, d, "orders")
    link = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.concat(F.lit("https://example.org/"), F.col("o_orderkey").cast("string")))
    item = fd.element("item", fd.element("title", fd.escaped(F.col("o_orderpriority"))), fd.element("link", link), fd.element("pubDate", F.date_format("o_orderdate", "EEE, d MMM yyyy HH:mm:ss 'GMT'")))
    body = fd.element("rss", fd.element("channel", fd.element("title", F.lit("orders")), F.col("inside")))
    return fd.rss(_joined(o, item, "o_custkey", "o_orderdate").select("o_custkey", body.alias("body")), "o_custkey", "body")


@query("s11_halts", """SELECT user_id::VARCHAR AS symbol, date_trunc('second', ts) AS halted_at, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS resumed_at, event_type AS reason, CASE WHEN event_type = 'error' THEN 'halted' ELSE 'resumed' END AS state FROM events""")
def s11(spark, d):
    """A halt feed for each minute, so none is large."""
    e = scan(spark, d, "events")
    time = F.date_format("ts", "HH:mm:ss")
    item = fd.element("item", fd.element("symbol", F.col("user_id").cast("string")), fd.element("haltDate", F.date_format("ts", "MM/dd/yyyy")), fd.element("haltTime", time), fd.element("resumeTime", F.when(F.col("event_type") == "error", F.lit("")).otherwise(time)), fd.element("reason", F.col("event_type")))
    feeds = _joined(e.withColumn("minute", F.date_trunc("minute", "ts")), item, "minute")
    return fd.halts(feeds.select(fd.element("feed", F.col("inside")).alias("body")), "body")


@query("s15_submissions", """WITH f AS (SELECT o_custkey, o_orderpriority, o_orderkey, o_orderdate::DATE AS filed_on, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
    SELECT o_custkey, o_orderpriority, o_orderkey, filed_on FROM f WHERE n <= 2""")
def s15(spark, d):
    o = scan(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", F.to_date("o_orderdate").alias("filed_on"))
    return fd.newest_per_form(o, ["o_custkey", "o_orderpriority"], "o_orderkey", "filed_on", "1996-01-01", 2)


@query("s16_ownership", """SELECT l_orderkey, string_agg(DISTINCT l_returnflag, '+' ORDER BY l_returnflag) AS codes, count(DISTINCT l_suppkey)::INTEGER AS owners, sum(l_quantity) AS shares FROM lineitem GROUP BY 1""")
def s16(spark, d):
    """An insider form for each order: its lines are transactions, their suppliers the owners."""
    li = scan(spark, d, "lineitem")
    owner = fd.element("reportingOwner", fd.element("cik", F.col("l_suppkey").cast("string")))
    traded = fd.element("transaction", fd.element("code", F.lower("l_returnflag")), fd.element("shares", F.col("l_quantity").cast("string")))
    forms = _joined(li, F.concat(owner, traded), "l_orderkey")
    return fd.ownership(forms.select("l_orderkey", fd.element("ownershipDocument", F.col("inside")).alias("body")), "l_orderkey", "body")


@query("s22_page_text", """WITH t AS (SELECT page_id, html, regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g') AS bare FROM pages),
    u AS (SELECT page_id, html, trim(regexp_replace(coalesce(replace(replace(replace(replace(replace(bare, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), ''), '[ \\t\\r\\n]+', ' ', 'g')) AS text FROM t)
    SELECT page_id, length(text)::INTEGER AS n_chars, md5(text) AS digest, concat_ws('+', CASE WHEN text = '' THEN 'empty' END, CASE WHEN coalesce(NOT contains(lower(html), '</html>'), true) THEN 'unclosed' END) AS gaps FROM u""")
def s22(spark, d):
    text, gaps = fd.page_text(F.col("html"))
    return scan(spark, d, "pages").withColumns({"text": text, "gaps": gaps}).select("page_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"), "gaps")
