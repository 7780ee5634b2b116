"""Dated mentions, named subjects, claims, deliveries and poll windows on the driver's tables."""

from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.functions import mentions as mn
from lodestone.operators import matching as m
from lodestone.operators import subjects as sb
from lodestone.sources.tables import scan

#: An order's notice: its lines as sentences, sorted; each names an event and, some way behind it, a day.
NOTICES_SQL = """l AS (SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 'CRL' WHEN 'A' THEN 'Advisory  committee' ELSE 'note' END AS word, CASE l_returnflag WHEN 'R' THEN 'CRL' WHEN 'A' THEN 'ADCOM' END AS kind, l_shipdate::DATE AS day, l_linestatus = 'F' AS named,
        CASE WHEN l_linestatus = 'F' THEN strftime(l_shipdate, '%B %-d, %Y') ELSE strftime(l_shipdate, '%Y-%m-%d') END AS wrote, repeat('x', l_quantity::INTEGER) AS pad FROM lineitem),
    s AS (SELECT *, word || ' ' || pad || ' ' || wrote AS t FROM l),
    p AS (SELECT *, coalesce(sum(length(t) + 1) OVER (PARTITION BY l_orderkey ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INTEGER AS a FROM s),
    w AS (SELECT l_orderkey, a AS start, a + length(word) AS stop, kind FROM p WHERE kind IS NOT NULL),
    d AS (SELECT l_orderkey, a + length(word) + length(pad) + 2 AS pos, a + length(t) AS till, day, named FROM p),
    near AS (SELECT w.l_orderkey, start, kind, arg_min(day, (abs(pos - start), NOT named, pos)) AS day FROM w LEFT JOIN d ON w.l_orderkey = d.l_orderkey AND pos >= start - 200 AND till <= stop + 200 GROUP BY 1, 2, 3)"""


def notices(spark, d):
    word = F.when(F.col("l_returnflag") == "R", "CRL").when(F.col("l_returnflag") == "A", "Advisory  committee").otherwise("note")
    day = F.when(F.col("l_linestatus") == "F", F.date_format("l_shipdate", "MMMM d, yyyy")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    line = F.concat_ws(" ", word, F.repeat(F.lit("x"), F.col("l_quantity").cast("int")), day)
    return scan(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_list(line)), " ").alias("text"))


@query("k13_nearest_date", f"WITH {NOTICES_SQL} SELECT l_orderkey, start, kind, day FROM near")
def k13(spark, d):
    hits = F.explode(mn.dated_keywords(F.col("text"), mn.CATALYSTS)).alias("h")
    return notices(spark, d).select("l_orderkey", hits).select("l_orderkey", "h.start", "h.kind", "h.day")


@query("e10_catalysts", f"WITH {NOTICES_SQL} SELECT DISTINCT l_orderkey, kind, day, date_diff('day', DATE '1999-01-01', day) BETWEEN 0 AND 90 AS alert FROM near WHERE day IS NOT NULL")
def e10(spark, d):
    """Dated events of each notice once; one in the next 90 days alerts."""
    ahead = F.date_diff("day", F.lit("1999-01-01").cast("date"))
    return k13(spark, d).filter("day is not null").select("l_orderkey", "kind", "day").distinct().withColumn("alert", ahead.between(0, 90))


@query("k15_relevance", """WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN coalesce(text, '') || ' $of' ELSE coalesce(text, '') END AS b FROM conversations),
    x AS (SELECT *, turn % 3 = 0 AS tag, regexp_matches(b, '(^|[^A-Za-z0-9])THE([^A-Za-z0-9]|$)') AS the, regexp_matches(b, '(^|[^A-Za-z0-9])OF([^A-Za-z0-9]|$)') AS of, contains(lower(b), 'tion of') AS a, contains(lower(b), 'the an') AS e FROM t)
    SELECT conv_id, turn, concat_ws('+', CASE WHEN tag OR of OR a THEN 'OF' END, CASE WHEN the OR e THEN 'THE' END) AS symbols, CASE WHEN tag THEN 1.0 WHEN the OR of THEN 0.8 WHEN a OR e THEN 0.6 ELSE 0.0 END::DOUBLE AS relevance FROM x""")
def k15(spark, d):
    turns = scan(spark, d, "conversations").withColumn("b", F.concat(F.coalesce("text", F.lit("")), F.when(F.col("turn") % 3 == 0, " $of").otherwise("")))
    symbols, relevance = mn.named_subjects(F.col("b"), {"OF": ["tion of"], "THE": ["the an"]})
    return turns.select("conv_id", "turn", F.array_join(symbols, "+").alias("symbols"), relevance.alias("relevance"))


@query("k29_projection", """SELECT event_id, '{"rows":[{"k":' || json_extract_string(props, '$.k') || '},{"type":"' || event_type || '"}],"user":' || user_id || '}' AS projected FROM events""")
def k29(spark, d):
    proof = F.struct(F.col("event_id").alias("at"))
    k = F.get_json_object("props", "$.k").cast("long")
    body = F.struct(F.col("user_id").alias("user"), proof.alias("support"), F.array(F.to_json(F.struct(k.alias("k"), proof.alias("support"))), F.to_json(F.struct(F.col("event_type").alias("type"), F.lit(1).alias("result_id")))).alias("rows"))
    nested = F.concat(F.lit('{"user":'), body["user"].cast("string"), F.lit(',"support":'), F.to_json(body["support"]), F.lit(',"rows":['), F.array_join(body["rows"], ","), F.lit("]}"))
    return scan(spark, d, "events").select("event_id", mn.without_keys(nested, {"support", "result_id"}).alias("projected"))


@query("x13_claim_values", r"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, concat_ws('+', CASE WHEN l_linenumber = 1 THEN 'key' END, CASE WHEN l_quantity < 10 OR l_quantity >= 40 THEN 'value' END, CASE WHEN l_returnflag = 'N' THEN 'unit' END, CASE WHEN l_linestatus = 'F' THEN 'period' END) AS faults FROM lineitem""")
def x13(spark, d):
    """Lines as claims: the first line's key begins with a digit, small quantities are padded by a zero and large ones have an exponent."""
    q = F.col("l_quantity").cast("int").cast("string")
    key = F.concat(F.when(F.col("l_linenumber") == 1, "1_").otherwise("k_"), F.col("l_partkey"))
    value = F.when(F.col("l_quantity") < 10, F.concat(F.lit("0"), q)).when(F.col("l_quantity") >= 40, F.concat(q, F.lit("e0"))).otherwise(F.concat(q, F.lit(".50")))
    faults = sb.claim_faults(key, value, F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")), F.when(F.col("l_linestatus") == "F", "").otherwise(F.col("l_linestatus")))
    return scan(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", faults.alias("faults"))


@query("x16_story_class", r"""SELECT doc_id, CASE WHEN regexp_matches(lower(text), '(^|\P{L})(tion|heit)(\P{L}|$)') THEN 'stress' WHEN regexp_matches(lower(text), '(^|\P{L})(die|the|et)(\P{L}|$)') THEN 'efficiency' WHEN text IS NULL THEN 'unread' ELSE 'note' END AS class FROM documents""")
def x16(spark, d):
    """Stories by the first class one of whose words they hold."""
    holds = lambda words: F.lower("text").rlike(rf"(^|\P{{L}})({words})(\P{{L}}|$)")
    rules = [("stress", holds("tion|heit")), ("efficiency", holds("die|the|et")), ("unread", F.col("text").isNull())]
    return m.ladder(scan(spark, d, "documents"), rules, "class").fillna("note", ["class"]).select("doc_id", "class")


@query("x09_subject_slice", """SELECT 'orders' AS section, o_orderkey AS id FROM orders WHERE o_custkey = 7 UNION ALL SELECT 'events', event_id FROM events WHERE user_id = 7 UNION ALL SELECT 'customers', c_custkey FROM customer WHERE c_custkey = 7 UNION ALL SELECT 'turns', conv_id FROM conversations WHERE contains(text, 'hable')""")
def x09(spark, d):
    """Everything that concerns customer 7, by key where a section has one and by its name in a text elsewhere."""
    s = lambda name: scan(spark, d, name)
    return sb.subject_slice({"orders": (s("orders"), "o_orderkey", F.col("o_custkey") == 7), "events": (s("events"), "event_id", F.col("user_id") == 7), "customers": (s("customer"), "c_custkey", F.col("c_custkey") == 7), "turns": (s("conversations"), "conv_id", F.contains("text", F.lit("hable")))})


@query("t07_outbox", """WITH q AS (SELECT user_id, max((ts, event_id)) AS last FROM events WHERE event_type = 'purchase' GROUP BY 1), a AS (SELECT e.user_id, min(e.ts) AS done FROM events e JOIN q ON q.user_id = e.user_id WHERE event_type = 'click' AND (ts, event_id) > last GROUP BY 1)
    SELECT q.user_id, CASE WHEN done IS NULL THEN 'pending' ELSE 'acknowledged' END AS state, done AS acknowledged_at FROM q LEFT JOIN a ON a.user_id = q.user_id""")
def t07(spark, d):
    return sb.outbox(scan(spark, d, "events"), "user_id", ["ts", "event_id"], "ts", F.col("event_type") == "purchase", F.col("event_type") == "click")


@query("x30_poll_windows", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderdate ELSE coalesce((SELECT max(p.o_orderdate) FROM orders p WHERE p.o_orderpriority = o.o_orderpriority AND p.o_orderkey % 50 = (o.o_orderkey * 7) % 50 AND p.o_orderstatus <> 'P' AND p.o_orderdate < o.o_orderdate), o_orderdate) END AS starts, o_orderdate AS ends FROM orders o""")
def x30(spark, d):
    """Orders as polls of their priority's feed, each from one watermark to another; those in progress aren't proven."""
    polls = scan(spark, d, "orders").withColumns({"mark": F.col("o_orderkey") % 50, "before": (F.col("o_orderkey") * 7) % 50})
    return sb.poll_windows(polls, "o_orderpriority", "o_orderkey", "before", "mark", "o_orderdate", F.col("o_orderstatus") != "P")
