"""Decisions, kinds of change, validity, census, admission and source choice on the driver's tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.operators import matching as m
from lodestone.operators import measures as ms
from lodestone.operators import records as rc
from lodestone.sources.tables import BARS_SQL, bars, scan


@query("g07_decision_rules", """WITH o AS (SELECT o_orderkey, o_orderpriority, o_orderdate, o_orderstatus, coalesce(lag(o_orderkey) OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey), nullif(min(o_orderkey) OVER (PARTITION BY o_custkey), o_orderkey)) AS supersedes FROM orders),
    d AS (SELECT * FROM o WHERE o_orderstatus <> 'P'), h AS (SELECT supersedes AS s, count(*) AS heirs FROM d WHERE supersedes IS NOT NULL GROUP BY 1)
    SELECT d.o_orderkey, d.supersedes, concat_ws('+', CASE WHEN d.supersedes IS NOT NULL AND b.o_orderkey IS NULL THEN 'missing' END, CASE WHEN d.o_orderpriority <> b.o_orderpriority THEN 'other_scope' END,
    CASE WHEN d.o_orderdate <= b.o_orderdate THEN 'not_later' END, CASE WHEN heirs > 1 THEN 'fork' END) AS reasons FROM d LEFT JOIN d b ON d.supersedes = b.o_orderkey LEFT JOIN h ON h.s = d.supersedes""")
def g07(spark, d):
    """Orders as decisions: each supersedes its customer's one before of the same priority, else the customer's first; those in progress aren't recorded."""
    o = scan(spark, d, "orders")
    before = F.lag("o_orderkey").over(Window.partitionBy("o_custkey", "o_orderpriority").orderBy("o_orderkey"))
    first = F.nullif(F.min("o_orderkey").over(Window.partitionBy("o_custkey")), F.col("o_orderkey"))
    decisions = o.withColumn("supersedes", F.coalesce(before, first)).filter("o_orderstatus <> 'P'")
    return rc.judged_decisions(decisions, "o_orderkey", "supersedes", "o_orderpriority", "o_orderdate").select("o_orderkey", "supersedes", "reasons")


@query("g08_filing_anchors", """SELECT l_orderkey, min((l_shipdate, l_linenumber, l_returnflag))[1] AS l_shipdate, min((l_shipdate, l_linenumber, l_returnflag))[2] AS l_linenumber, min((l_shipdate, l_linenumber, l_returnflag))[3] AS l_returnflag
    FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""")
def g08(spark, d):
    filings = scan(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_returnflag")
    stored = scan(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return rc.anchors(filings, stored, "l_orderkey", ["l_shipdate", "l_linenumber"])


@query("g13_lifecycle", """WITH v AS (SELECT event_id, user_id, event_type, ts, value >= 20 AS good, json_extract_string(props, '$.k')::BIGINT // 25 AS p FROM events),
    w AS (SELECT *, last_value(CASE WHEN good THEN p END IGNORE NULLS) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
    count(*) FILTER (good) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM v)
    SELECT event_id, CASE WHEN NOT good THEN 'quarantined' WHEN before IS NULL THEN 'new' WHEN before = p THEN 'same' ELSE 'changed' END AS kind, good AND later = 0 AS head FROM w""")
def g13(spark, d):
    v = scan(spark, d, "events").withColumn("p", F.floor(F.get_json_object("props", "$.k").cast("long") / 25))
    return rc.change_kinds(v, ["user_id", "event_type"], ["ts", "event_id"], "p", F.col("value") >= 20).select("event_id", "kind", "head")


@query("t08_reemission", """WITH v AS (SELECT event_id, user_id, ts, ts::DATE AS day, event_type FROM events), w AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS before FROM v)
    SELECT user_id, day, event_id, event_type FROM w WHERE before IS DISTINCT FROM event_type""")
def t08(spark, d):
    """A state is emitted again on the same day only where it differs from the day's last emission."""
    v = scan(spark, d, "events").withColumn("day", F.to_date("ts"))
    kinds = rc.change_kinds(v, ["user_id", "day"], ["ts", "event_id"], "event_type", F.lit(True))
    return kinds.filter("kind in ('new', 'changed')").select("user_id", "day", "event_id", "event_type")


@query("g16_census", """WITH p AS (SELECT ts::DATE AS day, event_type, count(*) AS n FROM events WHERE value > 60 GROUP BY 1, 2), e AS (SELECT day::DATE AS day, event_type FROM (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day FROM p), (VALUES ('view'), ('click'), ('purchase'), ('signup')) t(event_type))
    SELECT coalesce(e.day, p.day) AS day, coalesce(e.event_type, p.event_type) AS event_type, coalesce(n, 0) AS n, CASE WHEN e.day IS NULL THEN 'unexpected' WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'repeated' ELSE 'published' END AS state FROM e FULL JOIN p ON e.day = p.day AND e.event_type = p.event_type""")
def g16(spark, d):
    scope = spark.createDataFrame([(t,) for t in ("view", "click", "purchase", "signup")], "event_type string")
    return rc.census(scan(spark, d, "events").filter("value > 60").withColumn("day", F.to_date("ts")), scope, "day", "event_type")


@query("x27_attestations", """WITH r AS (SELECT l_orderkey, min(l_shipdate) AS revoked FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), e AS (SELECT l_orderkey, max(l_shipdate) AS ends FROM lineitem GROUP BY 1)
    SELECT o_orderkey, CASE WHEN ends < o_orderdate THEN 'reversed' WHEN revoked <= TIMESTAMP '1999-01-01' THEN 'revoked' WHEN o_orderdate > TIMESTAMP '1999-01-01' THEN 'not_yet' WHEN ends < TIMESTAMP '1999-01-01' THEN 'expired' ELSE 'valid' END AS state
    FROM orders JOIN e ON o_orderkey = e.l_orderkey LEFT JOIN r ON r.l_orderkey = o_orderkey""")
def x27(spark, d):
    """Orders as attestations, valid up to their last shipment; a return revokes."""
    li = scan(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    records = scan(spark, d, "orders").join(li.groupBy("o_orderkey").agg(F.max("l_shipdate").alias("ends")), "o_orderkey")
    out = rc.valid_at(records, li.filter("l_returnflag = 'R'"), "o_orderkey", "o_orderdate", "ends", "l_shipdate", F.expr("timestamp_ntz'1999-01-01'"))
    return out.select("o_orderkey", "state")


@query("x28_rights", """WITH s AS (SELECT l_partkey, l_suppkey, min(l_shipdate) AS starts, max(l_shipdate) AS ends, min(l_shipdate) FILTER (l_discount >= 0.1) AS revoked FROM lineitem GROUP BY 1, 2)
    SELECT l_suppkey, state, count(*) AS n FROM (SELECT l_suppkey, CASE WHEN revoked <= TIMESTAMP '1999-01-01' THEN 'revoked' WHEN starts > TIMESTAMP '1999-01-01' THEN 'not_yet' WHEN ends < TIMESTAMP '1999-01-01' THEN 'expired' ELSE 'valid' END AS state FROM s) GROUP BY 1, 2""")
def x28(spark, d):
    """Rights of each supplier to each part, from its first to its last shipment; a full discount revokes."""
    li = scan(spark, d, "lineitem").withColumn("right", F.struct("l_partkey", "l_suppkey"))
    records = li.groupBy("right").agg(F.min("l_shipdate").alias("starts"), F.max("l_shipdate").alias("ends"))
    out = rc.valid_at(records, li.filter("l_discount >= 0.1"), "right", "starts", "ends", "l_shipdate", F.expr("timestamp_ntz'1999-01-01'"))
    return out.groupBy(F.col("right.l_suppkey").alias("l_suppkey"), "state").agg(F.count("*").alias("n"))


@query("x11_intake", """WITH f AS (SELECT *, ts::DATE AS day, row_number() OVER (PARTITION BY user_id, ts::DATE, event_type ORDER BY ts, event_id) = 1 AS first FROM events),
    u AS (SELECT *, sum(CASE WHEN first THEN strlen(props) ELSE 0 END) OVER (PARTITION BY user_id, day ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS used FROM f)
    SELECT user_id, day, count(*) FILTER (first AND used <= 25) AS taken, count(*) FILTER (NOT first) AS duplicate, count(*) FILTER (first AND used > 25) AS budget FROM u GROUP BY 1, 2""")
def x11(spark, d):
    """What a user's day takes in within 25 bytes, one row of each type, and why the rest is left out."""
    rows = scan(spark, d, "events").withColumn("day", F.to_date("ts"))
    out = rc.admitted(rows, ["user_id", "day"], ["event_type"], ["ts", "event_id"], F.octet_length("props"), 25)
    return out.groupBy("user_id", "day").agg(F.count_if(F.col("omitted").isNull()).alias("taken"), *[F.count_if(F.col("omitted") == k).alias(k) for k in ("duplicate", "budget")])


@query("x21_source_priority", """WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY CASE l_returnflag WHEN 'N' THEN 1 WHEN 'A' THEN 2 ELSE 3 END, l_shipdate DESC, l_orderkey, l_linenumber, l_extendedprice) AS n FROM lineitem)
    SELECT l_partkey, l_returnflag AS source, l_shipdate::DATE AS shipped FROM r WHERE n = 1""")
def x21(spark, d):
    li = scan(spark, d, "lineitem").withColumn("back", F.date_diff(F.lit("1970-01-01").cast("date"), F.to_date("l_shipdate")))
    out = rc.by_priority(li, ["l_partkey"], "l_returnflag", ["N", "A"], ["back", "l_orderkey", "l_linenumber", "l_extendedprice"])
    return out.select("l_partkey", F.col("l_returnflag").alias("source"), F.to_date("l_shipdate").alias("shipped"))


@query("x34_index_merge", """WITH a AS (SELECT user_id, max((ts, event_id, event_type, floor(value / 50)::BIGINT)) AS r FROM events WHERE event_type IN ('view', 'click') GROUP BY 1), b AS (SELECT user_id, max((ts, event_id, event_type, floor(value / 50)::BIGINT)) AS r FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1),
    x AS (SELECT user_id, r[3] AS t, r[4] AS v, CASE WHEN r[3] = 'view' THEN date_trunc('day', r[1]) ELSE r[1] END AS at FROM a), y AS (SELECT user_id, r[3] AS t, r[4] AS v, r[1] AS at FROM b),
    j AS (SELECT coalesce(x.user_id, y.user_id) AS user_id, x.user_id IS NULL AS fresh, y.user_id IS NULL AS gone, x.t IS DISTINCT FROM y.t AS dt, x.v IS DISTINCT FROM y.v AS dv, x.at AS xa, y.at AS ya FROM x FULL JOIN y ON x.user_id = y.user_id)
    SELECT user_id, CASE WHEN fresh THEN 'added' WHEN gone THEN 'removed' WHEN dt OR dv THEN 'changed' ELSE 'same' END AS state, CASE WHEN fresh OR gone THEN '' ELSE concat_ws('+', CASE WHEN dt THEN 'event_type' END, CASE WHEN dv THEN 'level' END) END AS changed,
    CASE WHEN xa IS NOT NULL AND xa <> date_trunc('day', xa) THEN xa ELSE coalesce(ya, xa) END AS at FROM j""")
def x34(spark, d):
    """Each user's latest reading (views known by day only) merged with the latest of the other types."""
    e = scan(spark, d, "events").withColumn("level", F.floor(F.col("value") / 50))
    newest = lambda rows: rows.groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type", "level")).alias("r")).select("user_id", "r.event_type", "r.level", F.col("r.ts").alias("at"))
    reading = F.col("event_type").isin("view", "click")
    old = newest(e.filter(reading)).withColumn("at", F.when(F.col("event_type") == "view", F.date_trunc("day", "at").cast("timestamp_ntz")).otherwise(F.col("at")))
    return rc.index_merge(old, newest(e.filter(~reading)), "user_id", ["event_type", "level"], "at")


@query("t03_late_rows", """WITH s AS (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM orders)
    SELECT o_orderkey, coalesce(o_orderdate < seen - INTERVAL 720 HOUR, false) AS late FROM s""")
def t03(spark, d):
    return rc.late_rows(scan(spark, d, "orders"), ["o_custkey"], "o_orderkey", "o_orderdate", 720).select("o_orderkey", "late")


@query("x55_breadth", """WITH r AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, [(l_suppkey % 7)::VARCHAR, l_returnflag || l_linestatus] AS a FROM lineitem), l AS (SELECT l_orderkey, list({'seen': a, 'n': 0} ORDER BY l_linenumber, l_partkey, a) AS r FROM r GROUP BY 1)
    SELECT l_orderkey, least(list_reduce(list_prepend({'seen': ['']::VARCHAR[], 'n': 0}, r), lambda s, x: CASE WHEN list_has_any(s.seen, x.seen) THEN s ELSE {'seen': list_concat(s.seen, x.seen), 'n': s.n + 1} END).n, 3)::INTEGER AS breadth FROM l""")
def x55(spark, d):
    li = scan(spark, d, "lineitem").withColumn("aliases", F.array((F.col("l_suppkey") % 7).cast("string"), F.concat("l_returnflag", "l_linestatus")))
    return rc.breadth(li, "l_orderkey", ["l_linenumber", "l_partkey"], "aliases", 3)


@query("x02_pool_accounting", """WITH f AS (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS nth FROM documents), b AS (SELECT source, CASE WHEN coalesce(text, '') = '' THEN 'empty' WHEN nth > 1 THEN 'duplicate' WHEN lang <> 'en' THEN 'foreign' WHEN n_chars < 400 THEN 'short' ELSE 'kept' END AS bucket FROM f)
    SELECT source, bucket, count(*) AS n FROM b GROUP BY 1, 2""")
def x02(spark, d):
    """Every row in exactly one terminal bucket; repeats are told by the digest of the text, whose smallest id is the first."""
    docs = scan(spark, d, "documents").withColumn("digest", F.md5("text"))
    firsts = docs.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    j = docs.select("doc_id", "digest", "source", "lang", "n_chars", (F.coalesce(F.length("text"), F.lit(0)) == 0).alias("void")).join(firsts, "digest", "left")
    out = m.ladder(j, [("empty", F.col("void")), ("duplicate", F.col("doc_id") > F.col("first_id")), ("foreign", F.col("lang") != "en"), ("short", F.col("n_chars") < 400)], "bucket")
    return out.fillna("kept", ["bucket"]).groupBy("source", "bucket").agg(F.count("*").alias("n"))


@query("x20_source_ladder", """WITH s AS (SELECT s_suppkey, s_acctbal, count(l_orderkey) AS n, max(l_shipdate) AS newest, date_diff('day', max(l_shipdate)::DATE, DATE '2002-01-01')::INTEGER AS age FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey AND l_discount > 0.05 GROUP BY 1, 2)
    SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'insecure' WHEN age > 60 THEN 'stale' WHEN n < 1 THEN 'empty' WHEN newest IS NULL THEN 'undated' ELSE 'fresh' END AS state, n, age FROM s""")
def x20(spark, d):
    li = scan(spark, d, "lineitem").filter("l_discount > 0.05").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.max("l_shipdate").alias("newest"))
    j = scan(spark, d, "supplier").join(li, F.col("s_suppkey") == F.col("l_suppkey"), "left").fillna(0, ["n"]).withColumn("age", F.date_diff(F.lit("2002-01-01").cast("date"), F.to_date("newest")))
    out = m.ladder(j, [("insecure", F.col("s_acctbal") < 0), ("stale", F.col("age") > 60), ("empty", F.col("n") < 1), ("undated", F.col("newest").isNull())], "state")
    return out.fillna("fresh", ["state"]).select("s_suppkey", "state", "n", "age")


@query("x29_clock_interval", """WITH c AS (SELECT event_id, epoch_us(ts) AS clock, CASE event_type WHEN 'view' THEN 1000000 WHEN 'click' THEN 60000000 ELSE 1000 END // 2 + floor(value)::BIGINT * 1000 AS half FROM events) SELECT event_id, clock - half AS low, clock + half AS high FROM c""")
def x29(spark, d):
    """An instant with the uncertainty of its clock (here the value, in milliseconds) and half the precision of its type's time stamps."""
    clock = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', ts)")
    precision = F.when(F.col("event_type") == "view", 1_000_000).when(F.col("event_type") == "click", 60_000_000).otherwise(1000)
    half = F.floor(precision / 2) + F.floor("value") * 1000
    return scan(spark, d, "events").select("event_id", (clock - half).alias("low"), (clock + half).alias("high"))


@query("x31_first_observed", """WITH u AS (SELECT o_custkey AS k, o_orderdate::DATE AS day, 'orders' AS source FROM orders UNION ALL SELECT o_custkey, l_shipdate::DATE, 'shipments' FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    SELECT k, min((day, source))[1] AS first_observed, min((day, source))[2] AS source, count(DISTINCT source) AS sources FROM u GROUP BY 1""")
def x31(spark, d):
    o, li = scan(spark, d, "orders"), scan(spark, d, "lineitem")
    ordered = o.select(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("day"), F.lit("orders").alias("source"))
    shipped = li.join(o, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("k"), F.to_date("l_shipdate").alias("day"), F.lit("shipments").alias("source"))
    g = ordered.unionByName(shipped).groupBy("k").agg(F.min(F.struct("day", "source")).alias("m"), F.count_distinct("source").alias("sources"))
    return g.select("k", F.col("m.day").alias("first_observed"), F.col("m.source").alias("source"), "sources")


@query("x42_containment", """WITH s AS (SELECT l_orderkey, min(l_shipdate) AS a, max(l_shipdate) AS b FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1) SELECT l.l_orderkey, count(*) AS evidence, count(*) FILTER (l_shipdate BETWEEN a AND b) AS retained FROM lineitem l LEFT JOIN s ON s.l_orderkey = l.l_orderkey GROUP BY 1""")
def x42(spark, d):
    """How much of each order's evidence lies in its retention interval; without one, none."""
    li = scan(spark, d, "lineitem")
    span = li.filter("l_returnflag = 'N'").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    return li.join(span, "l_orderkey", "left").groupBy("l_orderkey").agg(F.count("*").alias("evidence"), F.count_if(F.col("l_shipdate").between(F.col("a"), F.col("b"))).alias("retained"))


@query("x45_crosswalk", """SELECT l_orderkey, sum(l_quantity) AS stake, concat_ws('+', CASE WHEN sum(l_quantity) > 100 THEN 'stake' END, CASE WHEN count(DISTINCT l_partkey) < count(*) THEN 'repeated' END, CASE WHEN min(l_tax) <= 0 THEN 'no_proof' END) AS reasons FROM lineitem GROUP BY 1""")
def x45(spark, d):
    """Stakes of an order's parts: at most 100 together, each part once, each with proof (here the tax)."""
    g = scan(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("stake"), F.count("*").alias("n"), F.count_distinct("l_partkey").alias("parts"), F.min("l_tax").alias("proof"))
    return g.select("l_orderkey", "stake", rc.reasons(stake=F.col("stake") > 100, repeated=F.col("parts") < F.col("n"), no_proof=F.col("proof") <= 0).alias("reasons"))


@query("p05_maturation", """WITH e AS (SELECT l_orderkey, min(l_shipdate) AS a, max(l_shipdate) AS b FROM lineitem GROUP BY 1), r AS (SELECT y AS run FROM generate_series(1994, 2003) t(y)), s AS (SELECT l_orderkey, run, CASE WHEN b < make_timestamp(run, 1, 1, 0, 0, 0) THEN 'filled' WHEN a < make_timestamp(run, 1, 1, 0, 0, 0) THEN 'partial' ELSE 'pending' END AS status FROM e, r),
    c AS (SELECT *, lag(status) OVER (PARTITION BY l_orderkey ORDER BY run) AS before FROM s) SELECT l_orderkey, run::INTEGER AS run, status FROM c WHERE before IS DISTINCT FROM status""")
def p05(spark, d):
    """Outcomes of yearly runs: a revision is appended only where the status changes."""
    span = scan(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    runs = span.withColumn("run", F.explode(F.sequence(F.lit(1994), F.lit(2003))))
    status = F.when(F.year("b") < F.col("run"), "filled").when(F.year("a") < F.col("run"), "partial").otherwise("pending")
    kinds = rc.change_kinds(runs.withColumn("status", status), ["l_orderkey"], ["run"], "status", F.lit(True))
    return kinds.filter("kind <> 'same'").select("l_orderkey", "run", "status")


@query("p06_unified_signals", """SELECT 'large_order' AS family, o_custkey AS subject, o_orderkey AS record, 'long' AS direction FROM orders WHERE o_totalprice > 400000 UNION ALL SELECT 'open_order', o_custkey, o_orderkey, 'none' FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'return', l_suppkey, l_orderkey, 'short' FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45 UNION ALL SELECT 'discount', l_suppkey, l_orderkey, 'short' FROM lineitem WHERE l_discount >= 0.1 UNION ALL SELECT 'error', user_id, event_id, 'short' FROM events WHERE event_type = 'error' UNION ALL SELECT 'debt', c_custkey, c_custkey, 'short' FROM customer WHERE c_acctbal < 0""")
def p06(spark, d):
    """Six extractors as one table of signals."""
    o, li = scan(spark, d, "orders"), scan(spark, d, "lineitem")
    parts = [
        ("large_order", o.filter("o_totalprice > 400000"), "o_custkey", "o_orderkey", "long"),
        ("open_order", o.filter("o_orderstatus = 'P'"), "o_custkey", "o_orderkey", "none"),
        ("return", li.filter("l_returnflag = 'R' and l_quantity > 45"), "l_suppkey", "l_orderkey", "short"),
        ("discount", li.filter("l_discount >= 0.1"), "l_suppkey", "l_orderkey", "short"),
        ("error", scan(spark, d, "events").filter("event_type = 'error'"), "user_id", "event_id", "short"),
        ("debt", scan(spark, d, "customer").filter("c_acctbal < 0"), "c_custkey", "c_custkey", "short"),
    ]
    out = None
    for family, rows, subject, record, direction in parts:
        rows = rows.select(F.lit(family).alias("family"), F.col(subject).alias("subject"), F.col(record).alias("record"), F.lit(direction).alias("direction"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("g17_evaluation", """WITH g AS (SELECT source, count(*) AS n, count(*) FILTER (toxic = 0) AS correct FROM labels JOIN documents USING (doc_id) WHERE quality >= 1 GROUP BY 1),
    w AS (SELECT *, (correct / n + 1.959963984540054 ** 2 / (2 * n) - 1.959963984540054 * sqrt(correct / n * (1 - correct / n) / n + 1.959963984540054 ** 2 / (4 * n * n))) / (1 + 1.959963984540054 ** 2 / n) AS low FROM g)
    SELECT source, n, correct, CASE WHEN n < 5 THEN 'insufficient' WHEN low >= 0.5 THEN 'pass' ELSE 'fail' END AS gate FROM w""")
def g17(spark, d):
    """A gate for each source: enough judged rows, and the interval of their precision above a half."""
    j = scan(spark, d, "labels").filter("quality >= 1").join(scan(spark, d, "documents").select("doc_id", "source"), "doc_id")
    g = j.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("toxic") == 0).alias("correct"))
    low, _ = ms.wilson(F.col("correct"), F.col("n"))
    return g.select("source", "n", "correct", F.when(F.col("n") < 5, "insufficient").when(low >= 0.5, "pass").otherwise("fail").alias("gate"))


@query("g20_price_context", f"""WITH {BARS_SQL}, p AS (SELECT *, lag(session) OVER w AS before, lag(close) OVER w AS base FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY session))
    SELECT symbol, session, CASE WHEN before IS NULL THEN 'no_baseline' WHEN date_diff('day', before, session) > 4 THEN 'gap' WHEN volume < 20 THEN 'thin' WHEN abs(close / base - 1) > 0.9 THEN 'implausible' ELSE 'comparable' END AS context FROM p""")
def g20(spark, d):
    w = Window.partitionBy("symbol").orderBy("session")
    p = bars(spark, d).withColumns({"before": F.lag("session").over(w), "base": F.lag("close").over(w)})
    rules = [("no_baseline", F.col("before").isNull()), ("gap", F.date_diff("session", "before") > 4), ("thin", F.col("volume") < 20), ("implausible", F.abs(F.col("close") / F.col("base") - 1) > 0.9)]
    return m.ladder(p, rules, "context").fillna("comparable", ["context"]).select("symbol", "session", "context")


@query("k03_latest_session", """SELECT event_id, (SELECT max(s) FROM (SELECT unnest(generate_series(ts::DATE - INTERVAL 5 DAY, ts::DATE, INTERVAL 1 DAY))::DATE AS s) WHERE isodow(s) <= 5 AND s + INTERVAL 21 HOUR <= ts) AS session FROM events""")
def k03(spark, d):
    """The latest weekday session that had closed (20:00) and settled (an hour later) at each event."""
    day = F.to_date(F.col("ts") - F.expr("interval 21 hours"))
    return scan(spark, d, "events").select("event_id", F.date_sub(day, F.greatest(F.weekday(day) - 4, F.lit(0))).alias("session"))


@query("k16_clean_code", """SELECT c_custkey, split_part(c_name, '#', 1) AS kind, nullif(ltrim(split_part(c_name, '#', 2), '0'), '')::BIGINT AS number FROM customer""")
def k16(spark, d):
    """Codes with a kind and a padded number; a number of zeros alone is null."""
    number = F.nullif(F.regexp_extract("c_name", "#0*([0-9]*)$", 1), F.lit(""))
    return scan(spark, d, "customer").select("c_custkey", F.trim(F.regexp_extract("c_name", "^([^#]*)#", 1)).alias("kind"), number.cast("long").alias("number"))


@query("k07_schedule", """SELECT s::DATE AS session, s + INTERVAL 810 MINUTE AS opened, s + INTERVAL 20 HOUR AS closed FROM (SELECT unnest(generate_series(min(o_orderdate::DATE), max(o_orderdate::DATE), INTERVAL 1 DAY)) AS s FROM orders)
    WHERE isodow(s) <= 5 AND strftime(s, '%m-%d') NOT IN ('01-01', '07-04', '12-25')""")
def k07(spark, d):
    """Sessions of the span of the orders: weekdays but for fixed holidays, from 13:30 to 20:00."""
    span = scan(spark, d, "orders").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b")).filter("a is not null")
    days = span.select(F.explode(F.sequence("a", "b")).alias("session"))
    open_days = days.filter((F.weekday("session") < 5) & ~F.date_format("session", "MM-dd").isin("01-01", "07-04", "12-25"))
    at = lambda minutes: F.col("session").cast("timestamp_ntz") + F.expr(f"interval {minutes} minutes")
    return open_days.select("session", at(810).alias("opened"), at(1200).alias("closed"))


@query("g15_closure", """SELECT c_nationkey, count(DISTINCT c_custkey) AS inventory, count(DISTINCT o_custkey) AS units, count(DISTINCT o_custkey) FILTER (open_orders = 0) AS closed FROM customer LEFT JOIN (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'P') AS open_orders FROM orders GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1""")
def g15(spark, d):
    """Of each nation's customers those with orders, and those of them without one in progress."""
    units = scan(spark, d, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "P").alias("open_orders"))
    j = scan(spark, d, "customer").join(units, F.col("o_custkey") == F.col("c_custkey"), "left")
    return j.groupBy("c_nationkey").agg(F.count_distinct("c_custkey").alias("inventory"), F.count("o_custkey").alias("units"), F.count_if(F.col("open_orders") == 0).alias("closed"))


@query("g19_listing_state", """WITH s AS (SELECT l_partkey, min(l_shipdate) AS a, max(l_shipdate) AS b, count(DISTINCT l_suppkey) AS venues FROM lineitem GROUP BY 1)
    SELECT p_partkey, CASE WHEN a IS NULL THEN 'unlisted' WHEN a > TIMESTAMP '1999-01-01' THEN 'not_yet' WHEN b < TIMESTAMP '2001-06-01' THEN 'delisted' ELSE 'listed' END AS state,
    concat_ws('+', CASE WHEN a IS NULL THEN 'no_history' END, CASE WHEN date_diff('day', a, b) < 365 THEN 'short_history' END, CASE WHEN venues < 2 THEN 'one_venue' END) AS refusal FROM part LEFT JOIN s ON l_partkey = p_partkey""")
def g19(spark, d):
    """Parts as instruments: the state of their listing, and why they can't be compared."""
    s = scan(spark, d, "lineitem").groupBy("l_partkey").agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"), F.count_distinct("l_suppkey").alias("venues"))
    j = scan(spark, d, "part").join(s, F.col("l_partkey") == F.col("p_partkey"), "left")
    rules = [("unlisted", F.col("a").isNull()), ("not_yet", F.col("a") > F.expr("timestamp_ntz'1999-01-01'")), ("delisted", F.col("b") < F.expr("timestamp_ntz'2001-06-01'"))]
    why = rc.reasons(no_history=F.col("a").isNull(), short_history=F.date_diff("b", "a") < 365, one_venue=F.col("venues") < 2)
    return m.ladder(j, rules, "state").fillna("listed", ["state"]).select("p_partkey", "state", why.alias("refusal"))


@query("p07_sightings", """SELECT user_id, event_type, min((ts, event_id))[2] AS first_id, max((ts, event_id))[2] AS last_id, count(*) AS sightings FROM events GROUP BY 1, 2""")
def p07(spark, d):
    """The first and the last sighting of each key are kept, and how many there were."""
    at = F.struct("ts", "event_id")
    g = scan(spark, d, "events").groupBy("user_id", "event_type").agg(F.min(at).alias("a"), F.max(at).alias("b"), F.count("*").alias("sightings"))
    return g.select("user_id", "event_type", F.col("a.event_id").alias("first_id"), F.col("b.event_id").alias("last_id"), "sightings")


@query("x37_operations", """SELECT o_orderpriority, max((o_orderdate, o_orderkey))[2] AS latest, max(o_orderdate)::DATE AS latest_on, count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_orderstatus = 'O') AS opened, count(*) FILTER (o_orderstatus = 'P') AS pending FROM orders GROUP BY 1""")
def x37(spark, d):
    """The latest cycle of each source, and how many are in which state."""
    states = [F.count_if(F.col("o_orderstatus") == k).alias(n) for k, n in (("F", "finished"), ("O", "opened"), ("P", "pending"))]
    g = scan(spark, d, "orders").groupBy("o_orderpriority").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("m"), *states)
    return g.select("o_orderpriority", F.col("m.o_orderkey").alias("latest"), F.to_date("m.o_orderdate").alias("latest_on"), "finished", "opened", "pending")


@query("x57_review_currency", """WITH r AS (SELECT l_orderkey, sha256(string_agg(l_partkey::VARCHAR || ':' || l_returnflag, ',' ORDER BY l_partkey::VARCHAR || ':' || l_returnflag)) AS now, sha256(string_agg(l_partkey::VARCHAR || ':' || l_returnflag, ',' ORDER BY l_partkey::VARCHAR || ':' || l_returnflag) FILTER (l_shipdate < TIMESTAMP '2000-01-01')) AS bound FROM lineitem GROUP BY 1)
    SELECT l_orderkey, CASE WHEN bound IS NULL THEN 'unreviewed' WHEN bound = now THEN 'current' ELSE 'outdated' END AS state FROM r""")
def x57(spark, d):
    """A review of an order's lines binds the digest of those shipped before 2000; it is current while the recomputed digest is that."""
    item = F.concat_ws(":", F.col("l_partkey").cast("string"), "l_returnflag")
    digest = lambda rows: F.sha2(F.array_join(F.array_sort(rows), ","), 256)
    g = scan(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(item).alias("now"), F.collect_list(F.when(F.col("l_shipdate") < F.expr("timestamp_ntz'2000-01-01'"), item)).alias("bound"))
    state = F.when(F.size("bound") == 0, "unreviewed").when(digest("bound") == digest("now"), "current").otherwise("outdated")
    return g.select("l_orderkey", state.alias("state"))
