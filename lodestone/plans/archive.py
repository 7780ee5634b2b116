"""Archive scans and sinks on documents that are written from the driver's tables and read back."""

import uuid

from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.sources import archive as ar
from lodestone.sources.scratch import shared_dir
from lodestone.sources.tables import scan

def _path(spark, name):
    return f"{shared_dir(spark)}/lodestone/{name}-{uuid.uuid4().hex}"


def briefs(spark, d):
    """The archive, scanned again: a line for each event, a folder for each day."""
    e = scan(spark, d, "events").select("event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("run"))
    obj = lambda *pairs: F.to_json(F.struct(*[v.alias(k) for k, v in pairs]))
    some = F.when(F.col("value") >= 10, F.col("value"))
    line = (
        F.when(F.col("event_type") == "view", obj(("schema", F.lit("brief/1")), ("id", F.col("event_id")), ("value", some)))
        .when(F.col("event_type") == "click", obj(("schema", F.lit("brief/2")), ("id", F.col("event_id")), ("payload", F.struct(some.alias("value")))))
        .when(F.col("event_type") == "purchase", obj(("schema", F.lit("brief/9")), ("id", F.col("event_id"))))
        .when(F.col("event_type") == "signup", obj(("id", F.col("event_id")), ("value", some)))
        .otherwise(F.concat(F.lit('{"schema":"brief/1","id":'), F.col("event_id").cast("string")))
    )
    path = _path(spark, "briefs")
    ar.write_lines(e.withColumn("line", line), path, "run")
    return ar.read_lines(spark, path, "run")


ADAPTERS = {"brief/1": ("schema string, id long, value double", "d.value"), "brief/2": ("schema string, id long, payload struct<value: double>", "d.payload.value")}


@query("s01_archived_briefs", "SELECT strftime(ts, '%Y-%m-%d') AS run, count(*) AS documents FROM events GROUP BY 1")
def s01(spark, d):
    return briefs(spark, d).groupBy("run").agg(F.count("*").alias("documents"))


@query("s04_schema_dispatch", """SELECT event_id AS id, CASE WHEN event_type IN ('view', 'click') THEN CASE WHEN value >= 10 THEN 'accepted' ELSE 'rejected' END ELSE 'quarantined' END AS state,
    CASE WHEN event_type IN ('view', 'click') THEN CASE WHEN value < 10 THEN 'no_value' END WHEN event_type = 'purchase' THEN 'unknown_schema' WHEN event_type = 'signup' THEN 'no_schema' ELSE 'not_json' END AS reason,
    CASE WHEN event_type IN ('view', 'click') AND value >= 10 THEN value END AS value FROM events""")
def s04(spark, d):
    out = ar.dispatch(briefs(spark, d), ADAPTERS)
    return out.select(F.regexp_extract("line", '"id":([0-9]+)', 1).cast("long").alias("id"), "state", "reason", "value")


@query("s05_rejections", """SELECT strftime(ts, '%Y-%m-%d') AS run, count(*) FILTER (event_type IN ('view', 'click') AND value >= 10) AS accepted, count(*) FILTER (event_type IN ('view', 'click') AND value < 10) AS rejected,
    count(*) FILTER (event_type NOT IN ('view', 'click')) AS quarantined FROM events GROUP BY 1""")
def s05(spark, d):
    out = ar.dispatch(briefs(spark, d), ADAPTERS)
    return out.groupBy("run").agg(*[F.count_if(F.col("state") == s).alias(s) for s in ("accepted", "rejected", "quarantined")])


@query("s02_byte_identity", "SELECT paths, count(*) AS contents FROM (SELECT r_name, count(*) AS paths FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 1) GROUP BY 1")
def s02(spark, d):
    """A file for each nation that says its region's name: as many contents as regions, each at as many paths as nations."""
    rows = scan(spark, d, "nation").join(F.broadcast(scan(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    path = _path(spark, "files")
    rows.select(F.col("r_name").alias("line"), "n_nationkey").repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    return ar.digests(spark, path).groupBy("paths").agg(F.count("*").alias("contents"))


@query("s06_json_pointer", "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, json_extract_string(props, '$.nothing') AS nothing FROM events")
def s06(spark, d):
    v = F.try_parse_json("props")
    return scan(spark, d, "events").select("event_id", F.try_variant_get(v, "$.k", "long").alias("k"), F.try_variant_get(v, "$.nothing", "string").alias("nothing"))


def index_lines(spark, d):
    """A daily index as text: a header, a rule, a line for each order line; every seventh order has a line that must be refused."""
    li = scan(spark, d, "lineitem").join(scan(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    key = F.col("l_orderkey")
    odd = (F.col("l_linenumber") == 1) & (key % 7 == 0)
    accession = F.format_string("edgar/%010d-%02d-%06d.txt", key, F.lit(98), (key % 1_000_000).cast("int"))
    filed = F.when(odd & (key % 3 == 0), F.lit("29990101")).when(odd & (key % 3 == 1), F.lit("yesterday")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    line = F.concat_ws("|", F.col("l_suppkey").cast("string"), F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")), F.lit("8-K"), filed, accession)
    line = F.when(odd & (key % 3 == 2), F.concat(line, F.lit("|more"))).otherwise(line)
    heads = spark.createDataFrame([("CIK|Company Name|Form Type|Date Filed|File Name",), ("-" * 60,), ("",)], "line string")
    path = _path(spark, "index")
    li.select(line.alias("line")).unionByName(heads).write.text(path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("s07_daily_index", """WITH l AS (SELECT *, l_linenumber = 1 AND l_orderkey % 7 = 0 AS odd FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    SELECT printf('%010d-98-%06d', l_orderkey, l_orderkey % 1000000) AS accession, '8-K' AS form, o_orderdate::DATE AS filed_on, string_agg(DISTINCT printf('%010d', l_suppkey), '+' ORDER BY printf('%010d', l_suppkey)) AS registrants, count(*) AS lines
    FROM l WHERE NOT odd GROUP BY 1, 2, 3""")
def s07(spark, d):
    return ar.parse_index(index_lines(spark, d), "2010-01-01")[0]


@query("s07_refused_lines", """SELECT CASE l_orderkey % 3 WHEN 0 THEN 'future_date' WHEN 1 THEN 'bad_date' ELSE 'field_count' END AS reason, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE l_linenumber = 1 AND l_orderkey % 7 = 0 GROUP BY 1""")
def s07_refused(spark, d):
    return ar.parse_index(index_lines(spark, d), "2010-01-01")[1].groupBy("reason").agg(F.count("*").alias("n"))


def halves(spark, d):
    """What is stored of each customer (the orders up to 1996) and what comes later."""
    o = scan(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    first = o.filter("o_orderdate < timestamp_ntz'1996-01-01'")
    old = first.groupBy("o_custkey").agg(F.min_by("o_orderkey", "o_orderkey").alias("o_orderkey"), F.min_by("o_orderstatus", "o_orderkey").alias("o_orderstatus"))
    return old, o.filter("o_orderdate >= timestamp_ntz'1996-01-01'").select(*old.columns)


HALVES = """old AS (SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1),
    ign AS (SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1),
    rep AS (SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1)"""


@query("s28_insert_or_ignore", f"WITH {HALVES} SELECT * FROM old UNION ALL SELECT * FROM ign WHERE o_custkey NOT IN (SELECT o_custkey FROM old)")
def s28(spark, d):
    return ar.upsert(*halves(spark, d), ["o_custkey"], "o_orderkey", replace=False)


@query("s28_replace", f"WITH {HALVES} SELECT * FROM rep UNION ALL SELECT * FROM old WHERE o_custkey NOT IN (SELECT o_custkey FROM rep)")
def s28_replace(spark, d):
    return ar.upsert(*halves(spark, d), ["o_custkey"], "o_orderkey", replace=True)


@query("d06_idempotent_reimport", """WITH s AS (SELECT l_partkey AS k, min(l_returnflag) AS v FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01' GROUP BY 1), i AS (SELECT l_partkey AS k, count(DISTINCT l_returnflag) AS kinds, min(l_returnflag) AS v FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-01' GROUP BY 1)
    SELECT i.k AS l_partkey, CASE WHEN kinds > 1 THEN 'conflict' WHEN s.v IS NULL THEN 'new' WHEN s.v = i.v THEN 'same' ELSE 'conflict' END AS effect FROM i LEFT JOIN s USING (k)""")
def d06(spark, d):
    li = scan(spark, d, "lineitem").select("l_partkey", "l_shipdate", F.sha2("l_returnflag", 256).alias("digest"), "l_returnflag")
    old = li.filter("l_shipdate < timestamp_ntz'1997-01-01'").groupBy("l_partkey").agg(F.sha2(F.min("l_returnflag"), 256).alias("digest"))
    return ar.reimport(old, li.filter("l_shipdate >= timestamp_ntz'2001-06-01'"), "l_partkey", "digest")


@query("s27_lean_brief", "SELECT strftime(ts, '%Y-%m-%d') AS run, event_id, event_type FROM events WHERE ts::DATE > (SELECT max(ts)::DATE FROM events) - 7")
def s27(spark, d):
    """The projection that is kept for seven days up to the newest run."""
    e = scan(spark, d, "events")
    newest = e.agg(F.max(F.to_date("ts")).alias("newest"))  # one row
    return e.join(F.broadcast(newest)).filter(F.to_date("ts") > F.date_sub("newest", 7)).select(F.date_format("ts", "yyyy-MM-dd").alias("run"), "event_id", "event_type")


@query("g10_archive_verification", """WITH b AS (SELECT strftime(ts, '%Y-%m-%d') AS run, count(*) AS n, sum(event_id) AS ids, count(*) FILTER (value < 450) AS m, sum(event_id) FILTER (value < 450) AS kept FROM events GROUP BY 1)
    SELECT run, n AS n_rebuilt, m AS n_stored, CASE WHEN m = 0 THEN 'missing' WHEN n = m AND ids = kept THEN 'verified' ELSE 'differs' END AS state FROM b""")
def g10(spark, d):
    """Sightings rebuilt from the written archive against a store that lost the dear ones: each run is verified, differs or is missing."""
    held = scan(spark, d, "events").filter("value < 450").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run")).agg(F.count("*").alias("n_stored"), F.sum("event_id").alias("kept"))
    rebuilt = briefs(spark, d).groupBy("run").agg(F.count("*").alias("n_rebuilt"), F.sum(F.regexp_extract("line", '"id":([0-9]+)', 1).cast("long")).alias("ids"))
    state = F.when(F.col("n_stored").isNull(), "missing").when((F.col("n_rebuilt") == F.col("n_stored")) & (F.col("ids") == F.col("kept")), "verified").otherwise("differs")
    return rebuilt.join(held, "run", "left").select("run", "n_rebuilt", F.coalesce("n_stored", F.lit(0)).alias("n_stored"), state.alias("state"))
