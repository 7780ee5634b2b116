"""Origins over links between orders, and decisions that match orders with events."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.operators import adjudication as ad
from lodestone.sources.tables import scan

AT = "2000-01-01"


@query("g14_origins", f"""WITH RECURSIVE l AS (SELECT o_custkey AS u, (o_orderkey * 7) % (SELECT count(*) FROM customer) AS v, CASE WHEN o_totalprice > 380000 THEN 'same_release' WHEN o_totalprice > 350000 THEN 'republishes' WHEN o_totalprice < 60000 THEN 'independently_reports' ELSE 'corrects' END AS r FROM orders
        WHERE o_orderdate <= TIMESTAMP '{AT}' AND (o_orderpriority <> '5-LOW' OR o_orderdate::DATE + (o_orderkey % 900)::INTEGER > DATE '{AT}')),
    e AS (SELECT u, v FROM l WHERE r IN ('same_release', 'republishes') UNION ALL SELECT v, u FROM l WHERE r IN ('same_release', 'republishes')),
    w(node, reach) AS (SELECT c_custkey, c_custkey FROM customer UNION SELECT w.node, e.v FROM w JOIN e ON e.u = w.reach),
    g AS (SELECT node, min(reach) AS origin FROM w GROUP BY 1), n AS (SELECT origin, count(*) AS n_members FROM g GROUP BY 1),
    x AS (SELECT DISTINCT a.origin FROM l JOIN g a ON a.node = u JOIN g b ON b.node = v WHERE r = 'independently_reports' AND u <> v AND a.origin = b.origin)
    SELECT node, origin, n_members, origin IN (SELECT origin FROM x) AS contested FROM g JOIN n USING (origin)""")
def g14(spark, d):
    """Customers whose orders say that they carry one story, as of a day; some links had been withdrawn by then."""
    customers, o = scan(spark, d, "customer"), scan(spark, d, "orders")
    n = customers.agg(F.count("*").alias("n"))  # one row
    price, day = F.col("o_totalprice"), F.to_date("o_orderdate")
    relation = F.when(price > 380_000, "same_release").when(price > 350_000, "republishes").when(price < 60_000, "independently_reports").otherwise("corrects")
    withdrawn = F.when(F.col("o_orderpriority") == "5-LOW", F.date_add(day, (F.col("o_orderkey") % 900).cast("int")))
    links = o.crossJoin(F.broadcast(n)).select(F.col("o_custkey").alias("u"), ((F.col("o_orderkey") * 7) % F.col("n")).alias("v"), relation.alias("relation"), day.alias("observed_at"), withdrawn.alias("withdrawn_at"))
    return ad.origins(customers.select(F.col("c_custkey").alias("node")), links, F.lit(AT).cast("date"))


@query("x33_adjudication")
def x33(spark, d):
    """Order lines as decisions that match their order with an event of one of the next orders.  Decisions hang on earlier ones, which SQL can't say."""
    o = scan(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("family"), F.to_date("o_orderdate").alias("seen"), F.col("o_orderstatus").alias("status"))
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    line = scan(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", n.alias("n"))
    decisions = line.select(
        (F.col("l_partkey") * 10**10 + F.col("l_orderkey") * 100 + F.col("n")).alias("decision_id"), F.col("l_orderkey").alias("unit_id"), (F.col("l_orderkey") + F.col("l_suppkey") % 3).alias("event_id"), (F.col("l_suppkey") % 10 == 0).cast("int").alias("revision"), F.to_date("l_shipdate").alias("reviewed_at")
    )
    units = o.select(F.col("o_orderkey").alias("unit_id"), F.lit("all").alias("family"), F.lit("one").alias("origin_id"), F.col("seen").alias("first_observed"))
    events = o.select(F.col("o_orderkey").alias("event_id"), F.lit(0).alias("revision"), F.lit("all").alias("family"), F.lit("one").alias("origin_id"), F.date_add("seen", -400).alias("first_observed"), (F.col("status") == "P").alias("quarantined"))
    return ad.adjudicate(decisions, units, events).select("decision_id", "unit_id", "event_id", "reason", "current")
