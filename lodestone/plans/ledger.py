"""Signal outcomes on the driver's tables: orders as signals, lineitem's bars as prices."""

from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.operators import ledger as l
from lodestone.plans.technicals import rounded
from lodestone.sources.tables import BARS_SQL, SIGNALS_SQL, bars, signals

MEMBERS = ["AF", "AO", "NF", "NO", "RF", "RO"]
WINDOWS = f"""{BARS_SQL}, {SIGNALS_SQL}, cal AS (SELECT session, row_number() OVER (ORDER BY session) AS k FROM (SELECT DISTINCT session FROM bars)),
    hz AS (SELECT unnest([1, 5, 20]) AS horizon),
    w AS (SELECT s.*, hz.horizon, c.session AS entry, c.k AS k, x.session AS exit, CASE WHEN x.session IS NULL THEN 'pending' ELSE 'filled' END AS status
      FROM signals s ASOF LEFT JOIN cal c ON s.generated_on <= c.session CROSS JOIN hz LEFT JOIN cal x ON x.k = c.k + hz.horizon)"""
RETURNS = f"""{WINDOWS}, r AS (SELECT w.* EXCLUDE (status), CASE WHEN a.close > 0 AND b.close > 0 THEN b.close / a.close - 1 END AS ret, w.status AS ws FROM w
      LEFT JOIN bars a ON a.symbol = w.symbol AND a.session = w.entry LEFT JOIN bars b ON b.symbol = w.symbol AND b.session = w.exit),
    sp AS (SELECT DISTINCT entry, exit FROM w WHERE exit IS NOT NULL),
    bm AS (SELECT sp.entry, sp.exit, count(a.close * b.close) AS priced, sum((b.close / a.close - 1) / 6) AS uw FROM sp CROSS JOIN (SELECT DISTINCT symbol FROM bars) m
      LEFT JOIN bars a ON a.symbol = m.symbol AND a.session = sp.entry LEFT JOIN bars b ON b.symbol = m.symbol AND b.session = sp.exit GROUP BY 1, 2),
    o AS (SELECT r.*, CASE WHEN ws = 'pending' THEN 'pending' WHEN ret IS NULL THEN 'unpriceable' ELSE 'filled' END AS status, priced, CASE WHEN priced = 6 THEN uw END AS univ_ret,
      CASE WHEN priced = 6 THEN 'complete' WHEN priced > 0 THEN 'partial' WHEN priced = 0 THEN 'unavailable' END AS benchmark_status FROM r LEFT JOIN bm USING (entry, exit))"""


def _outcomes(spark, d):
    return l.outcomes(signals(spark, d), bars(spark, d), MEMBERS)


@query("j03_forward_asof_window", f"WITH {WINDOWS} SELECT record_id, horizon, entry, exit, status FROM w")
def j03(spark, d):
    return l.forward_windows(signals(spark, d), bars(spark, d)).select("record_id", "horizon", "entry", "exit", "status")


@query("j04_strict_asof_decision", f"""WITH {BARS_SQL}, {SIGNALS_SQL}, cal AS (SELECT session, row_number() OVER (ORDER BY session) AS k FROM (SELECT DISTINCT session FROM bars)),
    w AS (SELECT s.record_id, c.k FROM signals s ASOF LEFT JOIN cal c ON s.generated_on < c.session)
    SELECT record_id, e.session AS entry FROM w LEFT JOIN cal e ON e.k = w.k + 1""")
def j04(spark, d):
    return l.forward_windows(signals(spark, d), bars(spark, d), (0,), strict=True, delay=1).select("record_id", "entry")


@query("j02_window_endpoints", f"WITH {RETURNS} SELECT record_id, horizon, status, round(ret, 6) AS ret FROM o")
def j02(spark, d):
    return rounded(l.window_returns(l.forward_windows(signals(spark, d), bars(spark, d)), bars(spark, d)).select("record_id", "horizon", "status", "ret"), "ret")


@query("j13_cohort_fanout", f"""WITH {WINDOWS}, sp AS (SELECT DISTINCT entry, exit FROM w WHERE exit IS NOT NULL), m AS (SELECT DISTINCT symbol FROM bars)
    SELECT sp.entry, sp.exit, m.symbol, round(CASE WHEN a.close > 0 AND b.close > 0 THEN b.close / a.close - 1 END, 6) AS ret FROM sp CROSS JOIN m
    LEFT JOIN bars a ON a.symbol = m.symbol AND a.session = sp.entry LEFT JOIN bars b ON b.symbol = m.symbol AND b.session = sp.exit""")
def j13(spark, d):
    w = l.forward_windows(signals(spark, d), bars(spark, d)).filter("exit is not null").select("entry", "exit").distinct()
    fan = w.withColumn("symbol", F.explode(F.array(*map(F.lit, MEMBERS)))).withColumn("status", F.lit("filled"))
    return rounded(l.window_returns(fan, bars(spark, d)).select("entry", "exit", "symbol", "ret"), "ret")


@query("a15_cohort_benchmark", f"""WITH {RETURNS} SELECT entry, exit, priced, round(CASE WHEN priced = 6 THEN uw END, 6) AS univ_ret,
    CASE WHEN priced = 6 THEN 'complete' WHEN priced > 0 THEN 'partial' ELSE 'unavailable' END AS benchmark_status FROM bm""")
def a15(spark, d):
    return rounded(l.cohort_benchmark(l.forward_windows(signals(spark, d), bars(spark, d)), bars(spark, d), MEMBERS), "univ_ret")


def cell_sql(keys, source):
    return f"""c AS (SELECT {keys}, symbol, entry, avg(ret) AS r, avg(CASE direction WHEN 'short' THEN -ret WHEN 'long' THEN ret END) AS s, count(*) AS n FROM {source} WHERE ret IS NOT NULL GROUP BY {keys}, symbol, entry)
    SELECT {keys}, sum(n)::BIGINT AS n_rows, count(*) AS n_clusters, round(CASE WHEN count(*) >= 20 THEN avg(r) END, 6) AS mean, round(CASE WHEN count(*) >= 20 THEN quantile_cont(r, 0.25) END, 6) AS p25,
    round(CASE WHEN count(*) >= 20 THEN median(r) END, 6) AS median, round(CASE WHEN count(*) >= 20 THEN quantile_cont(r, 0.75) END, 6) AS p75,
    round(CASE WHEN count(s) >= 20 THEN avg((s > 0)::INT) END, 6) AS hit_rate FROM c GROUP BY {keys}"""


CELL = ("mean", "p25", "median", "p75", "hit_rate")


@query("a01_ledger_cell", f"WITH {RETURNS}, {cell_sql('family, horizon', 'o')}")
def a01(spark, d):
    return rounded(l.cell(_outcomes(spark, d), ["family", "horizon"]), *CELL)


@query("a02_multi_grain", f"""WITH {RETURNS}, g AS (SELECT *, 'family' AS grain, family AS key FROM o UNION ALL SELECT *, 'family|direction', family || '|' || direction FROM o
    UNION ALL SELECT *, 'symbol', symbol FROM o), {cell_sql('grain, key, horizon', 'g')}""")
def a02(spark, d):
    grains = {"family": F.col("family"), "family|direction": F.concat_ws("|", "family", "direction"), "symbol": F.col("symbol")}
    return rounded(l.cell(l.multi_grain(_outcomes(spark, d), grains), ["grain", "key", "horizon"]), *CELL)


@query("a03_partitioned_cell", f"""WITH {RETURNS}, g AS (SELECT *, CASE WHEN entry >= DATE '2000-01-01' THEN 'holdout' WHEN exit >= DATE '2000-01-01' THEN 'purged' ELSE 'development' END AS part FROM o), {cell_sql('part, family, horizon', 'g')}""")
def a03(spark, d):
    o = _outcomes(spark, d)
    return rounded(l.cell(o.withColumn("part", l.partition_of(F.col("entry"), F.col("exit"), "2000-01-01")), ["part", "family", "horizon"]), *CELL)


@query("a04_energy_ratio", f"""WITH {RETURNS} SELECT family, horizon, count(*) AS pairs, round(CASE WHEN count(*) >= 20 AND median(abs(univ_ret)) > 1e-12 THEN median(abs(ret)) / median(abs(univ_ret)) END, 6) AS energy,
    CASE WHEN median(abs(univ_ret)) <= 1e-12 THEN 'undefined_zero_benchmark' ELSE 'defined' END AS state FROM o WHERE ret IS NOT NULL AND univ_ret IS NOT NULL AND benchmark_status = 'complete' GROUP BY 1, 2""")
def a04(spark, d):
    return rounded(l.energy(_outcomes(spark, d), ["family", "horizon"]), "energy")


@query("a19_readiness", f"""WITH {RETURNS} SELECT family, horizon, count(*) AS n_total, count(ret) AS usable, count(*) FILTER (direction <> 'none' AND ret IS NOT NULL) AS directional,
    count(DISTINCT CASE WHEN ret IS NOT NULL THEN symbol || entry::VARCHAR END) AS clusters, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'unpriceable') AS unpriceable FROM o GROUP BY 1, 2""")
def a19(spark, d):
    o = _outcomes(spark, d)
    return o.groupBy("family", "horizon").agg(
        F.count("*").alias("n_total"), F.count("ret").alias("usable"), F.count_if((F.col("direction") != "none") & F.col("ret").isNotNull()).alias("directional"),
        F.count_distinct(F.when(F.col("ret").isNotNull(), F.concat("symbol", F.col("entry").cast("string")))).alias("clusters"), F.count_if(F.col("status") == "pending").alias("pending"), F.count_if(F.col("status") == "unpriceable").alias("unpriceable"),
    )
