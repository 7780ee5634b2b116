"""Technical and baseline measures on the driver's tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.operators import windows as w
from lodestone.sources.tables import BARS_SQL, bars, scan


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("w01_rsi14", f"""WITH {BARS_SQL}, d AS (SELECT *, coalesce(close - lag(close) OVER h, 0) AS d FROM bars WINDOW h AS (PARTITION BY symbol ORDER BY session)),
    g AS (SELECT symbol, session, avg(greatest(d, 0)) OVER f AS g, avg(greatest(-d, 0)) OVER f AS l, count(*) OVER f AS n FROM d WINDOW f AS (PARTITION BY symbol ORDER BY session ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
    SELECT symbol, session, round(CASE WHEN n < 14 OR (g = 0 AND l = 0) THEN NULL WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END, 6) AS rsi FROM g""")
def w01(spark, d):
    return rounded(w.rsi(bars(spark, d)), "rsi")


@query("w02_volume_ratio", f"""WITH {BARS_SQL} SELECT symbol, session, round(CASE WHEN count(volume) OVER f = 20 THEN volume / avg(volume) OVER f END, 6) AS volume_ratio
    FROM bars WINDOW f AS (PARTITION BY symbol ORDER BY session ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)""")
def w02(spark, d):
    return rounded(w.volume_ratio(bars(spark, d)), "volume_ratio")


@query("w03_52w_proximity", f"""WITH {BARS_SQL} SELECT symbol, session, round(close / max(close) OVER f - 1, 6) AS from_high, round(close / min(close) OVER f - 1, 6) AS from_low
    FROM bars WINDOW f AS (PARTITION BY symbol ORDER BY session RANGE BETWEEN INTERVAL 365 DAYS PRECEDING AND CURRENT ROW)""")
def w03(spark, d):
    return rounded(w.range_proximity(bars(spark, d)), "from_high", "from_low")


@query("w04_sma_cross", f"""WITH {BARS_SQL}, m AS (SELECT symbol, session, CASE WHEN count(*) OVER s = 50 THEN avg(close) OVER s END AS a, CASE WHEN count(*) OVER l = 200 THEN avg(close) OVER l END AS b
    FROM bars WINDOW s AS (PARTITION BY symbol ORDER BY session ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), l AS (PARTITION BY symbol ORDER BY session ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)),
    p AS (SELECT *, lag(a) OVER h AS pa, lag(b) OVER h AS pb FROM m WINDOW h AS (PARTITION BY symbol ORDER BY session))
    SELECT symbol, session, round(a, 6) AS sma_short, round(b, 6) AS sma_long, CASE WHEN pa <= pb AND a > b THEN 'golden' WHEN pa >= pb AND a < b THEN 'death' END AS "cross",
    CASE WHEN a > b THEN 'up' WHEN a < b THEN 'down' END AS trend FROM p""")
def w04(spark, d):
    return rounded(w.sma_cross(bars(spark, d)), "sma_short", "sma_long")


@query("w05_turning_points", f"""WITH {BARS_SQL}, n AS (SELECT *, lag(close) OVER h AS a, lag(close, 2) OVER h AS b, lead(close) OVER h AS c, lead(close, 2) OVER h AS e FROM bars WINDOW h AS (PARTITION BY symbol ORDER BY session)),
    k AS (SELECT symbol, session, close, CASE WHEN close > a AND close > b AND close > c AND close > e THEN 'peak' WHEN close < a AND close < b AND close < c AND close < e THEN 'trough' END AS kind FROM n),
    r AS (SELECT symbol, kind, row_number() OVER (PARTITION BY symbol, kind ORDER BY session DESC)::INT AS recency, session, close FROM k WHERE kind IS NOT NULL)
    SELECT * FROM r WHERE recency <= 2""")
def w05(spark, d):
    return w.turning_points(bars(spark, d))


DAILY = "daily AS (SELECT user_id::VARCHAR AS key, ts::DATE AS session, count(*)::DOUBLE AS value FROM events GROUP BY 1, 2)"


@query("a10_baseline_zscore", f"""WITH {DAILY}, b AS (SELECT *, count(value) OVER f AS n, avg(value) OVER f AS m, stddev_pop(value) OVER f AS s FROM daily WINDOW f AS (PARTITION BY key ORDER BY session ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
    z AS (SELECT *, CASE WHEN n >= 15 AND greatest(s, 0.05 * abs(m)) > 1e-9 THEN (value - m) / greatest(s, 0.05 * abs(m)) END AS z FROM b)
    SELECT key, session, value, n AS points, round(CASE WHEN n < 20 AND z IS NOT NULL THEN greatest(-8.0, least(8.0, z)) ELSE z END, 6) AS z FROM z""")
def a10(spark, d):
    out = w.baseline_zscore(w.daily_counts(scan(spark, d, "events"), "user_id"))
    return rounded(out, "z")


@query("a11_burst_ratio", f"""WITH {DAILY}, b AS (SELECT *, list(value) OVER f AS p FROM daily WINDOW f AS (PARTITION BY key ORDER BY session ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
    SELECT key, session, value, round(CASE WHEN len(p) >= 5 THEN value / greatest(list_aggregate(p, 'median'), 1.0) END, 6) AS burst FROM b""")
def a11(spark, d):
    return rounded(w.burst_ratio(w.daily_counts(scan(spark, d, "events"), "user_id")), "burst")


@query("t09_daily_tumbling", f"WITH {DAILY} SELECT * FROM daily")
def t09(spark, d):
    return w.daily_counts(scan(spark, d, "events"), "user_id")


@query("w09_twr_drawdown", f"""WITH {BARS_SQL}, f AS (SELECT symbol AS key, session, close / lag(close) OVER (PARTITION BY symbol ORDER BY session) AS factor FROM bars),
    g AS (SELECT key, session, exp(sum(ln(factor)) OVER (PARTITION BY key ORDER BY session)) AS wealth FROM f WHERE factor IS NOT NULL)
    SELECT key, session, round(ln(wealth), 6) AS log_wealth, round(wealth / greatest(max(wealth) OVER (PARTITION BY key ORDER BY session), 1) - 1, 6) AS drawdown FROM g""")
def w09(spark, d):
    h = Window.partitionBy("symbol").orderBy("session")
    f = bars(spark, d).withColumn("factor", F.try_divide("close", F.lag("close").over(h))).filter("factor is not null")
    return w.wealth_index(f.withColumnRenamed("symbol", "key")).select("key", "session", F.round(F.log("wealth"), 6).alias("log_wealth"), F.round("drawdown", 6).alias("drawdown"))


@query("w13_monthly_sma", f"""WITH {BARS_SQL}, e AS (SELECT symbol, date_trunc('month', session)::DATE AS month, arg_max(close, session) AS close FROM bars GROUP BY 1, 2),
    m AS (SELECT *, avg(close) OVER f AS sma, count(*) OVER f AS n FROM e WINDOW f AS (PARTITION BY symbol ORDER BY month ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
    SELECT symbol, month, close, round(sma, 6) AS sma, close > sma AS invested FROM m WHERE n = 10""")
def w13(spark, d):
    return rounded(w.monthly_rule(bars(spark, d)), "sma")


@query("w14_aligned_return", f"""WITH {BARS_SQL}, c AS (SELECT session FROM (SELECT DISTINCT session FROM bars) ORDER BY session DESC LIMIT 6)
    SELECT symbol, count(close) AS points, round(CASE WHEN count(close) = 6 THEN arg_max(close, session) / arg_min(close, session) - 1 END, 6) AS aligned_return FROM bars JOIN c USING (session) GROUP BY symbol""")
def w14(spark, d):
    b = bars(spark, d)
    return rounded(w.aligned_return(b, b.select("session").distinct()), "aligned_return")


@query("w11_first_last_sighting", "SELECT l_partkey, min(l_shipdate::DATE) AS first_seen, max(l_shipdate::DATE) AS last_seen, count(*) AS sightings FROM lineitem GROUP BY 1")
def w11(spark, d):
    return w.first_last(scan(spark, d, "lineitem").withColumn("at", F.to_date("l_shipdate")), ["l_partkey"], "at")


@query("j07_latest_revision", "SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem) WHERE k = 1")
def j07(spark, d):
    return w.latest(scan(spark, d, "lineitem"), ["l_orderkey"], [F.col("l_linenumber").desc(), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")]).select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")


@query("w18_hash_chain", """WITH RECURSIVE o AS (SELECT conv_id, turn, sha256(role || '|' || text) AS own, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
    r AS (SELECT conv_id, turn, k, sha256('|' || own) AS link FROM o WHERE k = 1 UNION ALL SELECT o.conv_id, o.turn, o.k, sha256(r.link || '|' || o.own) FROM r JOIN o ON o.conv_id = r.conv_id AND o.k = r.k + 1)
    SELECT conv_id, turn, link FROM r""")
def w18(spark, d):
    return w.hash_chain(scan(spark, d, "conversations"), ["conv_id"], "turn", F.concat_ws("|", "role", "text"))
