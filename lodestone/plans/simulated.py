"""Portfolios, streams and text extraction on the driver's tables: no DuckDB statement, tested on fixtures."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.functions import text as t
from lodestone.operators import portfolio
from lodestone.sources.scratch import shared_dir
from lodestone.sources.tables import bars, scan
from lodestone.streaming import windows as stream


@query("p01_portfolio")
def p01(spark, d):
    """Equal weights at each month's first session, under two cost scenarios and without cost."""
    b = bars(spark, d)
    first = b.groupBy(F.trunc("session", "month").alias("m")).agg(F.min("session").alias("session")).select("session", F.lit(1 / 6).alias("w"))
    start = b.agg(F.min("session").alias("start"))
    days = b.join(first, "session", "left").crossJoin(F.broadcast(start))  # one row
    scenarios = F.explode(F.array(*[F.struct(F.lit(n).alias("account"), F.lit(c).alias("bps"), F.lit(f).alias("fixed")) for n, c, f in (("gross", 0.0, 0.0), ("net", 10.0, 1.0), ("double", 20.0, 2.0))]))
    rows = days.withColumn("s", scenarios).select("s.*", "session", "symbol", "open", "close", F.col("w").alias("weight"), F.when(F.col("session") == F.col("start"), 100_000.0).otherwise(0.0).alias("contribution"))
    return portfolio.simulate(rows)


@query("t02_stream_confluence", """WITH w AS (SELECT DISTINCT user_id, event_type, event_id, unnest([date_trunc('day', ts) + INTERVAL 1 DAY, date_trunc('day', ts) + INTERVAL 2 DAY]) AS as_of FROM events)
    SELECT user_id AS key, as_of, string_agg(DISTINCT event_type, '+' ORDER BY event_type) AS families, count(*) AS n_events FROM w GROUP BY 1, 2 HAVING count(DISTINCT event_type) >= 2""")
def t02(spark, d):
    """The event table replayed as a stream of files."""
    import uuid

    base = f"{shared_dir(spark)}/lodestone/stream-{uuid.uuid4().hex}"
    e = scan(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    e.withColumn("day", F.date_format("ts", "yyyyMMdd")).repartition("day").sortWithinPartitions("ts").drop("day").write.parquet(f"{base}/in")
    # A last event, of nobody, far enough ahead to close every window before it.
    end = e.agg((F.max("ts") + F.expr("interval 10 days")).alias("ts")).select(F.lit(-1).cast("long").alias("event_id"), "ts", F.lit(None).cast("long").alias("user_id"), F.lit("end").alias("event_type"))
    end.write.mode("append").parquet(f"{base}/in")
    live = stream.confluence(stream.event_stream(spark, f"{base}/in", "event_id long, ts timestamp_ntz, user_id long, event_type string", 1000), "user_id", "event_type", "event_id")
    stream.drain(live, f"{base}/out", f"{base}/state", "append")
    return spark.read.schema("key long, as_of timestamp, families string, n_events long, batch int").parquet(f"{base}/out").drop("batch")


@query("e01_sentences")
def e01(spark, d):
    s = scan(spark, d, "documents").select("doc_id", F.posexplode(t.sentence_spans("text")).alias("n", "s"))
    return s.select("doc_id", "n", F.col("s.a").alias("start"), F.col("s.b").alias("end"))


@query("k08_title_normalize")
def k08(spark, d):
    return scan(spark, d, "documents").select("doc_id", t.nfkc_title(F.substring_index("text", "\n", 1)).alias("title"))


@query("t01_cursor_advance", """WITH p AS (SELECT event_type AS source, ts::DATE AS start, (ts::DATE + 1)::DATE AS end, count(*) >= 40 AS complete FROM events GROUP BY 1, 2, 3), c AS (SELECT DISTINCT event_type AS source, DATE '2024-01-10' AS w FROM events),
    o AS (SELECT *, coalesce(max(p.end) OVER (PARTITION BY source ORDER BY p.start, p.end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), w) AS before FROM c JOIN p USING (source) WHERE complete),
    g AS (SELECT *, bool_or(start > greatest(w, before)) OVER (PARTITION BY source ORDER BY start, o.end ROWS UNBOUNDED PRECEDING) AS gap FROM o)
    SELECT source, greatest(w, coalesce(max(g.end) FILTER (NOT gap), w)) AS watermark FROM c LEFT JOIN g USING (source, w) GROUP BY source, w""")
def t01(spark, d):
    e = scan(spark, d, "events")
    day = F.to_date("ts")
    proven = e.groupBy(F.col("event_type").alias("source"), day.alias("start"), F.date_add(day, 1).alias("end")).agg((F.count("*") >= 40).alias("complete"))
    cursors = e.select(F.col("event_type").alias("source")).distinct().withColumn("watermark", F.lit("2024-01-10").cast("date"))
    return stream.advance_cursors(cursors, proven)
