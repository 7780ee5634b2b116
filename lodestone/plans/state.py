"""The event table replayed as a stream of days: windows as of each event, trimmed histories, deliveries."""

import uuid

from pyspark.sql import functions as F

from lodestone.catalog import query
from lodestone.sources.scratch import shared_dir
from lodestone.sources.tables import scan
from lodestone.streaming import state as st

SCHEMA = "key string, id string, ts timestamp, family string, value double"


def replayed(spark, d, base):
    """A file for each day of events, and a last row far ahead, of nobody, that closes what is open."""
    e = scan(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), F.col("event_id").cast("string").alias("id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("family"), F.col("value").cast("double").alias("value"))
    e.withColumn("day", F.date_format("ts", "yyyyMMdd")).repartition("day").drop("day").sortWithinPartitions("ts").write.parquet(f"{base}/in")
    end = e.agg((F.max("ts") + F.expr("interval 90 days")).alias("ts")).select(F.lit("").alias("key"), F.lit("end").alias("id"), "ts", F.lit("end").alias("family"), F.lit(0.0).alias("value"))
    end.write.mode("append").parquet(f"{base}/in")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1000).parquet(f"{base}/in")


def through(spark, d, processor):
    base = f"{shared_dir(spark)}/lodestone/state-{uuid.uuid4().hex}"
    st.run(st.keyed(replayed(spark, d, base), processor, "48 hours"), lambda b, n: b.write.mode("overwrite").parquet(f"{base}/out/batch={n}"), f"{base}/state")
    return spark.read.schema(processor.SCHEMA + ", batch int").parquet(f"{base}/out").drop("batch")


@query("t02_as_of_confluence", """WITH w AS (SELECT user_id, event_id, list(event_type) OVER o AS f, count(*) OVER o AS n FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 48 HOURS PRECEDING AND CURRENT ROW))
    SELECT user_id::VARCHAR AS key, event_id::VARCHAR AS id, array_to_string(list_sort(list_distinct(f)), '+') AS families, n AS n_events FROM w WHERE len(list_distinct(f)) >= 2""")
def t02_as_of(spark, d):
    """What each event's user showed in the 48 hours that end with it, to the microsecond."""
    return through(spark, d, st.AsOf(48, 2)).select("key", "id", "families", "n_events")


@query("t05_trimmed_stream", """SELECT user_id::VARCHAR AS key, event_id::VARCHAR AS id, count(*) OVER w AS n_prior, round(avg(value) OVER w, 6) AS mean_prior FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id::VARCHAR ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)""")
def t05_stream(spark, d):
    """For each event the mean of its user's up to 20 events before it, from state that holds no more than these."""
    return through(spark, d, st.Trimmed(20)).filter("id <> 'end'").select("key", "id", "n_prior", F.round("mean_prior", 6).alias("mean_prior"))


@query("t07_deliveries", "SELECT event_id::VARCHAR AS delivery_id, count(*) AS n FROM events GROUP BY 1")
def t07_deliveries(spark, d):
    """Every event delivered once, though files overlap by a day and every batch runs twice."""
    base = f"{shared_dir(spark)}/lodestone/outbox-{uuid.uuid4().hex}"
    e = scan(spark, d, "events").select(F.col("event_id").cast("string").alias("delivery_id"), F.explode(F.array(F.to_date("ts"), F.date_add(F.to_date("ts"), 1))).alias("day"))
    e.repartition(8, F.col("day")).drop("day").write.parquet(f"{base}/in")
    box = st.Outbox(spark, f"{base}/box")

    def twice(batch, number):
        box.deliver(batch, number)
        box.deliver(batch, number)

    st.run(spark.readStream.schema("delivery_id string").option("maxFilesPerTrigger", 3).parquet(f"{base}/in"), twice, f"{base}/state")
    return box.delivered().groupBy("delivery_id").agg(F.count("*").alias("n"))
