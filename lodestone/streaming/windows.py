"""Structured Streaming versions of the event-time operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def daily(events: DataFrame, key: str, at: str = "ts", late: str = "2 days") -> DataFrame:
    """Tumbling days per key; a day closes when the watermark has passed it."""
    e = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return e.groupBy(F.col(key).alias("key"), F.window(at, "1 day").alias("w")).agg(F.count("*").alias("value")).select("key", F.to_date("w.start").alias("session"), "value")


def confluence(events: DataFrame, key: str, family: str, identity: str, at: str = "ts", hours: int = 48, slide: str = "24 hours", least: int = 2) -> DataFrame:
    """Sliding windows in which a key shows at least `least` families; an event counts once however often it arrives."""
    e = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, f"{hours} hours").dropDuplicatesWithinWatermark([identity])
    g = e.groupBy(F.col(key).alias("key"), F.window(at, f"{hours} hours", slide).alias("w")).agg(F.array_sort(F.collect_set(family)).alias("families"), F.count("*").alias("n_events"))
    return g.filter(F.size("families") >= least).select("key", F.col("w.end").alias("as_of"), F.array_join("families", "+").alias("families"), "n_events")


def sessions(events: DataFrame, key: str, at: str = "ts", gap: str = "6 hours", late: str = "2 days") -> DataFrame:
    e = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return e.groupBy(F.col(key).alias("key"), F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n")).select("key", "w.start", "w.end", "n")


def idempotent_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Each batch goes to a folder of its own number, replaced when the batch runs again."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Runs all that is there through the sink and stops."""
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(idempotent_sink(path)).start()
    q.awaitTermination()
    return q


def advance_cursors(cursors: DataFrame, proven: DataFrame) -> DataFrame:
    """Per source the watermark moves to the end of the chain of complete intervals that it is in or at the start of, and never back."""
    whole = cursors.join(proven.filter("complete"), "source")
    order = Window.partitionBy("source").orderBy("start", "end")  # the proven intervals of one source
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    # From the first interval on that starts beyond all before it, nothing joins the chain.
    gap = F.max(F.col("start") > F.greatest("watermark", "before")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    reach = whole.withColumn("before", before).withColumn("gap", gap).filter("not gap").groupBy("source").agg(F.max("end").alias("r"))
    return cursors.join(reach, "source", "left").select("source", F.greatest("watermark", "r").alias("watermark"))
