"""Keyed state with timers: windows as of each event, trimmed histories, and deliveries that happen once.

Rows of a key are taken in event time: they wait in the key's state until the watermark has passed them, so what arrives
out of order within the delay is put in order, and what is later is dropped and never changes what was given out.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Timers stand at whole hours: a row's result depends on its own time alone, so all rows that the watermark has passed can be taken together.
STEP_MS = 3_600_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _hour(millis: int) -> int:
    """The first whole hour after a time."""
    return (millis // STEP_MS + 1) * STEP_MS


class _InEventTime(StatefulProcessor):
    """Holds a key's rows (id, micros, family, value) until their time has come."""

    FIELDS = T.StructType([T.StructField("id", T.StringType()), T.StructField("at", T.LongType()), T.StructField("family", T.StringType()), T.StructField("value", T.DoubleType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Rows that wait are read and written whole, so they are one value.
        self.waiting = handle.getValueState("waiting", T.StructType([T.StructField("rows", T.BinaryType())]))
        self.past = handle.getListState("past", self.FIELDS)

    def _held(self) -> list[tuple]:
        """The rows that wait, in order."""
        one = self.waiting.get()
        return pickle.loads(one[0]) if one else []

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {r[0]: r for r in self._held()}
        known = {r[0] for r in self.past.get()} if self.past.exists() else set()
        before = len(held)
        watermark = timerValues.getCurrentWatermarkInMs()
        for part in rows:
            at_all = part["ts"].to_numpy("datetime64[us]").astype("int64").tolist()
            for i, at, family, value in zip(part["id"].tolist(), at_all, part["family"].tolist(), part["value"].tolist(), strict=True):
                # Too late, or seen: the first row of an id counts.
                if at // 1000 < watermark or i in held or i in known:
                    continue
                held[i] = (i, at, family, float(value))
        if len(held) > before:
            rows_held = sorted(held.values(), key=lambda r: (r[1], r[0]))
            self.waiting.update((pickle.dumps(rows_held),))
            # One timer a key, for its first row: those behind it are taken with it or get the next.
            self.handle.registerTimer(_hour(rows_held[0][1] // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # All whole hours up to the watermark at once, not only the timer's own.
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() // STEP_MS * STEP_MS)
        waiting = self._held()
        due = [r for r in waiting if r[1] // 1000 < now]
        past = [tuple(r) for r in self.past.get()] if self.past.exists() else []
        rest = waiting[len(due) :]
        out, past = self.taken(key, past, due, now)
        if due:
            (self.waiting.update((pickle.dumps(rest),)) if rest else self.waiting.clear())
        if rest:
            self.handle.registerTimer(_hour(rest[0][1] // 1000))
        (self.past.put(past) if past else self.past.clear())
        if out:
            yield pd.DataFrame(out, columns=self.COLUMNS)

    def taken(self, key, past: list[tuple], due: list[tuple], now: int) -> tuple[list[tuple], list[tuple]]:
        """What the due rows give out, and the past that is kept."""
        raise NotImplementedError

    def close(self) -> None:
        pass


class AsOf(_InEventTime):
    """For each row the families of the key within the window that ends with it; the window's rows are the state, which a timer empties."""

    SCHEMA = "key string, id string, as_of timestamp, families string, n_events long"
    COLUMNS = ("key", "id", "as_of", "families", "n_events")

    def __init__(self, hours: int, least: int):
        self.span, self.least = hours * 3_600_000_000, least

    def taken(self, key, past, due, now):
        out, every, counts = [], [*past, *due], Counter()
        low = high = 0
        for r in due:
            # Rows of one moment are in each other's windows.
            while high < len(every) and every[high][1] <= r[1]:
                counts[every[high][2]] += 1
                high += 1
            while every[low][1] < r[1] - self.span:
                counts[every[low][2]] -= 1
                low += 1
            families = sorted(k for k, n in counts.items() if n)
            if len(families) >= self.least:
                out.append((key[0], r[0], pd.Timestamp(r[1] * 1000), "+".join(families), high - low))
        if due:
            self.handle.registerTimer(_hour((due[-1][1] + self.span) // 1000))
        return out, [r for r in every if r[1] // 1000 >= now - 1 - self.span // 1000]


class Trimmed(_InEventTime):
    """For each row how many of the key's rows before it are held, at most `most`, and their mean; the newest rows are the state, with a time to live."""

    SCHEMA = "key string, id string, as_of timestamp, n_prior long, mean_prior double"
    COLUMNS = ("key", "id", "as_of", "n_prior", "mean_prior")

    def __init__(self, most: int):
        self.most = most

    def taken(self, key, past, due, now):
        out = []
        for r in due:
            values = [x[3] for x in past]
            out.append((key[0], r[0], pd.Timestamp(r[1] * 1000), len(past), sum(values) / len(past) if past else None))
            past = [*past, r][-self.most :]
        return out, past


def keyed(events: DataFrame, processor: _InEventTime, late: str) -> DataFrame:
    """events (key, id, ts, family, value; strings but for ts and value) through a processor, which gives out a row's result once the watermark has passed it."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return e.groupBy("key").transformWithStateInPandas(statefulProcessor=processor, outputStructType=processor.SCHEMA, outputMode="Append", timeMode="EventTime")


def run(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Runs all that is there and stops.  The state store that timers need is set for the start of this query only."""
    spark: SparkSession = stream.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        q = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
        q.awaitTermination()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
    return q


class Outbox:
    """Deliveries that happen once, though a batch may run again after a failure at any point.

    A batch's new deliveries (ids not delivered by an earlier batch, once each) replace the folder of its number, then its
    acknowledgement is written.  A batch that runs again does the same once more with the same result, whatever it had got
    to; delivered() reads acknowledged batches only, so a half-written one is never seen.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "delivery_id"):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key

    def _read(self, what: str) -> DataFrame | None:
        """Rows of all batches so far, with the batch; None before the first."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{what}")
        there = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)
        return self.spark.read.parquet(f"{self.root}/{what}") if there else None

    def deliver(self, batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates([self.key]).filter(F.col(self.key).isNotNull())
        sent = self._read("sent")
        if sent is not None:
            fresh = fresh.join(sent.filter(F.col("batch") < number).select(self.key), self.key, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{self.root}/sent/batch={number}")
        self.acknowledge(number)

    def acknowledge(self, number: int) -> None:
        count = self.spark.read.parquet(f"{self.root}/sent/batch={number}").count()
        self.spark.createDataFrame([(count,)], "n long").write.mode("overwrite").parquet(f"{self.root}/acknowledged/batch={number}")

    def delivered(self) -> DataFrame:
        done = self._read("acknowledged").select("batch")
        return self._read("sent").join(F.broadcast(done), "batch")  # a row for each batch
