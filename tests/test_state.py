"""Keyed state and deliveries: the stream gives what a batch over the same rows gives, under lateness, repeats and failures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lodestone.streaming import state as st

START = dt.datetime(2024, 1, 1)
SCHEMA = "key string, id string, ts timestamp, family string, value double"


def events(seed):
    """Rows by arrival: mostly in order, some repeated, some up to a day late, two far too late."""
    r = random.Random(seed)
    rows = sorted(((f"k{r.randrange(5)}", f"e{k}", START + dt.timedelta(minutes=r.randrange(12 * 1440), microseconds=r.randrange(10**6)), r.choice("abcd"), float(r.randrange(100))) for k in range(240)), key=lambda x: x[2])
    arrival = [(x[2] + dt.timedelta(hours=r.choice([0, 0, 0, 20])), x) for x in rows]
    arrival += [(t + dt.timedelta(hours=1), x) for t, x in r.sample(arrival, 40)]
    late = [(START + dt.timedelta(days=11, hours=k), ("k1", f"late{k}", START + dt.timedelta(days=2), "z", 1.0)) for k in range(2)]
    end = (START + dt.timedelta(days=40), ("end", "end", START + dt.timedelta(days=40), "end", 0.0))
    return rows, [x for _, x in sorted([*arrival, *late, end], key=lambda x: x[0])]


def streamed(spark, path, arrived, size=25):
    """One file for each so many rows, in the order they arrive."""
    import time

    for k in range(0, len(arrived), size):
        spark.createDataFrame(arrived[k : k + size], SCHEMA).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def collected(spark, path):
    return spark.read.parquet(path).collect()


@pytest.mark.parametrize("seed", [1])
def test_as_of_equals_batch(spark, tmp_path, seed):
    rows, arrived = events(seed)
    live = st.keyed(streamed(spark, str(tmp_path / "in"), arrived), st.AsOf(48, 2), "36 hours")
    for day in (50, 60):  # later rows let the timers of the last windows fire, in runs that go on from the checkpoint
        st.run(live, lambda b, n: b.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}"), str(tmp_path / "state"))
        spark.createDataFrame([("end", f"end{day}", START + dt.timedelta(days=day), "end", 0.0)], SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
    st.run(live, lambda b, n: b.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}"), str(tmp_path / "state"))
    wanted = []
    for key, i, at, _, _ in rows:
        inside = [x for x in rows if x[0] == key and at - dt.timedelta(hours=48) <= x[2] <= at]
        families = sorted({x[3] for x in inside})
        if len(families) >= 2:
            wanted.append((key, i, at, "+".join(families), len(inside)))
    got = [(r.key, r.id, r.as_of, r.families, r.n_events) for r in collected(spark, str(tmp_path / "out"))]
    assert sorted(got) == sorted(wanted) and len(wanted) > 100
    held = spark.read.format("statestore").option("path", str(tmp_path / "state")).option("stateVarName", "past").option("flattenCollectionTypes", True).load()
    assert held.filter("key.key <> 'end'").count() == 0  # every window has been emptied by its timer


def test_trimmed_equals_batch(spark, tmp_path):
    rows, arrived = events(7)
    live = st.keyed(streamed(spark, str(tmp_path / "in"), arrived, 60), st.Trimmed(6), "36 hours")
    st.run(live, lambda b, n: b.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}"), str(tmp_path / "state"))
    past, wanted = {}, []
    for key, i, _, _, v in rows:
        own = past.setdefault(key, [])
        wanted.append((i, len(own[-6:]), round(sum(own[-6:]) / len(own[-6:]), 6) if own else None))
        own.append(v)
    got = [(r.id, r.n_prior, r.mean_prior if r.mean_prior is None else round(r.mean_prior, 6)) for r in collected(spark, str(tmp_path / "out")) if r.key != "end"]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    held = spark.read.format("statestore").option("path", str(tmp_path / "state")).option("stateVarName", "past").option("flattenCollectionTypes", True).load()
    assert held.count() <= 6 * 6


@pytest.mark.parametrize("point", ["before", "between"])
def test_deliveries_happen_once(spark, tmp_path, point):
    source = str(tmp_path / "in")
    for k in range(3):  # ids overlap between files and within them
        spark.createDataFrame([(f"d{n}", n) for n in [*range(k * 4, k * 4 + 8), k * 4]], "delivery_id string, n int").coalesce(1).write.mode("append").parquet(source)
    live = spark.readStream.schema("delivery_id string, n int").option("maxFilesPerTrigger", 1).parquet(source)
    box, failed = st.Outbox(spark, str(tmp_path / "box")), []

    def deliver(batch, number):
        if number == 1 and not failed:
            failed.append(number)
            if point == "between":  # written, not acknowledged
                whole, box.acknowledge = box.acknowledge, lambda n: (_ for _ in ()).throw(RuntimeError("killed"))
                try:
                    box.deliver(batch, number)
                finally:
                    box.acknowledge = whole
            raise RuntimeError("killed")
        box.deliver(batch, number)

    with pytest.raises(Exception, match="killed"):
        st.run(live, deliver, str(tmp_path / "state"))
    assert {r.batch for r in box.delivered().select("batch").distinct().collect()} == {0}
    st.run(live, deliver, str(tmp_path / "state"))
    got = sorted(r.delivery_id for r in box.delivered().collect())
    assert got == sorted(f"d{n}" for n in range(16)) and failed == [1]
    box.deliver(spark.createDataFrame([("d3", 1), (None, 2)], "delivery_id string, n int"), 9)  # delivered before, or without an id
    assert box.delivered().filter(F.col("batch") == 9).count() == 0


class Held:
    """A handle without Spark: values, lists and timers of one key."""

    def __init__(self):
        self.timers, self.calls = [], 0

    def registerTimer(self, at):
        self.timers.append(at)

    def _state(self, name, schema):
        return State(self)

    getListState = getValueState = _state


class State:
    def __init__(self, handle):
        self.handle, self.value = handle, None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def put(self, value):
        self.handle.calls += 1
        self.value = value

    update = put

    def clear(self):
        self.value = None


class Now:
    def __init__(self, millis):
        self.millis, self.getCurrentWatermarkInMs, self.getExpiryTimeInMs = millis, lambda: millis, lambda: millis


@pytest.mark.parametrize("processor", [st.AsOf(48, 1), st.Trimmed(20)])
def test_rows_that_are_due_are_taken_at_once(processor):
    """A timer for each hour with a row read and wrote all that waited each time."""
    import pandas as pd

    handle, n = Held(), 500
    processor.init(handle)
    base = pd.Timestamp("2024-01-01")
    rows = pd.DataFrame({"key": "k", "id": [f"e{k}" for k in range(n)], "ts": [base + pd.Timedelta(hours=k) for k in range(n)], "family": "f", "value": 1.0})
    list(processor.handleInputRows(("k",), iter([rows]), Now(0)))
    assert len(handle.timers) == 1 and handle.timers[0] == base.value // 10**6 + 3_600_000
    half = base.value // 10**6 + 250 * 3_600_000
    fired = Now(half)
    fired.getExpiryTimeInMs = lambda: handle.timers[0]
    got = pd.concat(processor.handleExpiredTimer(("k",), fired, fired))
    assert got["id"].tolist() == [f"e{k}" for k in range(250)] and handle.calls <= 4
    got = pd.concat(processor.handleExpiredTimer(("k",), Now(half * 2), Now(max(handle.timers))))
    assert got["id"].tolist() == [f"e{k}" for k in range(250, n)] and handle.calls <= 6


def test_windows_as_of_slide():
    """Many rows in one window: counts go along with it, rows of one moment see each other, and the window's first moment is inside."""
    handle, one = Held(), st.AsOf(1, 1)
    one.init(handle)
    hour, n = 3_600_000_000, 30_000
    due = [(f"e{k:05d}", (k // 2) * 100_000, "ab"[k % 2], 0.0) for k in range(n)] + [("last", (n // 2 - 1) * 100_000 + hour, "c", 0.0)]
    out, past = one.taken(("k",), [], due, 10**9)
    assert [r[4] for r in out] == [2 * (k // 2 + 1) for k in range(n)] + [3] and {r[3] for r in out[:-1]} == {"a+b"} and out[-1][3] == "a+b+c"
    assert past == []
