"""Operators without a DuckDB statement, and edge cases, on small fixtures."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from lodestone.functions import scalars, text
from lodestone.operators import graph, ledger, matching, measures, portfolio, windows
from lodestone.streaming import windows as stream

DAY = dt.date(2024, 1, 1)


def days(n):
    return [DAY + dt.timedelta(k) for k in range(n)]


def test_rsi_edges(spark):
    rows = [("up", d, float(k + 1)) for k, d in enumerate(days(16))] + [("flat", d, 5.0) for d in days(16)]
    got = windows.rsi(spark.createDataFrame(rows, "symbol string, session date, close double")).collect()
    up = [r.rsi for r in sorted((r for r in got if r.symbol == "up"), key=lambda r: r.session)]
    assert up[:13] == [None] * 13 and up[13:] == [100.0] * 3
    assert all(r.rsi is None for r in got if r.symbol == "flat")


def test_baseline_needs_points_and_holds_young_scores(spark):
    rows = [("a", d, 10.0) for d in days(15)] + [("a", days(16)[15], 100.0), ("b", DAY, 1.0)]
    got = {(r.key, r.session): r.z for r in windows.baseline_zscore(spark.createDataFrame(rows, "key string, session date, value double")).collect()}
    assert got["a", days(16)[15]] == 8.0 and got["a", days(15)[14]] is None and got["b", DAY] is None


def test_forward_window_is_on_or_after_and_strictly_after(spark):
    cal = spark.createDataFrame([(d,) for d in (dt.date(2024, 1, 2), dt.date(2024, 1, 5), dt.date(2024, 1, 8))], "session date")
    s = spark.createDataFrame([(0, dt.date(1990, 1, 2)), (1, dt.date(2024, 1, 2)), (2, dt.date(2024, 1, 3)), (3, dt.date(2024, 1, 9))], "record_id int, generated_on date")
    get = lambda strict: {r.record_id: (r.entry, r.exit, r.status) for r in ledger.forward_windows(s, cal, (1,), strict=strict).collect()}
    assert get(False) == {0: (dt.date(2024, 1, 2), dt.date(2024, 1, 5), "filled"), 1: (dt.date(2024, 1, 2), dt.date(2024, 1, 5), "filled"), 2: (dt.date(2024, 1, 5), dt.date(2024, 1, 8), "filled"), 3: (None, None, "pending")}
    assert get(True) == {0: (dt.date(2024, 1, 2), dt.date(2024, 1, 5), "filled"), 1: (dt.date(2024, 1, 5), dt.date(2024, 1, 8), "filled"), 2: (dt.date(2024, 1, 5), dt.date(2024, 1, 8), "filled"), 3: (None, None, "pending")}


def test_greedy_caps_walk(spark):
    rows = [("r", k, p, q) for k, (p, q) in enumerate([("x", 1), ("x", 1), ("x", 2), ("y", 1), ("x", 3), ("y", 2)])]
    got = matching.greedy_caps(spark.createDataFrame(rows, "run string, rank int, p string, q int"), {("p",): 2, ("p", "q"): 1}, 4).collect()
    assert sorted(r["rank"] for r in got) == [0, 2, 3, 5]


def test_greedy_query_equals_a_walk_over_all_rows(spark):
    from lodestone import catalog

    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").toPandas()
    wanted = set()
    for _, day in e.groupby(e["ts"].dt.date):
        types, users, pairs, n = {}, {}, set(), 0
        for r in day.sort_values(["value", "event_id"], ascending=[False, True]).itertuples():
            if n < 5 and types.get(r.event_type, 0) < 3 and users.get(r.user_id, 0) < 2 and (r.event_type, r.user_id) not in pairs:
                n += 1
                types[r.event_type] = types.get(r.event_type, 0) + 1
                users[r.user_id] = users.get(r.user_id, 0) + 1
                pairs.add((r.event_type, r.user_id))
                wanted.add(r.event_id)
    assert {r.event_id for r in catalog.queries()["o05_greedy_caps"](spark, "/root/testdata/sf0.001").collect()} == wanted


def test_reachable_has_no_depth(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(150)] + [(150, 149)], "src int, dst int")
    got = {tuple(r) for r in graph.reachable(spark, chain).collect()}
    assert (0, 150) in got and (149, 149) in got and (3, 2) not in got and len(got) == 150 * 151 // 2 + 3


def test_hash_chain_covers_all_earlier_rows(spark):
    rows = [("a", k, "p") for k in range(5)]
    link = lambda rows: {r.k: r.link for r in windows.hash_chain(spark.createDataFrame(rows, "key string, k int, p string"), ["key"], "k", F.col("p")).collect()}
    one, two = link(rows), link([("a", 0, "x"), *rows[1:]])
    assert all(one[k] != two[k] for k in range(5))


def test_components_and_token_edges(spark):
    t = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i k"), (3, "j i h g f e d c b a"), (4, "a b c"), (5, "a b c d e f g h i j l")]
    rows = spark.createDataFrame(t, "node long, s string").withColumn("s", F.split("s", " "))
    got = {r.node: r.component for r in graph.components(rows.select("node"), graph.token_edges(rows, "node", "s")).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 1}


def test_wilson_bounds(spark):
    low, high = measures.wilson(F.col("k"), F.col("n"))
    r = spark.createDataFrame([(0, 10), (10, 10)], "k int, n int").select(low.alias("l"), high.alias("h")).collect()
    assert r[0].l == 0 and abs(r[0].h - 0.2775) < 1e-3 and abs(r[1].h - 1) < 1e-12


def test_portfolio_invariants(spark):
    schema = "account string, session date, symbol string, open double, close double, weight double, bps double, fixed double, contribution double"
    rows = [("a", days(3)[0], "s", 10.0, 10.0, 1.0, 0.0, 0.0, 1000.0), ("a", days(3)[1], "s", 20.0, 20.0, None, 0.0, 0.0, 1000.0), ("a", days(3)[2], "s", 20.0, 20.0, None, 0.0, 0.0, 0.0), ("idle", DAY, "s", 1.0, 1.0, None, 0.0, 0.0, 500.0)]
    got = {(r.account, r.session): r for r in portfolio.simulate(spark.createDataFrame(rows, schema)).collect()}
    assert got["a", days(3)[1]].wealth == 2.0 and got["a", days(3)[1]].nav == 3000.0  # doubling counts, the contribution doesn't
    assert got["idle", DAY].wealth == 1.0 and got["idle", DAY].drawdown == 0.0
    cash, held, cost, _ = portfolio.rebalanced(1000.0, {}, {"s": 10.0}, {"s": 1.0}, 10.0, 1.0, 1.0)
    assert abs(cash) < 1e-6 and abs(held["s"] * 10 + cost - 1000) < 1e-6
    assert portfolio.annualised(1.1, 200) is None


def test_times_and_urls(spark):
    rows = [("2024-01-02T03:04:05Z", "HTTP://WWW.A.com:80//x//?utm_source=f&b=2&a=1#t"), ("2024-01-02T03:04:05+02:00", "nonsense"), ("2024-01-02T03:04:05", None), ("1700000000", "http://m.b.org/"), ("12", "x"), ("rubbish", "x"), (None, "x")]
    got = spark.createDataFrame(rows, "t string, u string").select(scalars.to_utc(F.col("t")).cast("string").alias("t"), scalars.canonical_url(F.col("u")).alias("u"), scalars.domain(F.col("u")).alias("d")).collect()
    assert [r.t for r in got] == ["2024-01-02 03:04:05", "2024-01-02 01:04:05", "2024-01-02 00:00:00", "2023-11-14 22:13:20", None, None, None]
    assert got[0].u == "http://www.a.com:80/x?a=1&b=2" and got[0].d == "a.com" and got[1].u == "nonsense" and got[2].u is None and got[3].u == "http://m.b.org/" and got[3].d == "b.org"


def test_sentences():
    t = "One. Two is $5 million upfront!\nThree"
    assert [t[a:b] for a, b in text.sentences(t)] == ["One.", "Two is $5 million upfront!", "Three"]


def test_streams_equal_batches(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "user_id", "event_type").limit(300)
    e.write.parquet(str(tmp_path / "in"))
    s = stream.event_stream(spark, str(tmp_path / "in"), "event_id long, ts timestamp_ntz, user_id long, event_type string")
    stream.drain(stream.daily(s, "user_id"), str(tmp_path / "out"), str(tmp_path / "state"), "complete")
    got = spark.read.parquet(str(tmp_path / "out")).select(F.col("key").cast("string").alias("key"), "session", F.col("value").cast("double").alias("value"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, windows.daily_counts(spark.read.parquet(str(tmp_path / "in")), "user_id").collect()))


def test_cursor_never_goes_back(spark):
    c = spark.createDataFrame([("a", days(9)[5]), ("b", days(9)[5])], "source string, watermark date")
    p = spark.createDataFrame([("a", days(9)[4], days(9)[7], True), ("a", days(9)[6], days(9)[8], True), ("b", days(9)[1], days(9)[2], True), ("b", days(9)[4], days(9)[8], False)], "source string, start date, end date, complete boolean")
    assert {r.source: r.watermark for r in stream.advance_cursors(c, p).collect()} == {"a": days(9)[8], "b": days(9)[5]}


def test_cursor_follows_the_chain(spark):
    d = days(20)
    c = spark.createDataFrame([(k, d[10]) for k in "abcde"], "source string, watermark date")
    p = spark.createDataFrame(
        [("a", d[10], d[11], True), ("a", d[11], d[12], True), ("a", d[13], d[15], True), ("b", d[2], d[14], True), ("b", d[3], d[4], True), ("b", d[14], d[16], True), ("c", d[10], d[12], False), ("c", d[12], d[13], True), ("d", d[11], d[12], True)],
        "source string, start date, end date, complete boolean",
    )
    assert {r.source: r.watermark for r in stream.advance_cursors(c, p).collect()} == {"a": d[12], "b": d[16], "c": d[10], "d": d[10], "e": d[10]}


def test_version_gate(spark):
    rows = pd.DataFrame({"v": ["2.6.3", "2.10.0", "2.6.2", "bad", None]})
    assert [r.o for r in spark.createDataFrame(rows).select(matching.version_at_least(F.col("v"), (2, 6, 3)).alias("o")).collect()] == [True, True, False, False, False]
