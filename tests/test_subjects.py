"""Dated mentions, named subjects, projections, claims, deliveries and poll windows on fixtures with known answers."""

import datetime as dt

from pyspark.sql import functions as F

from lodestone.functions import mentions as mn
from lodestone.operators import subjects as sb


def test_nearest_dates(spark):
    far = "CRL " + "x" * 220 + " 2024-01-02"
    texts = ["PDUFA date is March 5, 2024, not 2024-04-01", "on 31 February 2024 the Action\n Date", far, "recrl 2024-01-01", "", None, "2024-01-01 xx CRL xxxxxxx 2024-01-31"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", F.explode(mn.dated_keywords(F.col("t"), mn.CATALYSTS)).alias("h"))
    got = {(r["k"], r["h"]["start"], r["h"]["kind"], r["h"]["day"]) for r in rows.collect()}
    assert got == {(0, 0, "PDUFA_DATE", dt.date(2024, 3, 5)), (1, 24, "PDUFA_DATE", None), (2, 0, "CRL", None), (6, 14, "CRL", dt.date(2024, 1, 31))}


def test_days_in_all_forms():
    cases = {
        "March 5, 2024": (0, 2024, 3, 5), "MARCH 5th 2024": (0, 2024, 3, 5), "March 5 ,2024": None, "March 5 , 2024": None, "March 5,2024": None, "5 march 2024": (1, 2024, 3, 5), "5th March 2024": None, "2024-03-05": (2, 2024, 3, 5),
        "2024-3-05": None, "2024 -03-05": None, "March 123, 2024": None, "March 5, 20245": None, "March_5 2024": None, "Marchs 5 2024": None, "5 March, 2024": None, "March 22nd, 2024": (0, 2024, 3, 22), "March": None, "5": None, "2024-03-05x": None,
    }
    for text, wanted in cases.items():
        at = mn._day_at(mn.tokens(text))
        assert (at and at[:4]) == wanted, text
    assert mn._days(mn.tokens("31 February 2024, May 1 2024")) == [(18, 0, 28, dt.date(2024, 5, 1))]
    assert [(t.text, t.start) for t in mn.tokens(" A_b-7é\u00a0.x")] == [("a_b", 1), ("-", 4), ("7é", 5), (".", 8), ("x", 9)]


def test_named_subjects(spark):
    symbols, relevance = mn.named_subjects(F.col("t"), {"AB": ["abel corp"], "CD": []})
    texts = ["buy $ab and CD", "CD2 is not it", "CD, AB", "Abel Corp rose", "$ABCDEF", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(symbols.alias("s"), relevance.alias("r")).collect()
    assert [(r["s"], r["r"]) for r in got] == [(["AB", "CD"], 1.0), ([], 0.0), (["AB", "CD"], 0.8), (["AB"], 0.6), ([], 0.0), ([], 0.0)]


def test_without_keys(spark):
    bodies = ['{"b":[{"p":1,"a":2},[{"p":{}}]],"a":null,"p":[1]}', "[1, 2]", "no json", None, '{"a":NaN}', ""]
    got = spark.createDataFrame([(b,) for b in bodies], "b string").select(mn.without_keys(F.col("b"), {"p"}).alias("o")).collect()
    assert [r["o"] for r in got] == ['{"a":null,"b":[{"a":2},[{}]]}', "[1,2]", None, None, None, None]


def test_claim_faults(spark):
    rows = [("rev", "-1.50", "usd", "q1"), ("Rev", "01", "", None), ("a" * 65, "1e3", "x", "y"), (None, None, None, None), ("a\n", "1\n", "x", "y")]
    got = spark.createDataFrame(rows, "k string, v string, u string, p string").select(sb.claim_faults(*map(F.col, "kvup")).alias("f")).collect()
    assert [r["f"] for r in got] == ["", "key+value+unit+period", "key+value", "key+value+unit+period", "key+value"]


def test_outbox(spark):
    rows = [(1, 1, "q"), (1, 2, "a"), (1, 3, "a"), (2, 1, "q"), (2, 2, "a"), (2, 3, "q"), (3, 1, "a"), (4, 1, None), (4, 2, "q")]
    log = spark.createDataFrame(rows, "k int, at int, what string")
    got = sb.outbox(log, "k", ["at"], "at", F.col("what") == "q", F.col("what") == "a").collect()
    assert {(r["k"], r["state"], r["acknowledged_at"]) for r in got} == {(1, "acknowledged", 2), (2, "pending", None), (4, "pending", None)}
    assert sb.outbox(log.limit(0), "k", ["at"], "at", F.col("what") == "q", F.col("what") == "a").count() == 0


def test_poll_windows(spark):
    rows = [("s", 1, None, 5, 10, True), ("s", 2, 5, 6, 20, True), ("s", 3, 5, 7, 20, False), ("s", 4, 6, 6, 20, True), ("t", 5, 5, 9, 30, True), ("s", 6, 6, 8, 40, True), ("s", 7, 7, 8, 50, True)]
    polls = spark.createDataFrame(rows, "s string, c int, before int, mark int, at int, ok boolean")
    got = sb.poll_windows(polls, "s", "c", "before", "mark", "at", F.col("ok")).collect()
    assert {r["c"]: (r["starts"], r["ends"]) for r in got} == {1: (10, 10), 2: (10, 20), 3: (20, 20), 4: (20, 20), 5: (30, 30), 6: (20, 40), 7: (50, 50)}


def test_subject_slice_of_nothing(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id int, t string")
    got = sb.subject_slice({"x": (rows, "id", F.contains("t", F.lit("a"))), "y": (rows.limit(0), "id", F.lit(True))}).collect()
    assert [(r["section"], r["id"]) for r in got] == [("x", 1)]
