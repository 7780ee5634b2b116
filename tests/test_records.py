"""Record and feed operators on small fixtures with known answers, nulls and empty tables included."""

import datetime as dt

from pyspark.sql import functions as F

from lodestone.operators import records as rc
from lodestone.sources import feeds as fd


def test_decisions(spark):
    rows = [(1, None, "a", 1), (2, 1, "a", 2), (3, 1, "b", 3), (4, 9, "a", 4), (5, 4, "a", 4)]
    got = rc.judged_decisions(spark.createDataFrame(rows, "k long, s long, scope string, at int"), "k", "s", "scope", "at")
    assert {r["k"]: r["reasons"] for r in got.collect()} == {1: "", 2: "fork", 3: "other_scope+fork", 4: "missing", 5: "not_later"}


def test_change_kinds_never_compare_with_quarantined(spark):
    rows = [(1, 1, "x", True), (1, 2, "y", False), (1, 3, "x", True), (1, 4, None, True), (1, 5, None, True), (1, 6, "z", None)]
    got = rc.change_kinds(spark.createDataFrame(rows, "k long, o int, p string, ok boolean"), ["k"], ["o"], "p", F.col("ok")).orderBy("o").collect()
    assert [(r["kind"], r["head"]) for r in got] == [("new", False), ("quarantined", False), ("same", False), ("changed", False), ("same", True), ("quarantined", False)]


def test_valid_at(spark):
    rows = [(1, 1, 9), (2, 5, 4), (3, 7, 9), (4, 1, 2), (5, 1, 9), (6, None, None)]
    records = spark.createDataFrame(rows, "k long, a int, b int")
    got = rc.valid_at(records, spark.createDataFrame([(5, 5), (5, 8), (1, 6)], "k long, r int"), "k", "a", "b", "r", F.lit(5))
    assert {r["k"]: r["state"] for r in got.collect()} == {1: "valid", 2: "reversed", 3: "not_yet", 4: "expired", 5: "revoked", 6: "valid"}


def test_census_of_nothing_and_of_days(spark):
    scope = spark.createDataFrame([("a",)], "s string")
    none = spark.createDataFrame([], "day date, s string")
    assert rc.census(none, scope, "day", "s").count() == 0
    rows = [(dt.date(2024, 1, 1), "a"), (dt.date(2024, 1, 3), "a"), (dt.date(2024, 1, 3), "a"), (dt.date(2024, 1, 3), "b")]
    got = rc.census(spark.createDataFrame(rows, "day date, s string"), scope, "day", "s").collect()
    assert {(r["day"].day, r["s"]): r["state"] for r in got} == {(1, "a"): "published", (2, "a"): "missing", (3, "a"): "repeated", (3, "b"): "unexpected"}


def test_breadth_counts_disjoint_aliases_in_order(spark):
    rows = [(1, 1, ["a", "b"]), (1, 2, ["b", "c"]), (1, 3, ["c"]), (2, 1, [])]
    got = rc.breadth(spark.createDataFrame(rows, "k long, o int, al array<string>"), "k", ["o"], "al", 5)
    assert {r["k"]: r["breadth"] for r in got.collect()} == {1: 2, 2: 1}


def test_feeds_that_cannot_be_read(spark):
    bodies = [(1, "<feed><entry><id>x</id><title>t</title><updated>soon</updated></entry></feed>"), (2, "no xml"), (3, None), (4, "<feed></feed>")]
    entries, gaps = fd.atom(spark.createDataFrame(bodies, "k long, body string"), "k", "body", 5)
    assert [(r["k"], r["id"], r["title"], r["updated"]) for r in entries.collect()] == [(1, "x", "t", None)]
    assert {(r["k"], r["code"]) for r in gaps.collect()} == {(1, "undated"), (2, "unreadable"), (3, "unreadable"), (4, "unreadable")}


def test_mail_time(spark):
    texts = ["Wed, 15 Jan 1997 00:00:01 GMT", "5 Feb 2001 10:20:30 +0000", "yesterday", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(fd.mail_time(F.col("t")).alias("at")).collect()
    assert [r["at"] for r in got] == [dt.datetime(1997, 1, 15, 0, 0, 1), dt.datetime(2001, 2, 5, 10, 20, 30), None, None]


def test_page_text(spark):
    pages = [("<html><style>p{}</style><p>a &lt;b&gt;\n c</p></html>",), ("<p>x",), (None,)]
    text, gaps = fd.page_text(F.col("html"))
    got = spark.createDataFrame(pages, "html string").select(text.alias("t"), gaps.alias("g")).collect()
    assert [(r["t"], r["g"]) for r in got] == [("a <b> c", ""), ("x", "unclosed"), ("", "empty+unclosed")]
