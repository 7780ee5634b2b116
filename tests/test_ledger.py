"""Cells: clusters whose longs and shorts cancel."""

import datetime as dt

from lodestone.operators import ledger


def test_what_cancels_is_no_hit_in_any_order(spark):
    day = dt.date(2024, 1, 1)
    runs = ["long"] * 3 + ["short"] * 3, ["short", "short", "long", "long", "long", "short"], ["long"] * 7 + ["short"] * 7, ["long", "none", "long"]
    rows = [("f", f"s{k}", day, ret, side) for k, run in enumerate(runs) for ret in (0.1,) for side in run]
    rows += [("f", "s9", day, 1e30, "long"), ("f", "s8", day, 0.2, None)]
    df = spark.createDataFrame(rows, "family string, symbol string, entry date, ret double, direction string").coalesce(1)
    one = ledger.cell(df, ["family"], least=1).collect()[0]
    assert (one["n_rows"], one["n_clusters"], one["hit_rate"]) == (len(rows), 6, 2 / 5)
