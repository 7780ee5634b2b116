"""Tables in HTML: every cell on a grid, headers found by what they say, and two readings that must agree.

The worker only reads tags (grid_cells); all else is DataFrame work.  A cell that spans rows or columns stands in every
place it covers.  The spread reading takes a row's values from the grid's columns, the plain one takes its cells as they
are written, so they differ exactly where spans move something.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELLS = T.ArrayType(T.StructType([*(T.StructField(n, T.IntegerType()) for n in ("table", "row", "column", "place")), T.StructField("header", T.BooleanType()), T.StructField("text", T.StringType())]))
#: The most rows or columns that one cell may span, and the names that headers go by.
MOST_SPAN, MOST_COLUMNS = 1000, 512
SAME_HEADERS = {"deltaown": "delta own", "down": "delta own", "δown": "delta own"}


class _Tables(HTMLParser):
    """Cells in the order they are written: [table, row, is a header, text, rows spanned, columns spanned].  Tables inside tables are tables of their own."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.cells: list[list] = []
        self.open: list[dict] = []  # tables around the place read: number, row, cell (or None)
        self.tables, self.skipping = 0, 0

    def _span(self, attrs: dict, name: str) -> int:
        value = (attrs.get(name) or "1").strip()
        return min(MOST_SPAN, max(1, int(value))) if value.isascii() and value.isdigit() else 1

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skipping += 1
        if tag == "table":
            self.open.append({"n": self.tables, "row": -1, "cell": None})
            self.tables += 1
        elif self.open:
            at = self.open[-1]
            if tag == "tr":
                at["row"] += 1
                at["cell"] = None
            elif tag in ("td", "th"):
                at["row"] = max(at["row"], 0)
                at["cell"] = [at["n"], at["row"], tag == "th", [], self._span(dict(attrs), "rowspan"), self._span(dict(attrs), "colspan")]
                self.cells.append(at["cell"])
            elif tag == "br" and at["cell"]:
                at["cell"][3].append(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skipping = max(0, self.skipping - 1)
        if self.open and tag == "table":
            self.open.pop()
        elif self.open and tag in ("td", "th", "tr"):
            self.open[-1]["cell"] = None

    def handle_data(self, data):
        if self.open and self.open[-1]["cell"] and not self.skipping:
            self.open[-1]["cell"][3].append(data)


def placed(cells: list[list]) -> Iterator[dict]:
    """Cells with every place (row, column) they cover; place is the number of the cell in its written row."""
    taken: dict[tuple[int, int, int], bool] = {}
    written: dict[tuple[int, int], int] = {}
    last = {}
    for table, row, *_ in cells:
        last[table] = row
    for table, row, header, parts, down, across in cells:
        place = written.get((table, row), 0)
        written[table, row] = place + 1
        column = 0
        while taken.get((table, row, column)):
            column += 1
        text = " ".join("".join(parts).split())
        for r in range(row, min(row + down, last[table] + 1)):
            for c in range(column, min(column + across, MOST_COLUMNS)):
                taken[table, r, c] = True
                yield {"table": table, "row": r, "column": c, "place": place if (r, c) == (row, column) else None, "header": header, "text": text}


@F.pandas_udf(CELLS)
def grid_cells(html: pd.Series) -> pd.Series:
    def one(body):
        if not body:
            return []
        reader = _Tables()
        reader.feed(body)
        reader.close()
        return list(placed(reader.cells))

    return html.map(one)


def header_name(text: Column) -> Column:
    name = F.lower(F.trim(F.regexp_replace(F.regexp_replace(text, "[%\\x{A0}]", " "), r"\s+", " ")))
    return F.coalesce(*[F.when(name == k, F.lit(v)) for k, v in SAME_HEADERS.items()], name)


def records(pages: DataFrame, key: str, wanted: str, required: tuple[str, ...]) -> DataFrame:
    """pages (key, html) -> key, table, row, spread and plain (maps of header to text), and agree.

    A table counts if a row of it holds the header `wanted` and all required ones; its first such row names the columns.
    Rows above it, rows without a value under `wanted` and repeated header rows give no record.  The plain reading has a
    record only where a row has as many written cells as headers; where it differs, or has none, agree is false.
    """
    cells = pages.select(key, F.explode(grid_cells("html")).alias("c")).select(key, "c.*")
    rows = cells.groupBy(key, "table", "row").agg(
        F.array_sort(F.collect_list(F.struct("column", "text"))).alias("grid"), F.transform(F.array_sort(F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", "text")))), lambda c: c["text"]).alias("plain")
    )
    names = F.transform("grid", lambda c: header_name(c["text"]))
    rows = rows.withColumn("names", names).withColumn("heads", F.array_contains("names", wanted) & (F.size(F.array_except(F.array(*map(F.lit, required)), "names")) == 0))
    head = rows.filter("heads").groupBy(key, "table").agg(F.min_by(F.struct("row", F.transform("grid", lambda c: c["column"]).alias("columns"), "names"), "row").alias("head"))
    below = rows.join(head, [key, "table"]).filter("row > head.row and not heads")
    at = F.map_from_entries(F.array_distinct(F.col("grid")))
    # Of columns with one name the first counts.
    named = F.filter(F.transform(F.arrays_zip(F.col("head.names").alias("n"), F.col("head.columns").alias("c")), lambda x, i: F.struct(x["n"].alias("n"), x["c"].alias("c"), i.alias("i"))), lambda x: (x["n"] != "") & (F.array_position(F.col("head.names"), x["n"]) == x["i"] + 1))
    spread = F.map_from_entries(F.transform(named, lambda x: F.struct(x["n"], F.coalesce(F.try_element_at(at, x["c"]), F.lit("")))))
    plain = F.when(F.size("plain") == F.size("head.names"), F.map_from_entries(F.transform(named, lambda x: F.struct(x["n"], F.get("plain", x["i"])))))
    out = below.select(key, "table", "row", spread.alias("spread"), plain.alias("plain")).filter(F.col("spread")[wanted] != "")
    return out.withColumn("agree", F.coalesce(F.forall(F.map_entries("spread"), lambda e: e["value"].eqNullSafe(F.try_element_at("plain", e["key"]))), F.lit(False)))
