"""Tables in HTML: spans, headers by content, and readings that disagree."""

from lodestone.sources import tables_html as th

HEAD = "<tr><th>X</th><th>Filing&nbsp;Date</th><th> Ticker</th><th>&Delta;Own %</th></tr>"


def table(body):
    return f"<p>no</p><table><tr><td>menu<td>Ticker tape</table><table class=tiny><tr><td colspan=4>Title</td></tr>{HEAD}{body}</table>"


PAGES = [
    (1, table("<tr><td>a</td><td>2024-01-02</td><td><a href=x>ABC</a></td><td>+5</td></tr><tr><td><td>2024-01-03<td>DE<br>F<td>1%")),
    (2, table("<tr><td rowspan=2>a</td><td>d1</td><td>AA</td><td>1</td></tr><tr><td>d2</td><td>BB</td><td>2</td></tr>")),  # the second row's cells move
    (3, table("<tr><td colspan=2>both</td><td>CC</td><td>3</td></tr><tr><td>x</td><td>y</td><td></td><td>4</td></tr>" + HEAD + "<tr><td>1</td><td>2</td><td>DD</td></tr>")),
    (4, "<table><tr><td>Ticker</td></tr><tr><td>ZZ</td></tr></table>"), (5, None), (6, ""), (7, "<table>" + HEAD + "<tr><td>a</td><td><table>" + HEAD + "<tr><td>i</td><td>j</td><td>IN</td><td>k</td></tr></table>b</td><td>OUT</td><td>9</td></tr></table>"),
    (8, "<table>" + HEAD + "<tr><td>a</td><td>b<script>no</script></td><td>E&amp;F</td><td rowspan=x colspan=0>7</td></tr>"),
]


def test_records(spark):
    pages = spark.createDataFrame(PAGES, "page_id int, html string")
    got = {}
    for r in th.records(pages, "page_id", "ticker", ("filing date", "delta own")).collect():
        got.setdefault(r.page_id, []).append((r.row, r.spread["ticker"], r.spread["filing date"], r.spread["delta own"], r.plain and r.plain["ticker"], r.agree))
    assert {k: sorted(v) for k, v in got.items()} == {
        1: [(2, "ABC", "2024-01-02", "+5", "ABC", True), (3, "DE F", "2024-01-03", "1%", "DE F", True)],
        2: [(2, "AA", "d1", "1", "AA", True), (3, "BB", "d2", "2", None, False)],
        3: [(2, "CC", "both", "3", None, False), (5, "DD", "2", "", None, False)],
        7: [(1, "IN", "j", "k", "IN", True), (1, "OUT", "b", "9", "OUT", True)],
        8: [(1, "E&F", "b", "7", "E&F", True)],
    }


def test_grids_are_bounded():
    reader = th._Tables()
    reader.feed("<table><tr><td rowspan=99999999 colspan=99999999>x<tr><td>y")
    assert len(list(th.placed(reader.cells))) == 2 * th.MOST_COLUMNS  # the next cell has no place left
