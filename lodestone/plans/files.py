"""Files and workbooks written from the tables through the verified sink, and read again."""

import io
import uuid
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.catalog import query
from lodestone.sources import files, sheets, tables_html
from lodestone.sources.scratch import shared_dir
from lodestone.sources.tables import scan


def _folder(spark, label):
    return f"{shared_dir(spark)}/lodestone/{label}-{uuid.uuid4().hex}"


def briefs(spark, d):
    """A file for each month of orders: its number of orders and customers."""
    o = scan(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("m")).agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("c"))
    text = F.concat(F.lit('{"month":"'), "m", F.lit('","orders":'), F.col("n").cast("string"), F.lit(',"customers":'), F.col("c").cast("string"), F.lit("}\n"))
    return o.select(F.concat("m", F.lit(".json")).alias("name"), text.cast("binary").alias("content"))


BRIEFS_SQL = """b AS (SELECT strftime(o_orderdate, '%Y-%m') || '.json' AS name, '{"month":"' || strftime(o_orderdate, '%Y-%m') || '","orders":' || count(*) || ',"customers":' || count(DISTINCT o_custkey) || '}' || chr(10) AS t FROM orders GROUP BY strftime(o_orderdate, '%Y-%m'))
    SELECT name, strlen(t) AS n_bytes, sha256(t) AS digest FROM b"""


def _told(df):
    return df.select("name", F.octet_length("content").cast("long").alias("n_bytes"), F.sha2("content", 256).alias("digest"))


@query("s23_verified_files", f"WITH {BRIEFS_SQL}")
def s23(spark, d):
    """Monthly files as published, after a write that other bytes of one name must stop."""
    spark.dataSource.register(files.VerifiedFiles)
    at, made = _folder(spark, "files"), briefs(spark, d)
    made.write.format("verified_files").option("path", at).mode("append").save()
    try:
        made.limit(1).withColumn("content", F.encode(F.lit("torn"), "UTF-8")).write.format("verified_files").option("path", at).mode("append").save()
        raise AssertionError("other bytes were taken")
    except Exception as e:
        if "other bytes" not in str(e) or isinstance(e, AssertionError):
            raise
    return _told(spark.read.format("verified_files").option("path", at).load())


@query("s24_mirrored_files", f"WITH {BRIEFS_SQL}")
def s24(spark, d):
    """The mirror of files that were published in two overlapping writes."""
    spark.dataSource.register(files.VerifiedFiles)
    at, mirror, made = _folder(spark, "files"), _folder(spark, "mirror"), briefs(spark, d)
    for part in (made.filter("name < '1998'"), made):
        part.write.format("verified_files").options(path=at, mirror=mirror).mode("append").save()
    return _told(spark.read.format("verified_files").option("path", mirror).load())


@query("t11_state_rollback", "SELECT user_id, count(*) AS n, max(ts) AS last FROM events WHERE event_id % 2 = 0 GROUP BY 1")
def t11(spark, d):
    """State as the last good run left it: the run that failed in its second table changed neither."""
    root, e = _folder(spark, "run"), scan(spark, d, "events")
    state = lambda rows: rows.groupBy("user_id").agg(F.count("*").alias("n"), F.max("ts").alias("last"))
    with files.Transaction(spark, root) as run:
        run.put("seen", state(e.filter("event_id % 2 = 0")))
        run.put("runs", spark.createDataFrame([(1,)], "run int"))
    try:
        with files.Transaction(spark, root) as run:
            run.put("seen", state(e))
            run.put("runs", spark.createDataFrame([(2,)], "run int").select(F.raise_error(F.lit("stage failed")).cast("int").alias("run")))
    except Exception as failed:
        if "stage failed" not in str(failed):
            raise
    return files.Transaction(spark, root).get("seen")


NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


@F.pandas_udf(T.BinaryType())
def workbooks(rows: pd.Series, names: pd.Series) -> pd.Series:
    """A workbook for each list of (key, name, balance, day number): shared strings, numbers and dates, a gap before the dates."""

    def one(cells, sheet):
        strings = sorted({c["name"] for c in cells})
        lines = "".join(f'<row r="{2 * k + 1}"><c r="A{2 * k + 1}"><v>{c["key"]}</v></c><c r="B{2 * k + 1}" t="s"><v>{strings.index(c["name"])}</v></c><c r="C{2 * k + 1}"><v>{c["balance"]}</v></c><c r="E{2 * k + 1}" s="1"><v>{c["day"]}</v></c></row>' for k, c in enumerate(cells))
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("xl/workbook.xml", f'<workbook {NS} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{escape(sheet)}" r:id="r1"/></sheets></workbook>')
            z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
            z.writestr("xl/sharedStrings.xml", f"<sst {NS}>" + "".join(f"<si><t>{escape(s)}</t></si>" for s in strings) + "</sst>")
            z.writestr("xl/styles.xml", f'<styleSheet {NS}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
            z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {NS}><sheetData>{lines}</sheetData></worksheet>")
        return out.getvalue()

    return pd.Series([one(sorted(r, key=lambda c: c["key"]), n) for r, n in zip(rows, names, strict=True)])


@query("s20_sheets", """WITH s AS (SELECT n_name, c_custkey AS k, c_name, c_acctbal, row_number() OVER (PARTITION BY n_name ORDER BY c_custkey) * 2 - 1 AS r FROM customer JOIN nation ON n_nationkey = c_nationkey)
    SELECT n_name || '.xlsx' AS file, n_name AS sheet, r::INTEGER AS row, unnest([1, 2, 3, 5])::INTEGER AS "column", unnest(['number', 'text', 'number', 'number']) AS kind, unnest([k::VARCHAR, c_name, printf('%.2f', c_acctbal), (30000 + k % 10000)::VARCHAR]) AS value,
           unnest([NULL, NULL, NULL, DATE '1899-12-30' + (30000 + k % 10000)::INTEGER]) AS day FROM s""")
def s20(spark, d):
    """Customers as a workbook for each nation, read cell by cell."""
    spark.dataSource.register(files.VerifiedFiles)
    spark.dataSource.register(sheets.Sheets)
    at, c = _folder(spark, "sheets"), scan(spark, d, "customer")
    row = F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.format_string("%.2f", "c_acctbal").alias("balance"), (30000 + F.col("c_custkey") % 10000).alias("day"))
    named = c.join(scan(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey").groupBy("n_name").agg(F.collect_list(row).alias("rows"))
    made = named.select(F.concat("n_name", F.lit(".xlsx")).alias("name"), workbooks("rows", "n_name").alias("content"))
    made.write.format("verified_files").option("path", at).mode("append").save()
    return spark.read.format("sheets").option("path", at).load().filter("reason is null").select("file", "sheet", "row", "column", "kind", "value", "day")


@query("s17_html_tables", """WITH o AS (SELECT o_custkey, o_orderkey, o_orderstatus AS s, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey % 7 AS t, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus, o_orderkey) AS row, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) = 1 AS first, printf('%.2f', o_totalprice) AS v FROM orders)
    SELECT o_custkey, row::INTEGER AS row, s AS status, day AS filed, 'T' || t AS ticker, v AS value, first AS agree FROM o WHERE o_orderkey % 11 <> 0""")
def s17(spark, d):
    """A page for each customer: its orders by status, whose cell spans all rows of that status; rows without a ticker are no records."""
    key = F.col("o_orderkey")
    ticker = F.when(key % 11 == 0, "").otherwise(F.concat(F.lit("T"), (key % 7).cast("string")))
    row = F.struct(key.alias("key"), F.format_string("<td>%s</td><td><b>%s</b></td><td>%.2f</td></tr>", F.date_format("o_orderdate", "yyyy-MM-dd"), ticker, "o_totalprice").alias("html"))
    group = scan(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.transform(F.sort_array(F.collect_list(row)), lambda x: x["html"]).alias("rows"))
    first = F.concat(F.lit("<tr><td rowspan="), F.size("rows").cast("string"), F.lit(">"), "o_orderstatus", F.lit("</td>"))
    spanned = F.concat(first, F.array_join("rows", "<tr>"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o_orderstatus", spanned.alias("html")))), lambda x: x["html"]), "")
    pages = group.groupBy("o_custkey").agg(F.concat(F.lit("<html><body><p>Trades</p><table><tr><th>Status<th>Filing&nbsp;Date<th> TICKER <th>Value %</tr>"), body, F.lit("</table></body></html>")).alias("html"))
    found = tables_html.records(pages, "o_custkey", "ticker", ("filing date", "value"))
    value = lambda c: F.col("spread")[c]
    return found.select("o_custkey", "row", value("status").alias("status"), value("filing date").alias("filed"), value("ticker").alias("ticker"), value("value").alias("value"), "agree")
