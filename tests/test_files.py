"""Verified files, transactions and spreadsheets."""

import datetime as dt
import hashlib
import os
import time
import zipfile

import pytest

from lodestone.sources import files, sheets


def listed(path):
    return {n: open(f"{path}/{n}", "rb").read() for n in os.listdir(path) if os.path.isfile(f"{path}/{n}")}


def staged(path):
    """Files of writes; tasks that outlive a failed one clean up within moments."""
    for _ in range(50):
        found = [f for _, _, names in os.walk(f"{path}/{files.STAGING}") for f in names]
        if not found:
            break
        time.sleep(0.1)
    return found


@pytest.fixture
def write(spark, tmp_path):
    spark.dataSource.register(files.VerifiedFiles)

    def run(rows, at="a", parts=3, **options):
        df = spark.createDataFrame(rows, files.SCHEMA).repartition(parts)
        df.write.format("verified_files").options(path=f"file://{tmp_path}/{at}", **options).mode("append").save()

    return run


ROWS = [(f"f{k}.json", f"content {k}".encode() * k) for k in range(12)]


def test_files_are_published_once(spark, write, tmp_path):
    write(ROWS, mirror=f"file://{tmp_path}/m")
    assert listed(tmp_path / "a") == dict(ROWS) == listed(tmp_path / "m") and not staged(tmp_path / "a")
    before = os.stat(tmp_path / "a/f3.json").st_mtime_ns
    write([*ROWS[3:], ROWS[3], ("new", b"x")])  # the same bytes again, even twice in one write, change nothing
    assert listed(tmp_path / "a") == dict([*ROWS, ("new", b"x")]) and os.stat(tmp_path / "a/f3.json").st_mtime_ns == before
    got = spark.read.format("verified_files").options(path=f"file://{tmp_path}/a", filesPerPartition="5").load()
    assert got.rdd.getNumPartitions() == 3 and {r.name: bytes(r.content) for r in got.collect()} == listed(tmp_path / "a")


@pytest.mark.parametrize("bad", [("f3.json", b"other"), ("../x", b"y"), ("", b"y"), ("z", None), (files.STAGING, b"y")])
def test_a_failed_write_leaves_nothing(write, tmp_path, bad):
    write(ROWS[:4])
    with pytest.raises(Exception, match="other bytes|not a file name|no content"):
        write([("fresh", b"1"), bad])
    assert listed(tmp_path / "a") == dict(ROWS[:4]) and not staged(tmp_path / "a") and os.listdir(tmp_path) == ["a"]


def test_two_contents_of_one_name(write, tmp_path):
    with pytest.raises(Exception, match="other bytes"):
        write([("n", b"1"), ("n", b"2"), ("m", b"3")])
    assert listed(tmp_path / "a") == {} and not staged(tmp_path / "a")


def test_overwriting_is_refused(spark, write, tmp_path):
    write(ROWS[:2])
    with pytest.raises(Exception, match="never replaced"):
        spark.createDataFrame(ROWS, files.SCHEMA).write.format("verified_files").option("path", f"file://{tmp_path}/a").mode("overwrite").save()
    assert listed(tmp_path / "a") == dict(ROWS[:2])


def test_what_reads_back_otherwise_is_removed(tmp_path, monkeypatch):
    fs, root = files.opened(str(tmp_path))
    monkeypatch.setattr(files, "read_bytes", lambda fs, path: b"torn")
    with pytest.raises(OSError):
        files.write_verified(fs, f"{root}/x", b"whole")
    assert os.listdir(tmp_path) == []


def test_transactions(spark, tmp_path):
    root = f"file://{tmp_path}/state"
    with files.Transaction(spark, root) as t:
        t.put("a", spark.range(3))
        t.put("b", spark.range(5))
    with pytest.raises(RuntimeError, match="stage failed"), files.Transaction(spark, root) as t:
        t.put("a", spark.range(100))
        assert t.get("a").count() == 3  # not published yet
        raise RuntimeError("stage failed")
    t = files.Transaction(spark, root)
    assert t.get("a").count() == 3 and t.get("b").count() == 5 and t.get("c") is None
    assert len(os.listdir(tmp_path / "state/a")) == 1 and sorted(n for n in os.listdir(tmp_path / "state")) == ["a", "b", "current.json"]
    with files.Transaction(spark, root) as t:
        t.put("a", spark.range(7))
    assert t.get("a").count() == 7 and t.get("b").count() == 5


def workbook(path, rows, *, strings=(), styles="", more=(), sheet="Data", rels=""):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{sheet}" r:id="r1"/><sheet name="Other" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/s1.xml"/><Relationship Id="r2" Target="/xl/worksheets/s2.xml"/>{rels}</Relationships>')
        z.writestr("xl/worksheets/s1.xml", f"<worksheet {ns}><sheetData>{rows}</sheetData></worksheet>")
        z.writestr("xl/worksheets/s2.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1"><v>1</v></c></row></sheetData></worksheet>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{s}</t></si>" for s in strings) + "</sst>")
        z.writestr("xl/styles.xml", f"<styleSheet {ns}>{styles}</styleSheet>")
        for name, data in more:
            z.writestr(name, data)


STYLES = '<numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm"/><numFmt numFmtId="171" formatCode="0.0&quot;d&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs>'
GOOD = '<row r="1"><c r="A1" t="s"><v>1</v></c><c r="C1" t="inlineStr"><is><r><t>in</t></r><t>line</t></is></c></row><row r="4"><c r="B4"><v>1.50</v></c><c r="AA4" s="1"><v>45000.25</v></c><c r="AB4" s="2"><v>45000</v></c><c r="AC4" s="3"><v>45000</v></c><c r="AD4" t="b"><v>1</v></c><c r="AE4"/></row>'


def test_sheets(spark, tmp_path):
    spark.dataSource.register(sheets.Sheets)
    workbook(tmp_path / "good.xlsx", GOOD, strings=("zero", "one"), styles=STYLES)
    bad = {
        "formula": '<row r="1"><c r="A1"><f>1+1</f><v>2</v></c></row>', "rows_unordered": '<row r="2"/><row r="2"/>', "cell_reference": '<row r="1"><c r="A1"><v>1</v></c><c r="A1"><v>2</v></c></row>', "malformed_cell": '<row r="1"><c r="A1" t="s"><v>9</v></c></row>',
        "malformed_xml": "<row", "column_limit": '<row r="1">' + "<c/>" * 513 + "</row>",
    }
    for name, rows in bad.items():
        workbook(tmp_path / f"{name}.xlsx", rows, strings=("a",))
    (tmp_path / "not_a_zip_archive.xlsx").write_bytes(b"PK no")
    workbook(tmp_path / "unsafe_part.xlsx", GOOD, more=[("../x", "y")])
    workbook(tmp_path / "too_many_or_doubled_parts.xlsx", GOOD, more=[(f"p{k}", "") for k in range(300)])
    workbook(tmp_path / "unpacked_size_limit.xlsx", GOOD, more=[("big", b"\0" * (sheets.MOST_PART + 1))])
    workbook(tmp_path / "external_relationship.xlsx", GOOD, rels='<Relationship Id="r9" TargetMode="External" Target="http://x"/>')
    workbook(tmp_path / "unsafe_xml.xlsx", '<!DOCTYPE x><row r="1"/>')
    (tmp_path / "ignored.txt").write_text("x")
    rows = spark.read.format("sheets").option("path", f"file://{tmp_path}").load().collect()
    good = [(r.row, r.column, r.kind, r.value, r.day, r.format) for r in rows if r.file == "good.xlsx" and r.sheet == "Data"]
    day = dt.date(2023, 3, 15)
    assert sorted(good) == sorted([(1, 1, "text", "one", None, None), (1, 3, "text", "inline", None, None), (4, 2, "number", "1.50", None, "General"), (4, 27, "number", "45000.25", day, "#14"), (4, 28, "number", "45000", day, "yyyy\\-mm"), (4, 29, "number", "45000", None, '0.0"d"'), (4, 30, "boolean", "1", None, None)])
    refused = {r.file[:-5]: r.reason for r in rows if r.reason}
    names = {*bad, "not_a_zip_archive", "unsafe_part", "too_many_or_doubled_parts", "unpacked_size_limit", "external_relationship", "unsafe_xml"}
    assert refused == {n: n for n in names}
    one = spark.read.format("sheets").options(path=f"file://{tmp_path}/good.xlsx", sheet="Other").load()
    assert [(r.sheet, r.value) for r in one.collect()] == [("Other", "1")]
    gone = spark.read.format("sheets").options(path=f"file://{tmp_path}/good.xlsx", sheet="No").load()
    assert [r.reason for r in gone.collect()] == ["sheet_missing"]


def test_names_and_digests():
    assert files.checked_name("2024-01-01_000000Z.json") and hashlib.sha256(b"").hexdigest().startswith("e3b0")
    assert sheets.column_number("A") == 1 and sheets.column_number("AA") == 27 and sheets.column_number("XFD") == 16384
