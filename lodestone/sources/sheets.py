"""Spreadsheets (Office Open XML) as a bounded data source: one partition for each sheet, one row for each cell.

    spark.dataSource.register(Sheets)
    spark.read.format("sheets").option("path", uri).load()

The path is one workbook, or a folder of them.  What is too large or unsafe is refused with a reason as a row of its own,
never read in part: limits hold for the file, its parts, what they expand to, shared strings, columns and rows.  Text cells
come from the shared strings or inline; numbers keep their text and get their style's format, and those with a date format
are dates; formulas, unordered rows and doubled cells refuse their sheet.  Gaps in rows and columns stay gaps.
"""

from __future__ import annotations

import datetime as dt
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from io import BytesIO
from xml.etree import ElementTree

import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lodestone.sources.files import opened, read_bytes

SCHEMA = "file string, sheet string, row int, column int, kind string, value string, day date, format string, reason string"
#: The most bytes of a file, of one part and of all parts unpacked; parts, shared strings, columns and rows.
MOST_BYTES, MOST_PART, MOST_UNPACKED, MOST_PARTS, MOST_STRINGS, MOST_COLUMNS, MOST_ROWS = 30_000_000, 110_000_000, 150_000_000, 300, 300_000, 512, 100_000
MAIN, RELATED = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}", "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"
#: Built-in number formats that show a day.
DAYS = frozenset((14, 15, 16, 17, 22))


class Refused(Exception):
    """Why a workbook or sheet isn't read."""


class Workbook:
    """A workbook's parts, under the limits."""

    def __init__(self, data: bytes):
        if len(data) > MOST_BYTES:
            raise Refused("file_size_limit")
        try:
            self.zip = zipfile.ZipFile(BytesIO(data))
        except zipfile.BadZipFile:
            raise Refused("not_a_zip_archive") from None
        parts = self.zip.infolist()
        names = [p.filename for p in parts]
        if len(parts) > MOST_PARTS or len(set(names)) < len(names):
            raise Refused("too_many_or_doubled_parts")
        if any(p.file_size > MOST_PART for p in parts) or sum(p.file_size for p in parts) > MOST_UNPACKED:
            raise Refused("unpacked_size_limit")
        if any(p.flag_bits & 1 or p.filename.startswith("/") or "\\" in p.filename or ".." in p.filename.split("/") for p in parts):
            raise Refused("unsafe_part")
        self.names = frozenset(names)

    def part(self, name: str) -> bytes:
        if name not in self.names:
            raise Refused("part_missing")
        try:
            raw = self.zip.read(name)
        except (zipfile.BadZipFile, OSError):
            raise Refused("part_damaged") from None
        if b"<!DOCTYPE" in raw.upper() or b"<!ENTITY" in raw.upper():
            raise Refused("unsafe_xml")
        return raw

    def tree(self, name: str) -> ElementTree.Element:
        try:
            return ElementTree.fromstring(self.part(name))
        except ElementTree.ParseError:
            raise Refused("malformed_xml") from None

    def sheets(self) -> dict[str, str]:
        """Sheet names and their parts."""
        targets = {}
        for r in self.tree("xl/_rels/workbook.xml.rels").iter(f"{PACKAGE}Relationship"):
            if r.get("TargetMode") == "External":
                raise Refused("external_relationship")
            target = r.get("Target", "")
            targets[r.get("Id")] = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        found = {}
        for s in self.tree("xl/workbook.xml").iter(f"{MAIN}sheet"):
            if s.get("name") in found:
                raise Refused("sheet_doubled")
            found[s.get("name")] = targets.get(s.get(f"{RELATED}id"), "")
        return found

    def strings(self) -> list[str]:
        if "xl/sharedStrings.xml" not in self.names:
            return []
        out = ["".join(t.text or "" for t in si.iter(f"{MAIN}t")) for si in self.tree("xl/sharedStrings.xml").iter(f"{MAIN}si")]
        if len(out) > MOST_STRINGS:
            raise Refused("shared_strings_limit")
        return out

    def formats(self) -> list[tuple[str, bool]]:
        """The number format of each cell style, and whether it shows a day."""
        if "xl/styles.xml" not in self.names:
            return []
        tree = self.tree("xl/styles.xml")
        own = {int(n.get("numFmtId")): n.get("formatCode", "") for n in tree.iter(f"{MAIN}numFmt")}
        out = []
        for xf in tree.findall(f"{MAIN}cellXfs/{MAIN}xf"):
            number = int(xf.get("numFmtId", "0"))
            code = own.get(number, "General" if number == 0 else f"#{number}")
            out.append((code, number in DAYS or number in own and bool(re.search("[dy]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code).lower()))))
        return out


def column_number(letters: str) -> int:
    n = 0
    for c in letters:
        n = n * 26 + ord(c) - 64
    return n


def cells(book: Workbook, part: str) -> Iterator[tuple[int, int, str, str | None, dt.date | None, str | None]]:
    """(row, column, kind, value, day, format) of every cell that holds something."""
    strings, formats = book.strings(), book.formats()
    before, rows = 0, 0
    try:
        for _, row in ElementTree.iterparse(BytesIO(book.part(part)), events=("end",)):
            if row.tag != f"{MAIN}row":
                continue
            number = int(row.get("r", before + 1))
            if number <= before:
                raise Refused("rows_unordered")
            before, rows = number, rows + 1
            if rows > MOST_ROWS:
                raise Refused("row_limit")
            if len(row) > MOST_COLUMNS:
                raise Refused("column_limit")
            seen = set()
            for c in row.iter(f"{MAIN}c"):
                at = re.fullmatch(r"([A-Z]{1,3})([1-9]\d*)", c.get("r", ""))
                if not at or int(at[2]) != number or at[1] in seen:
                    raise Refused("cell_reference")
                seen.add(at[1])
                if c.find(f"{MAIN}f") is not None:
                    raise Refused("formula")
                kind, value = c.get("t", "n"), c.findtext(f"{MAIN}v")
                form, is_day = formats[int(c.get("s", "0"))] if int(c.get("s", "0")) < len(formats) else (None, False)
                if kind == "s":
                    value = strings[int(value)]
                elif kind == "inlineStr":
                    inside = c.find(f"{MAIN}is")
                    value = "".join(inside.itertext()) if inside is not None else None
                if value is None:
                    continue
                # Days are counted from 1899-12-30, which allows for the leap day that 1900 is given.
                day = dt.date(1899, 12, 30) + dt.timedelta(int(float(value))) if kind == "n" and is_day and 61 <= float(value) < 2_958_466 else None
                yield number, column_number(at[1]), {"n": "number", "s": "text", "inlineStr": "text", "str": "text", "b": "boolean", "d": "date"}.get(kind, "other"), value, day, form if kind == "n" else None
            row.clear()
    except ElementTree.ParseError:
        raise Refused("malformed_xml") from None
    except (IndexError, ValueError, OverflowError):
        raise Refused("malformed_cell") from None


@dataclass
class Sheet(InputPartition):
    file: str
    sheet: str | None
    part: str | None
    reason: str | None


class SheetReader(DataSourceReader):
    def __init__(self, options):
        self.uri, self.only = options["path"], options.get("sheet")

    def _files(self) -> list[pafs.FileInfo]:
        fs, path = opened(self.uri)
        info = fs.get_file_info(path)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.uri)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(path))
        return sorted((f for f in found if f.type == pafs.FileType.File and f.base_name.lower().endswith(".xlsx")), key=lambda f: f.path)

    def partitions(self) -> list[Sheet]:
        """A partition for each sheet; a workbook that is refused, or lacks the wanted sheet, is one with a reason."""
        fs, _ = opened(self.uri)
        out = []
        for f in self._files():
            try:
                if f.size > MOST_BYTES:
                    raise Refused("file_size_limit")
                own = Workbook(read_bytes(fs, f.path)).sheets()
                own = {k: v for k, v in own.items() if self.only in (None, k)}
                if not own:
                    raise Refused("sheet_missing")
                out += [Sheet(f.path, k, v, None) for k, v in own.items()]
            except Refused as e:
                out.append(Sheet(f.path, None, None, str(e)))
        return out

    def read(self, partition: Sheet):
        name, reason, found = partition.file.rpartition("/")[2], partition.reason, []
        if reason is None:
            try:
                fs, _ = opened(self.uri)
                found = list(cells(Workbook(read_bytes(fs, partition.file)), partition.part))
            except Refused as e:
                found, reason = [], str(e)
        if reason:
            yield name, partition.sheet, None, None, None, None, None, None, reason
        for row, column, kind, value, day, form in found:
            yield name, partition.sheet, row, column, kind, value, day, form, None


class Sheets(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sheets"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SheetReader:
        return SheetReader(self.options)
