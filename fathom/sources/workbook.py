"""Workbooks (.xlsx) as a data source: ``spark.read.format("workbook")`` and ``df.write.format("workbook")``.

A workbook is a zip of XML parts. Reading takes one task for each sheet; writing lets tasks make the rows' XML, and the
commit puts them into the zip in order. A sheet holds 1,048,576 rows at most by its format, so both are bounded; a larger
table is an error, not a cut. Paths are files that all machines see (a mounted folder, or one machine)."""

from __future__ import annotations

import json
import os
import re
import shutil
import uuid
import zipfile
from collections.abc import Iterator, Mapping
from datetime import date, datetime, timedelta
from decimal import Decimal
from typing import Any
from xml.etree.ElementTree import iterparse
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import BooleanType, DateType, DecimalType, DoubleType, FloatType, LongType, StringType, StructField, StructType, TimestampNTZType, TimestampType

MOST_ROWS = 1_048_576
#: Names and numbers of the file format.
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
DATE_FORMATS = {*range(14, 23), *range(45, 48)}
_DAY0 = {False: datetime(1899, 12, 30), True: datetime(1904, 1, 1)}


def local(path: str) -> str:
    return re.sub(r"^file:(//)?(?=/)", "", path)


# text of cells


def written(text: str) -> str:
    """Text as XML; characters that XML cannot hold by their number, and texts that look like such numbers marked."""
    text = re.sub(r"_x(?=[0-9A-Fa-f]{4}_)", "_x005F_x", text)
    return escape(re.sub(r"[\x00-\x08\x0B\x0C\x0D\x0E-\x1F￾￿]", lambda m: f"_x{ord(m[0]):04X}_", text))


def plain(text: str) -> str:
    return re.sub(r"_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), text)


def letters(column: int) -> str:
    """The name of a column, from 0: A to Z, AA and on."""
    out = ""
    while column >= 0:
        out, column = chr(65 + column % 26) + out, column // 26 - 1
    return out


def number(name: str) -> int:
    n = 0
    for c in name:
        n = n * 26 + ord(c) - 64
    return n - 1


def cell(value: Any) -> str:
    """A cell's attributes and content; empty for null and for numbers that are not finite. Text is never a formula."""
    if value is None or (isinstance(value, float) and (value != value or value in (float("inf"), float("-inf")))):
        return ""
    if isinstance(value, bool):
        return f' t="b"><v>{int(value)}</v>'
    if isinstance(value, int | float | Decimal):
        return f"><v>{value!r}</v>" if not isinstance(value, Decimal) else f"><v>{value}</v>"
    if isinstance(value, date):
        moment = value if isinstance(value, datetime) else datetime(value.year, value.month, value.day)
        gone = moment.replace(tzinfo=None) - _DAY0[False]
        return f' s="2"><v>{gone / timedelta(days=1)!r}</v>' if isinstance(value, datetime) else f' s="1"><v>{gone.days}</v>'
    return f' t="inlineStr"><is><t xml:space="preserve">{written(str(value))}</t></is>'


# reading


def _tag(name: str) -> str:
    return f"{{{MAIN}}}{name}"


class Book:
    """An open workbook: its sheets, shared texts and which styles are dates."""

    def __init__(self, path: str):
        self.zip = zipfile.ZipFile(local(path))
        names = set(self.zip.namelist())
        target = {}
        for _, e in iterparse(self.zip.open("xl/_rels/workbook.xml.rels")):
            if e.tag.endswith("}Relationship"):
                t = e.get("Target").lstrip("/")
                target[e.get("Id")] = t if t.startswith("xl/") else f"xl/{t}"
        self.sheets, self.from1904 = {}, False
        for _, e in iterparse(self.zip.open("xl/workbook.xml")):
            if e.tag == _tag("sheet"):
                self.sheets[e.get("name")] = target[e.get(f"{{{LINKS}}}id")]
            elif e.tag == _tag("workbookPr"):
                self.from1904 = e.get("date1904") in ("1", "true")
        self.texts = [self._text(e) for _, e in iterparse(self.zip.open("xl/sharedStrings.xml")) if e.tag == _tag("si")] if "xl/sharedStrings.xml" in names else []
        self.dates: list[bool] = []
        if "xl/styles.xml" in names:
            own, inside = {}, False
            for event, e in iterparse(self.zip.open("xl/styles.xml"), ("start", "end")):
                if e.tag == _tag("cellXfs"):
                    inside = event == "start"
                elif event == "end" and e.tag == _tag("numFmt"):
                    own[e.get("numFmtId")] = e.get("formatCode") or ""
                elif event == "end" and inside and e.tag == _tag("xf"):
                    n = e.get("numFmtId") or "0"
                    code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", own.get(n, ""))
                    self.dates.append(int(n) in DATE_FORMATS or bool(re.search("[ymdhs]", code.lower())))

    @staticmethod
    def _text(e: Any) -> str:
        """All text of an element but phonetic hints."""
        return plain("".join(t.text or "" for r in ([e] if e.tag == _tag("t") else list(e)) for t in ([r] if r.tag == _tag("t") else [] if r.tag == _tag("rPh") else r.iter(_tag("t")))))

    def rows(self, sheet: str) -> Iterator[dict[int, Any]]:
        """Each row's cells by column, read as a stream: text, bool, int, float or datetime."""
        at = -1
        for _, e in iterparse(self.zip.open(self.sheets[sheet])):
            if e.tag != _tag("row"):
                continue
            out, at = {}, -1
            for c in e.iter(_tag("c")):
                place = re.match("[A-Z]+", c.get("r") or "")
                at = number(place[0]) if place else at + 1
                value = self._value(c)
                if value is not None:
                    out[at] = value
            e.clear()
            yield out

    def _value(self, c: Any) -> Any:
        kind, v = c.get("t") or "n", c.find(_tag("v"))
        if kind == "inlineStr":
            return self._text(c.find(_tag("is")))
        if v is None or v.text is None:
            return None
        if kind == "s":
            return self.texts[int(v.text)]
        if kind == "b":
            return v.text == "1"
        if kind != "n":
            return None if kind == "e" else datetime.fromisoformat(v.text) if kind == "d" else plain(v.text)
        style = int(c.get("s") or 0)
        if style < len(self.dates) and self.dates[style]:
            return _DAY0[self.from1904] + timedelta(microseconds=round(float(v.text) * 86_400_000_000))
        return int(v.text) if re.fullmatch(r"-?\d+", v.text) else float(v.text)


def inferred(book: Book, sheet: str) -> StructType:
    """Names from the first row, types from all others: boolean, bigint, double, date or timestamp where all cells agree,
    else string."""
    rows = book.rows(sheet)
    head = next(rows, {})
    seen: dict[int, set[str]] = {i: set() for i in head}
    for r in rows:
        for i, v in r.items():
            if i in seen:
                seen[i].add("moment" if isinstance(v, datetime) and v.time() != datetime.min.time() else type(v).__name__)

    def kind(k: set[str]) -> Any:
        if not k:
            return StringType()
        for most, t in (({"bool"}, BooleanType), ({"int"}, LongType), ({"int", "float"}, DoubleType), ({"datetime"}, DateType), ({"datetime", "moment"}, TimestampNTZType)):
            if k <= most:
                return t()
        return StringType()

    return StructType([StructField(str(head[i]), kind(seen[i])) for i in sorted(head)])


def as_type(value: Any, kind: Any) -> Any:
    """A cell by a column's type; cells that do not fit are an error."""
    if value is None:
        return None
    if isinstance(kind, StringType):
        return value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else value.date().isoformat() if isinstance(value, datetime) and value.time() == datetime.min.time() else str(value)
    if isinstance(kind, DateType):
        return (value if isinstance(value, datetime) else datetime.fromisoformat(value)).date()
    if isinstance(kind, TimestampType | TimestampNTZType):
        return value if isinstance(value, datetime) else datetime.fromisoformat(value)
    if isinstance(kind, BooleanType):
        return value if isinstance(value, bool) else str(value).strip().lower() in ("1", "true")
    if isinstance(kind, DecimalType):
        return Decimal(str(value))
    return float(value) if isinstance(kind, DoubleType | FloatType) else int(value)


class Sheet(InputPartition):
    def __init__(self, name: str):
        self.name = name


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, path: str, sheets: list[str]):
        self.schema, self.path, self.sheets = schema, path, sheets

    def partitions(self) -> list[InputPartition]:
        return [Sheet(s) for s in self.sheets]

    def read(self, partition: Sheet) -> Iterator[tuple]:
        rows = Book(self.path).rows(partition.name)
        place = {str(v): i for i, v in next(rows, {}).items()}
        absent = [f.name for f in self.schema.fields if f.name not in place]
        if absent:
            raise ValueError(f"missing columns: {', '.join(absent)}")
        fields = [(place[f.name], f.dataType) for f in self.schema.fields]
        for r in rows:
            if r:
                yield tuple(as_type(r.get(i), t) for i, t in fields)


class _Part(WriterCommitMessage):
    def __init__(self, name: str, at: int, rows: int):
        self.name, self.at, self.rows = name, at, rows


class _Writer(DataSourceWriter):
    """Tasks write a file of row XML each beside the workbook; the commit joins them into the zip."""

    def __init__(self, schema: StructType, path: str, sheet: str, overwrite: bool):
        self.schema, self.path, self.sheet, self.overwrite = schema, local(path), sheet, overwrite
        self.parts = f"{self.path}.{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Any]) -> WriterCommitMessage:
        from pyspark import TaskContext

        context = TaskContext.get()
        at = context.partitionId() if context else 0
        os.makedirs(self.parts, exist_ok=True)
        name, n = f"{self.parts}/{at}-{uuid.uuid4().hex}", 0  # a task that runs twice writes two files; one is named
        with open(name, "w", encoding="utf-8") as out:
            for row in iterator:
                n += 1
                if n >= MOST_ROWS:
                    raise ValueError("a sheet holds 1,048,576 rows at most")
                out.write(json.dumps([cell(v) for v in row]) + "\n")
        return _Part(name, at, n)

    def commit(self, messages: list[WriterCommitMessage]) -> None:
        told = sorted((m for m in messages if m is not None), key=lambda m: m.at)
        if sum(m.rows for m in told) + 1 > MOST_ROWS:
            self.abort(messages)
            raise ValueError("a sheet holds 1,048,576 rows at most")
        old = None if self.overwrite or not os.path.exists(self.path) else Book(self.path)
        names = [n for n in (old.sheets if old else []) if n != self.sheet]
        fresh = f"{self.path}.{uuid.uuid4().hex}"
        with zipfile.ZipFile(fresh, "w", zipfile.ZIP_DEFLATED) as z:
            for k, n in enumerate(names, 1):
                if old.texts or old.from1904:
                    raise ValueError("sheets can be added to workbooks of this writer only")
                z.writestr(f"xl/worksheets/sheet{k}.xml", old.zip.read(old.sheets[n]))
            with z.open(f"xl/worksheets/sheet{len(names) + 1}.xml", "w", force_zip64=True) as out:
                out.write(f'<?xml version="1.0" encoding="UTF-8"?>\n<worksheet xmlns="{MAIN}"><sheetData>'.encode())
                at = 1
                for line in self._lines(told):
                    cells = "".join(f'<c r="{letters(i)}{at}"{c}</c>' for i, c in enumerate(line) if c)
                    out.write(f'<row r="{at}">{cells}</row>'.encode())
                    at += 1
                out.write(b"</sheetData></worksheet>")
            _frame(z, [*names, self.sheet])
        os.replace(fresh, self.path)
        shutil.rmtree(self.parts, ignore_errors=True)

    def _lines(self, told: list[_Part]) -> Iterator[list[str]]:
        yield [cell(f.name) for f in self.schema.fields]
        for m in told:
            with open(m.name, encoding="utf-8") as rows:
                yield from map(json.loads, rows)

    def abort(self, messages: list[WriterCommitMessage]) -> None:
        shutil.rmtree(self.parts, ignore_errors=True)


def _frame(z: zipfile.ZipFile, names: list[str]) -> None:
    """The parts that name the sheets and their styles."""
    head = '<?xml version="1.0" encoding="UTF-8"?>\n'
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    count = range(1, len(names) + 1)
    over = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{kind}.worksheet+xml"/>' for k in count)
    z.writestr("[Content_Types].xml", f'{head}<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>{over}</Types>')
    z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
    sheets = "".join(f'<sheet name={quoteattr(n)} sheetId="{k}" r:id="rId{k}"/>' for k, n in zip(count, names, strict=True))
    z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{MAIN}" xmlns:r="{LINKS}"><sheets>{sheets}</sheets></workbook>')
    links = "".join(f'<Relationship Id="rId{k}" Type="{LINKS}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in count)
    z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{PACKAGE}/relationships">{links}<Relationship Id="rId{len(names) + 1}" Type="{LINKS}/styles" Target="styles.xml"/></Relationships>')
    one = '<xf numFmtId="0" fontId="0" fillId="0" borderId="0"/>'
    formats = "".join(f'<xf numFmtId="{n}" fontId="0" fillId="0" borderId="0" applyNumberFormat="1"/>' for n in (14, 22))
    z.writestr("xl/styles.xml", f'{head}<styleSheet xmlns="{MAIN}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1">{one}</cellStyleXfs><cellXfs count="3">{one}{formats}</cellXfs></styleSheet>')


class Workbook(DataSource):
    """Options: path; sheet (a name, the first sheet if absent), or sheets (a JSON list of sheets of one shape)."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def _sheets(self) -> list[str]:
        if "sheets" in self.options:
            return json.loads(self.options["sheets"])
        return [self.options.get("sheet") or next(iter(Book(self.options["path"]).sheets))]

    def schema(self) -> StructType:
        return inferred(Book(self.options["path"]), self._sheets()[0])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self.options["path"], self._sheets())

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(schema, self.options["path"], self.options.get("sheet") or "Sheet1", overwrite)


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None, schema: StructType | str | None = None) -> DataFrame:
    """One sheet of a workbook, its first row the names. Rows without any cell are left out."""
    spark.dataSource.register(Workbook)
    reader = spark.read.format("workbook").option("path", path)
    reader = reader.option("sheet", sheet) if sheet else reader
    return (reader.schema(schema) if schema else reader).load()


def write_workbook(sheets: Mapping[str, DataFrame], path: str) -> None:
    """A workbook with a sheet for each table, in their order; an older file of that name is replaced at the first."""
    for k, (name, df) in enumerate(sheets.items()):
        df.sparkSession.dataSource.register(Workbook)
        df.write.format("workbook").mode("append" if k else "overwrite").option("sheet", name).save(path)
