"""Workbooks: round trips of odd cells, and a file as other programs write it."""

import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fathom.sources import workbook

KINDS = "k long, name string, day date, at timestamp_ntz, x double, ok boolean"
ROWS = [
    (1, "=SUM(A1:A2)", date(2024, 2, 29), datetime(2024, 2, 29, 13, 5, 6, 789012), 0.1, True),
    (2, None, None, None, None, None),
    (9007199254740993, " <a & \"b\">\n\r\t_x000D_ \x01 é 𝒳", date(1900, 3, 1), datetime(1999, 12, 31, 23, 59, 59), -1e300, False),
    (4, "0123", date(9999, 12, 31), datetime(2000, 1, 1), 3.0, None),
]


def test_three_sheets_come_back(spark, tmp_path):
    path = str(tmp_path / "book.xlsx")
    odd = spark.createDataFrame(ROWS, KINDS)
    many = spark.range(3000).select(F.col("id"), F.concat(F.lit("n"), "id").alias("name")).repartition(7, "id")
    none = spark.createDataFrame([], "a string, b long")
    workbook.write_workbook({"Odd & <1>": odd, "Many": many, "None": none}, f"file://{path}")
    assert list(workbook.Book(path).sheets) == ["Odd & <1>", "Many", "None"]
    assert [tuple(r) for r in workbook.read_sheet(spark, path, "Odd & <1>", KINDS).collect()] == ROWS
    first = workbook.read_sheet(spark, path)
    assert first.dtypes == [("k", "bigint"), ("name", "string"), ("day", "date"), ("at", "timestamp_ntz"), ("x", "double"), ("ok", "boolean")]
    assert [tuple(r) for r in first.collect()] == ROWS
    back = workbook.read_sheet(spark, path, "Many")
    assert back.dtypes == [("id", "bigint"), ("name", "string")] and back.rdd.getNumPartitions() == 1
    assert sorted(map(tuple, back.collect())) == [(i, f"n{i}") for i in range(3000)]
    assert workbook.read_sheet(spark, path, "None").columns == ["a", "b"] and workbook.read_sheet(spark, path, "None").count() == 0
    with pytest.raises(Exception, match="missing columns: z"):
        workbook.read_sheet(spark, path, "Many", "id long, z string").collect()
    workbook.write_workbook({"Many": odd.select("k")}, path)
    assert list(workbook.Book(path).sheets) == ["Many"] and not [p for p in tmp_path.iterdir() if p.name != "book.xlsx"]


def test_shared_texts_styles_and_gaps(spark, tmp_path):
    path = str(tmp_path / "other.xlsx")
    m = workbook.MAIN
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{m}" xmlns:r="{workbook.LINKS}"><workbookPr date1904="1"/><sheets><sheet name="S" sheetId="1" r:id="x"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{workbook.PACKAGE}/relationships"><Relationship Id="x" Target="/xl/worksheets/s.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{m}"><si><t>SBU</t></si><si><r><t>B</t></r><r><t>U</t></r><rPh><t>no</t></rPh></si><si><t>when</t></si></sst>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{m}"><numFmts><numFmt numFmtId="170" formatCode="dd/mm/yy"/><numFmt numFmtId="171" formatCode="&quot;days&quot;0"/></numFmts><cellStyleXfs><xf numFmtId="14"/></cellStyleXfs><cellXfs><xf numFmtId="0"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/s.xml", f'<worksheet xmlns="{m}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c><c r="AB1" t="s"><v>2</v></c></row><row r="2"><c r="C2" s="2"><v>7</v></c><c r="AB2" s="1"><v>1</v></c></row><row r="3"/><row r="4"><c r="A4" t="str"><f>1+1</f><v>two</v></c><c r="C4" t="e"><v>#N/A</v></c></row></sheetData></worksheet>')
    df = workbook.read_sheet(spark, path)
    assert df.dtypes == [("SBU", "string"), ("BU", "bigint"), ("when", "date")]
    assert [tuple(r) for r in df.collect()] == [(None, 7, date(1904, 1, 2)), ("two", None, None)]


def test_names_of_columns():
    assert [workbook.letters(i) for i in (0, 25, 26, 51, 52, 701, 702)] == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA"]
    assert all(workbook.number(workbook.letters(i)) == i for i in range(2000))
