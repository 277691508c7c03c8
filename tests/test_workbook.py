"""Workbooks: what spreadsheet programs write, and what must end the job."""

import io
import zipfile
from datetime import datetime

import pytest

from ledgerlens.schemas import RAW_INVOICES
from ledgerlens.sources.retail import invoice_rejects, read_invoices
from ledgerlens.sources.workbook import make_workbook, workbook_lines

NAMES = [f.name for f in RAW_INVOICES]
ROW = {"Invoice": "489434", "StockCode": "85048", "Description": "LIGHTS <15> & \"more\" é", "Quantity": 12,
       "InvoiceDate": datetime(2009, 12, 1, 7, 45), "Price": 6.95, "Customer ID": 13085, "Country": "United Kingdom"}


def row(**changes):
    return [{**ROW, **changes}[n] for n in NAMES]


def test_files_read_side_by_side(spark, tmp_path):
    for i in range(3):
        rows = [row(Invoice=f"{i}{j}", Quantity=j - 1, **{"Customer ID": None if j == 2 else 13085 + j}) for j in range(5)]
        (tmp_path / f"part{i}.xlsx").write_bytes(make_workbook(NAMES, rows, sheet_rows=2))
    (tmp_path / "empty.xlsx").write_bytes(make_workbook(NAMES, []))
    lines = read_invoices(spark, str(tmp_path), "workbook").collect()
    assert len(lines) == 15
    one = next(r for r in lines if r["InvoiceNo"] == "13")
    assert (one["Quantity"], one["CustomerID"], one["UnitPrice"], one["InvoiceDate"]) == (2, 13088, 69500, datetime(2009, 12, 1, 7, 45))
    assert one["Description"] == ROW["Description"] and sum(r["CustomerID"] is None for r in lines) == 3


def test_text_that_fits_no_column(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(make_workbook(NAMES, [row(), row(Quantity="many")]))
    with pytest.raises(Exception, match="Quantity cannot be read: many"):
        read_invoices(spark, str(tmp_path), "workbook").collect()
    assert read_invoices(spark, str(tmp_path), "workbook", rejects="drop").count() == 1
    assert [r["rejected"] for r in invoice_rejects(spark, str(tmp_path), fmt="workbook").collect()] == [["Quantity"]]


def book(sheet, strings="", late=""):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as out:
        out.writestr("xl/workbook.xml", '<workbook xmlns="m" xmlns:r="o">' + late + '<sheets><sheet name="S" r:id="r1"/></sheets></workbook>')
        out.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="/xl/worksheets/sheet1.xml"/></Relationships>')
        out.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="m"><sheetData>{sheet}</sheetData></worksheet>')
        if strings:
            out.writestr("xl/sharedStrings.xml", f'<sst xmlns="m">{strings}</sst>')
    return raw.getvalue()


def test_cells_as_spreadsheet_programs_write_them():
    head = '<row/><row r="2"><c r="B2" t="inlineStr"><is><t>A</t></is></c><c r="AB2" t="s"><v>0</v></c><c r="C2" t="str"><v>T</v></c></row>'
    body = '<row r="3"><c r="AB3" t="s"><v>1</v></c><c r="C3" s="4"><v>1.5</v></c></row><row r="4"><c r="B4"><v>7</v></c><c r="C4"/></row>'
    strings = "<si><t>B</t></si><si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>x</t></rPh></si>"
    got = list(workbook_lines(book(head + body, strings), ["A", "B", "T"], times=("T",)))
    assert got == [[None, "rich", "1899-12-31 12:00:00"], ["7", None, None]]
    late = list(workbook_lines(book(head + body, strings, '<workbookPr date1904="1"/>'), ["A", "B", "T"], times=("T",)))
    assert late[0][2] == "1904-01-02 12:00:00"
    with pytest.raises(ValueError, match="sheet S has no column Z"):
        list(workbook_lines(book(head + body, strings), ["A", "Z"]))
    assert list(workbook_lines(book(""), ["A"])) == []


def test_lines_are_packed_by_all_tasks(spark, monkeypatch):
    """The joined lines of a small table sit in one partition; workbooks are made, and then read, by all tasks."""
    from ledgerlens.operators import stability
    from ledgerlens.plans.catalog import QUERIES
    parts, land = [], stability.landed
    monkeypatch.setattr(stability, "landed", lambda df: parts.append(df.rdd.getNumPartitions()) or land(df))
    lines = QUERIES["source_invoice_workbook"](spark, "/root/testdata/sf0.001")
    assert parts[0] >= 8 and lines.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
