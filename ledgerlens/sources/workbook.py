"""Invoice workbooks (Office Open XML): every sheet of every file as lines of text, to be typed like CSV.

A file is a row of Spark's binary file source, so files are read side by side; within a file the sheets'
XML is streamed.  Shared strings are held per file, as the format wants it.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.operators.stability import ship
from ledgerlens.schemas import RAW_INVOICES

_DAY_ZERO, _DAY_ZERO_1904 = datetime(1899, 12, 30), datetime(1904, 1, 1)
LINES_AT_ONCE = 20_000


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    found = []
    with book.open("xl/sharedStrings.xml") as stream:
        for _, node in ElementTree.iterparse(stream):
            if _local(node.tag) == "si":
                # Phonetic runs (rPh) repeat the text in another script.
                runs = [child for child in node if _local(child.tag) in ("t", "r")]
                found.append("".join(t.text or "" for run in runs for t in run.iter() if _local(t.tag) == "t"))
                node.clear()
    return found


def _sheets(book: zipfile.ZipFile) -> tuple[list[tuple[str, str]], bool]:
    """(name, file) of the sheets in order, and whether days count from 1904."""
    targets = {node.get("Id"): node.get("Target") for node in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    sheets, late = [], False
    for node in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
        if _local(node.tag) == "workbookPr":
            late = node.get("date1904") in ("1", "true")
        if _local(node.tag) == "sheet":
            target = targets[next(v for k, v in node.attrib.items() if _local(k) == "id")]
            sheets.append((node.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    return sheets, late


def _column(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]*", reference)[0]:
        number = number * 26 + ord(letter) - 64
    return number - 1


def _cells(row: ElementTree.Element, strings: list[str]) -> dict[int, tuple[str, bool]]:
    """Column → (text, whether it is a number)."""
    out, at = {}, -1
    for cell in row:
        at = _column(cell.get("r")) if cell.get("r") else at + 1
        kind, text = cell.get("t", "n"), None
        if kind == "inlineStr":
            text = "".join(t.text or "" for t in cell.iter() if _local(t.tag) == "t")
        else:
            value = next((c.text for c in cell if _local(c.tag) == "v"), None)
            text = strings[int(value)] if kind == "s" and value is not None else value
        if text is not None:
            out[at] = (text, kind == "n")
    return out


def _as_time(serial: str, late: bool) -> str:
    moment = (_DAY_ZERO_1904 if late else _DAY_ZERO) + timedelta(milliseconds=round(float(serial) * 86_400_000))
    return (moment + timedelta(microseconds=500_000)).replace(microsecond=0).isoformat(" ")  # days are fractions: to the second


def workbook_lines(content: bytes, names: Sequence[str], times: Sequence[str] = ("InvoiceDate",)) -> Iterator[list[str | None]]:
    """Lines of all sheets as text, in the order of ``names``; numbers in the columns ``times`` are days and become time stamps.

    A sheet's first row that holds anything is its header.  Empty sheets, rows and columns not in
    ``names`` are passed over; a sheet whose header lacks one of ``names`` ends the job.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings, (sheets, late) = _strings(book), _sheets(book)
        for sheet, file in sheets:
            places = None
            with book.open(file) as stream:
                for _, node in ElementTree.iterparse(stream):
                    if not node.tag.endswith("row") or _local(node.tag) != "row":  # most nodes are cells and values
                        continue
                    cells = _cells(node, strings)
                    node.clear()
                    if not cells:
                        continue
                    if places is None:
                        header = {text.strip(): at for at, (text, _) in cells.items()}
                        missing = [n for n in names if n not in header]
                        if missing:
                            raise ValueError(f"sheet {sheet} has no column {', '.join(missing)}")
                        places = [header[n] for n in names]
                        continue
                    line = [cells.get(at, (None, False)) for at in places]
                    yield [_as_time(text, late) if number and name in times else text for name, (text, number) in zip(names, line)]


def workbook_text(contents: DataFrame) -> DataFrame:
    """Lines of workbooks (a ``content`` column) as text with the published header; nulls and an empty table give no lines."""
    ship(contents.sparkSession)
    names = [field.name for field in RAW_INVOICES]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = lambda lines: pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*lines)], names)
        for batch in batches:
            for content in batch.column(0):
                lines = []
                for line in workbook_lines(content.as_py(), names) if content.is_valid else ():
                    lines.append(line)
                    if len(lines) == LINES_AT_ONCE:
                        yield pack(lines)
                        lines = []
                if lines:
                    yield pack(lines)

    return contents.select("content").mapInArrow(read, ", ".join(f"`{n}` string" for n in names))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return workbook_text(spark.read.format("binaryFile").load(path))


def make_workbook(names: Sequence[str], rows: Sequence[Sequence], sheet_rows: int = 1_000_000) -> bytes:
    """A workbook of rows: numbers and time stamps as numbers, other text as shared strings, ``sheet_rows`` to a sheet."""
    shared: dict[str, int] = {}

    def cell(value) -> str:
        if value is None:
            return "<c/>"
        if isinstance(value, datetime):
            return f"<c><v>{(value - _DAY_ZERO) / timedelta(days=1)!r}</v></c>"
        if isinstance(value, str):
            return f'<c t="s"><v>{shared.setdefault(value, len(shared))}</v></c>'
        return f"<c><v>{value}</v></c>"

    head = '<?xml version="1.0" encoding="UTF-8"?>'
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    line = lambda values: f"<row>{''.join(map(cell, values))}</row>"
    parts = [rows[at:at + sheet_rows] for at in range(0, len(rows), sheet_rows)] or [[]]
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as book:
        for i, part in enumerate(parts, start=1):
            body = "".join(map(line, [list(names), *part]))
            book.writestr(f"xl/worksheets/sheet{i}.xml", f"{head}<worksheet {space}><sheetData>{body}</sheetData></worksheet>")
        sheets = "".join(f'<sheet name="Sheet {i}" sheetId="{i}" r:id="r{i}"/>' for i in range(1, len(parts) + 1))
        office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        book.writestr("xl/workbook.xml", f'{head}<workbook {space} xmlns:r="{office}"><sheets>{sheets}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(parts) + 1))
        book.writestr("xl/_rels/workbook.xml.rels",
                      f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        texts = "".join(f'<si><t xml:space="preserve">{escape(text)}</t></si>' for text in shared)
        book.writestr("xl/sharedStrings.xml", f"{head}<sst {space}>{texts}</sst>")
    return raw.getvalue()
