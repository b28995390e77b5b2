"""Unpacks workbooks into the long cells table, one row per non-empty cell.

An .xlsx file is a zip of XML parts. Each file is unpacked inside one task (its size is bounded by the size gate) and
streamed out in batches; everything after that is DataFrame work in ``workbook``.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

CELLS = (
    "file_hash string, sheet_idx int, sheet string, row_idx int, col_idx int, value string, is_string boolean, "
    "error string"
)
_BATCH = 20_000
_BUILTIN_DATES = set(range(14, 23)) | set(range(27, 37)) | {45, 46, 47} | set(range(50, 59))


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _texts(node) -> str:
    return "".join(t.text or "" for t in node.iter() if _local(t.tag) == "t")


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    return [_texts(item) for item in ElementTree.parse(book.open("xl/sharedStrings.xml")).getroot()]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indexes of cell styles whose number format shows a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.parse(book.open("xl/styles.xml")).getroot()
    custom = {
        int(n.get("numFmtId")): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", n.get("formatCode", ""))
        for n in root.iter() if _local(n.tag) == "numFmt"
    }
    styles = next((n for n in root if _local(n.tag) == "cellXfs"), [])
    formats = [int(xf.get("numFmtId", 0)) for xf in styles]
    return {
        i for i, f in enumerate(formats)
        if f in _BUILTIN_DATES or (f in custom and re.search(r"[dmyhs]", custom[f].lower()))
    }


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(sheet name, part name) in workbook order."""
    rels = {
        r.get("Id"): r.get("Target").lstrip("/")
        for r in ElementTree.parse(book.open("xl/_rels/workbook.xml.rels")).getroot()
    }
    found = []
    for node in ElementTree.parse(book.open("xl/workbook.xml")).getroot().iter():
        if _local(node.tag) == "sheet":
            target = rels[next(v for k, v in node.attrib.items() if k.endswith("}id"))]
            found.append((node.get("name"), target if target.startswith("xl/") else f"xl/{target}"))
    return found


def _number(text: str, is_date: bool) -> str:
    number = float(text)
    if is_date:
        return str((datetime(1899, 12, 30) + timedelta(days=number)).replace(microsecond=0))
    return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)


def _cell(node, shared: list[str], dates: set[int]) -> tuple[str | None, bool]:
    kind = node.get("t", "n")
    if kind == "inlineStr":
        return _texts(node), True
    text = next((v.text for v in node if _local(v.tag) == "v"), None)
    if text is None:
        return None, False
    if kind == "s":
        return shared[int(text)], True
    if kind == "b":
        return ("True" if text == "1" else "False"), False
    if kind in ("str", "e", "d"):
        return text, kind == "str"
    return _number(text, int(node.get("s", 0)) in dates), False


def _column(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def workbook_cells(content: bytes) -> Iterator[tuple]:
    """(sheet_idx, sheet, row_idx, col_idx, value, is_string) of every cell with a value, streaming the sheets."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared, dates = _shared_strings(book), _date_styles(book)
        for sheet_idx, (sheet, part) in enumerate(_sheets(book)):
            row_at = -1
            for event, node in ElementTree.iterparse(book.open(part), events=("start", "end")):
                name = _local(node.tag)
                if name == "row" and event == "start":
                    row_at = int(node.get("r", row_at + 2)) - 1
                    col_at = -1
                elif name == "c" and event == "end":
                    col_at = _column(node.get("r")) if node.get("r") else col_at + 1
                    value, is_string = _cell(node, shared, dates)
                    if value is not None:
                        yield sheet_idx, sheet, row_at, col_at, value, is_string
                elif name == "row" and event == "end":
                    node.clear()


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [part.strip().split(" ")[0] for part in CELLS.split(",")]
    for batch in batches:
        for file_hash, content in zip(batch["file_hash"], batch["content"]):
            rows: list[tuple] = []
            try:
                for cell in workbook_cells(content):
                    rows.append((file_hash, *cell, None))
                    if len(rows) >= _BATCH:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
            except Exception as problem:  # one damaged file must not stop the others
                rows.append((file_hash, None, None, None, None, None, None, f"{type(problem).__name__}: {problem}"))
            if rows:
                yield pd.DataFrame(rows, columns=names).astype(
                    {"sheet_idx": "Int32", "row_idx": "Int32", "col_idx": "Int32", "is_string": "boolean"}
                )


def unpack(files: DataFrame) -> DataFrame:
    """Cells of workbooks given as file_hash and content; a damaged file ends with a row that holds its ``error``."""
    return files.select("file_hash", "content").mapInPandas(_unpack, CELLS)


def split_damaged(unpacked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells of whole files, failed files with ``error``). What was read of a damaged file before its damage is left
    out: a file is taken in as a whole or not at all. Write ``unpacked`` down first: both are read from it."""
    failed = unpacked.filter("error is not null").select("file_hash", "error")
    cells = unpacked.filter("error is null").drop("error")
    return cells.join(failed.select("file_hash"), "file_hash", "left_anti").select(*cells.columns), failed


def read_cells(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells, failed files with ``error``) of workbooks given as file_hash and content."""
    return split_damaged(unpack(files))
