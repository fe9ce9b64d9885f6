"""Excel workbook drop scan (A2): ``binaryFile`` + ``mapInPandas``.

Each workbook is one row of the binary scan, so files are parsed in
parallel across executors; the parser is a small per-file helper over the
standard library (an .xlsx file is a zip of XML parts) that reads a sheet row
by row, so a sheet of a million rows needs no more memory than a short one
beside its shared strings. Output is plain
text: one row per sheet row with a ``cells`` map of normalised header ->
text, which ``cells_to_columns`` turns into the columns ``conform`` expects.
Dates stored as Excel serial numbers are rendered as ISO text.
"""

from __future__ import annotations

import datetime as _dt
import io
import re
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from itertools import islice
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .reports import FILE_COL, ROW_COL, normalize_header, unique_names

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
OUT_SCHEMA = f"{FILE_COL} string, {ROW_COL} long, cells map<string,string>, error string"
# Built-in Excel number formats that display dates or times.
BUILTIN_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
EXCEL_EPOCH = _dt.datetime(1899, 12, 30)
ROWS = 4096  # of a sheet in one batch


def _col_index(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", ref).group(0):
        n = n * 26 + ord(ch) - 64
    return n - 1


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = {int(f.get("numFmtId")) for f in root.iterfind("m:numFmts/m:numFmt", NS)
              if re.search(r"[dyhs]", re.sub(r'"[^"]*"|\[[^]]*]', "", f.get("formatCode", "").lower()))}
    xfs = root.find("m:cellXfs", NS)
    if xfs is None:
        return set()
    return {i for i, xf in enumerate(xfs) if int(xf.get("numFmtId", 0)) in BUILTIN_DATE_FORMATS | custom}


def _first_sheet(z: zipfile.ZipFile) -> str:
    """Part name of the sheet that the workbook lists first."""
    if "xl/workbook.xml" in z.namelist() and "xl/_rels/workbook.xml.rels" in z.namelist():
        first = ET.fromstring(z.read("xl/workbook.xml")).find("m:sheets/m:sheet", NS)
        rid = None if first is None else first.get(f"{{{REL}}}id")
        for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")):
            if rid is not None and r.get("Id") == rid:
                target = r.get("Target")
                return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    return sorted(n for n in z.namelist() if n.startswith("xl/worksheets/sheet"))[0]


def _elements(part, *path: str) -> Iterator[ET.Element]:
    """Elements at ``path`` below the root of an XML part, one after the other; each is forgotten once it is used."""
    want, stack = [f"{{{NS['m']}}}{p}" for p in path], []
    for event, e in ET.iterparse(part, events=("start", "end")):
        if event == "start":
            stack.append(e)
            continue
        stack.pop()
        if len(stack) == len(want) and [x.tag for x in stack[1:]] + [e.tag] == want:
            yield e
            stack[-1].remove(e)


def _text(e: ET.Element) -> str:
    return "".join(t.text or "" for t in e.iter(f"{{{NS['m']}}}t"))


def _cell(c: ET.Element, shared: Sequence[str], dates: set[int]) -> str | None:
    t, v = c.get("t"), c.find("m:v", NS)
    if t == "inlineStr":
        return _text(c)
    if v is None:
        return None
    if t == "s":
        return shared[int(v.text)]
    if t == "b":
        return "TRUE" if v.text == "1" else "FALSE"
    if t in (None, "n") and int(c.get("s", 0)) in dates:
        # Excel keeps milliseconds; round away the binary fraction noise
        ts = EXCEL_EPOCH + _dt.timedelta(milliseconds=round(float(v.text) * 86_400_000))
        return ts.isoformat(sep=" ", timespec="microseconds")
    return v.text


def first_sheet_rows(data: bytes) -> Iterator[list[str | None]]:
    """Rows of the first worksheet as text (None for empty cells), read one after the other.

    Held at a time: the workbook's bytes, its shared strings and one row.
    """
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            with z.open("xl/sharedStrings.xml") as part:
                shared = [_text(si) for si in _elements(part, "si")]
        dates = _date_styles(z)
        with z.open(_first_sheet(z)) as part:
            for r in _elements(part, "sheetData", "row"):
                vals = {_col_index(c.get("r")): _cell(c, shared, dates) for c in r.iterfind("m:c", NS)}
                yield [vals.get(i) for i in range(max(vals) + 1 if vals else 0)]


def read_first_sheet(data: bytes) -> list[list[str | None]]:
    return list(first_sheet_rows(data))


def _parse_books(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            data = bytes(content)
            try:
                # Read through once first: a file that breaks off is one error row, and none of its rows comes out.
                for _ in first_sheet_rows(data):
                    pass
            except (zipfile.BadZipFile, zlib.error, ET.ParseError, KeyError, IndexError, ValueError, AttributeError, TypeError,
                    EOFError, OverflowError) as e:
                yield pd.DataFrame({FILE_COL: [path], ROW_COL: [0], "cells": [None], "error": [f"unreadable: {type(e).__name__}: {e}"]})
                continue
            rows = first_sheet_rows(data)
            header = unique_names([normalize_header(h or "") for h in next(rows, [])])
            at = 1
            while chunk := list(islice(rows, ROWS)):
                out = [{h: (r[i] if i < len(r) else None) for i, h in enumerate(header) if h} for r in chunk]
                yield pd.DataFrame({FILE_COL: path, ROW_COL: range(at, at + len(out)), "cells": out, "error": None})
                at += len(out)


def scan_workbooks(spark: SparkSession, path: str | Sequence[str], glob: str = "*.[xX][lL][sS][xX]") -> DataFrame:
    """Every workbook under ``path`` (recursive, case-insensitive ``.xlsx`` by default), or the given files.

    One row per sheet row; a file that cannot be read is one row with ``error``.
    """
    reader = spark.read.format("binaryFile")
    if isinstance(path, str):
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    files = reader.load(path if isinstance(path, str) else list(path)).select("path", "content")
    return files.mapInPandas(_parse_books, OUT_SCHEMA)


def cells_to_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Project the ``cells`` map onto named text columns (missing headers -> NULL)."""
    return df.select(FILE_COL, ROW_COL, *[F.col("cells").getItem(n).alias(n) for n in names])
