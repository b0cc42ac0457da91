"""Minimal Office Open XML spreadsheet (.xlsx) reading with the standard
library only (zipfile + ElementTree), used inside Spark tasks: first sheet, first row is the header, cell types shared string,
inline string, formula string, number, boolean; sparse rows are placed by
cell reference. Numbers in date columns are Excel serial days (epoch
1899-12-30) and become ISO timestamps.

A workbook is read from a seekable stream, row by row; its shared strings go
to a file of the task in Spark's spill folder, so memory does not grow with it.
"""

from __future__ import annotations

import datetime as dt
import io
import marshal
import os
import re
import tempfile
import zipfile
from array import array
from functools import lru_cache
from itertools import islice
from typing import BinaryIO
from xml.etree import ElementTree as ET

NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RNS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PKG_RNS = "{http://schemas.openxmlformats.org/package/2006/relationships}"
EXCEL_EPOCH = dt.datetime(1899, 12, 30)
_REF = re.compile(r"([A-Z]+)(\d+)")


_COLS: dict[str, int] = {}


def col_index(ref: str) -> int:
    """0-based column of a cell reference such as ``AB12`` (cached by
    column letters: a sheet has few distinct columns)."""
    letters = ref.rstrip("0123456789")
    i = _COLS.get(letters)
    if i is None:
        letters = _REF.match(ref).group(1)
        n = 0
        for ch in letters:
            n = n * 26 + (ord(ch) - 64)
        i = _COLS[letters] = n - 1
    return i


def serial_to_iso(v: str) -> str | None:
    try:
        days = float(v)
    except ValueError:
        return v
    ts = EXCEL_EPOCH + dt.timedelta(days=days)
    ts = ts.replace(microsecond=0) + dt.timedelta(seconds=round(ts.microsecond / 1e6))
    return ts.strftime("%Y-%m-%d %H:%M:%S")


def _first_sheet_path(z: zipfile.ZipFile) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheet = wb.find(f"{NS}sheets/{NS}sheet")
    rid = sheet.get(f"{RNS}id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for r in rels.iter(f"{PKG_RNS}Relationship"):
        if r.get("Id") == rid:
            target = r.get("Target").lstrip("/")
            return target if target.startswith("xl/") else "xl/" + target
    raise ValueError("first sheet not found")


def _string_items(z: zipfile.ZipFile):
    """The shared strings in order; a parsed one is dropped from the tree."""
    if "xl/sharedStrings.xml" not in z.namelist():
        return
    with z.open("xl/sharedStrings.xml") as f:
        root = None
        for event, el in ET.iterparse(f, events=("start", "end")):
            if event == "start":
                root = el if root is None else root
            elif el.tag == f"{NS}si":
                yield "".join(t.text or "" for t in el.iter(f"{NS}t"))
                root.clear()


class SharedStrings:
    """The shared strings of a workbook by number: blocks in a file, the
    last ones used in memory. The file is nameless and ends with the task."""

    BLOCK, KEPT = 256, 64

    def __init__(self, z: zipfile.ZipFile):
        spill = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        self._file = tempfile.TemporaryFile(dir=spill if os.path.isdir(spill) else None)
        self._ends = array("Q", [0])
        items = _string_items(z)
        while block := list(islice(items, self.BLOCK)):
            self._file.write(marshal.dumps(block))
            self._ends.append(self._file.tell())
        self._block = lru_cache(self.KEPT)(self._read)

    def _read(self, i: int) -> list[str]:
        self._file.seek(self._ends[i])
        return marshal.loads(self._file.read(self._ends[i + 1] - self._ends[i]))

    def __getitem__(self, i: int) -> str:
        return self._block(i // self.BLOCK)[i % self.BLOCK]


def _cells(row, shared: SharedStrings) -> list[str | None]:
    """Values of a row element, placed by cell reference."""
    cells: dict[int, str | None] = {}
    for pos, c in enumerate(row.iter(f"{NS}c")):
        kind = c.get("t", "n")
        if kind == "inlineStr":
            val = "".join(x.text or "" for x in c.iter(f"{NS}t"))
        else:
            v = c.find(f"{NS}v")
            val = v.text if v is not None else None
            if val is not None and kind == "s":
                val = shared[int(val)]
            elif val is not None and kind == "b":
                val = "True" if val == "1" else "False"
        cells[col_index(c.get("r")) if c.get("r") else pos] = val
    return [cells.get(i) for i in range(max(cells) + 1 if cells else 0)]


def _lines(z: zipfile.ZipFile):
    """Rows of the first sheet one after another; a parsed row is dropped
    from the tree before the next is read."""
    shared = SharedStrings(z)
    with z.open(_first_sheet_path(z)) as f:
        parent = None
        for event, el in ET.iterparse(f, events=("start", "end")):
            if event == "start" and el.tag == f"{NS}sheetData":
                parent = el
            elif event == "end" and el.tag == f"{NS}row":
                yield _cells(el, shared)
                if parent is not None:
                    parent.clear()


def read_rows(book: bytes | BinaryIO, date_columns: set[str] = frozenset()):
    """(header, iterator over the rows as lists of strings) of a workbook or
    a seekable stream of one; the sheet is parsed as the rows are taken."""
    lines = _lines(zipfile.ZipFile(io.BytesIO(book) if isinstance(book, bytes) else book))
    header = [x or "" for x in next(lines, [])]
    dates = {i for i, h in enumerate(header) if h in date_columns}

    def rows():
        for r in lines:
            for i in dates:
                if i < len(r) and r[i] not in (None, ""):
                    r[i] = serial_to_iso(r[i])
            yield r

    return header, rows()
