"""Writes one-sheet spreadsheets (.xlsx) with the standard library."""

from __future__ import annotations

import datetime as dt
import io
import zipfile
from typing import BinaryIO
from xml.sax.saxutils import escape

from billstar.sources.xlsx import EXCEL_EPOCH


def col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _iso_to_serial(v) -> float:
    ts = v if isinstance(v, dt.datetime) else dt.datetime.combine(v, dt.time())
    delta = ts - EXCEL_EPOCH
    return delta.days + delta.seconds / 86400.0


def write_workbook(header: list[str], rows, date_columns: set[str] = frozenset(),
                   number_columns: set[str] = frozenset()) -> bytes:
    """The workbook of :func:`stream_workbook` as bytes."""
    buf = io.BytesIO()
    stream_workbook(buf, header, rows, date_columns, number_columns)
    return buf.getvalue()


def stream_workbook(out: BinaryIO, header: list[str], rows, date_columns: set[str] = frozenset(),
                    number_columns: set[str] = frozenset()) -> int:
    """One-sheet workbook, written to a stream (that need not be seekable)
    as the rows are taken, none of which is kept; dates as serial numbers
    with a date style, numbers as numeric cells, everything else as inline
    strings. The rows written."""
    letters = [col_letters(i) for i in range(len(header))]

    def cell(ref, name, v):
        if v is None or (isinstance(v, float) and v != v):
            return ""
        if name in date_columns:
            return f'<c r="{ref}" s="1"><v>{_iso_to_serial(v)!r}</v></c>'
        if name in number_columns:
            return f'<c r="{ref}"><v>{v}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>'

    n = 1
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?>'
                   '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   '<Default Extension="xml" ContentType="application/xml"/>'
                   '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
                   '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
                   '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
                   '</Types>')
        z.writestr("_rels/.rels",
                   '<?xml version="1.0" encoding="UTF-8"?>'
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
                   '</Relationships>')
        z.writestr("xl/workbook.xml",
                   '<?xml version="1.0" encoding="UTF-8"?>'
                   '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
                   'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
                   '<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<?xml version="1.0" encoding="UTF-8"?>'
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
                   '<Relationship Id="rId2" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/styles" Target="styles.xml"/>'
                   '</Relationships>')
        z.writestr("xl/styles.xml",
                   '<?xml version="1.0" encoding="UTF-8"?>'
                   '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
                   '<fonts count="1"><font/></fonts><fills count="1"><fill/></fills>'
                   '<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
                   '<cellXfs count="2"><xf/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs>'
                   '</styleSheet>')
        # the sheet's size is not known beforehand
        with z.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as sheet:
            sheet.write(b'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                        b'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
            sheet.write(('<row r="1">' + "".join(
                f'<c r="{c}1" t="inlineStr"><is><t>{escape(h)}</t></is></c>' for c, h in zip(letters, header))
                + "</row>").encode())
            for n, r in enumerate(rows, start=2):
                sheet.write((f'<row r="{n}">' + "".join(
                    cell(f"{letters[i]}{n}", header[i], v) for i, v in enumerate(r)) + "</row>").encode())
            sheet.write(b"</sheetData></worksheet>")
    return n - 1
