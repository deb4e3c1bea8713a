"""Minimal workbooks from rows: what ``xlsx.read_cells`` reads back. For round trips and examples."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable
from xml.sax.saxutils import escape, quoteattr

SHEET_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE_NS = "http://schemas.openxmlformats.org/package/2006/relationships"
#: Characters that XML can't hold.
BAD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")


def column_name(n: int) -> str:
    """0 is A, 26 is AA."""
    out = ""
    n += 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def workbook(sheets: Iterable[tuple[str, Iterable[tuple[int, int, str]]]]) -> bytes:
    """One workbook of (name, cells (row, column, text) in order of rows) sheets; cells are inline strings."""
    sheets = list(sheets)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        listed = "".join(f'<sheet name={quoteattr(name)} sheetId="{i + 1}" r:id="r{i}"/>' for i, (name, _) in enumerate(sheets))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{SHEET_NS}" xmlns:r="{REL_NS}"><sheets>{listed}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PACKAGE_NS}">' + "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        for i, (_, cells) in enumerate(sheets):
            rows: dict[int, list[str]] = {}
            for row, column, text in cells:
                rows.setdefault(row, []).append(f'<c r="{column_name(column)}{row + 1}" t="inlineStr"><is><t xml:space="preserve">{escape(BAD.sub("", text))}</t></is></c>')
            body = "".join(f'<row r="{r + 1}">{"".join(c)}</row>' for r, c in sorted(rows.items()))
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{SHEET_NS}"><sheetData>{body}</sheetData></worksheet>')
    return buffer.getvalue()
