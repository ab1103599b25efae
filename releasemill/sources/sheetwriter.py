"""Task-side helper: write rows of text as a minimal .xlsx workbook."""

from __future__ import annotations

import zipfile
from xml.sax.saxutils import escape

EPOCH = (1980, 1, 1, 0, 0, 0)

# --- fixed parts of the OOXML format ----------------------------------------
HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"
PARTS = {
    "[Content_Types].xml": (
        f'{HEAD}<Types xmlns="{PACKAGE}/content-types">'
        '<Default Extension="rels" '
        'ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{TYPE}.sheet.main+xml"/>'
        f'<Override PartName="/xl/worksheets/sheet1.xml" ContentType="{TYPE}.worksheet+xml"/>'
        "</Types>"
    ),
    "_rels/.rels": (
        f'{HEAD}<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" '
        f'Type="{RELS}/officeDocument" Target="xl/workbook.xml"/></Relationships>'
    ),
    "xl/workbook.xml": (
        f'{HEAD}<workbook xmlns="{MAIN}" xmlns:r="{RELS}"><sheets>'
        '<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>'
    ),
    "xl/_rels/workbook.xml.rels": (
        f'{HEAD}<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" '
        f'Type="{RELS}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>'
    ),
}


def _row_xml(values) -> str:
    cells = (
        "<c/>"
        if value is None
        else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
        for value in values
    )
    return f"<row>{''.join(cells)}</row>"


def write_workbook(stream, header, rows, copies: int = 1, tail: bytes = b"") -> None:
    """`rows` is any iterable of value sequences; it is written as it comes, each row `copies` times.

    `tail` goes behind the last row as it is.
    """
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, body in PARTS.items():
            zf.writestr(zipfile.ZipInfo(name, EPOCH), body)
        with zf.open(zipfile.ZipInfo("xl/worksheets/sheet1.xml", EPOCH), "w") as sheet:
            sheet.write(f'{HEAD}<worksheet xmlns="{MAIN}"><sheetData>'.encode())
            sheet.write(_row_xml(header).encode())
            for row in rows:
                sheet.write(_row_xml(row).encode() * copies)
            sheet.write(tail + b"</sheetData></worksheet>")
