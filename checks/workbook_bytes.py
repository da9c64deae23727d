"""A minimal ``.xlsx`` file of text cells, to feed the workbook reader."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd

_HEAD = '<?xml version="1.0" encoding="UTF-8"?>'
_SHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def workbook_bytes(header: list[str], rows: list[list[str | None]], shared: bool = False) -> bytes:
    strings: list[str] = []

    def cell(value: str | None) -> str:
        if value is None:
            return "<c/>"
        if shared:
            strings.append(value)
            return f'<c t="s"><v>{len(strings) - 1}</v></c>'
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'

    lines = "".join("<row>" + "".join(cell(v) for v in row) + "</row>" for row in [header, *rows])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'{_HEAD}<workbook xmlns="{_SHEET}" xmlns:r="{_OFFICE}"><sheets><sheet name="s" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'{_HEAD}<Relationships xmlns="{_PACKAGE}"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        book.writestr("xl/worksheets/sheet1.xml", f'{_HEAD}<worksheet xmlns="{_SHEET}"><sheetData>{lines}</sheetData></worksheet>')
        if shared:
            items = "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in strings)
            book.writestr("xl/sharedStrings.xml", f'{_HEAD}<sst xmlns="{_SHEET}">{items}</sst>')
    return out.getvalue()


def workbook(group: pd.DataFrame) -> pd.DataFrame:
    """One workbook from the rows of one group, in ``doc_ord`` order."""
    ordered = group.sort_values("doc_ord")
    data = ordered.drop(columns=["doc_ord", "book"])
    rows = [[None if pd.isna(v) else str(v) for v in row] for row in data.itertuples(index=False)]
    content = workbook_bytes(list(data.columns), rows)
    return pd.DataFrame({"path": [f"book-{ordered['book'].iloc[0]}.xlsx"], "content": [content]})
