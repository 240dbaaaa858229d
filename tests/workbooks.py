"""Minimal workbooks for tests."""

from __future__ import annotations

import io
import zipfile
from typing import Sequence

from dimkiln.sources.xlsx import _NS


def write_workbook(sheets: dict[str, tuple[Sequence[str], Sequence[Sequence]]]) -> bytes:
    """A minimal workbook (inline strings), one sheet per entry — used by tests."""
    def cell(ref, v):
        if v is None:
            return ""
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f'<c r="{ref}"><v>{v}</v></c>'
        esc = str(v).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
        return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{esc}</t></is></c>'

    def letters(i):
        s = ""
        i += 1
        while i:
            i, r = divmod(i - 1, 26)
            s = chr(65 + r) + s
        return s

    buf = io.BytesIO()
    sheet_tags, rel_tags = [], []
    with zipfile.ZipFile(buf, "w") as z:
        for n_sheet, (name, (header, rows)) in enumerate(sheets.items(), start=1):
            body = []
            for n, values in enumerate([list(header)] + [list(r) for r in rows], start=1):
                body.append(f'<row r="{n}">' + "".join(cell(f"{letters(i)}{n}", v)
                                                       for i, v in enumerate(values)) + "</row>")
            z.writestr(f"xl/worksheets/sheet{n_sheet}.xml",
                       f'<worksheet xmlns="{_NS["m"]}"><sheetData>' + "".join(body)
                       + "</sheetData></worksheet>")
            sheet_tags.append(f'<sheet name="{name}" sheetId="{n_sheet}" r:id="rId{n_sheet}"/>')
            rel_tags.append(f'<Relationship Id="rId{n_sheet}" Type="http://schemas.openxmlformats.org/'
                            f'officeDocument/2006/relationships/worksheet" '
                            f'Target="worksheets/sheet{n_sheet}.xml"/>')
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{_NS["m"]}" xmlns:r="{_NS["r"]}"><sheets>'
                   + "".join(sheet_tags) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_NS["pr"]}">'
                   + "".join(rel_tags) + "</Relationships>")
    return buf.getvalue()


def write_xlsx_bytes(header: Sequence[str], rows: Sequence[Sequence], sheet: str = "Sheet1") -> bytes:
    """A one-sheet workbook — used by tests."""
    return write_workbook({sheet: (header, rows)})
