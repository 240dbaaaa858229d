"""Spreadsheet source (S-02 re-aimed): every cell as text.

No xlsx reader ships with Spark and none is installed, so workbooks are read
the Spark way: the ``binaryFile`` source lists and reads the files from any
Hadoop-compatible store (one row per file, split across tasks), and
``mapInPandas`` turns each file's bytes into rows. A workbook is a zip of
XML parts; only the standard library is needed to read one sheet:

* ``xl/workbook.xml`` + ``xl/_rels/workbook.xml.rels``: sheet name -> part;
* ``xl/sharedStrings.xml``: the shared string table;
* the sheet part: ``row``/``c`` elements with a cell reference, a type and a
  value (numbers are kept as written, booleans become ``True``/``False``).

Row 1 is the header; ``_row_number`` is the sheet row number of each data row.
Date cells stay as their serial number (styles are not interpreted).
"""

from __future__ import annotations

import io
import re
import zipfile
import xml.etree.ElementTree as ET
from typing import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from dimkiln.session import ship_package
from dimkiln.sources.files import literal, raw_name

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}
_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{{{_NS['m']}}}t"))


def _sheet_part(z: zipfile.ZipFile, sheet: str) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in rels.findall("pr:Relationship", _NS)}
    for s in wb.iter(f"{{{_NS['m']}}}sheet"):
        if s.get("name") == sheet:
            target = targets[s.get(f"{{{_NS['r']}}}id")].lstrip("/")
            return target if target.startswith("xl/") else f"xl/{target}"
    raise ValueError(f"worksheet named '{sheet}' not found")


def parse_xlsx(data: bytes, sheet: str) -> tuple[list[str], list[tuple[int, list]]]:
    """(header, [(sheet row number, values)]) of one sheet, values as text or None."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            sst = ET.fromstring(z.read("xl/sharedStrings.xml"))
            shared = [_text(si) for si in sst.findall("m:si", _NS)]
        root = ET.fromstring(z.read(_sheet_part(z, sheet)))
    rows = []
    for row in root.iter(f"{{{_NS['m']}}}row"):
        values: dict[int, str | None] = {}
        for c in row.findall("m:c", _NS):
            m = _REF.match(c.get("r", ""))
            idx = _col_index(m.group(1)) if m else len(values)
            t, v = c.get("t"), c.find("m:v", _NS)
            if t == "s" and v is not None:
                values[idx] = shared[int(v.text)]
            elif t == "inlineStr":
                values[idx] = _text(c)
            elif t == "b" and v is not None:
                values[idx] = "True" if v.text == "1" else "False"
            else:
                values[idx] = v.text if v is not None else None
        width = max(values) + 1 if values else 0
        rows.append((int(row.get("r", len(rows) + 1)), [values.get(i) for i in range(width)]))
    if not rows:
        return [], []
    header = [h if h is not None else f"Unnamed: {i}" for i, h in enumerate(rows[0][1])]
    return header, rows[1:]


def read_xlsx(spark: SparkSession, directory: str, pattern: str = "*.xlsx", sheet: str = "Sheet1",
              columns: Sequence[str] | None = None, exclude: Iterable[str] = ()) -> DataFrame:
    """All matching workbooks of ``directory`` as text rows with lineage.

    ``columns`` are the expected headers (from the mapping metadata); when
    omitted they are the headers of all files, in the order of the first file
    that has each. A header that no file has is not a column of the result,
    and a file lacking a column yields NULL for it. ``exclude`` names files to
    leave out. Arrow batches are bounded by bytes (``session.tune``), so a task
    holds a few small workbooks or one large one.
    """
    ship_package(spark)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(literal(directory))
             .filter(~raw_name("file_name").isin(list(exclude))).select("path", "content"))

    # the headers of each file, parsed on the executors; only distinct names come back
    def headers(batches):
        import pandas as pd
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                names = parse_xlsx(bytes(content), sheet)[0]
                yield pd.DataFrame({"path": [path] * len(names), "at": range(len(names)), "h": names})
    seen = [r["h"] for r in files.mapInPandas(headers, "path string, at int, h string")
            .groupBy("h").agg(F.min(F.struct("path", "at")).alias("first")).orderBy("first").collect()]
    cols = seen if columns is None else [c for c in columns if c in set(seen)]
    schema = StructType([StructField(c, StringType()) for c in cols]
                        + [StructField("_file_name", StringType()), StructField("_file_path", StringType()),
                           StructField("_row_number", LongType())])

    def parse(batches: Iterator) -> Iterator:
        import pandas as pd
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                header, rows = parse_xlsx(bytes(content), sheet)
                pos = {h: i for i, h in enumerate(header)}
                out = {c: [r[pos[c]] if c in pos and pos[c] < len(r) else None for _, r in rows]
                       for c in cols}
                out["_file_name"] = [path.rsplit("/", 1)[-1]] * len(rows)
                out["_file_path"] = [path] * len(rows)
                out["_row_number"] = [n for n, _ in rows]
                yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    return files.mapInPandas(parse, schema)
