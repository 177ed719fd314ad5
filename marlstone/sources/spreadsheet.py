"""The first sheet of an .xlsx file, by the standard library alone.

A workbook of holdings is a few thousand rows, so the driver reads it. Cells are
text; absent ones are null. Rows whose key cell is blank, or after the first such
footer row, aren't part of the table.
"""

from __future__ import annotations

import re
import zipfile
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def cells(path: str) -> list[list[str | None]]:
    """All rows of the first sheet, each as long as its last cell demands."""
    with zipfile.ZipFile(path) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_NS}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_NS}si")]
        sheet = ElementTree.fromstring(z.read(min(n for n in names if n.startswith("xl/worksheets/sheet"))))
    rows: list[list[str | None]] = []
    for row in sheet.iter(f"{_NS}row"):
        at = int(row.get("r", len(rows) + 1))
        rows += [[] for _ in range(at - len(rows))]
        for i, c in enumerate(row.iter(f"{_NS}c")):
            v, inline = c.find(f"{_NS}v"), c.find(f"{_NS}is")
            text = "".join(t.text or "" for t in inline.iter(f"{_NS}t")) if inline is not None else v.text if v is not None else None
            if c.get("t") == "s" and text is not None:
                text = shared[int(text)]
            k = _column(c.get("r")) if c.get("r") else i
            rows[at - 1] += [None] * (k + 1 - len(rows[at - 1]))
            rows[at - 1][k] = text
    return rows


def read_sheet(spark: SparkSession, path: str, header_row: int, key: str) -> DataFrame:
    """The table under the header in row header_row (counted from 1), up to the first row whose key is blank."""
    rows = cells(path)
    names = [(c or "").strip() for c in rows[header_row - 1]]
    keep = [i for i, n in enumerate(names) if n]
    at, out = names.index(key), []
    for r in rows[header_row:]:
        r = r + [None] * (len(names) - len(r))
        if not (r[at] or "").strip():
            break
        out.append(tuple(r[i] for i in keep))
    return spark.createDataFrame(out, ", ".join(f"`{names[i]}` string" for i in keep))
