"""The cells of an .xlsx workbook with the standard library: a zip of XML parts."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_M}t"))


def rows_of_workbook(data: bytes, sheet: str | None = None) -> Iterator[list[str | None]]:
    """The rows of a sheet (the first by default), top to bottom, as lists of strings and None."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = [_text(si) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_M}si")]
        sheets = {s.get("name"): s.get(f"{_R}id") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_M}sheet")}
        target = sheets[sheet] if sheet else next(iter(sheets.values()))
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        part = links[target].lstrip("/")
        part = part if part.startswith("xl/") else f"xl/{part}"
        with z.open(part) as f:
            for _, row in ElementTree.iterparse(f):
                if row.tag != f"{_M}row":
                    continue
                out: list[str | None] = []
                for cell in row.iter(f"{_M}c"):
                    at = _column(cell.get("r")) if cell.get("r") else len(out)
                    out += [None] * (at + 1 - len(out))
                    value = cell.find(f"{_M}v")
                    kind = cell.get("t")
                    if kind == "s" and value is not None:
                        out[at] = shared[int(value.text)]
                    elif kind == "inlineStr":
                        out[at] = _text(cell)
                    elif value is not None:
                        out[at] = value.text
                yield out
                row.clear()
