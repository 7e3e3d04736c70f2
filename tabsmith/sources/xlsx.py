"""Excel workbook (``.xlsx``) scan.

Spark has no spreadsheet reader, and none is installed here. Workbooks are
read with Spark's ``binaryFile`` source (so any Hadoop URI works and each file
is one task) and parsed inside the task with the standard library: an xlsx
file is a zip of XML parts. Only the header names travel to the driver, to
build the schema; the rows stay on the executors.

Semantics follow a spreadsheet read with default settings: first sheet,
first row is the header, empty cells are null. Values come back as text;
cast them (``conform`` / ``try_cast``) to the types you need.
"""

from __future__ import annotations

import io
import re
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tabsmith.functions import null_tokens

_NS = {
    "m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
    "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
    "rel": "http://schemas.openxmlformats.org/package/2006/relationships",
}
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")


def _column_index(letters: str) -> int:
    index = 0
    for ch in letters:
        index = index * 26 + (ord(ch) - ord("A") + 1)
    return index - 1


def _first_sheet_path(book: zipfile.ZipFile) -> str:
    workbook = ET.fromstring(book.read("xl/workbook.xml"))
    first = workbook.find("m:sheets/m:sheet", _NS)
    if first is None:
        raise ValueError("workbook has no sheet")
    rel_id = first.get(f"{{{_NS['r']}}}id")
    rels = ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    for rel in rels.findall("rel:Relationship", _NS):
        if rel.get("Id") == rel_id:
            target = rel.get("Target").lstrip("/")
            return target if target.startswith("xl/") else f"xl/{target}"
    raise ValueError("first sheet not found in workbook relations")


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ET.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in root.findall("m:si", _NS)]


def _cell_text(cell: ET.Element, shared: list[str]) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{{{_NS['m']}}}t"))
    value = cell.find("m:v", _NS)
    if value is None or value.text is None:
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind == "b":
        return "TRUE" if value.text == "1" else "FALSE"
    return value.text


def iter_sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet as lists of cell text (gaps are None),
    parsed as the zip member is read. Emptied row elements stay in the tree, so
    memory still grows slowly with the number of rows."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = _shared_strings(book)
        row_tag, cell_tag = f"{{{_NS['m']}}}row", f"{{{_NS['m']}}}c"
        with book.open(_first_sheet_path(book)) as sheet:
            for _, elem in ET.iterparse(sheet, events=("end",)):
                if elem.tag != row_tag:
                    continue
                values: dict[int, str | None] = {}
                for pos, cell in enumerate(elem.findall(cell_tag)):
                    ref = cell.get("r")
                    col = _column_index(_CELL_REF.match(ref).group(1)) if ref else pos
                    values[col] = _cell_text(cell, shared)
                width = max(values) + 1 if values else 0
                yield [values.get(i) for i in range(width)]
                elem.clear()


def sheet_rows(content: bytes) -> list[list[str | None]]:
    """All rows of the first sheet (for small workbooks and tests)."""
    return list(iter_sheet_rows(content))


def _headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            header = next(iter_sheet_rows(content), [])
            yield pd.DataFrame({"path": [path] * len(header), "pos": range(len(header)), "name": header})


def _frame(body: list[list[str | None]], names: list[str], where: dict[str, int]) -> pd.DataFrame:
    out = {
        name: [(r[where[name]] if name in where and where[name] < len(r) else None) for r in body] for name in names
    }
    return pd.DataFrame(out, columns=names, dtype=object)


def read_xlsx(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    batch_rows: int = 10000,
    glob: str | None = None,
    missing_tokens: Iterable[str] | None = None,
) -> DataFrame:
    """Rows of the first sheet of every workbook under ``path``.

    Without ``schema`` the columns are the union of the header names (text);
    a workbook lacking a column gives null there. Every file under ``path`` is
    read, whatever its name, unless ``glob`` narrows them; one that is not a
    workbook fails the read. ``missing_tokens`` turns text cells such as ``NA``
    into nulls before any cast.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select("path", "content")
    if schema is None:
        header_rows = (
            files.mapInPandas(_headers, "path string, pos int, name string")
            .groupBy("name")
            .agg(F.min("pos").alias("pos"))
            .orderBy("pos", "name")
            .collect()
        )
        names = [r["name"] for r in header_rows if r["name"] is not None]
        schema = StructType([StructField(n, StringType(), True) for n in names])
    names = schema.fieldNames()

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = iter_sheet_rows(content)
                header = next(rows, None)
                if header is None:
                    continue
                where = {name: header.index(name) for name in names if name in header}
                body: list[list[str | None]] = []
                for r in rows:
                    if any(v is not None for v in r):
                        body.append(r)
                    if len(body) >= batch_rows:
                        yield _frame(body, names, where)
                        body = []
                if body:
                    yield _frame(body, names, where)

    text_schema = StructType([StructField(n, StringType(), True) for n in names])
    parsed = files.select("content").mapInPandas(parse, text_schema)
    if missing_tokens is not None:
        tokens = list(missing_tokens)
        parsed = parsed.withColumns({n: null_tokens(n, tokens) for n in names}) if names else parsed
    return parsed.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
