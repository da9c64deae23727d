"""First sheet of ``.xlsx`` workbooks, one workbook per row of a distributed scan."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import DEFAULTS, Settings
from ..functions import text

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_ROW_BITS = 33


def _column_number(reference: str) -> int:
    number = 0
    for letter in re.match("[A-Z]+", reference).group():
        number = number * 26 + ord(letter) - 64
    return number - 1


def _texts(element) -> str:
    return "".join(t.text or "" for t in element.iter(f"{_MAIN}t"))


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Cell texts of the first sheet, row by row."""
    book = zipfile.ZipFile(io.BytesIO(content))
    shared = []
    if "xl/sharedStrings.xml" in book.namelist():
        shared = [_texts(item) for item in ElementTree.parse(book.open("xl/sharedStrings.xml")).getroot()]
    first = next(ElementTree.parse(book.open("xl/workbook.xml")).getroot().iter(f"{_MAIN}sheet")).get(_REL)
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.parse(book.open("xl/_rels/workbook.xml.rels")).getroot()}
    target = targets[first].lstrip("/")
    for _, row in ElementTree.iterparse(book.open(target if target.startswith("xl/") else f"xl/{target}")):
        if row.tag != f"{_MAIN}row":
            continue
        cells: list[str | None] = []
        for place, cell in enumerate(row.iter(f"{_MAIN}c")):
            at = _column_number(cell.get("r")) if cell.get("r") else place
            value = cell.find(f"{_MAIN}v")
            if cell.get("t") == "inlineStr":
                content_text = _texts(cell)
            elif value is None:
                content_text = None
            else:
                content_text = shared[int(value.text)] if cell.get("t") == "s" else value.text
            cells += [None] * (at + 1 - len(cells))
            cells[at] = content_text
        yield cells
        row.clear()


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows = sheet_rows(content)
            header = [h or f"_{i}" for i, h in enumerate(next(rows, []))]
            part: list[tuple] = []
            for number, row in enumerate(rows):
                part.append((path, number, {k: v for k, v in zip(header, row) if v is not None}))
                if len(part) == 1000:
                    yield pd.DataFrame(part, columns=["path", "number", "cells"])
                    part = []
            if part:
                yield pd.DataFrame(part, columns=["path", "number", "cells"])


def decode_workbooks(books: DataFrame) -> DataFrame:
    """``path, number, cells``: one row per sheet row, ``cells`` maps header to text."""
    return books.select("path", "content").mapInPandas(_cells, "path string, number long, cells map<string,string>")


def read_workbooks(
    spark: SparkSession, files: list[str], settings: Settings = DEFAULTS, columns: list[str] | None = None
) -> DataFrame:
    """All workbooks united by column name, in file and row order.

    Give ``columns`` to skip the pass that collects the distinct headers.
    """
    cells = decode_workbooks(spark.read.format("binaryFile").load(files))
    if columns is None:
        names = cells.select(F.explode(F.map_keys("cells")).alias("name")).distinct()
        columns = sorted(row.name for row in names.toLocalIterator())
    ranks = spark.createDataFrame(list(zip(files, range(len(files)))), "path string, _rank long")
    picked = [text.null_if_token(F.col("cells")[c], settings.null_tokens).alias(c) for c in columns]
    position = F.shiftleft(F.col("_rank"), _ROW_BITS) + F.col("number")
    return cells.join(F.broadcast(ranks), "path").select(position.alias("doc_ord"), *picked)
