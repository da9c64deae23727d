"""Delimited export files as DataFrames of text columns with an input order."""

from __future__ import annotations

import re
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import DEFAULTS, Settings
from ..functions import text
from ..operators import align
from ..operators.durable import file_system

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def list_files(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Matching files of the folder itself in name order; an absent folder has none."""
    path, system = file_system(spark, folder)
    if not system.exists(path):
        return []
    found = [status.getPath() for status in system.listStatus(path) if status.isFile()]
    return sorted(p.toString() for p in found if fnmatchcase(p.getName(), pattern))


def _plain(path: str) -> str:
    """Listed and reported paths spell their scheme differently (file:/ and file:///)."""
    return re.sub("^([a-z0-9]+:)/+", r"\1/", path)


def first_lines(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """The first line of every file, read by the tasks of one Spark job; files without a line are left out."""
    lines = spark.read.text(files).select(
        "_metadata.file_path", "_metadata.file_block_start", "value", F.monotonically_increasing_id().alias("_id")
    )
    first = lines.where("file_block_start = 0").groupBy("file_path").agg(F.min_by("value", "_id").alias("value"))
    found = {_plain(r.file_path): r.value for r in first.collect()}
    return {f: found[_plain(f)] for f in files if _plain(f) in found}


def read_delimited(
    spark: SparkSession, files: list[str], sep: str = ",", settings: Settings = DEFAULTS, order: str = "doc_ord",
    file_column: str | None = None,
) -> DataFrame:
    """All files united by column name, every column as text, missing cells NULL.

    Files with the same first line share one scan, so the number of jobs follows the number of headers, not of files. Quoted
    newlines are allowed, so a file is read by one task; its rows are numbered in file order, files in name
    order, and ``order`` holds that position. Files without a line have no records. ``file_column`` adds the file.
    """
    reader = spark.read.option("sep", sep).option("header", True).option("multiLine", True).option("escape", '"')
    by_line: dict[str, list[str]] = {}
    for file, line in first_lines(spark, files).items():
        # A header that goes on after a line break inside quotes is told by the reader, file by file.
        by_line.setdefault(f"{line}\n{file}" if line.count('"') % 2 else line, []).append(file)
    ranks = spark.createDataFrame([(_plain(f), i) for i, f in enumerate(files)], "_file string, _rank long")
    by_header: dict[tuple[str, ...], list[str]] = {}
    for members in by_line.values():
        by_header.setdefault(tuple(reader.csv(members[0]).columns), []).extend(members)
    parts = []
    for header, members in by_header.items():
        schema = ", ".join(f"`{c}` string" for c in header)
        cells = {c: text.null_if_token(F.col(f"`{c}`"), settings.null_tokens) for c in header}
        rows = reader.schema(schema).csv(members).select(
            "*", F.regexp_replace("_metadata.file_path", "^([a-z0-9]+:)/+", "$1/").alias("_path"),
            F.monotonically_increasing_id().alias("_id"),
        )
        ranked = rows.join(F.broadcast(ranks), F.col("_path") == F.col("_file"))
        position = F.shiftleft(F.col("_rank"), _ROW_BITS) + F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1)
        named = [F.col("_file").alias(file_column)] if file_column else []
        parts.append(ranked.withColumns(cells).select(position.alias(order), *named, *[F.col(f"`{c}`") for c in header]))
    if not parts:
        columns = [f"{order} long", *([f"{file_column} string"] if file_column else [])]
        return spark.createDataFrame([], ", ".join(columns))
    return align.union_sources(*parts)


def inventory_by_file(
    spark: SparkSession, files: list[str], required: list[str], sep: str = ",", settings: Settings = DEFAULTS
) -> DataFrame:
    """``file, column, records, blank_cells`` for every listed file and required column.

    Files without records count 0; a column that a file lacks is blank in all of its records.
    """
    rows = read_delimited(spark, files, sep, settings, file_column="_file")
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), (text.is_blank(F.col(f"`{c}`")) if c in rows.columns else F.lit(True)).alias("blank")) for c in required
    ])
    counted = rows.select("_file", F.inline(cells)).groupBy(F.col("_file").alias("file"), "column").agg(
        F.count(F.lit(1)).alias("records"), F.count_if("blank").alias("blank_cells")
    )
    listed = spark.createDataFrame([(_plain(f), c) for f in files for c in required], "file string, column string")
    return listed.join(counted, ["file", "column"], "left").na.fill(0, ["records", "blank_cells"])


def scan_inputs(spark: SparkSession, folder_a: str | None, folder_b: str | None, settings: Settings = DEFAULTS):
    """``(raw_a, raw_b)``: a missing or empty source is None, none at all is an error.

    Source A is ``*.csv``; source B is ``*.xlsx`` workbooks or ``*.csv``, ``*.txt`` exports (tab-separated).
    """
    from .workbooks import read_workbooks

    def files(folder, pattern):
        return list_files(spark, folder, pattern) if folder else []

    a_files = files(folder_a, "*.csv")
    books = files(folder_b, "*.xlsx")
    delimited = [(files(folder_b, "*.csv"), ","), (files(folder_b, "*.txt"), "\t")]
    raw_a = read_delimited(spark, a_files, settings=settings) if a_files else None
    parts_b = [read_delimited(spark, names, sep, settings) for names, sep in delimited if names]
    if books:
        parts_b.append(read_workbooks(spark, books, settings))
    if len(parts_b) > 1:
        raise ValueError("the second source mixes file formats; convert them to one, as their order is undefined")
    raw_b = parts_b[0] if parts_b else None
    if raw_a is None and raw_b is None:
        raise ValueError("there is no source to read")
    return raw_a, raw_b


def read_journals(spark: SparkSession, file: str | None, settings: Settings = DEFAULTS) -> DataFrame | None:
    """The optional ``;``-separated journal list, or None where there is none."""
    folder, _, name = file.rpartition("/") if file else ("", "", "")
    found = list_files(spark, folder or ".", name) if file else []
    return read_delimited(spark, found, ";", settings, order="j_ord") if found else None


def input_inventory(raw_a: DataFrame | None, raw_b: DataFrame | None) -> DataFrame:
    """Records per source, and how many lack each required cell."""
    rows = None
    for name, df, required in (
        ("Scopus", raw_a, ["Title"]),
        ("Web of science", raw_b, ["Article Title", "DOI", "Publication Year"]),
    ):
        if df is None:
            continue
        align.require_columns(df, required, name)
        missing = F.array(*[
            F.struct(F.lit(c).alias("column"), text.is_blank(F.col(f"`{c}`")).alias("blank")) for c in required
        ])
        part = df.select(F.lit(name).alias("Source"), F.inline(missing))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("Source", "column").agg(
        F.count(F.lit(1)).alias("records"), F.count_if("blank").alias("blank_cells")
    )
