"""Outputs: the clean records, the duplicate titles and the report tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.readwriter import DataFrameWriter

from ..operators.durable import file_system
from ..plans.pipeline import Result


def _csv(df: DataFrame) -> DataFrameWriter:
    """Quotes doubled, white space around a value kept: readable by any CSV reader."""
    keep = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return df.write.options(**keep)


def write_delimited(df: DataFrame, folder: str, sep: str = ",") -> None:
    _csv(df).option("sep", sep).csv(folder)


def write_records(records: DataFrame, folder: str, single_file: bool = False) -> None:
    """Parquet and CSV with a header; one CSV file only on request."""
    out = records.drop("doc_ord")
    out.write.parquet(f"{folder}/records")
    text = out.coalesce(1) if single_file else out
    write_delimited(text, f"{folder}/records_csv")


def write_duplicate_titles(titles: DataFrame, folder: str) -> None:
    write_delimited(titles.select("title_key").distinct().orderBy("title_key"), f"{folder}/duplicate_titles")


def write_reports(tables: dict[str, DataFrame], folder: str) -> None:
    for name, table in tables.items():
        write_delimited(table, f"{folder}/report/{name}")


def write_all(result: Result, folder: str, single_file: bool = False) -> None:
    write_records(result.records, folder, single_file)
    write_duplicate_titles(result.duplicate_titles, folder)
    result.duplicate_pairs.write.parquet(f"{folder}/duplicate_pairs")
    write_reports(result.reports, folder)


def write_run(result: Result, folder: str, single_file: bool = False) -> dict[str, int]:
    """All outputs of a run below ``folder``, and a manifest with the rows of each table.

    Tables are written beside their place and moved there when all are complete; the manifest comes last, so a folder with one
    is whole. Rows are counted by the tasks that write them. An output that exists already is an error, found before
    anything is moved.
    """
    spark = result.records.sparkSession
    records = result.records.drop("doc_ord")
    titles = result.duplicate_titles.select("title_key").distinct().orderBy("title_key")
    tables = {
        "records": (records, "parquet"), "records_csv": (records.coalesce(1) if single_file else records, "csv"),
        "duplicate_titles": (titles, "csv"), "duplicate_pairs": (result.duplicate_pairs, "parquet"),
        **{f"report/{name}": (table, "csv") for name, table in result.reports.items()},
    }
    stage, rows = f"{folder}/_staged-{uuid4().hex}", {}
    for name, (table, kind) in tables.items():
        seen = Observation()
        watched = table.observe(seen, F.count(F.lit(1)).alias("rows"))
        if kind == "csv":
            write_delimited(watched, f"{stage}/{name}")
        else:
            watched.write.parquet(f"{stage}/{name}")
        rows[name] = seen.get["rows"]
    moves = [(*file_system(spark, f"{stage}/{name}"), file_system(spark, f"{folder}/{name}")[0]) for name in tables]
    if taken := [str(to) for _, system, to in moves if system.exists(to)]:
        raise FileExistsError(f"there are outputs already: {taken}")
    for path, system, to in moves:
        system.mkdirs(to.getParent())
        if not system.rename(path, to):
            raise OSError(f"{path} could not be moved to {to}")
    left, system = file_system(spark, stage)
    system.delete(left, True)
    manifest = spark.createDataFrame(sorted(rows.items()), "table string, rows long")
    write_delimited(manifest.coalesce(1), f"{folder}/manifest")
    return rows
