import os

import pytest
from pyspark.sql import functions as F

from biblioweave.operators.durable import run_folder
from biblioweave.plans import pipeline
from biblioweave.sources import exports, sinks
from checks.workbook_bytes import workbook_bytes


def write(folder, name, content):
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        f.write(content if isinstance(content, bytes) else content.encode())


@pytest.fixture()
def inputs(tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    a.mkdir(), b.mkdir()
    write(a, "2.csv", "Year,Title,Extra\n2020,Later file,e\n")
    write(a, "1.csv", '﻿Title,Year,DOI\n"Quoted\nnewline, ""and"" quotes",2020,10.1/A\nSecond,N/A,\n')
    write(a, "ignored.tsv", "x")
    rows = [["Quoted newline, and quotes", "2021", None, "Doe, J."], ["Only here <&>", "2019", "10.1/b", "Roe, R."]]
    header = ["Article Title", "Publication Year", "DOI", "Authors"]
    write(b, "1.xlsx", workbook_bytes(header, rows))
    write(b, "2.xlsx", workbook_bytes(["DOI", *header[:2], "Authors", "ISSN"], [["10.1/A", "Other name", "2020", "Poe", "1234-5678"]], shared=True))
    write(tmp_path, "journals.csv", "Title;Issn;Year;SJR\nJ One;12345678, 87654321;2020;1.5\n")
    return tmp_path


def test_scan_a(spark, inputs):
    raw, _ = exports.scan_inputs(spark, str(inputs / "a"), None)
    rows = raw.orderBy("doc_ord").select("Title", "Year", "DOI", "Extra").collect()
    assert [tuple(r) for r in rows] == [
        ('Quoted\nnewline, "and" quotes', "2020", "10.1/A", None), ("Second", None, None, None), ("Later file", "2020", None, "e")
    ]


def test_scan_b_workbooks(spark, inputs):
    _, raw = exports.scan_inputs(spark, None, str(inputs / "b"))
    rows = raw.orderBy("doc_ord").select("Article Title", "DOI", "ISSN").collect()
    assert [tuple(r) for r in rows] == [
        ("Quoted newline, and quotes", None, None), ("Only here <&>", "10.1/b", None), ("Other name", "10.1/A", "1234-5678")
    ]


def test_journals_are_optional(spark, inputs):
    assert exports.read_journals(spark, None) is None
    assert exports.read_journals(spark, str(inputs / "absent.csv")) is None
    rows = exports.read_journals(spark, str(inputs / "journals.csv")).collect()
    assert [(r.Title, r.Issn, r.SJR) for r in rows] == [("J One", "12345678, 87654321", "1.5")]


def test_no_source_at_all(spark, tmp_path):
    with pytest.raises(ValueError, match="no source"):
        exports.scan_inputs(spark, str(tmp_path), str(tmp_path))


def test_absent_folders_and_sub_folders(spark, inputs):
    assert exports.list_files(spark, str(inputs / "nowhere"), "*.csv") == []
    assert exports.read_journals(spark, str(inputs / "nowhere" / "journals.csv")) is None
    (inputs / "a" / "old.csv").mkdir()
    write(inputs / "a" / "old.csv", "0.csv", "Title,Year\nElsewhere,2020\n")
    raw, none = exports.scan_inputs(spark, str(inputs / "a"), str(inputs / "nowhere"))
    assert none is None and raw.count() == 3


def test_inventory(spark, inputs):
    raw_a, raw_b = exports.scan_inputs(spark, str(inputs / "a"), str(inputs / "b"))
    rows = {(r.Source, r.column): (r.records, r.blank_cells) for r in exports.input_inventory(raw_a, raw_b).collect()}
    assert rows["Scopus", "Title"] == (3, 0)
    assert rows["Web of science", "DOI"] == (3, 1)


@pytest.mark.parametrize("use_a,use_b,use_j,expected", [
    (True, True, True, {("Scopus", 2020): 2, ("Web of science", 2019): 1}),
    (True, False, False, {("Scopus", 2020): 2}),
    (False, True, True, {("Web of science", 2019): 1, ("Web of science", 2020): 1, ("Web of science", 2021): 1}),
])
def test_run_and_write(spark, inputs, use_a, use_b, use_j, expected):
    raw_a, raw_b = exports.scan_inputs(spark, str(inputs / "a") if use_a else None, str(inputs / "b") if use_b else None)
    journals = exports.read_journals(spark, str(inputs / "journals.csv")) if use_j else None
    result = pipeline.run(raw_a, raw_b, journals)
    counts = {(r.Source, r.Year): r["count"] for r in result.records.groupBy("Source", "Year").count().collect()}
    assert counts == expected
    out = str(inputs / "out")
    sinks.write_all(result, out, single_file=True)
    assert spark.read.parquet(f"{out}/records").count() == sum(expected.values())
    back = exports.read_delimited(spark, exports.list_files(spark, f"{out}/records_csv", "*.csv"))
    assert back.count() == sum(expected.values())
    titles = exports.read_delimited(spark, exports.list_files(spark, f"{out}/duplicate_titles", "*.csv"))
    assert titles.count() == (2 if use_a and use_b else 0)
    stats = spark.read.option("header", True).csv(f"{out}/report/stats_summary")
    assert stats.count() == 18


def test_run_folder_leaves_nothing_and_outputs_have_a_manifest(spark, tmp_path):
    a = spark.createDataFrame([(1, "one thing", "2020", None), (2, "one thing", "2021", None)], "doc_ord long, Title string, Year string, DOI string")
    with run_folder(spark) as folder:
        result = pipeline.run(a, None)
        rows = sinks.write_run(result, str(tmp_path / "out"))
        assert os.listdir(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))
    written = spark.read.option("header", True).csv(str(tmp_path / "out" / "manifest"))
    assert {r.table: int(r.rows) for r in written.collect()} == rows
    assert rows["records"] == rows["records_csv"] == 1 and rows["report/stats_summary"] == 18
    assert spark.read.parquet(str(tmp_path / "out" / "records")).count() == 1
    assert not [n for n in os.listdir(tmp_path / "out") if n.startswith("_staged")]
    again = pipeline.run(a, None)
    with pytest.raises(FileExistsError):
        sinks.write_run(again, str(tmp_path / "out"))


def test_headers_are_read_in_one_job(spark, tmp_path):
    for i in range(9):
        (tmp_path / f"{i}.csv").write_text(("Title,Year\n" if i % 2 else "Year,Title,DOI\n") + ("x,1\n" if i % 2 else "1,x,y\n"))
    (tmp_path / "odd.csv").write_text('"Ti\ntle",Year\n"a\nb",3\n')
    (tmp_path / "void.csv").write_text("")
    files = exports.list_files(spark, str(tmp_path), "*.csv")
    assert len(exports.first_lines(spark, files)) == 10
    rows = exports.read_delimited(spark, files, file_column="file")
    assert rows.columns[:2] == ["doc_ord", "file"] and rows.count() == 10
    assert rows.where("DOI IS NULL").count() == 5 and rows.where(F.col("`Ti\ntle`") == "a\nb").count() == 1
    counted = {(r.file.rsplit("/", 1)[1], r.column): (r.records, r.blank_cells) for r in exports.inventory_by_file(spark, files, ["Title", "DOI"]).collect()}
    assert counted["void.csv", "Title"] == (0, 0) and counted["1.csv", "DOI"] == (1, 1) and counted["0.csv", "DOI"] == (1, 0)
