from biblioweave.operators import dedup, journals
from biblioweave.plans import pipeline, reports

J = "j_ord long, Title string, Issn string, Year string, SJR double, Publisher string, Categories string"
JOURNALS = [
    (1, "Nature Letters (print)", "1234-5678, 1111-222x", "2020", 1.5, "P1", "Optics (Q1); "),
    (2, "Nature Letters (print)", "12345678", "2020", 9.0, "P2", "Later (Q2)"),
    (3, "Nature Letters (print)", "12345678", "2021", 2.5, "P1", None),
    (4, "Annals of Fuzzy Joins", "99990000", "2020", 3.5, "P3", "Sets (Q1)"),
    (5, None, "55550000", "2020", 4.5, "P4", None),
]
R = "doc_ord long, Source string, `Source title` string, ISSN string, Year int, Publisher string"


def frames(spark, *rows):
    return spark.createDataFrame(list(rows), R), spark.createDataFrame(JOURNALS, J)


def test_issn_map_takes_the_first_title(spark):
    _, j = frames(spark, (1, "s", "t", "", 2020, None))
    assert {r.j_issn: r.canon_title for r in journals.issn_title_map(j).collect()} == {
        "12345678": "Nature Letters (print)", "1111222X": "Nature Letters (print)", "99990000": "Annals of Fuzzy Joins"
    }


def test_canonical_titles(spark):
    records, j = frames(
        spark,
        (1, "Scopus", "Nat Lett (x)", "12345678", 2020, None),
        (2, "Web of science", "NAT LETT (x)", "1234-5678", 2020, None),
        (3, "Web of science", "Fuzzy Joins of Annals", None, 2020, None),
        (4, "Web of science", "Annals of Fuzzy Join", " ", 2020, None),
        (5, None, "Fuzzy Joins of Annals", "00000001", 2020, None),
        (6, "Web of science", None, None, 2020, None),
        (7, "Web of science", "Annals of Nothing", "", 2020, None),
        (8, "Web of science", "own name", "0000-0001; 9999-0000, 1234-5678", 2020, None),
    )
    out = {r.doc_ord: (r.Source, r["Source title"]) for r in journals.canonical_titles(records, j).collect()}
    assert out == {
        1: ("Scopus", "Nat Lett"), 2: ("Web of science", "Nature Letters"), 3: ("Web of science", "Annals of Fuzzy Joins"),
        4: ("Web of science", "Annals of Fuzzy Joins"), 5: ("unknown", "Fuzzy Joins of Annals"), 6: ("Web of science", ""),
        7: ("Web of science", "Annals of Nothing"), 8: ("Web of science", "Annals of Fuzzy Joins"),
    }


def test_enrichment_keeps_every_record_once(spark):
    records, j = frames(
        spark,
        (1, "Scopus", "whatever", "12345678", 2020, "Own"),
        (1, "Web of science", "whatever", "12345678", 2020, None),
        (2, "Scopus", "ANNALS OF FUZZY JOINS", "", 2020, None),
        (3, "Scopus", "Annals of Fuzzy Joinz", "77777777", 2020, None),
        (4, "Scopus", "Annals of Fuzzy Joins", None, 2019, None),
        (5, "Scopus", None, "", 2020, None),
        (6, "Scopus", "Nature Letters", "1111222X", 2020, None),
        (7, "Scopus", "whatever", "00000001; 99990000; 12345678", 2020, None),
        (8, "Scopus", "whatever", "99990000; 12345678", 2021, None),
    )
    out = journals.enrich(records, j)
    rows = {(r.Source, r.doc_ord): r for r in out.collect()}
    assert out.count() == len(rows) == 9
    assert rows["Scopus", 1].SJR == 1.5 and rows["Scopus", 1].Publisher == "Own"
    assert rows["Scopus", 1].Categories == "Optics"
    assert rows["Web of science", 1].Publisher == "P1"
    assert rows["Scopus", 2].SJR == 3.5 and rows["Scopus", 2]["Source title"] == "ANNALS OF FUZZY JOINS"
    assert rows["Scopus", 3].SJR == 3.5
    assert rows["Scopus", 4].SJR is None and rows["Scopus", 5].SJR is None
    assert rows["Scopus", 6].SJR == 1.5
    assert rows["Scopus", 7].SJR == 3.5 and rows["Scopus", 8].SJR == 2.5


def test_reports(spark):
    a = spark.createDataFrame([("2020", "3"), ("2020", "n/a"), ("1999", "5"), (None, "1")], "Year string, `Cited by` string")
    b = spark.createDataFrame([("2020", "10"), ("2021", "2")], "`Publication Year` string, `Cited Reference Count` string")
    assert [tuple(r) for r in reports.raw_counts_by_year(a, b).collect()] == [(2020, 1, 2, 3), (2021, 1, 0, 1)]
    assert [tuple(r) for r in reports.raw_citations_by_year(a, b).collect()] == [(2020, 10, 3, 13), (2021, 2, 0, 2)]
    types = spark.createDataFrame([(2020, "Article; ; Review"), (2020, "Article"), (2021, None), (None, "Article")], "Year int, `Document Type` string")
    assert [r.asDict() for r in reports.doc_types_pivot(types, ["Article", "Review"]).collect()] == [{"Year": 2020, "Article": 2, "Review": 1}]


def test_distribution_adds_up_and_survives_empty_sources(spark):
    empty = spark.createDataFrame([], "x int")
    ten, six, titles = spark.range(10), spark.range(6), spark.createDataFrame([("t",)], "title_key string")
    rows = reports.dedup_distribution(reports.counts_of(ten, empty, six, empty, six, titles)).collect()
    assert [tuple(r) for r in rows] == [("Scopus", 6, 4, 10, 60.0, 40.0), ("WoS", 0, 0, 0, 0.0, 0.0)]
    stats = {r.Metric: r.Value for r in reports.stats_summary(reports.counts_of(ten, empty, six, empty, six, titles)).collect()}
    assert len(stats) == 18 and stats["Removed duplicated Scopus (%)"] == 40.0 and stats["Loaded WoS (%)"] == 0.0


def test_counts_are_taken_while_tables_are_written(spark):
    a = spark.createDataFrame([(1, "shared title here", "2020", "10.1/x"), (2, "shared title here", "2020", ""), (3, "題", "2020", "10.1/y"), (4, "own work", "2020", None)],
                              "doc_ord long, Title string, Year string, DOI string")
    b = spark.createDataFrame([(1, "shared title here", "2020", "", "X"), (2, "標", "2020", "10.1/X", "X"), (3, "題", "2020", "10.1/Y", "X"), (4, "fresh work", "2020", None, "X")],
                              "doc_ord long, `Article Title` string, `Publication Year` string, DOI string, Authors string")
    expected = {"loaded_a": 4, "loaded_b": 4, "final_a": 3, "kept_b": 1, "final_total": 4, "duplicates": 2}
    for stable in (False, True):
        sources = pipeline.read_sources(a, b, stable=stable)
        pairs = pipeline.match_sources(sources)
        sources.counts["final_total"] = lambda: {"rows": 4}
        assert pipeline.run_counts(sources.counts) == expected
        frames = (a, b, sources.a, pipeline.kept_of_b(sources, pairs), spark.range(4), dedup.duplicate_titles(pairs))
        assert reports.counts_of(*frames).first().asDict() == expected
    only = pipeline.run(a, None)
    assert {r.Metric: r.Value for r in only.reports["stats_summary"].collect()}["Loaded papers"] == 4


def test_pivot_of_many_types_collects_nothing(spark):
    types = ";".join(f"type {i:05d}" for i in range(12_000))
    records = spark.createDataFrame([("2020", types), ("2021", "type 00007; type 00007"), ("1999", "x")], "Year string, `Document Type` string")
    wide = reports.doc_types_pivot(records, ["type 00007", "absent"]).collect()
    assert [tuple(r) for r in wide] == [(2020, 1, 0), (2021, 2, 0)]
    assert [(r.Year, len(r.documents)) for r in reports.doc_types_by_year_map(records).collect()] == [(2020, 12_000), (2021, 1)]


def test_whole_records_move_in_one_join(spark):
    columns = "doc_ord long, Title string, Year string, DOI string, `Source title` string, ISSN string, Abstract string"
    a = spark.createDataFrame([(1, "one thing", "2020", None, "Nature Letters", "12345678", "long"), (2, "one thing", "2020", None, None, None, "x")], columns)
    journal_list = spark.createDataFrame(JOURNALS, J)
    sources = pipeline.read_sources(a, None, stable=True)
    pairs = pipeline.match_sources(sources)
    decisions = pipeline.decide(sources, pairs, journal_list)
    assert "Abstract" not in {*sources.a.columns, *pipeline.flagged(sources, pairs).columns, *decisions.columns}
    records = pipeline.assemble(sources, decisions)
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and "Window" not in plan and "Aggregate" not in plan and "Repartition" not in plan
    assert [(r.Title, r.Abstract, r.SJR) for r in records.collect()] == [("one thing", "long", 1.5)]
