import pytest
from pyspark.sql import functions as F

from biblioweave.config import Settings
from biblioweave.operators import align, dedup
from biblioweave.operators.skew import hot_keys, spread, spread_join

A = "doc_ord long, Title string, Year string, DOI string"
B = "doc_ord long, `Article Title` string, `Publication Year` string, DOI string, Authors string"


def a_frame(spark, *rows):
    return dedup.first_per_title(align.prepare_a(spark.createDataFrame(list(rows), A)))


def b_frame(spark, *rows):
    return dedup.first_per_title(align.prepare_b(spark.createDataFrame([(*r, "X, Y.") for r in rows], B)))


def ords(df, column="doc_ord"):
    return sorted(r[column] for r in df.select(column).collect())


def test_first_title_stays_and_blank_keys_are_never_equal(spark):
    a = a_frame(
        spark, (3, "Deep learning", "2020", None), (1, "The deep LEARNING", "2021", None),
        (4, "題名", "2020", None), (5, "標題", "2020", None), (6, None, None, None),
    )
    assert ords(a) == [1, 4, 5, 6]
    assert ords(dedup.first_per_title(a)) == [1, 4, 5, 6]


def test_copies_meet_reduced(spark):
    a = align.prepare_a(spark.createDataFrame([(1, "t", None, None)], A))
    plan = dedup.first_per_title(a)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_whole_records_meet_numbers_only(spark):
    raw = spark.createDataFrame([(2, "t", None, None), (1, "T", None, None), (3, None, None, None)], A).withColumn("Abstract", F.repeat(F.lit("x"), 99))
    kept = dedup.first_whole(align.prepare_a(raw))
    assert ords(kept) == [1, 3] and "Abstract" in kept.columns
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Abstract" not in plan[plan.index("Window ["):].split("\n")[0]


def test_result_does_not_depend_on_partitions(spark):
    rows = [(i, f"Title of group {'abcdefg'[i % 7]}", str(2015 + i % 3), None) for i in range(200)]
    raw = align.prepare_a(spark.createDataFrame(rows, A))
    for n in (1, 5, 23):
        assert ords(dedup.first_per_title(raw.repartition(n))) == list(range(7))


def test_final_dedup(spark):
    rows = [
        (1, " Same ", "2020", "Web of science"), (7, "Same", "2020.0", "Scopus"), (2, "Same", "2021", "Scopus"),
        (3, None, "2020", "Scopus"), (4, None, "2020", "Scopus"), (4, None, "2020", "Web of science"),
    ]
    df = spark.createDataFrame(rows, "doc_ord long, Title string, Year string, Source string")
    out = dedup.first_per_title_and_year(df)
    assert sorted((r.Source, r.doc_ord) for r in out.collect()) == [
        ("Scopus", 2), ("Scopus", 3), ("Scopus", 4), ("Scopus", 7), ("Web of science", 4)
    ]
    assert dedup.first_per_title_and_year(out).count() == 5


def test_doi_matches(spark):
    a = a_frame(spark, (1, "one thing", "2020", " 10.1/AB "), (2, "two thing", "2020", ""), (3, "six thing", "2020", "10.1/ab"))
    b = b_frame(spark, (1, "elsewhere", "2020", "10.1/Ab\t"), (2, "blank", "2020", ""), (3, "none", "2020", None))
    lookup = dedup.doi_lookup(a, b)
    assert [tuple(r) for r in dedup.doi_matches(lookup).collect()] == [(1, "elsewhere", 1)]
    assert ords(dedup.fuzzy_candidates(lookup), "b_ord") == [2, 3]


@pytest.mark.parametrize("a_year,b_year,same", [("2020", "2021", True), ("2020", "2022", False), (None, "2022", True), ("n.d.", "2022", True)])
def test_year_tolerance(spark, a_year, b_year, same):
    a = a_frame(spark, (1, "fuzzy matching large catalogue", a_year, None))
    b = b_frame(spark, (1, "fuzzy matching large catalogues x", b_year, None))
    assert dedup.duplicate_pairs(a, b).count() == same


def test_second_best_is_never_tried_unless_year_first(spark):
    a = a_frame(spark, (1, "fuzzy matching large catalogue", "2010", None), (2, "fuzzy matching large catalog", "2020", None))
    b = b_frame(spark, (5, "fuzzy matching large catalogue", "2020", None))
    assert dedup.duplicate_pairs(a, b).count() == 0
    pairs = dedup.duplicate_pairs(a, b, Settings(year_first=True)).collect()
    assert [(r.a_ord, r.b_ord, r.match_method) for r in pairs] == [(2, 5, "title")]


def test_short_titles_do_not_match(spark):
    a, b = a_frame(spark, (1, "abcd", "2020", None)), b_frame(spark, (1, "abcd", "2020", None))
    assert dedup.duplicate_pairs(a, b).count() == 0


def test_flags_and_kept_records(spark):
    a = a_frame(spark, (1, "shared title here", "2020", None), (2, "own title there", "2020", "10.1/x"), (3, "題", None, None))
    b = b_frame(spark, (1, "shared title here", "2020", None), (2, "something else", "2020", "10.1/X"), (3, "fresh work", "2020", None), (4, "題", "2020", ""))
    pairs = dedup.duplicate_pairs(a, b)
    flagged_b = dedup.flag_records(b, pairs)
    assert {r.doc_ord: r.In_Both for r in flagged_b.collect()} == {1: 1, 2: 1, 3: 0, 4: 0}
    assert {r.doc_ord: r.In_Both for r in dedup.flag_titles(a, dedup.duplicate_titles(pairs)).collect()} == {1: 1, 2: 0, 3: 0}
    kept = align.kept_records(flagged_b)
    removed = flagged_b.count() - kept.count()
    assert removed == pairs.select("b_ord").distinct().count() == 2
    assert align.b_in_a_schema(kept).columns == [
        "doc_ord", "Publication Stage", "Authors", "Author(s) ID", "Source", "DOI", "Year", "Title", "title_key", "In_Both"
    ]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_join(spark, how):
    left = spark.range(300).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string")).alias("k")
    )
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("4", 3), ("5", 4)], "k string, v int")
    hot = hot_keys(left, ["k"], share=20, min_rows=10)
    assert {r._hot0 for r in hot} == {"hot", None}
    salted, _ = spread(left, right, ["k"], "id", 20, 10)
    assert salted.where("k = 'hot'").select("_salt").distinct().count() > 1
    ours = spread_join(left, right, ["k"], "id", how, 20, 10)
    theirs = left.join(right, "k", how)
    assert sorted(map(str, ours.select(*theirs.columns).collect())) == sorted(map(str, theirs.collect()))


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="Title"):
        align.prepare_a(spark.range(1))
    with pytest.raises(ValueError, match="Publication Year"):
        align.prepare_b(spark.createDataFrame([(1, "t", "d")], "doc_ord long, `Article Title` string, DOI string"))
    with pytest.raises(ValueError):
        align.union_sources(None, None)
