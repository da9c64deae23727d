import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from biblioweave.config import COUNTRY_RULES_STRICT, ENGLISH_STOP_WORDS, Settings
from biblioweave.functions import text

STRICT = Settings(country_rules=COUNTRY_RULES_STRICT)


def values(spark, inputs, change):
    df = spark.createDataFrame(list(enumerate(inputs)), "i int, x string")
    return [r.y for r in df.select("i", change.alias("y")).orderBy("i").collect()]



def check(spark, change, cases):
    assert values(spark, [i for i, _ in cases], change(F.col("x"))) == [o for _, o in cases]


def test_stop_words_are_sparks(spark):
    assert set(ENGLISH_STOP_WORDS) == set(StopWordsRemover.loadDefaultStopWords("english"))


def test_title_key(spark):
    cases = [
        (None, ""),
        ("Café 2-D!", "caf d"),
        ("The  Studies of\tchildren", "study child"),
        ("Boxes, classes & analyses", "box class analysis"),
        ("Gas status", "gas status"),
        ("Deep\u00a0learning\u2003methods", "deep learning method"),
        ("題名", ""),
    ]
    assert values(spark, [i for i, _ in cases], text.title_key("x")) == [o for _, o in cases]


def test_title_key_takes_other_word_lists(spark):
    settings = Settings(stop_words=("of", "it's"), lemmas=(("oxen", "ox"),))
    assert values(spark, ["The oxen of it"], text.title_key("x", settings)) == ["the ox it"]


def test_author_names(spark):
    check(spark, text.author_names, [("Smith J. (57); ; Doe A. (7)", "Smith J.; Doe A."), (None, None)])


def test_document_type(spark):
    check(
        spark,
        text.document_type,
        [
            ("Article; Proceedings Paper", "Conference Paper"),
            ("Review ;Early Access", "Review; Early Access"),
            ("proceedings paper", "proceedings paper"),
            ("Review\u00a0;\u2003Book", "Review; Book"),
            (None, None),
        ],
    )


def test_doi(spark):
    check(spark, text.doi, [(" 10.1/AB\t", "10.1/ab"), (None, ""), (" X ", "x")])


def test_issn(spark):
    check(spark, text.issn, [("1234-567X", "1234567X"), ("1234-567x", "1234567X"), (None, "")])
    cells = [("1234-5678; 9999-0000, 12345678", "12345678; 99990000"), ("1234567x", "1234567X"), (" ;", ""), (None, "")]
    check(spark, text.issn_cell, cells)


def test_bracket_commas(spark):
    check(
        spark,
        text.bracket_commas,
        [
            ("[Smith, J.; Doe, A.] Univ, X", "[Smith J.; Doe A.] Univ, X"),
            ("a, b] c, [d, e", "a, b] c, [d, e"),
            ("[a, [b, c] d, e", "[a [b c] d, e"),
            (None, None),
        ],
    )


def test_countries_strict_and_default(spark):
    cases = [
        ("Univ, USA", "Univ, United States", "Univ, United States"),
        ("Univ, U.S.A.", "Univ, U.S.A.", "Univ, United States"),
        ("New South Wales", "New South United Kingdom", "New South Wales"),
        ("Cardiff, Wales", "Cardiff, United Kingdom", "Cardiff, United Kingdom"),
        ("Brunei Darussalam", "Brunei Darussalam Darussalam", "Brunei Darussalam"),
        ("Brunei", "Brunei Darussalam", "Brunei Darussalam"),
        ("Lagos, Nigeria", "Lagos, Niger", "Lagos, Nigeria"),
        ("côte d'ivoire", "Ivory Coast", "Ivory Coast"),
        ("St Martin; Sao Tome & Prin", "Saint Martin; Sao Tome and Principe", "Saint Martin; Sao Tome and Principe"),
        ("Germany (Democratic Republic, DDR)", "Germany (Democratic Republic, DDR)", "Germany"),
        ("Spain", "Spain", "Spain"),
    ]
    texts = [c[0] for c in cases]
    assert values(spark, texts, text.countries(F.col("x"), STRICT)) == [c[1] for c in cases]
    assert values(spark, texts, text.countries(F.col("x"))) == [c[2] for c in cases]


def test_affiliation_fill(spark):
    rows = [("  ", "x"), (None, ""), ("a", None), ("a", "b")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    a, b = F.col("a"), F.col("b")
    out = df.select("i", text.filled_from(a, b), text.filled_from(b, a)).orderBy("i").collect()
    assert [tuple(r)[1:] for r in out] == [("x", "x"), (None, ""), ("a", "a"), ("a", "b")]


@pytest.mark.parametrize("value", [None, "", "  ", "\t "])
def test_open_access_default(spark, value):
    check(spark, text.open_access, [(value, "subscription"), ("Gold", "Gold")])


def test_numbers(spark):
    check(spark, text.cited_by, [("n/a", 0), ("12.0", 12), (None, 0), (" 7 ", 7)])
    check(spark, text.year, [(" 2020 ", 2020), ("n.d.", None), ("2021.0", 2021), (None, None)])


def test_categories_and_names(spark):
    check(spark, text.categories, [("Catalysis (Q1);Optics (Q2); ", "Catalysis; Optics"), (None, "")])
    check(spark, text.journal_name, [(" Nature (print) ", "Nature")])


def test_null_tokens(spark):
    check(spark, text.null_if_token, [("N/A", None), ("", None), ("NAN", "NAN"), ("x", "x"), (None, None)])


def test_country_rules_behind_cheap_patterns(spark):
    from pyspark.sql import functions as F

    from biblioweave.config import COUNTRY_RULE_TEXTS, COUNTRY_RULES_DEFAULT, COUNTRY_RULES_STRICT, Settings

    cells = [
        None, "", "none of them", "the usage of thousands", "Univ, USA; x, u.s.a.", "Democratic Republic of the DEM REP CONGO", "new south wales, Wales",
        "viet nam", "Viet Nam", "CÔTE D'IVOIRE", "uſa; ſcotland", "Enɡland", "Kurkıye; TURKİYE; Turkıye", "éuk uké _uk uk",
        "Saint Martin st martin", "St Kitts & Nevi; Sao Tome & Prin", "Germany (Democratic Republic, DDR)", "úk éuk", "NIGERIA", "Brunei Brunei Darussalam",
    ]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i long, c string").cache()
    for rules in (COUNTRY_RULES_DEFAULT, COUNTRY_RULES_STRICT, (("(?i)none", "All"), *COUNTRY_RULES_DEFAULT)):
        plain = F.col("c")
        for pattern, replacement in rules:
            plain = F.regexp_replace(plain, pattern, replacement)
        wrong = rows.where(~plain.eqNullSafe(text.countries(F.col("c"), Settings(country_rules=rules))))
        assert wrong.collect() == []
    # Every rule is behind a cheap pattern, which finds whatever the rule finds.
    for pattern, _ in (*COUNTRY_RULES_DEFAULT, *COUNTRY_RULES_STRICT):
        assert pattern in COUNTRY_RULE_TEXTS
        assert rows.where(F.col("c").rlike(pattern) & ~F.col("c").rlike(text._any_country([pattern]))).count() == 0
