"""Source-shaped tables derived from the given parquet tables, in Spark.

Source A is all of ``documents`` (a record's title is its first line), source B is
all of ``pages`` (the title is the HTML title). Some B titles get a suffix or a
moved word, so that the fuzzy join has near copies to find. ``checks/sql.py``
states the same tables in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Affiliation endings, by record number.
PLACES = (
    "USA", "England", "Peoples R China", "Turkiye", "Russian Federation", "Viet Nam", "Wales",
    "New South Wales, Australia", "Brunei", "Brunei Darussalam", "Nigeria", "U.S.A.", "uk",
    "Republic of Korea", "Cote Ivoire", "St Lucia", "Papua N Guinea", "DEM REP CONGO", "France",
)


# A text for every country rule, and two that must stay as they are.
RULE_PLACES = (
    "USA", "U.S.A.", "united states of America", "U.K.", "united kingdom", "united arab emirates", "Republic of Korea", "Peoples R China",
    "Russian Federation", "England", "SCOTLAND", "Wales", "Northern Ireland", "Viet Nam", "VietNam", "Côte d'Ivoire", "Cote d'Ivoire",
    "Cote Ivoire", "Dominican Rep", "Trinidad Tobago", "Timor Leste", "St Vincent", "Germany (Democratic Republic, DDR)", "Sao Tome & Prin",
    "St Lucia", "St Kitts & Nevi", "Papua N Guinea", "Guinea Bissau", "Cent Afr Republ", "Cape Verde", "Brunei", "Nigeria", "DEM REP CONGO",
    "Democratic Republic of the Congo", "Turkiye", "St Martin", "Saint Martin", "New South Wales", "Brunei Darussalam",
)


TYPES = ("Article", "Article; Proceedings Paper", "Review ;Early Access", "Article; ; Book Chapter")


# Cells that are numbers in some spelling: only decimal ones count.
ODD_NUMBERS = ("12d", "2019f", "0x1p3", "Infinity", "+7", "201950e-2", ".5", "2020.", "1_000", "NaN", "-3", "2,021")


def _pick(number: str, options) -> str:
    listed = "|".join(options).replace("'", "\\'")
    return f"element_at(split('{listed}', '[|]'), cast({number} % {len(options)} + 1 AS int))"


def _issn(j: str) -> str:
    return f"if({j} % 10 = 3, concat(1000000 + {j} * 791, 'X'), string(10000000 + {j} * 7919))"


def _year_text(n: str, year: str) -> str:
    return (
        f"CASE WHEN {n} % 23 = 0 THEN NULL WHEN {n} % 29 = 0 THEN 'n.d.' "
        f"WHEN {n} % 37 = 5 THEN {_pick(n, ODD_NUMBERS)} WHEN {n} % 19 = 0 THEN concat({year}, '.0') ELSE string({year}) END"
    )


def _cited(n: str) -> str:
    return f"CASE WHEN {n} % 31 = 0 THEN 'n/a' WHEN {n} % 37 = 0 THEN {_pick(n, ODD_NUMBERS)} WHEN {n} % 13 = 0 THEN '12.0' ELSE string({n} % 50) END"


def _open_access(n: str) -> str:
    return f"CASE {n} % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' \t ' ELSE 'Gold' END"


def source_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    d = d.selectExpr("doc_id AS n", "doc_id % 120 AS j", "substring_index(text, '\n', 1) AS f", "lang", "text")
    place = _pick("n", PLACES)
    return d.selectExpr(
        "n AS doc_ord",
        "CASE WHEN n % 43 = 0 THEN ' \u2003' WHEN n % 9 = 4 THEN replace(f, ' ', '\u00a0') WHEN n % 41 <> 0 THEN f END AS Title",
        _year_text("n", "(2014 + length(f) % 13)") + " AS Year",
        "CASE WHEN length(f) % 3 = 0 THEN concat('10.5555/', md5(f)) WHEN n % 2 = 0 THEN '' END AS DOI",
        "concat('Journal of Supplier ', j, ' (print)') AS `Source title`",
        f"CASE WHEN n % 7 = 0 THEN concat('0000-0019, ', {_issn('j')}, '; ', {_issn('j')}) WHEN n % 17 <> 0 THEN {_issn('j')} END AS ISSN",
        _pick("n", TYPES) + " AS `Document Type`",
        _cited("n") + " AS `Cited by`",
        _open_access("n") + " AS `Open Access`",
        "concat('Smith J. (', n, '); ; Doe A. (7)') AS `Author full names`",
        "'Smith J.; Doe A.' AS Authors",
        f"if(n % 8 = 0, '', concat('Univ X, ', {place})) AS Affiliations",
        f"if(n % 12 <> 0, concat('[Smith, J.; Doe, A.] Univ X, ', {place}, '; [Roe, B.] x, y'), NULL) AS `Authors with affiliations`",
        "if(n % 3 = 0, 'Own Press', NULL) AS Publisher",
        "lang AS `Language of Original Document`",
        "text AS Abstract",
    )


def source_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/pages.parquet")
    p = p.selectExpr(
        "page_id AS n", "page_id % 120 AS j", "url", "regexp_extract(html, '<title>([^<]*)</title>', 1) AS t",
        "regexp_extract(html, 'lang=\"([a-z]+)\"', 1) AS lang",
    ).selectExpr("*", "n % 5 = 1 AND length(t) >= 20 AS longer", "n % 5 = 3 AND instr(t, ' ') > 0 AS moved", f"{_issn('j')} AS issn8")
    return p.selectExpr(
        "n AS doc_ord",
        """CASE WHEN longer THEN concat(t, ' rev') WHEN moved THEN concat(substring(t, instr(t, ' ') + 1), ' ',
             substring(t, 1, instr(t, ' ') - 1)) WHEN n % 9 = 5 THEN replace(t, ' ', '\u2003') ELSE t END AS `Article Title`""",
        _year_text("n", "(2014 + length(t) % 13 + if(longer, n % 4, 0))") + " AS `Publication Year`",
        """CASE WHEN NOT longer AND NOT moved AND length(t) % 3 = 0 THEN concat(' 10.5555/', upper(md5(t)), '\t')
             WHEN n % 2 = 0 THEN '' END AS DOI""",
        """CASE WHEN n % 5 = 0 THEN concat('Journal of Suplier ', j, ' (print)') WHEN n % 5 = 2
             THEN concat('Supplier of Journal ', j, ' (print)') ELSE concat('J & Supp ', j, ' (web)') END AS `Source Title`""",
        """if(n % 5 <> 0 AND n % 5 <> 2, concat(if(n % 3 = 0, '0000-0019; ', ''),
             lower(concat(substring(issn8, 1, 4), '-', substring(issn8, 5, 4)))), NULL) AS ISSN""",
        _pick("n", TYPES) + " AS `Document Type`",
        _cited("n") + " AS `Cited Reference Count`",
        _open_access("n") + " AS `Open Access Designations`",
        "'Smith, J.; Doe, A.' AS Authors",
        "'Smith, John; Doe, Ann' AS `Author Full Names`",
        "lang AS Language",
        f"concat('[Smith, J.; Doe, A.] Univ Y, ', {_pick('n', PLACES)}) AS Addresses",
        "'' AS Affiliations",
        "concat('WOS:', n) AS `UT (Unique WOS ID)`",
        "url AS `DOI Link`",
    )


def journal_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers as journals, nine years each, two ISSNs each."""
    supplier, nation, region = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("supplier", "nation", "region"))
    rows = (
        supplier.withColumnRenamed("s_nationkey", "n_nationkey").join(nation, "n_nationkey")
        .withColumnRenamed("n_regionkey", "r_regionkey").join(region, "r_regionkey")
    )
    return rows.selectExpr("*", "explode(sequence(2015, 2023)) AS y").selectExpr(
        "s_suppkey * 100 + y - 2015 AS j_ord",
        "concat('Journal of Supplier ', s_suppkey, ' (print)') AS Title",
        f"concat({_issn('s_suppkey')}, ', ', 20000000 + s_suppkey * 7919) AS Issn",
        "string(y) AS Year",
        "s_acctbal / 1000 AS SJR",
        "concat('Q', 1 + s_suppkey % 4) AS `SJR Best Quartile`",
        "int(s_suppkey % 97) AS `H index`",
        "n_name AS Country",
        "r_name AS Region",
        "s_name AS Publisher",
        "'Catalysis (Q1);Optics (Q2); ' AS Categories",
        "'Science' AS Areas",
    )


def lemma_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and lemmas made of all words of all texts: every word of 6, 9, 12 ... letters loses two."""
    words = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("explode(split(lower(text), '[^a-z]+')) AS form").distinct()
    return words.where("length(form) >= 5 AND length(form) % 3 = 0").selectExpr("form", "left(form, length(form) - 2) AS lemma")


def given_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole texts and pages as cells, with the edge cases of every cleaning rule around or between them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id AS n", "text AS t")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr("page_id + 1000000000 AS n", "html AS t")
    place = [_pick(f"(n div 12 + {k})", RULE_PLACES) for k in (0, 7)]
    return docs.unionByName(pages).selectExpr(
        "n AS doc_ord", "t AS other",
        f"""CASE n % 12 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' \t \u2003' WHEN 3 THEN concat('Smith J. (', t, '); ; Doe A. (7)')
        WHEN 4 THEN concat('[', t, ', x] , a; [b, c') WHEN 5 THEN concat(' ', t, ' ;Proceedings Paper;  Early Access ')
        WHEN 6 THEN concat({place[0]}, ', ', t, '; ', {place[1]}) WHEN 7 THEN concat('1234-567x, ', t)
        WHEN 8 THEN {_pick("(n div 12)", ODD_NUMBERS)} WHEN 9 THEN concat(' ', n % 50, '.0 ') WHEN 10 THEN concat(t, ' & (web) & more') ELSE t END AS cell""",
    )
