"""The derived tables and every query once more, in DuckDB SQL, as brute force."""

from __future__ import annotations

from biblioweave.config import COUNTRY_RULES_DEFAULT, DEFAULTS, TARGET_COLUMNS

from .tables import ODD_NUMBERS, PLACES, RULE_PLACES

# Every code point that Unicode counts as white space, and the four separators below the space.
_CODES = (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_SPACES = " || ".join(f"chr({code})" for code in _CODES)
_CLASS = "".join(map(chr, _CODES))


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def trim(x: str) -> str:
    return f"trim({x}, {_SPACES})"


def blank(x: str) -> str:
    return f"(coalesce({trim(x)}, '') = '')"


def _joined(x: str) -> str:
    return f"array_to_string(list_filter(list_transform(string_split({x}, ';'), lambda p: {trim('p')}), lambda p: p <> ''), '; ')"


def no_parens(x: str) -> str:
    return rf"regexp_replace({x}, '\([^)]*\)', '', 'g')"


def author_names(x: str) -> str:
    return _joined(no_parens(x))


def categories(x: str) -> str:
    return _joined(no_parens(f"coalesce({x}, '')"))


STOPS = _quoted(DEFAULTS.stop_words)


def title_tokens(x: str) -> str:
    letters = rf"lower(regexp_replace(coalesce({x}, ''), '[^a-zA-Z{_CLASS}]', '', 'g'))"
    return rf"list_filter(string_split_regex({trim(letters)}, '[{_CLASS}]+'), lambda t: t <> '' AND t NOT IN ({STOPS}))"


def lemma(t: str) -> str:
    irregular = " ".join(f"WHEN {t} = '{form}' THEN '{lemma}'" for form, lemma in DEFAULTS.lemmas)
    return (
        f"CASE WHEN length({t}) <= 3 THEN {t} {irregular} "
        f"WHEN suffix({t}, 'ies') AND length({t}) > 4 THEN left({t}, length({t}) - 3) || 'y' "
        f"WHEN regexp_matches({t}, '(?:sses|xes|zes|ches|shes)$') THEN left({t}, length({t}) - 2) "
        f"WHEN suffix({t}, 's') AND NOT regexp_matches({t}, '(?:ss|us|is)$') THEN left({t}, length({t}) - 1) ELSE {t} END"
    )


def title_key(x: str) -> str:
    lemmas = f"list_transform({title_tokens(x)}, lambda t: {lemma('t')})"
    return f"array_to_string(list_filter({lemmas}, lambda t: t NOT IN ({STOPS})), ' ')"


def document_type(x: str) -> str:
    renamed = f"replace({x}, 'Proceedings Paper', 'Conference paper')"
    whole = f"CASE WHEN contains(lower({renamed}), 'conference paper') THEN 'Conference Paper' ELSE {renamed} END"
    return trim(rf"regexp_replace({whole}, '[{_CLASS}]*;[{_CLASS}]*', '; ', 'g')")


def doi(x: str) -> str:
    return trim(f"lower(coalesce({x}, ''))")


def number(x: str) -> str:
    return f"CASE WHEN regexp_matches({trim(x)}, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$') THEN try_cast({trim(x)} AS DOUBLE) END"


def year(x: str) -> str:
    return f"try_cast(trunc({number(x)}) AS INTEGER)"


def cited(x: str) -> str:
    return f"coalesce(try_cast(trunc({number(x)}) AS BIGINT), 0)"


def issn(x: str) -> str:
    return f"regexp_replace(upper(coalesce({x}, '')), '[^0-9X]', '', 'g')"


def issns(x: str) -> str:
    return f"list_filter(list_transform(string_split_regex({x}, '[,;]'), lambda i: {issn('i')}), lambda i: i <> '')"


def issn_cell(x: str) -> str:
    """The cleaned ISSNs of a list, each once, in order."""
    listed = f"list_filter({issns(x)}, lambda i, k: list_position({issns(x)}, i) = k)"
    return f"coalesce(array_to_string({listed}, '; '), '')"


def bracket_commas(x: str) -> str:
    piece = (
        "CASE WHEN i < len({p}) AND instr(p, '[') > 0 THEN left(p, instr(p, '[') - 1) || "
        "replace(substr(p, instr(p, '[')), ',', '') ELSE p END"
    ).format(p=f"string_split({x}, ']')")
    return f"array_to_string(list_transform(string_split({x}, ']'), lambda p, i: {piece}), ']')"


def countries(x: str) -> str:
    # RE2 has no lookaround: the two guarded names are masked first.
    out = f"replace(replace({x}, 'New South Wales', 'New South W#les'), 'Brunei Darussalam', 'Brunei')"
    for pattern, replacement in COUNTRY_RULES_DEFAULT:
        plain = pattern.removeprefix("(?iU)").replace("(?<!new south )", "").replace("(?! Darussalam)", "")
        plain = plain.replace("'", "''")
        out = f"regexp_replace({out}, '{plain}', '{replacement}', 'gi')"
    return f"replace({out}, 'W#les', 'Wales')"


def affiliations(x: str) -> str:
    return countries(bracket_commas(x))


def filled(x: str, other: str) -> str:
    return f"CASE WHEN {blank(x)} AND NOT {blank(other)} THEN {other} ELSE {x} END"


def open_access(x: str) -> str:
    return f"CASE WHEN {blank(x)} THEN 'subscription' ELSE {x} END"


def journal_name(x: str) -> str:
    return trim(no_parens(x))


def share(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN round(100.0::DOUBLE * {part} / {whole}, 1) ELSE 0.0 END"


def sorted_tokens(x: str) -> str:
    return rf"array_to_string(list_sort(list_filter(string_split_regex({x}, '[{_CLASS}]+'), lambda t: t <> '')), ' ')"


def lev(a: str, b: str) -> str:
    return f"(1.0::DOUBLE - levenshtein({a}, {b})::DOUBLE / greatest(length({a}), length({b})))"


def _journal_issn(j: str) -> str:
    return f"CASE WHEN {j} % 10 = 3 THEN CAST(1000000 + {j} * 791 AS VARCHAR) || 'X' ELSE CAST(10000000 + {j} * 7919 AS VARCHAR) END"


def _year_text(n: str, y: str) -> str:
    return (
        f"CASE WHEN {n} % 23 = 0 THEN NULL WHEN {n} % 29 = 0 THEN 'n.d.' "
        f"WHEN {n} % 37 = 5 THEN list_extract([{_quoted(ODD_NUMBERS)}], {n} % {len(ODD_NUMBERS)} + 1) "
        f"WHEN {n} % 19 = 0 THEN CAST({y} AS VARCHAR) || '.0' ELSE CAST({y} AS VARCHAR) END"
    )


def _dirty(n: str) -> str:
    return f"""
  list_extract(['Article', 'Article; Proceedings Paper', 'Review ;Early Access', 'Article; ; Book Chapter'], {n} % 4 + 1) AS dtype,
  CASE WHEN {n} % 31 = 0 THEN 'n/a' WHEN {n} % 37 = 0 THEN list_extract([{_quoted(ODD_NUMBERS)}], {n} % {len(ODD_NUMBERS)} + 1) WHEN {n} % 13 = 0 THEN '12.0' ELSE CAST({n} % 50 AS VARCHAR) END AS cited,
  CASE WHEN {n} % 4 = 0 THEN NULL WHEN {n} % 4 = 1 THEN '' WHEN {n} % 4 = 2 THEN ' ' || chr(9) || ' ' ELSE 'Gold' END AS oa,
  list_extract([{_quoted(PLACES)}], {n} % {len(PLACES)} + 1) AS place"""


CTES: dict[str, str] = {}

CTES["d"] = f"""
SELECT doc_id AS n, doc_id % 120 AS j, split_part(text, chr(10), 1) AS f, lang, text, {_dirty('doc_id')} FROM documents"""

CTES["raw_a"] = f"""
SELECT n AS doc_ord, CASE WHEN n % 43 = 0 THEN ' ' || chr(8195) WHEN n % 9 = 4 THEN replace(f, ' ', chr(160)) WHEN n % 41 <> 0 THEN f END AS "Title",
  {_year_text('n', '(2014 + length(f) % 13)')} AS "Year",
  CASE WHEN length(f) % 3 = 0 THEN '10.5555/' || md5(f) WHEN n % 2 = 0 THEN '' END AS "DOI",
  'Journal of Supplier ' || j || ' (print)' AS "Source title",
  CASE WHEN n % 7 = 0 THEN '0000-0019, ' || {_journal_issn('j')} || '; ' || {_journal_issn('j')} WHEN n % 17 <> 0 THEN {_journal_issn('j')} END AS "ISSN",
  dtype AS "Document Type", cited AS "Cited by", oa AS "Open Access",
  'Smith J. (' || n || '); ; Doe A. (7)' AS "Author full names", 'Smith J.; Doe A.' AS "Authors",
  CASE WHEN n % 8 = 0 THEN '' ELSE 'Univ X, ' || place END AS "Affiliations",
  CASE WHEN n % 12 <> 0 THEN '[Smith, J.; Doe, A.] Univ X, ' || place || '; [Roe, B.] x, y' END AS "Authors with affiliations",
  CASE WHEN n % 3 = 0 THEN 'Own Press' END AS "Publisher",
  lang AS "Language of Original Document", text AS "Abstract"
FROM d"""

CTES["p"] = f"""
SELECT *, n % 5 = 1 AND length(t) >= 20 AS longer, n % 5 = 3 AND instr(t, ' ') > 0 AS moved FROM (
  SELECT page_id AS n, page_id % 120 AS j, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t,
    regexp_extract(html, 'lang="([a-z]+)"', 1) AS lang, {_dirty('page_id')} FROM pages)"""

CTES["raw_b"] = f"""
SELECT n AS doc_ord,
  CASE WHEN longer THEN t || ' rev' WHEN moved THEN substr(t, instr(t, ' ') + 1) || ' ' || left(t, instr(t, ' ') - 1)
       WHEN n % 9 = 5 THEN replace(t, ' ', chr(8195)) ELSE t END AS "Article Title",
  {_year_text('n', '(2014 + length(t) % 13 + CASE WHEN longer THEN n % 4 ELSE 0 END)')} AS "Publication Year",
  CASE WHEN NOT longer AND NOT moved AND length(t) % 3 = 0 THEN ' 10.5555/' || upper(md5(t)) || chr(9) WHEN n % 2 = 0 THEN '' END AS "DOI",
  CASE WHEN n % 5 = 0 THEN 'Journal of Suplier ' || j || ' (print)' WHEN n % 5 = 2 THEN 'Supplier of Journal ' || j || ' (print)'
       ELSE 'J & Supp ' || j || ' (web)' END AS "Source Title",
  CASE WHEN n % 5 <> 0 AND n % 5 <> 2 THEN CASE WHEN n % 3 = 0 THEN '0000-0019; ' ELSE '' END
       || lower(left({_journal_issn('j')}, 4) || '-' || substr({_journal_issn('j')}, 5, 4)) END AS "ISSN",
  dtype AS "Document Type", cited AS "Cited Reference Count", oa AS "Open Access Designations",
  'Smith, J.; Doe, A.' AS "Authors", 'Smith, John; Doe, Ann' AS "Author Full Names", lang AS "Language",
  '[Smith, J.; Doe, A.] Univ Y, ' || place AS "Addresses", '' AS "Affiliations",
  'WOS:' || n AS "UT (Unique WOS ID)", url AS "DOI Link"
FROM p"""

CTES["jref"] = f"""
SELECT s_suppkey * 100 + y - 2015 AS j_ord, 'Journal of Supplier ' || s_suppkey || ' (print)' AS "Title",
  {_journal_issn('s_suppkey')} || ', ' || CAST(20000000 + s_suppkey * 7919 AS VARCHAR) AS "Issn", CAST(y AS VARCHAR) AS "Year",
  s_acctbal / 1000 AS "SJR", 'Q' || (1 + s_suppkey % 4) AS "SJR Best Quartile", CAST(s_suppkey % 97 AS INTEGER) AS "H index",
  n_name AS "Country", r_name AS "Region", s_name AS "Publisher", 'Catalysis (Q1);Optics (Q2); ' AS "Categories", 'Science' AS "Areas"
FROM (SELECT *, unnest(generate_series(2015, 2023)) AS y FROM supplier)
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

_RULE_PLACE = [f"list_extract([{_quoted(RULE_PLACES)}], (n // 12 + {k}) % {len(RULE_PLACES)} + 1)" for k in (0, 7)]
CTES["cells"] = f"""
SELECT n AS doc_ord, t AS other, CASE n % 12 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' || chr(9) || ' ' || chr(8195)
  WHEN 3 THEN 'Smith J. (' || t || '); ; Doe A. (7)' WHEN 4 THEN '[' || t || ', x] , a; [b, c' WHEN 5 THEN ' ' || t || ' ;Proceedings Paper;  Early Access '
  WHEN 6 THEN {_RULE_PLACE[0]} || ', ' || t || '; ' || {_RULE_PLACE[1]} WHEN 7 THEN '1234-567x, ' || t
  WHEN 8 THEN list_extract([{_quoted(ODD_NUMBERS)}], n // 12 % {len(ODD_NUMBERS)} + 1) WHEN 9 THEN ' ' || (n % 50) || '.0 '
  WHEN 10 THEN t || ' & (web) & more' ELSE t END AS cell
FROM (SELECT doc_id AS n, text AS t FROM documents UNION ALL SELECT page_id + 1000000000, html FROM pages)"""

CTES["lemmas"] = """
SELECT form, left(form, length(form) - 2) AS lemma FROM (
  SELECT DISTINCT unnest(string_split_regex(lower(text), '[^a-z]+')) AS form FROM documents) WHERE length(form) >= 5 AND length(form) % 3 = 0"""

CTES["src_a"] = f"""
SELECT * REPLACE ({author_names('"Author full names"')} AS "Author full names", {doi('"DOI"')} AS "DOI"),
  'Scopus' AS "Source", {title_key('"Title"')} AS title_key FROM raw_a"""

CTES["src_b"] = f"""
SELECT * REPLACE (replace("Authors", ',', '') AS "Authors", replace("Source Title", '&', 'and') AS "Source Title",
  {document_type('"Document Type"')} AS "Document Type", {doi('"DOI"')} AS "DOI"),
  'Web of science' AS "Source", replace("Authors", ',', '') AS "Author(s) ID", 'Final' AS "Publication Stage",
  {title_key('"Article Title"')} AS title_key FROM raw_b"""

for side in "ab":
    CTES[f"{side}1"] = f"""
SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY title_key ORDER BY doc_ord) AS rk FROM src_{side})
WHERE rk = 1 OR title_key = ''"""

CTES["doi_m"] = """
SELECT b1.doc_ord AS b_ord, b1.title_key, k.a_ord FROM b1
JOIN (SELECT "DOI", min(doc_ord) AS a_ord FROM a1 WHERE "DOI" <> '' GROUP BY "DOI") k ON b1."DOI" = k."DOI\""""

CTES["cand"] = f"""
SELECT doc_ord AS b_ord, title_key, {year('"Publication Year"')} AS b_year FROM b1
WHERE doc_ord NOT IN (SELECT b_ord FROM doi_m) AND (title_key = '' OR title_key NOT IN (SELECT title_key FROM doi_m))"""

_near_length = "length(a.k) * 85 <= length(b.k) * 100 AND length(b.k) * 85 <= length(a.k) * 100"


def _best(year_condition: str) -> str:
    return f"""
SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY b_ord ORDER BY score DESC, a_ord) AS rk FROM (
    SELECT b.b_ord, b.k AS title_key, b.b_year, a.a_ord, a.k AS a_key, a.a_year,
      greatest({lev('a.k', 'b.k')}, {lev('a.s', 'b.s')}) AS score, coalesce(abs(b.b_year - a.a_year) <= 1, true) AS year_ok
    FROM (SELECT b_ord, title_key AS k, {sorted_tokens('title_key')} AS s, b_year FROM cand WHERE length(title_key) >= 5) b
    JOIN (SELECT doc_ord AS a_ord, title_key AS k, {sorted_tokens('title_key')} AS s, {year('"Year"')} AS a_year FROM a1 WHERE title_key <> '') a
      ON {_near_length} AND {year_condition}))
WHERE rk = 1 AND score >= 0.85::DOUBLE"""


CTES["fuzzy"] = _best("true")
CTES["fuzzy_year_first"] = _best("coalesce(abs(b.b_year - a.a_year) <= 1, true)")

CTES["pairs"] = """
SELECT title_key, 'doi' AS match_method, a_ord, b_ord, CAST(NULL AS DOUBLE) AS score FROM doi_m
UNION ALL SELECT title_key, 'title', a_ord, b_ord, score FROM fuzzy WHERE year_ok"""

CTES["flag_a"] = """
SELECT *, CASE WHEN title_key <> '' AND title_key IN (SELECT title_key FROM pairs) THEN 1 ELSE 0 END AS "In_Both" FROM a1"""
CTES["flag_b"] = """
SELECT *, CASE WHEN doc_ord IN (SELECT b_ord FROM pairs) THEN 1 ELSE 0 END AS "In_Both" FROM b1"""

_B_COLUMNS = {
    "Publication Stage": "Publication Stage", "Authors": "Authors", "Author(s) ID": "Author(s) ID", "Source": "Source",
    "EID": "UT (Unique WOS ID)", "Document Type": "Document Type", "Language of Original Document": "Language",
    "DOI": "DOI", "Cited by": "Cited Reference Count", "Year": "Publication Year", "Source title": "Source Title",
    "Title": "Article Title", "Affiliations": "Affiliations", "ISSN": "ISSN", "Link": "DOI Link",
    "Open Access": "Open Access Designations", "Author full names": "Author Full Names",
    "Authors with affiliations": "Addresses", "title_key": "title_key", "In_Both": "In_Both",
}
assert set(_B_COLUMNS) <= set(TARGET_COLUMNS)

CTES["b_kept"] = (
    "\nSELECT doc_ord, " + ", ".join(f'"{old}" AS "{new}"' for new, old in _B_COLUMNS.items())
    + ' FROM flag_b WHERE "In_Both" = 0'
)
CTES["combined"] = "\nSELECT * FROM flag_a UNION ALL BY NAME SELECT * FROM b_kept"

CTES["jmap"] = f"""
SELECT j_issn, canon_title FROM (
  SELECT *, row_number() OVER (PARTITION BY j_issn ORDER BY j_ord) AS rk FROM (
    SELECT unnest({issns('"Issn"')}) AS j_issn, "Title" AS canon_title, j_ord FROM jref WHERE "Title" IS NOT NULL)) WHERE rk = 1"""

CTES["canon_in"] = f"""
SELECT *, lower({trim('coalesce("Source", $$unknown$$)')}) <> 'scopus' AS elig, {issn_cell('"ISSN"')} AS own_issn,
  {trim('coalesce("Source title", $$$$)')} AS own FROM combined"""

CTES["canon_best"] = f"""
SELECT own, canon_title FROM (
  SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, first_issn) AS rk FROM (
    SELECT w.own, l.canon_title, l.first_issn, {lev('w.s', 'l.s')} AS score
    FROM (SELECT DISTINCT own, {sorted_tokens('own')} AS s FROM canon_in WHERE elig AND own_issn = '' AND own <> '') w,
         (SELECT canon_title, min(j_issn) AS first_issn, {sorted_tokens('canon_title')} AS s FROM jmap GROUP BY canon_title) l))
WHERE rk = 1 AND score > 0.9::DOUBLE"""

CTES["canon_listed"] = f"""
SELECT own_issn, canon_title FROM (
  SELECT *, row_number() OVER (PARTITION BY own_issn ORDER BY list_position(string_split(own_issn, '; '), one)) AS rk FROM (
    SELECT own_issn, unnest(string_split(own_issn, '; ')) AS one FROM (SELECT DISTINCT own_issn FROM canon_in WHERE own_issn <> ''))
  JOIN jmap ON one = j_issn WHERE {trim('canon_title')} <> '') WHERE rk = 1"""

CTES["canon"] = f"""
SELECT c.* EXCLUDE (elig, own_issn, own) REPLACE (
  {journal_name("coalesce(CASE WHEN c.elig THEN m.canon_title END, CASE WHEN c.elig AND c.own_issn = '' THEN s.canon_title END, c.own)")} AS "Source title")
FROM canon_in c LEFT JOIN canon_listed m ON c.own_issn = m.own_issn LEFT JOIN canon_best s ON c.own = s.own"""

CTES["cleaned"] = f"""
SELECT * EXCLUDE (title_key) REPLACE ({year('"Year"')} AS "Year", {issn_cell('"ISSN"')} AS "ISSN",
  {affiliations(filled('"Affiliations"', '"Authors with affiliations"'))} AS "Affiliations",
  {affiliations(filled('"Authors with affiliations"', '"Affiliations"'))} AS "Authors with affiliations",
  {open_access('"Open Access"')} AS "Open Access", {cited('"Cited by"')} AS "Cited by", "Author full names" AS "Authors")
FROM canon WHERE {year('"Year"')} BETWEEN 2015 AND 2025"""

CTES["jrows"] = f"""
SELECT * REPLACE ({journal_name('"Title"')} AS "Title", {year('"Year"')} AS "Year", {categories('"Categories"')} AS "Categories"),
  unnest({issns('"Issn"')}) AS j_issn FROM jref"""

CTES["listed_issn"] = """
SELECT cell, cell_year, one FROM (
  SELECT *, row_number() OVER (PARTITION BY cell, cell_year ORDER BY list_position(string_split(cell, '; '), one)) AS rk FROM (
    SELECT cell, cell_year, unnest(string_split(cell, '; ')) AS one FROM (
      SELECT DISTINCT "ISSN" AS cell, "Year" AS cell_year FROM cleaned WHERE "ISSN" <> ''))
  WHERE (one, cell_year) IN (SELECT (j_issn, "Year") FROM jrows)) WHERE rk = 1"""

CTES["by_issn"] = """
SELECT c.*, k.* FROM cleaned c LEFT JOIN listed_issn o ON c."ISSN" = o.cell AND c."Year" = o.cell_year LEFT JOIN (
  SELECT j_issn AS journal_issn, "Year" AS jy, "SJR", "SJR Best Quartile", "H index", "Country", "Region", "Publisher" AS jpub, "Categories", "Areas"
  FROM (SELECT *, row_number() OVER (PARTITION BY j_issn, "Year" ORDER BY j_ord) AS rk FROM jrows) WHERE rk = 1) k
ON o.one = k.journal_issn AND c."Year" = k.jy"""

CTES["title_best"] = f"""
SELECT low, "Title" FROM (
  SELECT *, row_number() OVER (PARTITION BY low ORDER BY score DESC, o) AS rk FROM (
    SELECT w.low, l."Title", l.o, greatest({lev('w.low', 'l.low')}, {lev('w.s', 'l.s')}) AS score
    FROM (SELECT DISTINCT lower("Source title") AS low, {sorted_tokens('lower("Source title")')} AS s FROM by_issn
          WHERE journal_issn IS NULL AND NOT {blank('"Source title"')}) w,
         (SELECT "Title", min(j_ord) AS o, lower("Title") AS low, {sorted_tokens('lower("Title")')} AS s FROM jrows GROUP BY "Title") l))
WHERE rk = 1 AND score >= 0.9::DOUBLE"""

CTES["jtitle"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "Title", "Year" ORDER BY j_ord, j_issn) AS rk FROM jrows) WHERE rk = 1"""

_metric = ["SJR", "SJR Best Quartile", "H index", "Country", "Region", "Categories", "Areas"]
CTES["enriched"] = (
    '\nSELECT c.* EXCLUDE (jy, jpub) REPLACE (coalesce(c.journal_issn, t.j_issn) AS journal_issn, coalesce(c."Publisher", c.jpub, t."Publisher") AS "Publisher", '
    + ", ".join(f'coalesce(c."{m}", t."{m}") AS "{m}"' for m in _metric)
    + ') FROM by_issn c LEFT JOIN title_best b ON c.journal_issn IS NULL AND lower(c."Source title") = b.low '
    'LEFT JOIN jtitle t ON t."Title" = b."Title" AND t."Year" = c."Year"'
)

CTES["final"] = f"""
SELECT * EXCLUDE (rk) REPLACE ({trim('"Title"')} AS "Title") FROM (
  SELECT *, row_number() OVER (PARTITION BY {trim('"Title"')}, "Year" ORDER BY ("Source" = 'Web of science'), doc_ord) AS rk FROM enriched)
WHERE rk = 1 OR {blank('"Title"')}"""

_ORDER = list(CTES)
_HEAVY = {"src_a", "src_b", "a1", "b1", "fuzzy", "fuzzy_year_first", "pairs", "canon", "cleaned", "by_issn", "enriched", "final", "jrows"}


def query(final: str) -> str:
    """``final`` after the CTEs it needs."""
    import re

    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in _ORDER:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b|,\s*{name}\b", sql):
                needed.add(name)
                visit(CTES[name])

    visit(final)
    parts = [
        f"{n} AS {'MATERIALIZED' if n in _HEAVY else 'NOT MATERIALIZED'} ({CTES[n]})" for n in _ORDER if n in needed
    ]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final
