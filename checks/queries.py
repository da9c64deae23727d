"""Registered queries: one per operator, each with the same result in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from biblioweave.config import DEFAULTS, Settings
from biblioweave.functions import similarity, text
from biblioweave.operators import align, dedup, fuzzy, journals, lemmas
from biblioweave.operators.durable import durable, file_system, run_folder, shared_folder
from biblioweave.plans import pipeline, reports
from biblioweave.sources import exports, sinks, workbooks

from . import sql, tables
from .workbook_bytes import workbook

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(oracle: str | None):
    def add(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = sql.query(oracle)
        return function

    return add


def _a(spark, sf):
    return align.prepare_a(tables.source_a(spark, sf))


def _b(spark, sf):
    return align.prepare_b(tables.source_b(spark, sf))


def _a1(spark, sf):
    return dedup.first_per_title(_a(spark, sf))


def _b1(spark, sf):
    return dedup.first_per_title(_b(spark, sf))


def _sources(spark, sf):
    return pipeline.read_sources(tables.source_a(spark, sf), tables.source_b(spark, sf), stable=True)


def _combined(spark, sf):
    sources = _sources(spark, sf)
    return pipeline.combine(sources, pipeline.match_sources(sources))


def _cleaned(spark, sf):
    combined = journals.canonical_titles(_combined(spark, sf), tables.journal_reference(spark, sf))
    return align.clean_combined(combined)


def _column(name: str, frame: Callable, source: str, column: str, change: Callable, oracle: str) -> None:
    """Register one column expression over all records of a source."""

    def run(spark, sf):
        return frame(spark, sf).select("doc_ord", change(F.col(f"`{column}`")).alias("value"))

    run.__name__ = name
    register(f"SELECT doc_ord, {oracle} AS value FROM {source}")(run)


@register(f"""SELECT doc_ord, {sql.title_key('"Title"')} AS title_key FROM raw_a""")
def title_key(spark, sf):
    return tables.source_a(spark, sf).select("doc_ord", text.title_key("Title").alias("title_key"))


@register(f"""SELECT doc_ord, {sql.title_key('"Article Title"')} AS title_key FROM raw_b""")
def title_key_b(spark, sf):
    return tables.source_b(spark, sf).select("doc_ord", text.title_key("Article Title").alias("title_key"))


@register(
    f"""SELECT doc_ord, coalesce(title_key, '') AS title_key FROM raw_a LEFT JOIN (
    SELECT doc_ord, string_agg(lemma, ' ' ORDER BY place) AS title_key FROM (
      SELECT doc_ord, place, coalesce(lemma, {sql.lemma('token')}) AS lemma FROM (
        SELECT doc_ord, unnest(tokens) AS token, unnest(range(len(tokens))) AS place FROM (
          SELECT doc_ord, {sql.title_tokens('"Title"')} AS tokens FROM raw_a)) LEFT JOIN lemmas ON token = form)
    WHERE lemma NOT IN ({sql.STOPS}) GROUP BY doc_ord) USING (doc_ord)"""
)
def title_key_lemma(spark, sf):
    """Title keys whose lemmas come from a dictionary table, joined by token."""
    titles = tables.source_a(spark, sf).select("doc_ord", "Title")
    return lemmas.with_title_key(titles, "Title", tables.lemma_dictionary(spark, sf)).select("doc_ord", "title_key")


_column("author_names_clean", tables.source_a, "raw_a", "Author full names", text.author_names, sql.author_names('"Author full names"'))
_column("doc_type_norm", tables.source_b, "raw_b", "Document Type", text.document_type, sql.document_type('"Document Type"'))
_column("doi_norm", tables.source_b, "raw_b", "DOI", text.doi, sql.doi('"DOI"'))
_column("authors_without_commas", tables.source_b, "raw_b", "Authors", text.without_commas, """replace("Authors", ',', '')""")
_column("journal_ampersand", tables.source_b, "raw_b", "Source Title", text.ampersand_to_and, """replace("Source Title", '&', 'and')""")
_column("year_coerced", tables.source_a, "raw_a", "Year", text.year, sql.year('"Year"'))
_column("cited_by_int", tables.source_a, "raw_a", "Cited by", text.cited_by, sql.cited('"Cited by"'))
_column("issn_clean", tables.source_b, "raw_b", "ISSN", text.issn, sql.issn('"ISSN"'))
_column("open_access_default", tables.source_a, "raw_a", "Open Access", text.open_access, sql.open_access('"Open Access"'))
_column("bracket_commas", tables.source_a, "raw_a", "Authors with affiliations", text.bracket_commas, sql.bracket_commas('"Authors with affiliations"'))
_column("country_norm", tables.source_a, "raw_a", "Affiliations", text.countries, sql.countries('"Affiliations"'))
_column("journal_name_strip", tables.source_b, "raw_b", "Source Title", text.journal_name, sql.journal_name('"Source Title"'))
_column("safe_text", tables.source_a, "raw_a", "Title", text.safe_text, """coalesce("Title", '')""")
_column("blank_test", tables.source_a, "raw_a", "Open Access", text.is_blank, sql.blank('"Open Access"'))
_column("token_sorted_title", _a, "src_a", "title_key", similarity.sorted_tokens, sql.sorted_tokens("title_key"))


@register(
    f"""SELECT doc_ord, {sql.filled('"Affiliations"', '"Authors with affiliations"')} AS affiliations,
    {sql.filled('"Authors with affiliations"', '"Affiliations"')} AS authors_with FROM raw_a"""
)
def affiliation_fill(spark, sf):
    one, two = F.col("Affiliations"), F.col("Authors with affiliations")
    return tables.source_a(spark, sf).select(
        "doc_ord", text.filled_from(one, two).alias("affiliations"), text.filled_from(two, one).alias("authors_with")
    )


# The cleaning rules over whole given texts, with edge cases among them.
for _name, _change, _oracle in (
    ("texts_author_names", text.author_names, sql.author_names("cell")),
    ("texts_document_type", text.document_type, sql.document_type("cell")),
    ("texts_without_commas", text.without_commas, "replace(cell, ',', '')"),
    ("texts_ampersand", text.ampersand_to_and, "replace(cell, '&', 'and')"),
    ("texts_year", text.year, sql.year("cell")),
    ("texts_cited_by", text.cited_by, sql.cited("cell")),
    ("texts_issn", text.issn, sql.issn("cell")),
    ("texts_open_access", text.open_access, sql.open_access("cell")),
    ("texts_bracket_commas", text.bracket_commas, sql.bracket_commas("cell")),
    ("texts_countries", text.countries, sql.countries("cell")),
    ("texts_journal_name", text.journal_name, sql.journal_name("cell")),
    ("texts_blank", text.is_blank, sql.blank("cell")),
    ("texts_categories", text.categories, sql.categories("cell")),
):
    _column(_name, tables.given_cells, "cells", "cell", _change, _oracle)


@register(f"SELECT doc_ord, {sql.filled('cell', 'other')} AS one, {sql.filled('other', 'cell')} AS two FROM cells")
def texts_filled(spark, sf):
    one, two = F.col("cell"), F.col("other")
    return tables.given_cells(spark, sf).select("doc_ord", text.filled_from(one, two).alias("one"), text.filled_from(two, one).alias("two"))


@register(
    f"""SELECT doc_ord, unnest(list_filter(list_transform(string_split(cell, ';'), lambda p: {sql.trim('p')}), lambda p: p <> '')) AS one_type
    FROM cells"""
)
def texts_document_types(spark, sf):
    return tables.given_cells(spark, sf).select("doc_ord", F.explode(text.document_types(F.col("cell"))).alias("one_type"))


@register("""SELECT doc_ord, coalesce("Source", 'unknown') AS "Source" FROM (
    SELECT doc_ord, CASE WHEN doc_ord % 3 = 0 THEN NULL WHEN doc_ord % 3 = 1 THEN 'Scopus' ELSE 'Web of science' END AS "Source" FROM raw_b)""")
def unknown_source(spark, sf):
    """Records whose source is not told pass the journal names as the source ``unknown``."""
    source = F.expr("CASE WHEN doc_ord % 3 = 0 THEN NULL WHEN doc_ord % 3 = 1 THEN 'Scopus' ELSE 'Web of science' END")
    rows = tables.source_b(spark, sf).select("doc_ord", source.alias("Source"), F.col("Source Title").alias("Source title"), "ISSN")
    return journals.canonical_titles(rows, tables.journal_reference(spark, sf)).select("doc_ord", "Source")


@register(f"""SELECT j_ord, {sql.categories('"Categories"')} AS value FROM jref""")
def categories_clean(spark, sf):
    return tables.journal_reference(spark, sf).select("j_ord", text.categories(F.col("Categories")).alias("value"))


@register(f"""SELECT j_ord, unnest({sql.issns('"Issn"')}) AS one_issn FROM jref""")
def issn_expansion(spark, sf):
    return tables.journal_reference(spark, sf).select("j_ord", F.explode(text.issn_list(F.col("Issn"))).alias("one_issn"))


@register(
    f"""SELECT doc_ord, unnest(list_filter(list_transform(string_split("Document Type", ';'), lambda p: {sql.trim('p')}),
    lambda p: p <> '')) AS one_type FROM raw_a"""
)
def document_type_expansion(spark, sf):
    return tables.source_a(spark, sf).select(
        "doc_ord", F.explode(text.document_types(F.col("Document Type"))).alias("one_type")
    )


@register(
    """SELECT 'Scopus' AS "Source", count(*) AS records, count(*) FILTER (coalesce("Title", '') = '') AS blank_titles FROM raw_a
    UNION ALL SELECT 'Web of science', count(*), count(*) FILTER (coalesce("Article Title", '') = '') FROM raw_b"""
)
def source_inventory(spark, sf):
    rows = _a(spark, sf).select("Source", F.col("Title").alias("t")).unionByName(
        _b(spark, sf).select("Source", F.col("Article Title").alias("t"))
    )
    return rows.groupBy("Source").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.coalesce("t", F.lit("")) == "").alias("blank_titles")
    )


@register("SELECT * FROM src_a")
def prepared_a(spark, sf):
    return _a(spark, sf)


@register("SELECT * FROM src_b")
def prepared_b(spark, sf):
    return _b(spark, sf)


@register("SELECT * FROM a1")
def dedup_within_a(spark, sf):
    return dedup.first_whole(_a(spark, sf))


@register("SELECT * FROM b1")
def dedup_within_b(spark, sf):
    return dedup.first_whole(_b(spark, sf))


@register("SELECT * FROM doi_m")
def doi_matches(spark, sf):
    return dedup.doi_matches(dedup.doi_lookup(_a1(spark, sf), _b1(spark, sf)))


@register("SELECT * FROM b1 WHERE doc_ord IN (SELECT b_ord FROM doi_m)")
def doi_semi_join(spark, sf):
    matched = dedup.doi_matches(dedup.doi_lookup(_a1(spark, sf), _b1(spark, sf)))
    return _b(spark, sf).join(matched.select(F.col("b_ord").alias("doc_ord")), "doc_ord", "left_semi")


@register("SELECT * FROM cand")
def fuzzy_candidates_left(spark, sf):
    return dedup.fuzzy_candidates(dedup.doi_lookup(_a1(spark, sf), _b1(spark, sf)))


def _fuzzy(spark, sf, settings: Settings = DEFAULTS):
    sources = _sources(spark, sf)
    return dedup.fuzzy_matches(sources.a, dedup.fuzzy_candidates(dedup.doi_lookup(sources.a, sources.b)), settings)


@register("SELECT * EXCLUDE (a_key) FROM fuzzy")
def fuzzy_best_match(spark, sf):
    return _fuzzy(spark, sf)


@register("SELECT b_ord, a_ord, b_year, a_year, score FROM fuzzy WHERE year_ok")
def fuzzy_year_pairs(spark, sf):
    return _fuzzy(spark, sf).where("year_ok").select("b_ord", "a_ord", "b_year", "a_year", "score")


@register("SELECT * EXCLUDE (a_key) FROM fuzzy_year_first")
def fuzzy_year_first(spark, sf):
    return _fuzzy(spark, sf, Settings(year_first=True))


@register(None)
def fuzzy_wratio(spark, sf):
    """The best title by the weighted ratio; SQL has no common subsequences, so tests hold it against a plain programme."""
    sources = _sources(spark, sf)
    asked = durable(
        dedup.fuzzy_candidates(dedup.doi_lookup(sources.a, sources.b)).where(F.length("title_key") >= DEFAULTS.min_title_length)
        .select("b_ord", "title_key"), "queries",
    )
    choices = sources.a.where("title_key <> ''").select(F.col("doc_ord").alias("a_ord"), F.col("title_key").alias("a_key"))
    return fuzzy.best_weighted(asked, choices, "b_ord", "title_key", "a_ord", "a_key", DEFAULTS.title_threshold)


@register("SELECT * FROM pairs")
def duplicate_pairs(spark, sf):
    return pipeline.match_sources(_sources(spark, sf))


@register("SELECT DISTINCT title_key FROM pairs ORDER BY title_key")
def duplicate_titles(spark, sf):
    return dedup.duplicate_titles(pipeline.match_sources(_sources(spark, sf))).orderBy("title_key")


@register("SELECT count(DISTINCT title_key) AS duplicate_titles FROM pairs")
def duplicate_title_count(spark, sf):
    return pipeline.match_sources(_sources(spark, sf)).agg(F.countDistinct("title_key").alias("duplicate_titles"))


@register(
    """SELECT "Source", doc_ord, title_key, "In_Both" FROM flag_a
    UNION ALL SELECT "Source", doc_ord, title_key, "In_Both" FROM flag_b"""
)
def in_both_flags(spark, sf):
    sources = _sources(spark, sf)
    pairs = pipeline.match_sources(sources)
    flags = ["Source", "doc_ord", "title_key", "In_Both"]
    return dedup.flag_titles(sources.a, dedup.duplicate_titles(pairs)).select(*flags).unionByName(
        dedup.flag_records(sources.b, pairs).select(*flags)
    )


@register("SELECT * FROM b_kept")
def b_to_a_schema(spark, sf):
    sources = _sources(spark, sf)
    marks = pipeline.flagged(sources, pipeline.match_sources(sources)).where("_origin = 1").select("doc_ord", "In_Both")
    return align.b_in_a_schema(sources.records_b.join(marks, "doc_ord"))


@register("SELECT * FROM combined")
def union_sources(spark, sf):
    return _combined(spark, sf)


@register(
    """SELECT "Source", "Year", count(*) AS records FROM (SELECT "Source", """
    + sql.year('"Year"')
    + """ AS "Year" FROM combined) WHERE "Year" BETWEEN 2015 AND 2025 GROUP BY ALL"""
)
def records_per_source_and_year(spark, sf):
    """Flagship: both sources deduplicated, united and counted."""
    sources = _sources(spark, sf)
    records = pipeline.flagged(sources, pipeline.match_sources(sources)).select("Source", text.year(F.col("Year")).alias("Year"))
    return (
        records.where(F.col("Year").between(DEFAULTS.year_start, DEFAULTS.year_end))
        .groupBy("Source", "Year")
        .agg(F.count(F.lit(1)).alias("records"))
    )


@register("SELECT j_issn, canon_title FROM jmap")
def issn_title_map(spark, sf):
    return journals.issn_title_map(tables.journal_reference(spark, sf))


@register('SELECT "Source", doc_ord, "Source title" FROM canon')
def canonical_titles(spark, sf):
    sources = _sources(spark, sf)
    rows = durable(pipeline.flagged(sources, pipeline.match_sources(sources)), "flagged")
    return journals.canonical_titles(rows, tables.journal_reference(spark, sf)).select("Source", "doc_ord", "Source title")


@register("SELECT * FROM cleaned")
def cleaned_records(spark, sf):
    return _cleaned(spark, sf)


@register('SELECT "Source", doc_ord, "Year", journal_issn, "SJR", "Areas" FROM by_issn')
def journal_metrics_issn_year(spark, sf):
    records = durable(_cleaned(spark, sf), "records")
    keys = journals.metrics_by_issn(journals.journal_keys(records), tables.journal_reference(spark, sf))
    return journals.with_metrics(records, keys).select(
        "Source", "doc_ord", "Year", "j.journal_issn", "j.SJR", "j.Areas"
    )


@register(
    """SELECT c."Source", c.doc_ord, c."Year", t.j_issn AS journal_issn, t."SJR" FROM by_issn c
    JOIN title_best b ON c.journal_issn IS NULL AND lower(c."Source title") = b.low
    JOIN jtitle t ON t."Title" = b."Title" AND t."Year" = c."Year\""""
)
def journal_metrics_title_fallback(spark, sf):
    reference = tables.journal_reference(spark, sf)
    records = durable(_cleaned(spark, sf), "records")
    keys = durable(journals.metrics_by_issn(journals.journal_keys(records), reference).where("j IS NULL"), "keys")
    filled = journals.metrics_by_title(keys, reference).where("j IS NOT NULL")
    return journals.with_metrics(records, filled).where("j IS NOT NULL").select(
        "Source", "doc_ord", "Year", "j.journal_issn", "j.SJR"
    )


@register("SELECT * FROM enriched")
def enriched_records(spark, sf):
    sources = _sources(spark, sf)
    return pipeline.assemble(
        sources, pipeline.decide(sources, pipeline.match_sources(sources), tables.journal_reference(spark, sf), unique=False)
    )


@register(
    f"""SELECT * EXCLUDE (rk) FROM (SELECT doc_ord, {sql.trim('"Title"')} AS "Title", {sql.year('"Year"')} AS "Year", "Source",
    row_number() OVER (PARTITION BY {sql.trim('"Title"')}, {sql.year('"Year"')} ORDER BY ("Source" = 'Web of science'), doc_ord) AS rk
    FROM (SELECT doc_ord, "Title", "Year", "Source" FROM src_a UNION ALL
          SELECT doc_ord, "Article Title", "Publication Year", "Source" FROM src_b)) WHERE rk = 1 OR coalesce("Title", '') = ''"""
)
def final_title_year_dedup(spark, sf):
    names = ["doc_ord", "Title", "Year", "Source"]
    rows = _a(spark, sf).select(*names).unionByName(align.b_in_a_schema(_b(spark, sf)).select(*names))
    return dedup.first_per_title_and_year(rows)


@register("SELECT * FROM final")
def clean_records(spark, sf):
    """The whole consolidation run."""
    return pipeline.consolidate(
        tables.source_a(spark, sf), tables.source_b(spark, sf), tables.journal_reference(spark, sf), stable=True
    )[2]


def _cells(names) -> str:
    """Columns as a reader returns them: text, with the usual missing-cell texts NULL."""
    tokens = sql._quoted(DEFAULTS.null_tokens)
    return ", ".join(f'CASE WHEN "{n}" NOT IN ({tokens}) THEN "{n}" END AS "{n}"' for n in names)


_A_TEXTS = [
    "Title", "Year", "DOI", "Source title", "ISSN", "Document Type", "Cited by", "Open Access", "Author full names",
    "Authors", "Affiliations", "Authors with affiliations", "Publisher", "Language of Original Document", "Abstract",
]
_B_TEXTS = [
    "Article Title", "Publication Year", "DOI", "Source Title", "ISSN", "Document Type", "Cited Reference Count",
    "Open Access Designations", "Authors", "Author Full Names", "Language", "Addresses", "Affiliations",
    "UT (Unique WOS ID)", "DOI Link",
]


@register(f"SELECT CAST(doc_ord AS VARCHAR) AS record, {_cells(_A_TEXTS)} FROM raw_a")
def csv_scan(spark, sf):
    """Source A written as CSV exports and scanned again."""
    folder = f"{shared_folder(spark)}/csv-scan-{uuid4().hex}"
    sinks.write_delimited(tables.source_a(spark, sf).withColumnRenamed("doc_ord", "record"), folder)
    return exports.read_delimited(spark, exports.list_files(spark, folder, "*.csv")).drop("doc_ord")


_GROUPS = {0: _A_TEXTS, 1: list(reversed([c for c in _A_TEXTS if c != "Publisher"])), 2: ["Title", "Year"]}


def _three_headers(spark, sf) -> str:
    """Source A in files of three headers, and a file without a line in a folder of its own."""
    folder = f"{shared_folder(spark)}/headers-{uuid4().hex}"
    rows = tables.source_a(spark, sf).withColumnRenamed("doc_ord", "record")
    for group, columns in _GROUPS.items():
        part = rows.where(F.col("record") % 3 == group).select("record", *[F.col(f"`{c}`") for c in columns])
        sinks.write_delimited(part.sortWithinPartitions("record"), f"{folder}/{group}")
    path, system = file_system(spark, f"{folder}/3/empty.csv")
    system.create(path).close()
    return folder


def _files(spark, folder: str) -> list[str]:
    return [f for group in range(4) for f in exports.list_files(spark, f"{folder}/{group}", "*.csv")]


@register(
    "\nUNION ALL ".join(
        f"""SELECT CAST(doc_ord AS VARCHAR) AS record, {group} AS header, {", ".join(f'{_cells([c])}' if c in columns else f'CAST(NULL AS VARCHAR) AS "{c}"'
        for c in ("Title", "Year", "DOI", "Publisher", "Abstract"))}, true AS in_order FROM raw_a WHERE doc_ord % 3 = {group}"""
        for group, columns in _GROUPS.items()
    )
)
def headers_scan(spark, sf):
    """Files of three headers scanned together: columns by name, absent ones null, rows in the order of their file."""
    rows = exports.read_delimited(spark, _files(spark, _three_headers(spark, sf)), file_column="file")
    before = F.lag(F.col("record").cast("long")).over(Window.partitionBy("file").orderBy("doc_ord"))
    return rows.select(
        "record", F.regexp_extract("file", "/([0-9])/[^/]*$", 1).cast("int").alias("header"), "Title", "Year", "DOI", "Publisher", "Abstract",
        F.coalesce(F.col("record").cast("long") > before, F.lit(True)).alias("in_order"),
    )


@register(
    f"""SELECT header, "column", CAST(sum(records) AS BIGINT) AS records, CAST(sum(blank_cells) AS BIGINT) AS blank_cells FROM (
    SELECT doc_ord % 3 AS header, 'Title' AS "column", 1 AS records, CASE WHEN {sql.blank('c')} THEN 1 ELSE 0 END AS blank_cells
      FROM (SELECT doc_ord, {_cells(['Title']).replace(' AS "Title"', ' AS c')} FROM raw_a)
    UNION ALL SELECT doc_ord % 3, 'DOI', 1, CASE WHEN doc_ord % 3 = 2 OR {sql.blank('c')} THEN 1 ELSE 0 END
      FROM (SELECT doc_ord, {_cells(['DOI']).replace(' AS "DOI"', ' AS c')} FROM raw_a)
    UNION ALL SELECT 3, unnest(['Title', 'DOI']), 0, 0) GROUP BY ALL"""
)
def inventory_by_file(spark, sf):
    """Records and blank cells of every file, summed over the files of one header, as file names are made up by the writer."""
    counted = exports.inventory_by_file(spark, _files(spark, _three_headers(spark, sf)), ["Title", "DOI"])
    header = F.regexp_extract("file", "/([0-9])/[^/]*$", 1).cast("long").alias("header")
    return counted.groupBy(header, "column").agg(F.sum("records").alias("records"), F.sum("blank_cells").alias("blank_cells"))


@lru_cache(maxsize=4)
def _written(spark, sf) -> str:
    """A whole run written to a folder; its intermediate tables are gone."""
    folder = f"{shared_folder(spark)}/written-{uuid4().hex}"
    with run_folder(spark):
        result = pipeline.run(
            tables.source_a(spark, sf), tables.source_b(spark, sf), tables.journal_reference(spark, sf), stable=True
        )
        sinks.write_run(result, folder)
    return folder


@register("SELECT * EXCLUDE (doc_ord) FROM final")
def written_records(spark, sf):
    return spark.read.parquet(f"{_written(spark, sf)}/records")


@register("SELECT DISTINCT title_key FROM pairs")
def written_titles(spark, sf):
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema("title_key string")
    return reader.csv(f"{_written(spark, sf)}/duplicate_titles").na.fill("")


@register(f"SELECT j_ord AS record, {_cells(['Title', 'Issn', 'Categories'])} FROM jref")
def journal_scan(spark, sf):
    """The journal list written with semicolons and scanned again, in order."""
    folder = f"{shared_folder(spark)}/journal-scan-{uuid4().hex}"
    rows = tables.journal_reference(spark, sf).withColumnRenamed("j_ord", "record").orderBy("record")
    sinks.write_delimited(rows, folder, ";")
    scanned = exports.read_journals(spark, f"{folder}/*.csv")
    return scanned.select(F.col("record").cast("long").alias("record"), "Title", "Issn", "Categories")


@register(f"SELECT doc_ord % 500 AS number, {_cells(_B_TEXTS)} FROM raw_b")
def xlsx_scan(spark, sf):
    """Source B packed into workbooks of 500 rows and decoded again."""
    rows = tables.source_b(spark, sf).withColumn("book", F.expr("doc_ord div 500"))
    books = rows.groupBy("book").applyInPandas(workbook, "path string, content binary")
    cells = workbooks.decode_workbooks(books)
    picked = [text.null_if_token(F.col("cells")[c]).alias(c) for c in _B_TEXTS]
    return cells.select("number", *picked)


@register(
    "\nUNION ALL ".join(
        f"""SELECT '{source}' AS "Source", '{c}' AS "column", count(*) AS records, count(*) FILTER ({sql.blank(f'"{c}"')}) AS blank_cells FROM {raw}"""
        for source, raw, c in (
            ("Scopus", "raw_a", "Title"), ("Web of science", "raw_b", "Article Title"),
            ("Web of science", "raw_b", "DOI"), ("Web of science", "raw_b", "Publication Year"),
        )
    )
)
def input_inventory(spark, sf):
    return exports.input_inventory(tables.source_a(spark, sf), tables.source_b(spark, sf))


def _per_year(value_a: str, value_b: str, names: tuple[str, str, str]) -> str:
    return f"""SELECT "Year", CAST(sum(b) AS BIGINT) AS "{names[0]}", CAST(sum(a) AS BIGINT) AS "{names[1]}", CAST(sum(a + b) AS BIGINT) AS "{names[2]}" FROM (
    SELECT {sql.year('"Year"')} AS "Year", 0 AS b, {value_a} AS a FROM a1
    UNION ALL SELECT {sql.year('"Publication Year"')}, {value_b}, 0 FROM b1)
    WHERE "Year" BETWEEN 2015 AND 2025 GROUP BY "Year" ORDER BY "Year\""""


@register(_per_year("1", "1", ("WoS", "Scopus", "Total Articles Raw")))
def raw_counts_by_year(spark, sf):
    return reports.raw_counts_by_year(_a1(spark, sf), _b1(spark, sf))


@register(
    _per_year(
        sql.cited('"Cited by"'), sql.cited('"Cited Reference Count"'), ("WoS Citations", "Scopus Citations", "Total Citations Raw")
    )
)
def raw_citations_by_year(spark, sf):
    return reports.raw_citations_by_year(_a1(spark, sf), _b1(spark, sf))


_TYPES = f"""SELECT "Year", unnest(list_filter(list_transform(string_split("Document Type", ';'), lambda p: {sql.trim('p')}),
    lambda p: p <> '')) AS "Document Type" FROM final"""


@register(f"""SELECT "Year", "Document Type", count(*) AS documents FROM ({_TYPES}) GROUP BY ALL""")
def doc_types_by_year(spark, sf):
    return reports.doc_types_by_year(clean_records(spark, sf))


@register(
    'SELECT "Year", '
    + ", ".join(
        f"""count(*) FILTER ("Document Type" = '{t}') AS "{t}\""""
        for t in DEFAULTS.document_types
    )
    + f' FROM ({_TYPES}) GROUP BY "Year" ORDER BY "Year"'
)
def doc_types_pivot(spark, sf):
    return reports.doc_types_pivot(clean_records(spark, sf), DEFAULTS.document_types)


_COUNTS = """(SELECT (SELECT count(*) FROM raw_a) AS la, (SELECT count(*) FROM raw_b) AS lb, (SELECT count(*) FROM a1) AS fa,
  (SELECT count(*) FROM b_kept) AS fb, (SELECT count(*) FROM final) AS total, (SELECT count(DISTINCT title_key) FROM pairs) AS dup)"""


def _stats_sql() -> str:
    rows = [
        ("Loaded papers", "la + lb"), ("Omitted papers by document type", "0"), ("Total after omission", "la + lb"),
        ("Loaded WoS", "lb"), ("Loaded WoS (%)", sql.share("lb", "(la + lb)")),
        ("Loaded Scopus", "la"), ("Loaded Scopus (%)", sql.share("la", "(la + lb)")),
        ("Duplicated papers found", "dup"), ("Duplicated papers found (%)", sql.share("dup", "(la + lb)")),
        ("Removed duplicated WoS", "lb - fb"), ("Removed duplicated WoS (%)", sql.share("(lb - fb)", "lb")),
        ("Removed duplicated Scopus", "la - fa"), ("Removed duplicated Scopus (%)", sql.share("(la - fa)", "la")),
        ("Total after duplicates removal", "total"), ("Final WoS", "fb"), ("Final WoS (%)", sql.share("fb", "total")),
        ("Final Scopus", "fa"), ("Final Scopus (%)", sql.share("fa", "total")),
    ]
    return "\nUNION ALL ".join(
        f"""SELECT '{m}' AS "Metric", CAST({v} AS DOUBLE) AS "Value" FROM {_COUNTS} AS c""" for m, v in rows
    )


@register(_stats_sql())
def stats_summary(spark, sf):
    return _reports(spark, sf)["stats_summary"]


@register(_stats_sql())
def written_reports(spark, sf):
    reader = spark.read.option("header", True).schema("Metric string, Value double")
    return reader.csv(f"{_written(spark, sf)}/report/stats_summary")


@register(
    "\nUNION ALL ".join(
        f"""SELECT '{name}' AS "Source", {kept} AS "Kept", {loaded} - {kept} AS "Removed", {loaded} AS "Total",
    {sql.share(kept, loaded)} AS "Kept (%)", {sql.share(f'({loaded} - {kept})', loaded)} AS "Removed (%)" FROM {_COUNTS} AS c"""
        for name, kept, loaded in (("WoS", "fb", "lb"), ("Scopus", "fa", "la"))
    )
)
def dedup_distribution(spark, sf):
    return _reports(spark, sf)["dedup_distribution"]


def _reports(spark, sf):
    return pipeline.run(
        tables.source_a(spark, sf), tables.source_b(spark, sf), tables.journal_reference(spark, sf), stable=True
    ).reports
