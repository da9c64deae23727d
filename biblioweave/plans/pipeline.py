"""The whole consolidation run: two sources and a journal list in, clean data and reports out.

Everything that is decided about a record (duplicates, flags, journal name and metrics, the final exact dedup) depends on a few
narrow columns. So the records are cleaned and stored once, the decisions are made on narrow tables, and the
whole records meet their decision in a single join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..config import DEFAULTS, Settings
from ..functions import text
from ..operators import align, dedup, journals as journal_ops
from ..operators.durable import counted, durable
from . import reports

# Columns of each source that decisions and reports need.
_NARROW_A = ("doc_ord", "Title", "Year", "DOI", "Source", "Source title", "ISSN", "Cited by", "title_key")
_NARROW_B = (
    "doc_ord", "Article Title", "Publication Year", "DOI", "Source", "Source Title", "ISSN", "Cited Reference Count", "title_key",
)
_ROW = ["_origin", "doc_ord"]
# Decisions of so many records may be broadcast; of more, both sides are shuffled. Their files, compressed, do not tell their size.
_BROADCAST_DECISIONS = 20_000


@dataclass(frozen=True)
class Sources:
    """Cleaned sources: whole records, and the narrow columns of those that are left after the duplicates inside each are gone."""

    records_a: DataFrame | None
    records_b: DataFrame | None
    a: DataFrame | None
    b: DataFrame | None
    counts: dict[str, Callable[[], dict[str, int]]] = field(default_factory=dict)


@dataclass(frozen=True)
class Result:
    records: DataFrame
    duplicate_titles: DataFrame
    duplicate_pairs: DataFrame
    reports: dict[str, DataFrame]


_PAIR_SCHEMA = "title_key string, match_method string, a_ord long, b_ord long, score double"


def read_sources(
    raw_a: DataFrame | None, raw_b: DataFrame | None, settings: Settings = DEFAULTS, stable: bool = False
) -> Sources:
    """Clean both sources and keep the first record of every title.

    The records are read twice: a few columns for the decisions, and whole at the end. Scans of exports number their records
    while reading, so the cleaned records are written once, without a shuffle. ``stable`` inputs give
    every record the same ``doc_ord`` at each reading (tables that hold it) and are read again instead. ``counts`` has
    the rows of each table, counted as it was written.
    """
    counts = {}

    def stored(df: DataFrame, name: str) -> DataFrame:
        table, counts[name] = counted(df, name)
        return table

    def narrow(records: DataFrame | None, columns: tuple[str, ...], side: str) -> tuple[DataFrame | None, DataFrame | None]:
        if records is None:
            return None, None
        if not stable:
            records = stored(records, f"loaded_{side}")
        few = records.select(*[F.col(f"`{c}`") for c in columns if c in records.columns])
        if stable:
            few = stored(few, f"loaded_{side}")
        return records, stored(dedup.first_per_title(few), f"final_{side}")

    records_a, a = narrow(align.prepare_a(raw_a, settings) if raw_a is not None else None, _NARROW_A, "a")
    records_b, b = narrow(align.prepare_b(raw_b, settings) if raw_b is not None else None, _NARROW_B, "b")
    return Sources(records_a, records_b, a, b, counts)


def match_sources(sources: Sources, settings: Settings = DEFAULTS) -> DataFrame:
    """The pair table: every record of the second source that the first has too."""
    if sources.a is None or sources.b is None:
        spark = (sources.a if sources.a is not None else sources.b).sparkSession
        return spark.createDataFrame([], _PAIR_SCHEMA)
    named = F.col("title_key") != ""
    pairs, sources.counts["pairs"] = counted(dedup.duplicate_pairs(sources.a, sources.b, settings), "pairs", titles=named)
    return pairs


def kept_of_b(sources: Sources, pairs: DataFrame) -> DataFrame | None:
    """The narrow columns of the second source's records that stay."""
    return None if sources.b is None else align.kept_records(dedup.flag_records(sources.b, pairs))


def flagged(sources: Sources, pairs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The narrow columns of all kept records with ``In_Both``, in the first source's names; a row is (``_origin``, ``doc_ord``)."""
    a, kept = sources.a, kept_of_b(sources, pairs)
    first = None if a is None else dedup.flag_titles(a, dedup.duplicate_titles(pairs)).withColumn("_origin", F.lit(0))
    second = None if kept is None else align.b_in_a_schema(kept, settings).withColumn("_origin", F.lit(1))
    return align.union_sources(first, second)


def whole_records(sources: Sources, settings: Settings = DEFAULTS) -> DataFrame:
    """All cleaned records of both sources in one schema, duplicates included; a row is (``_origin``, ``doc_ord``)."""
    a, b = sources.records_a, sources.records_b
    first = None if a is None else a.withColumn("_origin", F.lit(0))
    second = None if b is None else align.b_in_a_schema(b, settings).withColumn("_origin", F.lit(1))
    return align.union_sources(first, second)


def with_decisions(records: DataFrame, decided: DataFrame) -> DataFrame:
    """The decided records, each with the columns of its decision in place of its own: the one join that moves whole records."""
    changed = [c for c in decided.columns if c not in _ROW]
    own = [c for c in records.columns if c not in changed]
    return records.select(*[F.col(f"`{c}`") for c in own]).join(decided, _ROW).select(
        *[F.col(f"`{c}`") for c in [*records.columns, *[c for c in changed if c not in records.columns]]]
    )


def combine(sources: Sources, pairs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Flagged records of both sources in one schema."""
    marks = flagged(sources, pairs, settings).select(*_ROW, "In_Both")
    return with_decisions(whole_records(sources, settings), marks).drop("_origin")


def decide(
    sources: Sources, pairs: DataFrame, journals: DataFrame | None, settings: Settings = DEFAULTS, unique: bool = True
) -> DataFrame:
    """Which records stay, and what replaces their columns: flag, journal name, and the journal row ``j`` of their metrics.

    With ``unique`` only the first record of every title and year stays. Nothing after that depends on other records, so it
    comes before the journals are looked up.
    """
    rows = flagged(sources, pairs, settings)
    if "Year" in rows.columns:
        rows = rows.withColumn("Year", text.year(F.col("Year")))
        rows = rows.where(F.col("Year").between(settings.year_start, settings.year_end))
    if unique:
        rows = dedup.first_per_title_and_year(rows, _ROW)
    if journals is None:
        return rows.select(*_ROW, "In_Both")
    rows = journal_ops.canonical_titles(durable(rows, "flagged"), journals, settings)
    changed = ["In_Both", *[c for c in ("Source", "Source title") if c in rows.columns]]
    if not {"ISSN", "Year", "Source title"} <= set(rows.columns):
        return rows.select(*_ROW, *changed)
    rows = rows.withColumn("ISSN", text.issn_cell(F.col("ISSN")))
    rows = durable(rows.select(*dict.fromkeys([*_ROW, *changed, "ISSN", "Year"])), "named")
    return journal_ops.with_metrics(rows, journal_ops.journal_rows(rows, journals, settings)).select(*_ROW, *changed, "j")


def clean(records: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Cleaned columns, and gaps of the metric columns filled from the journal row ``j`` where there is one."""
    cleaned = align.clean_combined(records, settings).drop("_origin")
    if "j" not in cleaned.columns:
        return cleaned
    return journal_ops.unpack_metrics(cleaned, [c for c in cleaned.columns if c != "j"])


def assemble(sources: Sources, decisions: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The clean records that ``decisions`` keeps. The decisions are stored, and counted on the way."""
    decided, seen = counted(decisions, "decisions")
    if seen()["rows"] > _BROADCAST_DECISIONS:
        decided = decided.hint("merge")
    return clean(with_decisions(whole_records(sources, settings), decided), settings)


def consolidate(
    raw_a: DataFrame | None,
    raw_b: DataFrame | None,
    journals: DataFrame | None = None,
    settings: Settings = DEFAULTS,
    stable: bool = False,
) -> tuple[Sources, DataFrame, DataFrame]:
    """The cleaned sources, the pair table and the clean records."""
    if raw_a is None and raw_b is None:
        raise ValueError("there is no source to read")
    sources = read_sources(raw_a, raw_b, settings, stable)
    pairs = match_sources(sources, settings)
    decisions = decide(sources, pairs, journals, settings)
    return sources, pairs, assemble(sources, decisions, settings).withColumn("Title", text.ws_trim(F.col("Title")))


def run(
    raw_a: DataFrame | None,
    raw_b: DataFrame | None,
    journals: DataFrame | None = None,
    settings: Settings = DEFAULTS,
    stable: bool = False,
) -> Result:
    """``raw_a`` and ``raw_b`` carry ``doc_ord``, ``journals`` carries ``j_ord`` (their input order)."""
    sources, pairs, records = consolidate(raw_a, raw_b, journals, settings, stable)
    records, sources.counts["final_total"] = counted(records, "clean")
    tables = report_tables(sources, records, settings)
    return Result(records, dedup.duplicate_titles(pairs), pairs, tables)


def run_counts(counts: dict[str, Callable[[], dict[str, int]]]) -> dict[str, int]:
    """The numbers of the run from what was counted while its tables were written.

    A record of the second source has one partner at most, and its title key is its own unless it is blank.
    """
    rows = {name: seen() for name, seen in counts.items()}
    number = lambda name: rows.get(name, {}).get("rows", 0)
    pairs, titles = number("pairs"), rows.get("pairs", {}).get("titles", 0)
    return {
        "loaded_a": number("loaded_a"), "loaded_b": number("loaded_b"), "final_a": number("final_a"),
        "kept_b": number("final_b") - pairs, "final_total": number("final_total"), "duplicates": titles + (pairs > titles),
    }


def report_tables(sources: Sources, records: DataFrame, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """The report tables of a run whose tables are all written."""
    spark = records.sparkSession
    counts = reports.known_counts(spark, run_counts(sources.counts))
    no_a = spark.createDataFrame([], "`Year` string, `Cited by` string")
    no_b = spark.createDataFrame([], "`Publication Year` string, `Cited Reference Count` string")
    a = sources.a if sources.a is not None and "Year" in sources.a.columns else no_a
    b = sources.b if sources.b is not None else no_b
    tables = {
        "stats_summary": reports.stats_summary(counts),
        "dedup_distribution": reports.dedup_distribution(counts),
        "raw_counts_by_year": reports.raw_counts_by_year(a, b, settings),
        "raw_citations_by_year": reports.raw_citations_by_year(a, b, settings),
    }
    if {"Year", "Document Type"} <= set(records.columns):
        tables["doc_types_by_year"] = reports.doc_types_by_year(records, settings)
        tables["doc_types_pivot"] = reports.doc_types_pivot(records, settings.document_types, settings)
    return tables
