"""Report tables: counts, shares, per-year and per-type summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import DEFAULTS, Settings
from ..functions import text


def _per_year(a: DataFrame, b: DataFrame, a_value, b_value, names: Sequence[str], settings: Settings) -> DataFrame:
    """One aggregation over both sources instead of two and a full outer join."""
    zero = F.lit(0).cast("long")
    a_rows = a.select(text.year(F.col("Year")).alias("Year"), zero.alias("b"), a_value.alias("a"))
    b_rows = b.select(text.year(F.col("Publication Year")).alias("Year"), b_value.alias("b"), zero.alias("a"))
    return (
        a_rows.unionByName(b_rows)
        .where(F.col("Year").between(settings.year_start, settings.year_end))
        .groupBy("Year")
        .agg(F.sum("b").alias(names[0]), F.sum("a").alias(names[1]))
        .withColumn(names[2], F.col(names[0]) + F.col(names[1]))
        .orderBy("Year")
    )


def raw_counts_by_year(a: DataFrame, b: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    one = F.lit(1).cast("long")
    return _per_year(a, b, one, one, ("WoS", "Scopus", "Total Articles Raw"), settings)


def raw_citations_by_year(a: DataFrame, b: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    def cites(df: DataFrame, column: str):
        return text.cited_by(F.col(f"`{column}`")) if column in df.columns else F.lit(0).cast("long")

    names = ("WoS Citations", "Scopus Citations", "Total Citations Raw")
    return _per_year(a, b, cites(a, "Cited by"), cites(b, "Cited Reference Count"), names, settings)


def doc_types_by_year(records: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return (
        records.select(text.year(F.col("Year")).alias("Year"), F.explode(text.document_types(F.col("Document Type"))).alias("Document Type"))
        .where(F.col("Year").between(settings.year_start, settings.year_end))
        .groupBy("Year", "Document Type")
        .agg(F.count(F.lit(1)).alias("documents"))
    )


def doc_types_by_year_map(records: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """``Year, documents``: a map from each document type of the year to its count, whatever the number of types."""
    counted = doc_types_by_year(records, settings)
    entries = F.array_sort(F.collect_list(F.struct("Document Type", "documents")))
    return counted.groupBy("Year").agg(F.map_from_entries(entries).alias("documents")).orderBy("Year")


def doc_types_pivot(records: DataFrame, types: Sequence[str], settings: Settings = DEFAULTS) -> DataFrame:
    """Years by the given document types, 0 where a type is missing. Nothing is collected to plan it."""
    by_year = doc_types_by_year_map(records, settings)
    cells = [F.coalesce(F.try_element_at("documents", F.lit(t)), F.lit(0).cast("long")).alias(t) for t in types]
    return by_year.select("Year", *cells)


_PARTS = ("loaded_a", "loaded_b", "final_a", "kept_b", "final_total", "duplicates")


def counts_of(raw_a, raw_b, a, kept_b, combined, titles) -> DataFrame:
    """One row with every count: each frame is aggregated to one row first."""
    rows = None
    for name, df in zip(_PARTS, (raw_a, raw_b, a, kept_b, combined, titles)):
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
        rows = row if rows is None else rows.unionByName(row)
    return rows.agg(*[F.max(F.when(F.col("part") == p, F.col("n"))).alias(p) for p in _PARTS])


def known_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """The same row from counts that were taken while the tables were written."""
    return spark.range(1).select(*[F.lit(counts[p]).cast("long").alias(p) for p in _PARTS])


def _derived(counts: DataFrame) -> DataFrame:
    total = F.col("loaded_a") + F.col("loaded_b")
    return counts.withColumns(
        {
            "loaded": total,
            "removed_a": F.col("loaded_a") - F.col("final_a"),
            "removed_b": F.col("loaded_b") - F.col("kept_b"),
        }
    )


def stats_summary(counts: DataFrame) -> DataFrame:
    """``Metric, Value``: 18 rows describing the run. The metrics' names are fixed values."""
    col, share = F.col, text.percentage
    values = [
        ("Loaded papers", col("loaded")),
        ("Omitted papers by document type", F.lit(0)),
        ("Total after omission", col("loaded")),
        ("Loaded WoS", col("loaded_b")),
        ("Loaded WoS (%)", share(col("loaded_b"), col("loaded"))),
        ("Loaded Scopus", col("loaded_a")),
        ("Loaded Scopus (%)", share(col("loaded_a"), col("loaded"))),
        ("Duplicated papers found", col("duplicates")),
        ("Duplicated papers found (%)", share(col("duplicates"), col("loaded"))),
        ("Removed duplicated WoS", col("removed_b")),
        ("Removed duplicated WoS (%)", share(col("removed_b"), col("loaded_b"))),
        ("Removed duplicated Scopus", col("removed_a")),
        ("Removed duplicated Scopus (%)", share(col("removed_a"), col("loaded_a"))),
        ("Total after duplicates removal", col("final_total")),
        ("Final WoS", col("kept_b")),
        ("Final WoS (%)", share(col("kept_b"), col("final_total"))),
        ("Final Scopus", col("final_a")),
        ("Final Scopus (%)", share(col("final_a"), col("final_total"))),
    ]
    rows = [F.struct(F.lit(m).alias("Metric"), v.cast("double").alias("Value")) for m, v in values]
    return _derived(counts).select(F.inline(F.array(*rows)))


def dedup_distribution(counts: DataFrame) -> DataFrame:
    """Kept and removed records per source, the larger source first."""
    rows = [
        F.struct(F.lit(name).alias("Source"), F.col(kept).alias("Kept"), F.col(removed).alias("Removed"))
        for name, kept, removed in (("WoS", "kept_b", "removed_b"), ("Scopus", "final_a", "removed_a"))
    ]
    total = F.col("Kept") + F.col("Removed")
    return (
        _derived(counts)
        .select(F.inline(F.array(*rows)))
        .withColumn("Total", total)
        .withColumn("Kept (%)", text.percentage(F.col("Kept"), F.col("Total")))
        .withColumn("Removed (%)", text.percentage(F.col("Removed"), F.col("Total")))
        .orderBy(F.desc("Total"))
    )
