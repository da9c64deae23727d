"""Duplicates inside a source, identifier matches between sources, flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..config import DEFAULTS, Settings
from ..functions import text
from .durable import durable
from .fuzzy import best_match
from .skew import spread_join


def _first(df: DataFrame, keys, order) -> DataFrame:
    # The optimizer keeps one row per key and map task before the shuffle
    # (WindowGroupLimit), so copies of one key never meet in one task.
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def _hash(c):
    return F.unhex(F.md5(c))


def first_per_title(keys: DataFrame) -> DataFrame:
    """Keep the first record of every title key; blank keys are never equal.

    The rows themselves are shuffled, so pass the few columns that are needed; ``first_whole`` is for whole records.
    """
    own = F.when(F.col("title_key") == "", F.col("doc_ord"))
    return _first(keys, [_hash("title_key"), own], ["doc_ord"])


def first_whole(df: DataFrame) -> DataFrame:
    """As ``first_per_title`` for records of many columns: they only meet the numbers that stay."""
    return df.join(first_per_title(df.select("doc_ord", "title_key")).select("doc_ord"), "doc_ord", "left_semi")


def first_per_title_and_year(df: DataFrame, row: Sequence[str] = ("doc_ord",)) -> DataFrame:
    """Keep the first record of every (title, year), first source first; blank titles are never equal.

    Records of one source have different names ``row``. For a few columns, as ``first_per_title``.
    """
    named = df.withColumn("Title", text.ws_trim(F.col("Title"))).withColumn("Year", text.year(F.col("Year")))
    rank = F.when(F.col("Source") == "Web of science", 1).otherwise(0)
    own = F.when(text.is_blank(F.col("Title")), F.struct(rank, *[F.col(f"`{c}`") for c in row]))
    return _first(named, [_hash("Title"), "Year", own], [rank, "doc_ord", *[F.col(f"`{c}`") for c in row]])


def doi_lookup(a: DataFrame, b: DataFrame) -> DataFrame:
    """``b_ord, title_key, b_year, a_ord``: every ``b`` record with the first ``a`` record of its DOI, or NULL."""
    keys = a.where("DOI <> ''").groupBy("DOI").agg(F.min("doc_ord").alias("a_ord"))
    rows = b.select(
        F.col("doc_ord").alias("b_ord"), "title_key", text.year(F.col("Publication Year")).alias("b_year"),
        F.when(F.col("DOI") != "", F.col("DOI")).alias("DOI"),
    )
    return spread_join(rows, keys, ["DOI"], "b_ord", "left").select("b_ord", "title_key", "b_year", "a_ord")


def doi_matches(lookup: DataFrame) -> DataFrame:
    """Records of ``b`` whose DOI occurs in ``a``."""
    return lookup.where("a_ord IS NOT NULL").select("b_ord", "title_key", "a_ord")


def fuzzy_candidates(lookup: DataFrame) -> DataFrame:
    """Records of ``b`` without a DOI match.

    A title key other than '' occurs once in ``b``, so no other record can have
    made it a duplicate title already.
    """
    return lookup.where("a_ord IS NULL").select("b_ord", "title_key", "b_year")


def _own_key(df: DataFrame) -> DataFrame:
    """The title key, or a text no other record has where the key is blank."""
    own = F.concat(F.lit("#"), F.col("doc_ord").cast("string"))
    return df.withColumn("_key", F.when(F.col("title_key") == "", own).otherwise(F.col("title_key")))


def year_ok(b_year, a_year, settings: Settings = DEFAULTS):
    """Years agree within the tolerance; an unknown year agrees with any."""
    return F.coalesce(F.abs(b_year - a_year) <= settings.year_tolerance, F.lit(True))


def fuzzy_matches(a: DataFrame, candidates: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Best title of ``a`` for each candidate, with its score, year and ``year_ok``.

    The best title is chosen before the year check unless ``year_first`` is set,
    as the second best is never tried.
    """
    choices = a.where("title_key <> ''").select(
        F.col("doc_ord").alias("a_ord"), F.col("title_key").alias("a_key"), text.year(F.col("Year")).alias("a_year")
    )
    wanted = candidates.where(F.length("title_key") >= settings.min_title_length)
    years = ("b_year", "a_year", settings.year_tolerance) if settings.year_first else None
    best = best_match(wanted, choices, "b_ord", "title_key", "a_ord", "a_key", settings.title_threshold, years=years)
    return best.withColumn("year_ok", year_ok(F.col("b_year"), F.col("a_year"), settings))


def duplicate_pairs(a: DataFrame, b: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Every removed ``b`` record with its partner: ``title_key, match_method, a_ord, b_ord, score``."""
    lookup = durable(doi_lookup(a, b), "doi-lookup")
    by_title = fuzzy_matches(a, fuzzy_candidates(lookup), settings).where("year_ok")
    no_score = F.lit(None).cast("double").alias("score")
    return (
        doi_matches(lookup)
        .select("title_key", F.lit("doi").alias("match_method"), "a_ord", "b_ord", no_score)
        .unionByName(by_title.select("title_key", F.lit("title").alias("match_method"), "a_ord", "b_ord", "score"))
    )


def duplicate_titles(pairs: DataFrame) -> DataFrame:
    return pairs.select("title_key").distinct()


def flag_records(b: DataFrame, pairs: DataFrame) -> DataFrame:
    """``In_Both`` on the source that loses its duplicates: 1 where the record has a partner."""
    marks = pairs.select(F.col("b_ord").alias("doc_ord"), F.lit(1).alias("In_Both")).distinct()
    return b.join(marks, "doc_ord", "left").select(*b.columns, F.coalesce("In_Both", F.lit(0)).alias("In_Both"))


def flag_titles(a: DataFrame, titles: DataFrame) -> DataFrame:
    """``In_Both`` on the preferred source: 1 where the title key is a duplicate title."""
    marks = titles.select(F.col("title_key").alias("_key"), F.lit(1).alias("In_Both"))
    joined = _own_key(a).join(marks, "_key", "left")
    return joined.select(*a.columns, F.coalesce("In_Both", F.lit(0)).alias("In_Both"))
