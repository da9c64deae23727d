"""Canonical journal names and journal metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..config import DEFAULTS, METRIC_COLUMNS, Settings
from ..functions import text
from .durable import counted, durable
from .fuzzy import best_match
from .skew import spread_join


def issn_title_map(journals: DataFrame) -> DataFrame:
    """``(j_issn, canon_title)``: the first title in file order of every ISSN."""
    if not {"Issn", "Title"} <= set(journals.columns):
        return journals.sparkSession.createDataFrame([], "j_issn string, canon_title string")
    return (
        journals.where("Title IS NOT NULL")
        .select(F.explode(text.issn_list(F.col("Issn"))).alias("j_issn"), "Title", "j_ord")
        .groupBy("j_issn")
        .agg(F.min_by("Title", "j_ord").alias("canon_title"))
    )


def _half_as_far(percent: int) -> int | None:
    """Names of numbered journals are alike, so most pairs of a list lie near the bound: names with a nearer one skip these."""
    return (percent + 100) // 2 if percent < 98 else None


def _row_id(df: DataFrame):
    """Both sources count their records from the start, so a row is (source, number)."""
    return F.struct("Source", "doc_ord") if "Source" in df.columns else F.struct("doc_ord")


def canonical_titles(records: DataFrame, journals: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Replace ``Source title`` of records outside the preferred source.

    By the first listed one of its ISSNs where there are any, else by the most
    similar journal name; else the record's own name without parentheses. ISSNs
    that are all unlisted keep the record's own name.
    """
    if "Source title" not in records.columns:
        return records
    columns = records.columns
    source = F.coalesce("Source", F.lit("unknown")) if "Source" in columns else F.lit("unknown")
    eligible = F.lower(text.ws_trim(source)) != "scopus"
    own_issn = text.issn_cell(F.col("ISSN")) if "ISSN" in columns else F.lit("")
    own = text.ws_trim(text.safe_text(F.col("Source title")))
    keyed = records.withColumns(
        {
            "_row": _row_id(records),
            "_issn": F.when(eligible & (own_issn != ""), own_issn),
            "_name": F.when(eligible & (own_issn == "") & (own != ""), own),
        }
    ).withColumn("_key", F.coalesce(F.concat(F.lit("issn "), "_issn"), F.concat(F.lit("name "), "_name")))
    found = _canonical_names(keyed.select("_key", "_issn", "_name"), journals, settings)
    # Records of the preferred source have no key: they keep their names and are not moved.
    joined = spread_join(keyed.where("_key IS NOT NULL"), found, ["_key"], "_row", "left")
    joined = joined.unionByName(keyed.where("_key IS NULL"), allowMissingColumns=True)
    result = joined.withColumn("Source title", text.journal_name(F.coalesce("_found", own)))
    if "Source" in columns:
        result = result.withColumn("Source", source)
    return result.select(*[F.col(f"`{c}`") for c in columns])


def _canonical_names(keys: DataFrame, journals: DataFrame, settings: Settings) -> DataFrame:
    """``(_key, _found)`` for the distinct ISSNs and names among the records."""
    names = issn_title_map(journals)
    by_issn = (
        keys.where("_issn IS NOT NULL").select("_key", "_issn").distinct()
        .select("_key", F.posexplode(text.issn_list(F.col("_issn"))).alias("_place", "_one"))
        .join(names, F.col("_one") == F.col("j_issn"))
        .where(text.ws_trim(F.col("canon_title")) != "")
        .groupBy("_key").agg(F.min_by("canon_title", "_place").alias("_found"))
    )
    listed = durable(
        names.groupBy("canon_title").agg(F.min("j_issn").alias("first_issn"))
        .select("first_issn", "canon_title", F.col("canon_title").alias("_title")),
        "journal-names",
    )
    best = best_match(
        keys.where("_name IS NOT NULL").select("_key", "_name").distinct(), listed,
        "_key", "_name", "first_issn", "canon_title", settings.canonical_threshold, token_sort_only=True,
        first_percent=_half_as_far(settings.canonical_threshold),
    ).where(F.col("score") > settings.canonical_threshold / 100.0)
    by_name = best.select("_key", F.col("_title").alias("_found"))
    return by_issn.unionByName(by_name)


# Keys of so many rows may be broadcast to the journal list; of more, both sides are shuffled.
_BROADCAST_KEYS = 20_000


def _metrics(journals: DataFrame) -> DataFrame:
    """Journal rows with cleaned names and a numeric year."""
    return journals.withColumn("Title", text.journal_name(F.col("Title"))).withColumn("Year", text.year(F.col("Year")))


def _exploded(journals: DataFrame) -> DataFrame:
    """One row per journal row and ISSN ``j_issn``."""
    return _metrics(journals).withColumn("j_issn", F.explode_outer(text.issn_list(F.col("Issn")))).drop("Issn")


def _asked_for(metrics: DataFrame, keys: DataFrame, rows: int) -> DataFrame:
    """The journal rows that some of ``keys`` (stored, of so many rows) can meet, so that the others are not shuffled, sorted and ranked."""
    wanted = keys.distinct()
    return metrics.join(wanted.hint("merge") if rows > _BROADCAST_KEYS else wanted, keys.columns, "left_semi")


def _first_metric(metrics: DataFrame, keys: list[str]) -> DataFrame:
    """One journal row per key, the first in file order, with cleaned categories and packed as struct ``j``."""
    extra = [c for c in metrics.columns if c not in {"j_ord", "j_issn", "Title", "Year"}]
    packed = F.struct(F.col("j_issn").alias("journal_issn"), *[F.col(f"`{c}`") for c in extra])
    ranked = metrics.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy("j_ord", "j_issn")))
    first = ranked.where("_rank = 1")
    if "Categories" in extra:
        first = first.withColumn("Categories", text.categories(F.col("Categories")))
    return first.select(*keys, packed.alias("j"))


def journal_keys(records: DataFrame) -> DataFrame:
    """The distinct (ISSN, year, name) among the records: all that metrics depend on."""
    return records.select("ISSN", "Year", F.col("`Source title`").alias("_name")).distinct()


def metrics_by_issn(keys: DataFrame, journals: DataFrame) -> DataFrame:
    """Add the journal row of each key's year and first listed ISSN as ``j`` (or NULL)."""
    # Keys without an ISSN cannot match; they would only meet in one task.
    known = keys.where("ISSN <> ''")
    asked, seen = counted(
        known.select("ISSN", "Year").distinct()
        .select("ISSN", "Year", F.posexplode(text.issn_list(F.col("ISSN"))).alias("_place", "_one")),
        "journal-issns",
    )
    listed = _exploded(journals).where("j_issn IS NOT NULL AND Year IS NOT NULL")
    listed = _asked_for(listed, asked.select(F.col("_one").alias("j_issn"), "Year"), seen()["rows"])
    first = _first_metric(listed, ["j_issn", "Year"]).withColumnRenamed("Year", "j_year")
    same = (F.col("_one") == F.col("j_issn")) & (F.col("Year") == F.col("j_year"))
    found = asked.join(first, same).groupBy("ISSN", "Year").agg(F.min_by("j", "_place").alias("j"))
    return known.join(found, ["ISSN", "Year"], "left").unionByName(
        keys.where("coalesce(ISSN, '') = ''"), allowMissingColumns=True
    )


def metrics_by_title(keys: DataFrame, journals: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Fill ``j`` where it is NULL: the most similar journal name, same year."""
    metrics = _exploded(journals)
    listed = durable(
        metrics.where("Title IS NOT NULL").groupBy("Title").agg(F.min("j_ord").alias("first_ord"))
        .withColumn("_low", F.lower("Title")),
        "journal-names",
    )
    low = keys.withColumn("_lower", F.when(F.col("j").isNull() & ~text.is_blank(F.col("_name")), F.lower("_name")))
    wanted = low.where("_lower IS NOT NULL").select("_lower", F.col("_lower").alias("_wanted")).distinct()
    best = best_match(
        wanted, listed, "_lower", "_wanted", "first_ord", "_low", settings.journal_threshold,
        first_percent=_half_as_far(settings.journal_threshold),
    )
    best, seen = counted(best, "journal-titles")
    dated = metrics.where("Title IS NOT NULL AND Year IS NOT NULL")
    first = _first_metric(_asked_for(dated, best.select("Title"), seen()["rows"]), ["Title", "Year"])
    found = best.join(first, "Title").select("_lower", F.col("Year").alias("j_year"), F.col("j").alias("_similar"))
    still_open = low.where("_lower IS NOT NULL").drop("j").withColumn("j_year", F.col("Year"))
    filled = still_open.join(found, ["_lower", "j_year"], "left").withColumnRenamed("_similar", "j")
    return low.where("_lower IS NULL").drop("_lower").unionByName(filled.drop("_lower", "j_year"))


def with_metrics(records: DataFrame, keys: DataFrame) -> DataFrame:
    """Every record once, with the ``j`` of its key."""
    names = {"ISSN": "_i", "Year": "_y", "Source title": "_n"}
    absent = {"ISSN": F.lit(""), "Year": F.lit(0), "Source title": F.lit("")}

    def filled(column: str, name: str):
        # NULL keys must meet their own row, so NULL gets a value and a flag.
        return F.struct(F.col(f"`{column}`").isNull(), F.coalesce(F.col(f"`{column}`"), absent[name]))

    left = records.withColumns({k: filled(n, n) for n, k in names.items()} | {"_row": _row_id(records)})
    right = keys.select(filled("ISSN", "ISSN").alias("_i"), filled("Year", "Year").alias("_y"), filled("_name", "Source title").alias("_n"), "j")
    return spread_join(left, right, list(names.values()), "_row", "left").drop(*names.values(), "_row")


def journal_rows(records: DataFrame, journals: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The journal row ``j`` (or NULL) of every key: by ISSN and year, else by name and year."""
    keys = durable(metrics_by_issn(journal_keys(records), journals), "journal-keys")
    return metrics_by_title(keys, journals, settings)


def enrich(records: DataFrame, journals: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Every record once, gaps in its metric columns filled from its journal row."""
    return unpack_metrics(with_metrics(records, journal_rows(records, journals, settings)), records.columns)


def unpack_metrics(matched: DataFrame, own: list[str]) -> DataFrame:
    fields = matched.schema["j"].dataType.names
    filled = {
        c: F.coalesce(F.col(f"`{c}`").cast("string"), F.col(f"j.`{c}`").cast("string"))
        for c in METRIC_COLUMNS if c in own and c in fields
    }
    added = [F.col(f"j.`{c}`").alias(c) for c in fields if c not in own]
    return matched.withColumns(filled).select(*[F.col(f"`{c}`") for c in own], *added)
