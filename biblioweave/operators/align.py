"""Per-source cleaning, the schema of the second source, and the union."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import DEFAULTS, SOURCE_A, SOURCE_B, Settings
from ..functions import text


def require_columns(df: DataFrame, names: list[str], what: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")


def _change(df: DataFrame, changes: dict) -> DataFrame:
    """Apply ``column -> function`` to the columns that are present."""
    return df.withColumns({c: f(F.col(f"`{c}`")) for c, f in changes.items() if c in df.columns})


def prepare_a(raw: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Clean the preferred source and add its title key."""
    require_columns(raw, ["Title"], SOURCE_A)
    df = _change(raw, {"Author full names": text.author_names, "DOI": text.doi})
    if "DOI" not in df.columns:
        df = df.withColumn("DOI", F.lit(""))
    tag = F.lit(SOURCE_A)
    df = df.withColumn("Source", F.coalesce("Source", tag) if "Source" in df.columns else tag)
    return df.withColumn("title_key", text.title_key("Title", settings))


def prepare_b(raw: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Clean the second source and add its title key."""
    require_columns(raw, ["Article Title", "DOI", "Publication Year"], SOURCE_B)
    df = _change(
        raw,
        {
            "Authors": text.without_commas,
            "Source Title": text.ampersand_to_and,
            "Document Type": text.document_type,
            "DOI": text.doi,
        },
    ).withColumn("Source", F.lit(SOURCE_B))
    if "Author(s) ID" not in df.columns:
        require_columns(df, ["Authors"], SOURCE_B)
        df = df.withColumn("Author(s) ID", F.col("Authors"))
    if "Publication Stage" not in df.columns:
        df = df.withColumn("Publication Stage", F.lit("Final"))
    return df.withColumn("title_key", text.title_key("Article Title", settings))


def kept_records(b: DataFrame) -> DataFrame:
    """Records of the second source that the first does not have."""
    return b.where("In_Both = 0") if "In_Both" in b.columns else b


def b_in_a_schema(b: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Rename to the first source's schema and keep the target columns present."""
    renamed = b.withColumnsRenamed(dict(settings.b_to_a))
    wanted = [c for c in settings.target_columns if c in renamed.columns]
    return renamed.select("doc_ord", *[F.col(f"`{c}`") for c in wanted])


def union_sources(*frames: DataFrame | None) -> DataFrame:
    """Union by column name; a missing source is skipped, none at all is an error."""
    present = [f for f in frames if f is not None]
    if not present:
        raise ValueError("there is no source to read")
    out = present[0]
    for frame in present[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def clean_combined(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Year range, identifiers, affiliations, access status and citations."""
    if "Year" in df.columns:
        df = df.withColumn("Year", text.year(F.col("Year")))
        df = df.where(F.col("Year").between(settings.year_start, settings.year_end))
    places = ["Affiliations", "Authors with affiliations"]
    if set(places) <= set(df.columns):
        first, second = (F.col(p) for p in places)
        df = df.withColumns(dict(zip(places, (text.filled_from(first, second), text.filled_from(second, first)))))
    df = _change(
        df,
        {
            "ISSN": text.issn_cell,
            **{p: lambda c: text.affiliations(c, settings) for p in places},
            "Open Access": text.open_access,
            "Cited by": text.cited_by,
        },
    )
    if "Author full names" in df.columns:
        df = df.withColumn("Authors", F.col("Author full names"))
    return df.drop("title_key")
