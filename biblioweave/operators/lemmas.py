"""Title keys with lemmas from a dictionary table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import DEFAULTS, Settings
from ..functions import text
from .durable import durable
from .skew import spread_join


def _tokens(titles: DataFrame, settings: Settings) -> DataFrame:
    """``_id, _place, token`` of the distinct titles: letters only, lower case, no stop words."""
    words = F.posexplode(F.expr(text.title_tokens("_title", settings)))
    return titles.select("_id", words.alias("_place", "token"))


def token_lemmas(tokens: DataFrame, dictionary: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """``token, lemma`` for the distinct tokens: the dictionary's lemma, else that of the suffix rules.

    ``dictionary`` has columns ``form`` and ``lemma``. A form in several rows takes the least lemma; forms are met in
    lower case; null forms and null or blank lemmas count for nothing.
    """
    listed = (
        dictionary.select(F.lower("form").alias("token"), F.lower(text.ws_trim(F.col("lemma"))).alias("_lemma"))
        .where("token IS NOT NULL AND _lemma <> ''").groupBy("token").agg(F.min("_lemma").alias("_lemma"))
    )
    found = tokens.select("token").distinct().join(listed, "token", "left")
    return found.select("token", F.coalesce("_lemma", F.expr(text.lemma("token", settings))).alias("lemma"))


def title_keys(titles: DataFrame, dictionary: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """``_title, title_key`` of the distinct titles of column ``_title``.

    Tokens, not titles, meet the dictionary, each distinct one once. Their lemmas then go back to the places of the
    tokens (frequent tokens are split), stop words among the lemmas drop out, and every title is put together once.
    """
    named = durable(
        titles.select("_title").where("_title IS NOT NULL").distinct().withColumn("_id", F.unhex(F.md5("_title"))), "titles"
    )
    tokens = durable(_tokens(named, settings), "title-tokens")
    lemmas = token_lemmas(tokens, dictionary, settings)
    stops = list(settings.stop_words)
    placed = spread_join(tokens, lemmas, ["token"], "_id", "inner").where(~F.col("lemma").isin(stops))
    keys = placed.groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("_place", "lemma"))).alias("_all"))
    key = F.coalesce(F.array_join(F.transform("_all", lambda x: x.lemma), " "), F.lit(""))
    return named.join(keys, "_id", "left").select("_title", key.alias("title_key"))


def with_title_key(records: DataFrame, column: str, dictionary: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Add ``title_key``; a null title has the empty key."""
    keys = title_keys(records.select(F.col(f"`{column}`").alias("_title")), dictionary, settings)
    keys = keys.select(F.unhex(F.md5("_title")).alias("_own"), "title_key")
    own = records.withColumn("_own", F.unhex(F.md5(F.col(f"`{column}`"))))
    joined = spread_join(own.where("_own IS NOT NULL"), keys, ["_own"], "doc_ord", "left")
    rest = own.where("_own IS NULL").withColumn("title_key", F.lit(""))
    return joined.unionByName(rest).drop("_own")
