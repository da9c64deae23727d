"""URL filter: a weighted vocabulary found by Aho-Corasick, overridden by host and path rules."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

STRICT_TERMS = (
    "adult-x", "spam-farm", "porn", "porno", "xxx", "hentai", "escort", "escorts", "camgirl", "camgirls", "sexcam",
    "warez", "phishing", "malware", "link-farm", "onlinecasino", "online-casino",
)
SOFT_TERMS = (
    "adult", "sex", "nude", "casino", "poker", "bet", "betting", "slots", "gamble", "jackpot", "loan", "loans",
    "viagra", "pills", "pharma", "crack", "torrent", "spam", "farm", "free", "win", "winner", "bonus", "cheap", "deal",
)


@dataclass(frozen=True)
class Vocabulary:
    """One strict term rejects, so do ``soft_needed`` different soft ones."""

    strict: tuple[str, ...] = STRICT_TERMS
    soft: tuple[str, ...] = SOFT_TERMS
    soft_needed: int = 2


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"^(?s).*?://([^/?#]*)([^?#]*)"
_HITS = pa.schema([("strict_hits", pa.int64()), ("soft_hits", pa.int64())])


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty for a null url or one without ``://``; only A-Z change their case."""
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, _URL, 1), _UPPER, _LOWER), F.regexp_extract(text, _URL, 2)


def term_hits(df: DataFrame, url_col: str, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """Add ``strict_hits`` (occurrences) and ``soft_hits`` (different terms) of every url.

    A term counts where no ASCII letter or digit touches it on either side. Case is ignored; a null url has no
    hits. The vocabulary is a parameter, so the automaton's size does not depend on the data.
    """
    weights = {t.lower(): False for t in vocabulary.soft if t} | {t.lower(): True for t in vocabulary.strict if t}
    schema = df.sparkSession.createDataFrame([], df.schema).withColumns(
        {"strict_hits": F.lit(0).cast("long"), "soft_hits": F.lit(0).cast("long")}
    ).schema

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for term, strict in weights.items():
            automaton.add_word(term, (term, strict))
        automaton.make_automaton()
        edge = set("abcdefghijklmnopqrstuvwxyz0123456789")
        for batch in batches:
            strict_hits, soft_hits = [], []
            for url in batch.column(url_col).to_pylist():
                low, strict_n, soft = (url or "").translate(_ASCII), 0, set()
                for end, (term, strict) in automaton.iter(low) if weights else ():
                    start = end - len(term) + 1
                    if (start and low[start - 1] in edge) or (end + 1 < len(low) and low[end + 1] in edge):
                        continue
                    if strict:
                        strict_n += 1
                    else:
                        soft.add(term)
                strict_hits.append(strict_n)
                soft_hits.append(len(soft))
            columns = [*batch.columns, pa.array(strict_hits, pa.int64()), pa.array(soft_hits, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *_HITS.names])

    return df.mapInArrow(find, schema)


_ASCII = str.maketrans(_UPPER, _LOWER)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else nulls.

    A rule fits its host and all subdomains where the path starts with the rule's. Of equally long rules the
    one of the longer host wins, then the first given.
    """
    name = verdict = F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=lambda r: (-len(r.name), -len(r.host)))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def judge(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[Rule, ...] = RULES,
    vocabulary: Vocabulary = Vocabulary(),
) -> DataFrame:
    """``page_id, host, path, rule, verdict, strict_hits, soft_hits`` of every row, in one pass without a shuffle.

    Repeated rows are judged one by one; an empty table gives an empty result; other columns are not read.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{url_col}`").cast("string").alias("_url"))
    host, path = host_and_path(F.col("_url"))
    parts = term_hits(rows, "_url", vocabulary).withColumns({"host": host, "path": path})
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rejected = (F.col("strict_hits") > 0) | (F.col("soft_hits") >= vocabulary.soft_needed)
    return parts.select(
        id_col, "host", "path", name.alias("rule"),
        F.coalesce(verdict, F.when(rejected, "block").otherwise("allow")).alias("verdict"), "strict_hits", "soft_hits",
    )
