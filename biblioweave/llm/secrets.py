"""Secret scan: fixed rules, and random-looking strings found by two character Markov models. Column expressions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import let, texts

# The rules and the shortest match (or group) that counts, in the order of their kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
_LEAST_VALUE = 12

SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}"
IDENTIFIER = r"[A-Za-z][A-Za-z0-9_-]{11,}"
_MARK = "\u0001"


@dataclass(frozen=True)
class MarkovModel:
    """``ratio[a * n + b]``: log of P(b after a) in random strings over that in identifiers."""

    ratio: tuple[float, ...]
    threshold: float = 12.0


def _matches(text: Column, pattern: str, body) -> Column:
    """``body(lengths, pieces)`` over a text cut at its matches: pieces 1, 3, 5 ... (from 0) are the matches.

    Cutting marks take the place of two control signs that no rule can match, so all offsets stay.
    """
    clean = F.translate(text, "\u0001", "\u0002")
    pieces = F.split(F.regexp_replace(clean, pattern, f"{_MARK}$0{_MARK}"), _MARK)
    return let(pieces, lambda p: F.when(F.size(p) > 1, let(F.transform(p, F.length), lambda n: body(n, p))))


def _prefix_sums(numbers: Column, body) -> Column:
    """``body`` of a function that sums the first i numbers: whole blocks of about their root, then what is left of one."""
    total = lambda some: F.aggregate(some, F.lit(0).cast("long"), lambda a, x: a + x)
    size = F.greatest(F.lit(8), F.ceil(F.sqrt(F.size(numbers)))).cast("int")

    def summed(block):
        count = F.floor(F.size(numbers) / block).cast("int")
        sums = F.transform(F.sequence(F.lit(0), count), lambda b: total(F.slice(numbers, b * block + 1, block)))
        before = lambda sums: F.transform(F.sequence(F.lit(0), count), lambda b: total(F.slice(sums, F.lit(1), b)))

        def of(starts):
            def first(i):
                return let(F.floor(i / block).cast("int"), lambda b: starts[b] + total(F.slice(numbers, b * block + 1, i - b * block)))

            return body(first)

        return let(let(sums, before), of)

    return let(size, summed)


def _spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """``array<struct<start, kind, end>>`` of the matches, in code points, end exclusive."""

    def found(lengths, pieces):
        at = F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2))
        if keep is not None:
            at = F.filter(at, lambda i: keep(pieces[i]))

        def spans(start_of):
            def span(i):
                return let(start_of(i), lambda start: F.struct(
                    start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (start + lengths[i]).alias("end")
                ))

            return F.transform(at, span)

        return _prefix_sums(lengths, spans)

    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return F.coalesce(_matches(text, pattern, found), none)


def rule_spans(text: Column) -> dict[str, Column]:
    """Spans of each fixed rule: leftmost, not overlapping within a rule, short matches dropped.

    The lengths of ``access`` and ``hex`` stand in the pattern, since a run too short cannot hold a longer one.
    A short ``assign`` match still uses up its text, so its length is tested after the match.
    """
    long_value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= _LEAST_VALUE
    return {
        "assign": _spans(text, ASSIGN, "assign", long_value),
        "access": _spans(text, ACCESS, "access"),
        "hex": _spans(text, HEX, "hex"),
    }


def labelled_strings(docs: DataFrame) -> DataFrame:
    """``token, is_random``: values that the fixed rules find in a corpus, and its long identifiers outside of them."""
    secrets = F.concat(
        F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= _LEAST_VALUE),
        F.regexp_extract_all("text", F.lit(f"{ACCESS}|{HEX}"), F.lit(0)),
    )
    rest = F.regexp_replace("text", f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    names = F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))
    labelled = F.concat(
        F.transform(secrets, lambda t: F.struct(t.alias("token"), F.lit(True).alias("is_random"))),
        F.transform(names, lambda t: F.struct(t.alias("token"), F.lit(False).alias("is_random"))),
    )
    return docs.select(F.inline(labelled))


def train(samples: DataFrame, floor: float = 0.02, threshold: float = 12.0) -> MarkovModel:
    """Fit both models from all labelled ``token, is_random`` rows.

    Pairs of neighbouring characters are counted before the shuffle; what reaches the driver is one count per
    label and pair of ``SYMBOLS``, 8,192 rows at most. ``floor`` of each distribution is uniform, so pairs that
    neither kind has seen say nothing. Without samples of a kind its model is uniform.
    """
    pairs = samples.where("length(token) > 1").select(
        "is_random", "token", F.explode(F.sequence(F.lit(1), F.length("token") - 1)).alias("i")
    ).select("is_random", F.substring("token", F.col("i"), F.lit(2)).alias("pair"))
    n = len(SYMBOLS)
    counts = {True: [0.0] * (n * n), False: [0.0] * (n * n)}
    known = pairs.where(F.col("pair").rlike(r"^[A-Za-z0-9+/_-]{2}$"))
    for row in known.groupBy("is_random", "pair").count().collect():
        counts[row.is_random][SYMBOLS.index(row.pair[0]) * n + SYMBOLS.index(row.pair[1])] = float(row["count"])

    def share(c, a, b):
        total = sum(c[a * n : a * n + n])
        return (1 - floor) * c[a * n + b] / total + floor / n if total else 1 / n

    ratio = tuple(math.log(share(counts[True], a, b) / share(counts[False], a, b)) for a in range(n) for b in range(n))
    return MarkovModel(ratio, threshold)


def log_ratio(token: Column, model: MarkovModel) -> Column:
    """Summed log-likelihood ratio of a string of ``SYMBOLS``; above 0 it looks random."""
    n = len(SYMBOLS)
    codes = F.transform(F.sequence(F.lit(1), F.length(token)), lambda i: F.instr(F.lit(SYMBOLS), F.substring(token, i, F.lit(1))) - 1)
    ratios = F.lit(list(model.ratio))
    return let(codes, lambda c: F.aggregate(
        F.sequence(F.lit(0), F.size(c) - 2), F.lit(0.0), lambda total, i: total + ratios[c[i] * n + c[i + 1]]
    ))


def random_spans(text: Column, model: MarkovModel) -> Column:
    """Spans of strings whose likelihood ratio passes the model's threshold."""
    return _spans(text, CANDIDATE, "random", lambda m: log_ratio(m, model) >= model.threshold)


def with_spans(df: DataFrame, model: MarkovModel, text_col: str = "text") -> DataFrame:
    """Add ``_base`` and ``_spans``: sorted spans of the fixed rules, and these with the model's.

    A span of the model counts where it overlaps none of the rules. Null and empty texts have no spans; each
    repeated row is scanned on its own; an empty table gives an empty result. One pass, no shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = df.withColumns({"_base": F.array_sort(F.concat(*rule_spans(text).values())), "_random": random_spans(text, model)})
    base = F.col("_base")
    new = F.filter("_random", lambda r: ~F.exists(base, lambda b: (b.start < r.end) & (r.start < b.end)))
    return found.withColumn("_spans", F.array_sort(F.concat(base, new))).drop("_random")


def scan(docs: DataFrame, model: MarkovModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, base, spans`` of every row, as ``with_spans`` finds them."""
    found = with_spans(texts(docs, id_col, text_col), model)
    return found.select("doc_id", "text", F.col("_base").alias("base"), F.col("_spans").alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.lit(list(KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s.kind], s.start, s.end)), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``mark``."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done, s):
        gap = F.substr(text, (done.at + 1).cast("int"), F.greatest(s.start - done.at, F.lit(0)).cast("int"))
        fresh = (s.start >= done.at) & ((s.start > done.at) | (done.at == 0))
        return F.struct(
            F.greatest(done.at, s.end).alias("at"),
            F.when(fresh, F.concat(done.out, gap, F.lit(mark))).otherwise(done.out).alias("out"),
        )

    cut = F.aggregate(spans, start, step, lambda d: F.concat(d.out, F.substr(text, (d.at + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, cut).otherwise(text)
