"""Filter interaction audit: which of five document filters removes what, in every order, by contracting one small tensor a part.

Each text is judged once by all filters. A part's documents then are counts over pass or fail of each filter: a tensor of shape
2x2x2x2x2. Every figure of every order selects pass, fail or all along each axis, so no text is looked at again for an order.

Filters: A too few words, B too few distinct words, C too many capitals, D holds a symbol, E equal to the text of a smaller id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..operators.durable import durable
from .common import batch_of, slices

FILTERS = "ABCDE"
_CAPITALS = bytes(range(65, 91))
_JUDGED = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("fails", pa.int32()), ("copy", pa.binary())])
_PASS, _FAIL, _ALL = (1, 0), (0, 1), (1, 1)
_FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_AUDIT = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *[(f, pa.int64()) for f in _FIGURES]])


@dataclass(frozen=True)
class Settings:
    """Failure conditions of the filters that look at one text."""

    least_words: int = 200
    distinct_percent: int = 50
    capitals_percent: int = 2
    symbols: str = "#$%&*|"


def judge(docs: DataFrame, part_col: str = "source", settings: Settings = Settings()) -> DataFrame:
    """``doc_id, part, fails, copy`` of each whole text: filters A to D as bits (A the highest) and a 128-bit hash of the text.

    Words are runs of other than ASCII white space. A null text is empty, a null part the empty string. No shuffle; about two
    megabytes of text are held at a time, or one text where that is longer.
    """
    symbols, rule = settings.symbols.encode(), settings

    def fails(raw: bytes, points: int) -> int:
        words = raw.split()
        few = len(words) < rule.least_words
        same = 100 * len(set(words)) < rule.distinct_percent * len(words)
        capitals = len(raw) - len(raw.translate(None, _CAPITALS))
        loud = 100 * capitals > rule.capitals_percent * points
        return few << 3 | same << 2 | loud << 1 | (len(raw.translate(None, symbols)) < len(raw))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                points = pc.utf8_length(batch.column("text")).to_pylist()
                raw = batch.column("text").cast(pa.binary()).to_pylist()
                yield batch_of(
                    _JUDGED, batch.column("doc_id"), batch.column("part"), [fails(t, n) for t, n in zip(raw, points)],
                    [hashlib.blake2b(t, digest_size=16).digest() for t in raw],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, part string, fails int, copy binary")


def outcomes(docs: DataFrame, labels: DataFrame, part_col: str = "source", settings: Settings = Settings()) -> DataFrame:
    """One row per id and text: ``doc_id, copy, fails`` and ``seen``, its counts by part and label.

    An id with several rows in ``labels`` is good (toxic) if one of them says so. Rows without an id have no label; they are
    dealt by text. Equal rows are counted.
    """
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.max(F.expr("coalesce(quality = 1, false)")).alias("good"), F.max(F.expr("coalesce(toxic = 1, false)")).alias("toxic")
    ).withColumn("_copy", F.lit(None).cast("binary"))
    judged = judge(docs, part_col, settings).withColumn("_spread", F.expr("if(doc_id IS NULL, copy, NULL)"))
    same = (F.col("doc_id") == F.col("_id")) & F.col("_spread").eqNullSafe(F.col("_copy"))
    known = judged.join(marks, same, "left").select(
        "doc_id", "copy", "fails", "part", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    )
    counted = known.groupBy("doc_id", "copy", "fails", "part", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("doc_id", "copy", "fails").agg(F.collect_list(F.struct("part", "good", "toxic", "n")).alias("seen"))


def cells(rows: DataFrame) -> DataFrame:
    """``part, fails, docs, good, toxic``: counts by the outcome of all five filters (A the highest bit, E the lowest).

    ``rows`` is the stored table of ``outcomes``. All documents are counted as copies and the first ones of each text counted
    off again, so a text of any number of copies sends one row per task. A row without an id is smaller than none and has no
    smaller one: it passes E and makes no other fail. All rows of the smallest id pass.
    """
    first = rows.where("doc_id IS NOT NULL").groupBy("copy").agg(F.min_by(F.struct("fails", "seen"), "doc_id").alias("_first"))
    passing = first.select("_first.*").unionByName(rows.where("doc_id IS NULL").select("fails", "seen"))

    def signed(frame: DataFrame, failed: int, sign: int) -> DataFrame:
        one = frame.select((F.col("fails") * 2 + failed).alias("fails"), F.explode("seen").alias("s"))
        return one.select("s.part", "fails", *[
            (F.when(keep, F.col("s.n")).otherwise(0) * sign).alias(name)
            for name, keep in (("docs", F.lit(True)), ("good", F.col("s.good")), ("toxic", F.col("s.toxic")))
        ])

    both = signed(rows, 1, 1).unionByName(signed(passing, 1, -1)).unionByName(signed(passing, 0, 1))
    return both.groupBy("part", "fails").agg(*[F.sum(c).cast("long").alias(c) for c in ("docs", "good", "toxic")])


def _selectors() -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """Every (order, step), and for each figure what it selects along each axis: arrays of shape (steps, axes, 2)."""
    steps, chosen = [], {"kept": [], "removed": [], "failed": [], "unique_fails": []}
    for order in permutations(range(len(FILTERS))):
        for place, own in enumerate(order):
            before = order[:place]
            steps.append(("".join(FILTERS[i] for i in order), place + 1))
            axes = range(len(FILTERS))
            chosen["kept"].append([_PASS if a in before or a == own else _ALL for a in axes])
            chosen["removed"].append([_FAIL if a == own else _PASS if a in before else _ALL for a in axes])
            chosen["failed"].append([_FAIL if a == own else _ALL for a in axes])
            chosen["unique_fails"].append([_FAIL if a == own else _PASS for a in axes])
    return steps, {k: np.array(v, np.int64) for k, v in chosen.items()}


def contract(counts: DataFrame) -> DataFrame:
    """One row per part, order and step with the figures of the audit, zeros included; no part, no rows.

    A part is at most 32 cells; tensors of many parts are contracted at once.
    """
    packed = counts.groupBy("part").agg(F.collect_list(F.struct("fails", "docs", "good", "toxic")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, chosen = _selectors()
        own = np.array([FILTERS.index(order[step - 1]) for order, step in steps])

        def select(tensor: np.ndarray, figure: str) -> np.ndarray:
            return np.einsum("pabcde,ra,rb,rc,rd,re->pr", tensor, *np.moveaxis(chosen[figure], 1, 0), optimize=True)

        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                batch = whole.slice(start, 64)
                counted = np.zeros((3, batch.num_rows, 1 << len(FILTERS)), np.int64)
                for p, row in enumerate(batch.column("cells").to_pylist()):
                    for cell in row:
                        counted[:, p, cell["fails"]] = cell["docs"], cell["good"], cell["toxic"]
                docs, good, toxic = counted.reshape(3, batch.num_rows, *[2] * len(FILTERS))
                removed = select(docs, "removed")
                each = np.stack([removed[:, own == i].sum(axis=1) for i in range(len(FILTERS))], axis=1)
                figures = [
                    select(docs, "kept"), removed, select(docs, "failed") - removed, select(docs, "unique_fails"),
                    select(good, "removed"), select(toxic, "removed"), each[:, own],
                ]
                yield batch_of(
                    _AUDIT, np.repeat(np.array(batch.column("part").to_pylist(), object), len(steps)),
                    [order for order, _ in steps] * batch.num_rows, [step for _, step in steps] * batch.num_rows,
                    *[f.ravel() for f in figures],
                )

    return packed.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{f} long" for f in _FIGURES))


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "source", settings: Settings = Settings()) -> DataFrame:
    """The whole audit: see ``contract`` for its rows."""
    return contract(cells(durable(outcomes(docs, labels, part_col, settings), "filter-outcomes")))
