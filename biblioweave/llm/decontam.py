"""Benchmark decontamination: spaced seeds find passages that share most words in place, then the alignment is counted."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import append, batch_of, slices, texts

WORD = re.compile(r"\w+")
# Masks of words that must agree; 0 marks a word that may differ. However four words of twenty are substituted, one
# of these masks finds a place where it agrees (``lossless``).
MASKS = ("11101111", "1110100000111", "1101000100010011", "1101001011000001", "101010101101")
_HITS = "doc_id long, item_id long, start_word long, end_word long, same_words long, share double"
_HITS_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int64()), ("end_word", pa.int64()),
    ("same_words", pa.int64()), ("share", pa.float64()),
])


@dataclass(frozen=True)
class Settings:
    """A document is contaminated where ``window`` aligned words (or a whole shorter item) agree in ``share``.

    ``block_words`` bounds the words of the benchmark items that a task holds at once; a larger benchmark is
    taken in several blocks, each against all documents. Where ``masks`` can miss an overlap of this window and
    share, a run of words that cannot is added to them.
    """

    masks: tuple[str, ...] = MASKS
    window: int = 20
    share: float = 0.8
    block_words: int = 1_000_000


@dataclass(frozen=True)
class Index:
    """Words of a block of items and its sorted seed hashes."""

    vocabulary: dict[str, int]
    item_ids: np.ndarray
    words: np.ndarray
    begins: np.ndarray
    lengths: np.ndarray
    seeds: list[tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]]  # places, span, hashes, item, position


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _hashes(ids: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """Hash of the words at ``places`` of every window start 0 ... n - 1."""
    h = np.zeros(n, np.uint64)
    for p in places:
        h = _mix(h + ids[p : p + n].astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    return h


def misses(words: int, share: float) -> int:
    """How many of ``words`` aligned words may differ."""
    return max(m for m in range(words + 1) if m == 0 or words - m >= share * words)


def lossless(masks: tuple[str, ...], window: int, free: int) -> bool:
    """Whether no ``free`` substitutions in ``window`` words touch every place of every mask."""
    places = [
        frozenset(s + i for i, c in enumerate(m) if c == "1") for m in masks for s in range(window - len(m) + 1)
    ]

    def escapes(left: list[frozenset[int]], free: int) -> bool:
        if not left or not free:
            return not left
        return any(escapes([p for p in left if at not in p], free - 1) for at in left[0])

    return not escapes(places, free)


def masks_of(settings: Settings) -> tuple[str, ...]:
    """The masks for items of ``window`` words or more: of the words left alike, one run has at least the mean length."""
    free = misses(settings.window, settings.share)
    if free <= 5 and lossless(settings.masks, settings.window, free):
        return settings.masks
    return (*settings.masks, "1" * max(1, -(-(settings.window - free) // (free + 1))))


def build_index(items: list[tuple[int, str]], settings: Settings) -> Index:
    """Items of fewer words than the window are cut into one part more than words may differ: one part agrees."""
    vocabulary: dict[str, int] = {}
    bodies, ids = [], []
    for item_id, text in items:
        own = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        if own:
            ids.append(item_id)
            bodies.append(np.array(own, np.int64))
    lengths = np.array([len(b) for b in bodies], np.int64)
    parts: dict[tuple[int, ...], list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

    def seed(places: np.ndarray, i: int, first: int, n: int) -> None:
        at = np.arange(first, first + n)
        parts.setdefault(tuple(places.tolist()), []).append((_hashes(bodies[i][first:], places, n), np.full(n, i), at))

    masks = [np.array([i for i, c in enumerate(m) if c == "1"]) for m in masks_of(settings)]
    for i, n in enumerate(lengths):
        if n >= settings.window:
            for places in masks:
                if n > places[-1]:
                    seed(places, i, 0, int(n - places[-1]))
        else:
            for part in np.array_split(np.arange(n), misses(int(n), settings.share) + 1):
                if len(part):
                    seed(part - part[0], i, int(part[0]), 1)
    seeds = []
    for key, made in parts.items():
        h, item, position = (np.concatenate(x) for x in zip(*made))
        order = np.argsort(h, kind="stable")
        seeds.append((np.array(key), key[-1] + 1, h[order], item[order], position[order]))
    words = np.concatenate(bodies) if bodies else np.zeros(0, np.int64)
    return Index(vocabulary, np.array(ids, np.int64), words, np.cumsum(lengths) - lengths, lengths, seeds)


def find(ids: np.ndarray, doc_of: np.ndarray, begins: np.ndarray, counts: np.ndarray, index: Index, settings: Settings):
    """(document, item, first word, end word, same words, share) for the words of several documents laid end to end.

    Seeds that agree name a document, an item and the shift between them; each such alignment is verified once.
    """
    found = []
    for places, span, hashes, item, position in index.seeds:
        n = len(ids) - span + 1
        if n <= 0:
            continue
        # Only windows whose first and last words the benchmark knows can agree.
        maybe = np.flatnonzero((ids[:n] > 0) & (ids[span - 1 : span - 1 + n] > 0) & (doc_of[:n] == doc_of[span - 1 : span - 1 + n]))
        for p in places[1:-1]:
            maybe = maybe[ids[maybe + p] > 0]
        if not len(maybe):
            continue
        h = np.zeros(len(maybe), np.uint64)
        for p in places:
            h = _mix(h + ids[maybe + p].astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
        low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        for one in _pieces(high - low):
            times = (high - low)[one]
            hit = np.repeat(np.arange(one.start, one.stop), times)
            at = np.repeat(low[one], times) + np.arange(len(hit)) - np.repeat(np.cumsum(times) - times, times)
            doc = doc_of[maybe[hit]]
            found.append(_distinct(np.stack([doc, item[at], maybe[hit] - begins[doc] - position[at]])))
    if not found:
        return []
    out = []
    for doc, item, shift in _likely(_distinct(np.concatenate(found, 1)), ids, begins, counts, index, settings).T:
        own = index.words[index.begins[item] : index.begins[item] + index.lengths[item]]
        first, last = max(0, shift), min(counts[doc], shift + len(own))
        same = ids[begins[doc] + first : begins[doc] + last] == own[first - shift : last - shift]
        width = min(settings.window, len(own))
        total = np.concatenate([[0], np.cumsum(same)])
        sums = total[width:] - total[:-width]
        best = int(sums.argmax())
        if sums[best] >= settings.share * width:
            good = np.flatnonzero(sums >= settings.share * width)
            start, end = first + int(good[0]), first + int(good[-1]) + width
            agree = int(total[good[-1] + width] - total[good[0]])
            out.append((int(doc), int(item), start, end, agree, sums[best] / width))
    return out


def _pieces(sizes: np.ndarray, budget: int = 1 << 20) -> Iterator[slice]:
    """Runs of entries whose sizes add up to about ``budget``; entries of nothing on their own are left out."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes) and ends[-1] > (ends[start - 1] if start else 0):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + budget, "right")))
        yield slice(start, stop)
        start = stop


def _distinct(rows: np.ndarray) -> np.ndarray:
    rows = rows[:, np.lexsort(rows[::-1])]
    fresh = np.ones(rows.shape[1], bool)
    fresh[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)
    return rows[:, fresh]


def _likely(rows: np.ndarray, ids: np.ndarray, begins: np.ndarray, counts: np.ndarray, index: Index, settings: Settings) -> np.ndarray:
    """Alignments (document, item, shift) that are long enough and have, over all their words, enough words alike."""
    doc, item, shift = rows
    width = np.minimum(settings.window, index.lengths[item])
    first = np.maximum(0, shift)
    size = np.minimum(counts[doc], shift + index.lengths[item]) - first
    rows, first, size, width = rows[:, size >= width], first[size >= width], size[size >= width], width[size >= width]
    alike = np.zeros(len(size), np.int64)
    for one in _pieces(size):
        doc, item, shift = rows[:, one]
        n = size[one]
        heads = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(heads, n)
        here = ids[np.repeat(begins[doc] + first[one], n) + step]
        there = index.words[np.repeat(index.begins[item] + first[one] - shift, n) + step]
        alike[one] = np.add.reduceat((here == there).astype(np.int64), heads)
    return rows[:, alike >= settings.share * width]


def hits_of(bodies: list[str], index: Index, settings: Settings):
    """``find`` over whole texts."""
    known = index.vocabulary.get
    found = [[known(w, 0) for w in words_of(t)] for t in bodies]
    counts = np.array([len(f) for f in found], np.int64)
    ids = np.fromiter((i for f in found for i in f), np.int64, int(counts.sum()))
    doc_of = np.repeat(np.arange(len(found)), counts)
    return find(ids, doc_of, np.cumsum(counts) - counts, counts, index, settings)


def with_flag(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add ``contaminated`` to every row; all other columns pass through. No shuffle, whole texts, as in ``overlaps``."""
    spark = docs.sparkSession
    flagged = docs.withColumn("contaminated", F.lit(False))
    for block in blocks(items, settings, "item_id", "text"):
        shared = spark.sparkContext.broadcast(build_index(block, settings))

        def make(shared=shared):
            def flags(bodies: list[str]):
                out = np.zeros(len(bodies), bool)
                out[[h[0] for h in hits_of(bodies, shared.value, settings)]] = True
                return (out,)

            return flags

        found = append(flagged, make, {"_in_block": ("boolean", pa.bool_())})
        flagged = found.withColumn("contaminated", F.col("contaminated") | F.col("_in_block")).drop("_in_block")
    return flagged


def blocks(items: DataFrame, settings: Settings, id_col: str, text_col: str):
    """The benchmark in runs of about ``block_words`` words, read from Spark one row at a time."""
    held, size = [], 0
    for row in texts(items, id_col, text_col).toLocalIterator():
        held.append((row.doc_id if row.doc_id is not None else -1, row.text))
        size += len(row.text) // 2 + 1
        if size >= settings.block_words:
            yield held
            held, size = [], 0
    if held:
        yield held


def overlaps(
    docs: DataFrame, items: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, start_word, end_word, same_words, share`` of every verified overlap, whole texts, no shuffle.

    Null and empty texts overlap nothing, an item without words is never found, a null item id is shown as -1;
    repeated documents each give their rows; an empty side gives an empty result.
    """
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col)
    results = [spark.createDataFrame([], _HITS)]
    for block in blocks(items, settings, item_id_col, item_text_col):
        shared = spark.sparkContext.broadcast(build_index(block, settings))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for whole in batches:
                for batch in slices(whole, "text"):
                    hits = hits_of(batch.column("text").to_pylist(), index, settings)
                    if hits:
                        doc_ids = batch.column("doc_id").to_pylist()
                        yield batch_of(_HITS_ARROW, *zip(*[(doc_ids[d], int(index.item_ids[i]), *rest) for d, i, *rest in hits]))

        results.append(rows.mapInArrow(run, _HITS))
    out = results[0]
    for part in results[1:]:
        out = out.unionByName(part)
    return out


def judge(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_items, n_overlaps, share`` of every contaminated document id, by its whole text."""
    return overlaps(docs, items, settings).groupBy("doc_id").agg(
        F.countDistinct("item_id").alias("n_items"), F.count(F.lit(1)).alias("n_overlaps"), F.max("share").alias("share"),
        F.sort_array(F.collect_set("item_id")).alias("item_ids"),
    )
