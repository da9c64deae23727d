"""Near-duplicates: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.durable import durable
from .common import batch_of, slices, texts
from .components import components

WORD = re.compile(r"\w+")
_APART = {c: " " for c in range(128) if not WORD.fullmatch(chr(c))}  # what no word of an ASCII text holds
_SIGNATURES = "doc_id long, copy long, node long, signature array<int>"
_SIGNATURES_ARROW = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("node", pa.int64()), ("signature", pa.list_(pa.int32()))])
_CHUNK = 1 << 12
_NEAR = 1 << 14


@dataclass(frozen=True)
class Settings:
    """``bands`` of ``rows`` samples each: at the similarity of 0.8 a pair shares a band with a probability of 0.9992.

    Document frequencies are counted in ``slots`` hashed counters, which bound the true ones from above; pairs that
    these bounds leave open are counted exactly. The bound 1/9 of ``near_duplicates`` is that of a similarity of 0.8
    or more.
    """

    words: int = 5
    similarity: float = 0.8
    bands: int = 10
    rows: int = 3
    slots: int = 1 << 20

    @property
    def samples(self) -> int:
        return self.bands * self.rows


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class _Words(dict):
    """The eight bytes of a hash of each word, kept for the most recent 300,000 words of a task."""

    def __missing__(self, word: str) -> bytes:
        if len(self) >= 300_000:
            self.clear()
        self[word] = digest = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        return digest


def _letters(codes: np.ndarray) -> np.ndarray:
    return _mix((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def _places(n: int) -> np.ndarray:
    return _mix((np.arange(n).astype(np.uint64) + np.uint64(1)) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


_LOWER = np.array([ord(chr(c).lower()) if c not in _APART else 0 for c in range(128)] + [0] * 128, np.uint8)
_LETTERS, _FIRST_PLACES = _letters(np.arange(128)), _places(64)


class _Quick(_Words):
    """Other hashes of the same words, summed up over letters and places, which is cheaper for a whole run of texts.

    Signatures, counters and nodes go by ``_Words``; these are for true frequencies, which are asked for by the same hashes.
    """

    def words(self, bodies: list[str]) -> tuple[np.ndarray, np.ndarray]:
        hashes, counts, run, held = [], [], [], 0
        for text, following in zip(bodies, [*bodies[1:], None]):
            run.append(text)
            held += len(text)
            if following is None or held > 1 << 17 or following.isascii() != text.isascii():
                self._run(run, hashes, counts)
                run, held = [], 0
        return np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate([np.zeros(0, np.int64), *counts])

    def _run(self, run: list[str], hashes: list, counts: list) -> None:
        if run[0].isascii():
            letter = _LOWER[np.frombuffer("\n".join(["", *run]).encode(), np.uint8)]
            values, inside = _LETTERS, letter > 0
        else:
            run = [t.lower() for t in run]
            letter = np.frombuffer("\n".join(["", *run]).encode("utf-32-le", "surrogatepass"), "<u4")
            values, inside = None, _inside()[letter]
        at = np.flatnonzero(inside)
        heads = np.flatnonzero(~inside[at - 1])
        ends = np.cumsum([len(t) + 1 for t in run])
        counts.append(np.diff(np.searchsorted(at[heads], ends, "right"), prepend=0))
        if len(heads):
            sizes = np.diff(np.append(heads, len(at)))
            place = np.arange(len(at)) - np.repeat(heads, sizes)
            by_place = _FIRST_PLACES if sizes.max() <= len(_FIRST_PLACES) else _places(int(sizes.max()))
            values = _letters(letter[at]) if values is None else values[letter[at]]
            hashes.append(_mix(_mix(np.add.reduceat(values * by_place[place], heads)) + sizes.astype(np.uint64)))


@cache
def _inside() -> np.ndarray:
    """Whether each code point belongs to words, as ``WORD`` has it."""
    return np.array([chr(c).isalnum() or c == 95 for c in range(0x110000)])


def shingles(bodies: list[str], known: _Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, count) of the different shingles of each text, ordered by document.

    Words are lower-cased. A text of fewer words than ``size`` is one shingle, one without words none.
    """
    flat, counts = words(bodies, known)
    return shingles_of(flat, counts, size)


def words(bodies: list[str], known: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words of the texts, one after another, and the number of words of each text."""
    if isinstance(known, _Quick):
        return known.words(bodies)
    found = [t.lower().translate(_APART).split() if t.isascii() else WORD.findall(t.lower()) for t in bodies]
    counts = np.array([len(f) for f in found], np.int64)
    return np.frombuffer(b"".join(list(map(known.__getitem__, chain.from_iterable(found)))), "<u8"), counts


def sequences(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each text's words in their order; zero for texts without words."""
    out = np.zeros(len(counts), np.uint64)
    begins, filled = np.cumsum(counts) - counts, counts > 0
    if filled.any():
        place = np.arange(len(flat)) - np.repeat(begins, counts)
        mixed = _mix(_mix(flat) + _mix((place + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        out[filled] = _mix(np.add.reduceat(mixed, begins[filled]) + counts[filled].astype(np.uint64))
    return out


def shingles_of(flat: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``shingles`` of texts given by ``words``."""
    doc, h = runs_of(flat, counts, size)
    cuts = [0, *(np.flatnonzero(doc[1:] != doc[:-1]) + 1).tolist(), len(doc)]
    for begin, end in zip(cuts, cuts[1:]):
        h[begin:end].sort()
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    heads = np.flatnonzero(fresh)
    return doc[heads], h[heads], np.diff(np.append(heads, len(doc)))


def runs_of(flat: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of all shingles, equal ones too, ordered by document."""
    doc_of = np.repeat(np.arange(len(counts)), counts)
    n = max(0, len(flat) - size + 1)
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = _mix(h + flat[i : i + n] + np.uint64(0x9E3779B97F4A7C15))
    inside = doc_of[:n] == doc_of[size - 1 : size - 1 + n]
    docs, hashes = [doc_of[:n][inside]], [h[inside]]
    begins = np.cumsum(counts) - counts
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        own = np.zeros(1, np.uint64)
        for w in flat[begins[i] : begins[i] + counts[i]]:
            own = _mix(own + w + np.uint64(0x9E3779B97F4A7C15))
        docs.append(np.array([i]))
        hashes.append(own + np.uint64(counts[i]))
    doc, h = np.concatenate(docs), np.concatenate(hashes)
    if len(docs) > 1:
        order = np.argsort(doc, kind="stable")
        doc, h = doc[order], h[order]
    return doc, h


def _slot(h: np.ndarray, slots: int) -> np.ndarray:
    high = (h >> np.uint64(20)).astype(np.int64)
    return high % slots if slots & (slots - 1) else high & (slots - 1)


def document_frequencies(docs: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """Documents per hashed shingle, and the number of documents, over all rows.

    Tasks add up counters of a fixed number and send them in compressed pieces, which are summed piece by piece:
    neither the shuffle per task nor the result grows with the data. Shingles that share a counter add up, so a
    counter is never less than the true count.
    """
    schema = pa.schema([("piece", pa.int64()), ("docs", pa.int64()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, n = _Words(), np.zeros(settings.slots, np.int64), 0
        for whole in batches:
            for batch in slices(whole, "text"):
                _, h, _ = shingles(batch.column("text").to_pylist(), known, settings.words)
                total += np.bincount(_slot(h, settings.slots), minlength=settings.slots)
                n += batch.num_rows
        pieces = [p for p in range(0, settings.slots, _CHUNK) if total[p : p + _CHUNK].any()]
        yield batch_of(
            schema, [-1, *pieces], [n, *[0] * len(pieces)],
            [b"", *[zlib.compress(total[p : p + _CHUNK].tobytes(), 1) for p in pieces]],
        )

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(min(_CHUNK, settings.slots), np.int64)
        for batch in batches:
            for c in batch.column("counts").to_pylist():
                total += np.frombuffer(zlib.decompress(c), np.int64)
        yield batch_of(schema, [key[0].as_py()], [0], [zlib.compress(total.tobytes(), 1)])

    parts = texts(docs).mapInArrow(count, "piece long, docs long, counts binary")
    parts = durable(parts, "shingle-counts")
    rows = parts.where("piece >= 0").groupBy("piece").applyInArrow(add, "piece long, docs long, counts binary").collect()
    frequency = np.zeros(settings.slots, np.int64)
    for r in rows:
        frequency[r.piece : r.piece + _CHUNK] = np.frombuffer(zlib.decompress(r.counts), np.int64)
    return frequency, parts.where("piece < 0").agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]


def inverse_frequencies(frequency: np.ndarray, n: int) -> np.ndarray:
    """Weight per counter, 1 for what stands in every document and growing slowly with rarity.

    Half a natural logarithm: the words that an editor has changed are rarer than those of a large group of copies,
    and a full logarithm would let them outweigh the group's common text.
    """
    return true_weights(frequency, n).astype(np.float32)


def true_weights(frequency: np.ndarray, n: int) -> np.ndarray:
    return 1 + 0.5 * np.log(1 + n / np.maximum(frequency, 1.0)) / np.log(1 + max(n, 1))


def typical(frequency: np.ndarray) -> np.ndarray:
    """Counters less what the other shingles of a counter add to it; only to draw signatures with."""
    return np.maximum(frequency - int(np.median(frequency)), 1)


class _Samples:
    """Random parts of consistent weighted sampling, drawn by hash from tables of quantiles."""

    def __init__(self, samples: int):
        draw = np.random.RandomState(20_241).gamma(2.0, 1.0, (2, 1 << 16)).astype(np.float32)
        self.r, self.log_c = np.maximum(draw[0], 1e-3), np.log(np.maximum(draw[1], 1e-6))
        self.seeds = [_mix(np.array([s + 1], np.uint64) * np.uint64(0xA0761D6478BD642F))[0] for s in range(samples)]

    def signatures(self, doc: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """Per document and sample a hash of the chosen (shingle, level); documents without shingles have zeros."""
        out = np.zeros((n, len(self.seeds)), np.int32)
        if not len(doc):
            return out
        heads = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        log_w = np.log(weight).astype(np.float32)
        # Whole documents at a time, so few that what is made of them stays in a core's cache.
        firsts = np.flatnonzero(np.append(True, np.diff(heads // _NEAR) > 0))
        for begin, end in zip(firsts, [*firsts[1:], len(heads)]):
            rows = slice(heads[begin], heads[end] if end < len(heads) else len(doc))
            self._sign(out, doc[rows], h[rows], log_w[rows], heads[begin:end] - heads[begin])
        return out

    def _sign(self, out: np.ndarray, doc: np.ndarray, h: np.ndarray, log_w: np.ndarray, heads: np.ndarray) -> None:
        own, sizes = doc[heads], np.diff(np.append(heads, len(doc)))
        for s, seed in enumerate(self.seeds):
            z = _mix(h ^ seed)
            r = self.r[(z & np.uint64(0xFFFF)).view(np.int64)]
            beta = ((z >> np.uint64(32)).view(np.int64).astype(np.float32)) * np.float32(2.0**-32)
            level = np.floor(log_w / r + beta)
            log_a = self.log_c[((z >> np.uint64(16)) & np.uint64(0xFFFF)).view(np.int64)] - r * (level - beta + 1)
            best = np.minimum.reduceat(log_a, heads)
            at = np.flatnonzero(log_a == np.repeat(best, sizes))
            owner = doc[at]
            first = at[np.append(True, owner[1:] != owner[:-1])]
            picked = _mix(h[first] ^ (level[first].astype(np.int64).view(np.uint64) << np.uint64(40)))
            out[own, s] = (picked >> np.uint64(32)).astype(np.uint32).view(np.int32)


def signatures(docs: DataFrame, weights, settings: Settings) -> DataFrame:
    """``doc_id, copy, node, signature`` of every row; ``node`` is a hash of the words (of the text where there are none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, samples, table = _Words(), _Samples(settings.samples), weights.value
        for whole in batches:
            for batch in slices(whole, "text"):
                bodies = batch.column("text").to_pylist()
                flat, counts = words(bodies, known)
                doc, h, count = shingles_of(flat, counts, settings.words)
                made = samples.signatures(doc, h, table[_slot(h, settings.slots)] * count, len(bodies))
                nodes = sequences(flat, counts).view(np.int64)
                for i in np.flatnonzero(counts == 0):
                    digest = hashlib.blake2b(bodies[i].encode("utf-8", "surrogatepass"), digest_size=8).digest()
                    nodes[i] = int.from_bytes(digest, "little", signed=True)
                yield batch_of(_SIGNATURES_ARROW, batch.column("doc_id"), batch.column("copy"), nodes, list(made))

    rows = texts(docs).withColumn("copy", F.xxhash64("text")).select("doc_id", "copy", "text")
    return rows.mapInArrow(run, _SIGNATURES)


_COMPARED = "a long, b long, crowded boolean, low double, high double, same double, same_low double, same_count long, shingles array<long>, gaps array<int>, totals array<int>, idfs array<float>"
_COMPARED_ARROW = pa.schema([
    ("a", pa.int64()), ("b", pa.int64()), ("crowded", pa.bool_()), ("low", pa.float64()), ("high", pa.float64()), ("same", pa.float64()),
    ("same_low", pa.float64()), ("same_count", pa.int64()),
    ("shingles", pa.list_(pa.int64())), ("gaps", pa.list_(pa.int32())), ("totals", pa.list_(pa.int32())), ("idfs", pa.list_(pa.float32())),
])
_HEADS = "hub long, node long, failed boolean, least double, own array<long>, any array<long>, own_left array<double>, any_left array<double>"
_HEADS_ARROW = pa.schema([
    ("hub", pa.int64()), ("node", pa.int64()), ("failed", pa.bool_()), ("least", pa.float64()), ("own", pa.list_(pa.int64())), ("any", pa.list_(pa.int64())),
    ("own_left", pa.list_(pa.float64())), ("any_left", pa.list_(pa.float64())),
])
_TERMS = "a long, b long, shingle long, gap long, total long"
_TERMS_ARROW = pa.schema([(c, pa.int64()) for c in ("a", "b", "shingle", "gap", "total")])
_BITS, _PIECE, _FINE = 1 << 26, 1 << 20, 1 << 22
_STEPS = 2.0 ** (np.arange(256) / 8)


def in_both(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    left = bodies.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = bodies.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select(*pairs.columns, "text_a", "text_b")


def differences(batch: pa.RecordBatch, known: _Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, count in b less that in a, count in both) of the different shingles of each row's two texts."""
    one = shingles(batch.column("text_a").to_pylist(), known, size)
    two = shingles(batch.column("text_b").to_pylist(), known, size)
    doc, h = np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]])
    count = np.concatenate([-one[2], two[2]])
    order = np.lexsort((h, doc))
    doc, h, count = doc[order], h[order], count[order]
    heads = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]))[: len(doc)])
    if not len(heads):
        return doc, h, count, count
    return doc[heads], h[heads], np.add.reduceat(count, heads), np.add.reduceat(np.abs(count), heads)


def compared(pairs: DataFrame, bodies: DataFrame, bounds, settings: Settings) -> DataFrame:
    """``a, b, crowded, low, high, ...``: bounds of the weighted Jaccard similarity of each pair's whole texts.

    ``bounds`` are the least weight per counter, and the weights of what stands in one document and in two: a shingle
    is no lighter than its counter says, and no heavier than what the pair itself shows.
    For ``crowded`` pairs also where ``b`` differs from ``a``: signed shingles with their gaps, counts in both and least
    weights, and ``same``, the most that all other shingles can weigh, ``same_low``, the least, and ``same_count``, how many there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (table, single, double) = _Words(), bounds.value
        for whole in batches:
            for batch in slices(whole, "text_a"):
                n, pair = batch.num_rows, [batch.column(c) for c in ("a", "b", "crowded")]
                doc, h, gap, total = differences(batch, known, settings.words)
                if not len(doc):
                    yield batch_of(_COMPARED_ARROW, *pair, *[np.zeros(n)] * 4, np.zeros(n, np.int64), *[[[]] * n] * 4)
                    continue
                idf = table[_slot(h, settings.slots)]
                top = np.maximum(idf, np.where(np.abs(gap) < total, double, single))
                apart, most_apart = np.bincount(doc, np.abs(gap) * idf, n), np.bincount(doc, np.abs(gap) * top, n)
                same = (total - np.abs(gap)) / 2
                alike, most_alike = np.bincount(doc, same * idf, n), np.bincount(doc, same * top, n)
                low = alike / np.maximum(alike + most_apart, 1e-9)
                high = most_alike / np.maximum(most_alike + apart, 1e-9)
                equal, equal_low, equals = (np.bincount(doc, np.where(gap == 0, total * w, 0), n) for w in (top, idf, 1))
                keep = (gap != 0) & np.array(batch.column("crowded").to_pylist(), bool)[doc]
                doc, h, gap, total, idf = (x[keep] for x in (doc, h, gap, total, idf))
                signed = _mix(h ^ (gap > 0).astype(np.uint64)).view(np.int64)
                cuts = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(x, kind)) for x, kind in
                    ((signed, pa.int64()), (gap.astype(np.int32), pa.int32()), (total.astype(np.int32), pa.int32()), (idf.astype(np.float32), pa.float32()))
                ]
                yield batch_of(_COMPARED_ARROW, *pair, low, high, equal, equal_low, equals.astype(np.int64), *lists)

    return in_both(pairs, bodies).mapInArrow(run, _COMPARED)


def head(least: np.ndarray, most: np.ndarray):
    """A function of ``less``: the length of the shortest head whose ``least`` sum is above the ``most`` sum of the rest plus ``less``."""
    both, total = np.cumsum(least + most), most.sum()

    def length(less: float) -> int:
        bound = (total + less) * (1 + 1e-6) + 1e-6 if total + less > -1e-6 else total + less
        return 0 if bound < 0 else min(int(np.searchsorted(both, bound, "right")) + 1, len(both))

    return length


def _grade(weight: float) -> int:
    """Grades double; ``_grade_from`` is where one begins."""
    return int(np.log2(weight)) if weight >= 1 else 0


def _grade_from(grade: int) -> float:
    return 2.0**grade if grade > 0 else 0.0


def heads(found: DataFrame, bounds, n: int = 0) -> DataFrame:
    """``hub, node, failed, least, own, any, ...`` of all members of hubs where a member fails: the differences to look others up by.

    All members of a hub h put their differences in one order, those that fewest members have ahead: what h has alone
    all others lack, and it comes last. Write w for weights and D for the weight of the difference from h. Members x and y
    link only where they share N = (D(x) + D(y) - (w(x) + w(y)) / 9) / 2 or more of their differences, and where neither
    is heavier than 5/4 of the other nor D(x) and D(y) are further apart than w / 4. Whatever the other one is, N is at
    least (D - w / 4) / 2 of the one, plus half of the other one's D, which is known by its grade. Where x has failed, so
    D(x) = (w(x) + w(h)) / 9 + t with t > 0, N is at least t / 2 and more than (D(y) - (w(y) - w(h)) / 9) / 2 too.
    So each member gives, for every grade that its partner can have, the head of its list behind which less than N is
    left: the first difference that two members share stands in the heads of both. ``own`` is for failed partners, ``any``
    what a failed member looks for. Values are hashes of the difference and both grades, so that only members of these grades
    meet. Differences of a 16th of the members or more are counted, at most 16 times the mean list per hub.

    Where the number ``n`` of documents is given, what the group shows bounds weights from above: a shingle that the hub holds
    stands in all members that do not lack it, one that k members have and the hub lacks in k documents.
    ``least`` is at most D(x) - w(x) / 9, so two members' sum is 2 N or less. ``own_left`` and ``any_left`` are, for each
    value, the most that its difference and all after it weigh: the first difference that two linked members share has no
    less than N there, on both sides.
    """
    wide = found.where("crowded").select(
        F.col("a").alias("hub"), F.col("b").alias("node"), (~F.col("close")).alias("failed"), "same", "same_low", "same_count",
        "shingles", "gaps", "totals", "idfs",
    )
    hubs = wide.groupBy("hub").agg(F.count(F.lit(1)).alias("members"), F.max("failed").alias("open")).where("open").select("hub", "members")
    wide = wide.join(hubs, "hub")
    often = (
        wide.select("hub", "members", F.explode("shingles").alias("shingle")).groupBy("hub", "shingle")
        .agg(F.count(F.lit(1)).alias("n"), F.first("members").alias("members")).where("n > 1 AND 16 * n >= members")
        .groupBy("hub").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("often"))
    )
    listed = wide.join(often, "hub", "left").select(
        "hub", "node", "failed", "same", "same_low", "same_count", "shingles", "gaps", "totals", "idfs", "members",
        F.col("often.n").alias("times"), F.col("often.shingle").alias("often"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, single, double = bounds.value
        hub, place, common, times = None, *[np.zeros(0, np.int64)] * 3

        def keys(ids: np.ndarray, x: int, y: int) -> np.ndarray:
            return _mix(ids.view(np.uint64) ^ np.uint64((x << 10 | y) * 0x9E3779B97F4A7C15 % (1 << 64))).view(np.int64)

        for batch in batches:
            least_, own, any_, own_left, any_left = [], [], [], [], []
            hubs, failed, same, same_low, same_count, members = (
                batch.column(c).to_pylist() for c in ("hub", "failed", "same", "same_low", "same_count", "members")
            )
            for i in range(batch.num_rows):
                if hub != hubs[i]:
                    hub, (common, times) = hubs[i], (batch.column(c)[i].values for c in ("often", "times"))
                    common, times = (np.zeros(0, np.int64) if c is None else c.to_numpy() for c in (common, times))
                    order = np.argsort(common, kind="stable")
                    place, common, times = order + 1, common[order], times[order]
                ids, gap, total, idf = (batch.column(c)[i].values.to_numpy() for c in ("shingles", "gaps", "totals", "idfs"))
                rank, held = np.zeros(len(ids), np.int64), np.where(gap < 0, members[i] - max(1, (members[i] - 1) // 16) + 1, 1)
                often_lacked = max(1, (members[i] - 1) // 16)
                if len(common) and len(ids):
                    at = np.minimum(np.searchsorted(common, ids), len(common) - 1)
                    listed_here = common[at] == ids
                    rank = np.where(listed_here, place[at], 0)
                    held = np.where(listed_here, np.where(gap < 0, members[i] - times[at] + 1, times[at]), held)
                    others = np.ones(len(common), bool)
                    others[at[listed_here]] = False
                    often_lacked = max(often_lacked, times[others].max(initial=0))
                line = np.lexsort((ids, -idf, rank))
                ids, gap, total, held = ids[line], gap[line].astype(float), total[line].astype(float), held[line]
                idf = idf[line].astype(float) * (1 - 1e-6)
                size = np.abs(gap)
                top, alike = np.where(size < total, double, single), same[i]
                if n:
                    top = np.minimum(top, true_weights(held, n))
                    alike = min(alike, same_count[i] * float(true_weights(np.array([members[i] - often_lacked + 1]), n)[0]))
                top = np.maximum(idf, top)
                weighed = lambda part: np.where(part > 0, idf, top) * part
                far, heavy = (size * idf).sum(), ((total + gap) * top).sum() / 2 + alike / 2
                light = ((total + gap) / 2 * idf).sum() + same_low[i] / 2 * (1 - 1e-6)
                light_hub = ((total - gap) / 2 * idf).sum() + same_low[i] / 2 * (1 - 1e-6)
                least_.append(max(weighed(size - (total + gap) / 18).sum() - alike / 18, light_hub / 9 if failed[i] else -np.inf))
                left = np.cumsum((size * top)[::-1])[::-1]
                grade, last = _grade(far), _grade((far + heavy / 4) * (1 + 1e-6))
                by_far = head(weighed(size / 2 - (total + gap) / 16), top * (size / 2 + (total + gap) / 16))
                as_partner = head(idf * (size / 2 - gap / 18), top * (size / 2 + gap / 18))(0.0)
                # Grades go by D in least weights, which differs by w / 4 at most too; ``single`` times it is more than the true D.
                near = (far - heavy / 4) * (1 - 1e-6)
                least = max(near, (0.8 * light + light_hub) / 9 / single * (1 - 1e-6))
                cuts = [
                    (g, min(as_partner, by_far(alike / 16 - _grade_from(g) / 2))) for g in range(last + 1) if _grade_from(g + 1) > least
                ]
                own.append(np.concatenate([ids[:0]] + [keys(ids[:cut], g, grade) for g, cut in cuts]))
                own_left.append(np.concatenate([left[:0]] + [left[:cut] for _, cut in cuts]))
                cuts = []
                if failed[i]:
                    as_failed = head(weighed(size / 2 - total / 18), top * (size / 2 + total / 18))(alike / 18)
                    cuts = [
                        (g, min(as_failed, by_far(alike / 16 - _grade_from(g) / 2))) for g in range(last + 1) if _grade_from(g + 1) > near
                    ]
                any_.append(np.concatenate([ids[:0]] + [keys(ids[:cut], grade, g) for g, cut in cuts]))
                any_left.append(np.concatenate([left[:0]] + [left[:cut] for _, cut in cuts]))
            if batch.num_rows:
                yield batch_of(_HEADS_ARROW, *(batch.column(c) for c in ("hub", "node", "failed")), least_, own, any_, own_left, any_left)

    return listed.mapInArrow(run, _HEADS)


def frequencies(nodes: DataFrame, bodies: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """``shingle, df``: the true document frequencies of all shingles of the texts of ``nodes`` (and of some others), over all rows of ``docs``.

    A bitmap of fixed size keeps most shingles that no such text holds out of the count.
    """
    marked = pa.schema([("piece", pa.int64()), ("bits", pa.binary())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = _Quick(), np.zeros(_BITS // 8, np.uint8)
        for whole in batches:
            for batch in slices(whole, "text"):
                _, h = runs_of(*words(batch.column("text").to_pylist(), known), settings.words)
                at = _slot(h, _BITS)
                np.bitwise_or.at(bits, at >> 3, (128 >> (at & 7)).astype(np.uint8))
        pieces = [p for p in range(0, _BITS, _PIECE) if bits[p // 8 : (p + _PIECE) // 8].any()]
        yield batch_of(marked, pieces, [zlib.compress(bits[p // 8 : (p + _PIECE) // 8].tobytes(), 1) for p in pieces])

    def unite(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(_PIECE // 8, np.uint8)
        for batch in batches:
            for c in batch.column("bits").to_pylist():
                bits |= np.frombuffer(zlib.decompress(c), np.uint8)
        yield batch_of(marked, [key[0].as_py()], [bits.tobytes()])

    wanted = np.zeros(_BITS // 8, np.uint8)
    found = bodies.join(nodes, "node", "left_semi").select("text").mapInArrow(mark, "piece long, bits binary")
    for r in found.groupBy("piece").applyInArrow(unite, "piece long, bits binary").toLocalIterator():
        wanted[r.piece // 8 : (r.piece + _PIECE) // 8] = np.frombuffer(r.bits, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(wanted)
    counted = pa.schema([("shingle", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = _Quick(), shared.value
        for whole in batches:
            for batch in slices(whole, "text"):
                doc, h = runs_of(*words(batch.column("text").to_pylist(), known), settings.words)
                at = _slot(h, _BITS)
                asked = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
                doc, h = doc[asked], h[asked]
                order = np.lexsort((h, doc))
                doc, h = doc[order], h[order]
                fresh = np.append(True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]))[: len(h)]
                h, times = np.unique(h[fresh], return_counts=True)
                yield batch_of(counted, h.view(np.int64), times)

    counts = texts(docs).select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("df"))
    return durable(counts, "frequencies")


def _fine_slot(h: np.ndarray) -> np.ndarray:
    """Not from the bits that the bitmap goes by, or what that lets through by chance would meet the very shingle it passed for."""
    return _slot(_mix(h * np.uint64(0x9E3779B97F4A7C15)), _FINE)


def extremes(frequency: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Per hashed slot the least and the greatest frequency of its shingles, in eighths of an octave, rounded apart."""
    schema = pa.schema([("piece", pa.int64()), ("least", pa.binary()), ("most", pa.binary())])
    kinds = "piece long, least binary, most binary"

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, most = np.full(_FINE, 255, np.uint8), np.zeros(_FINE, np.uint8)
        for batch in batches:
            at, df = _fine_slot(batch.column("shingle").to_numpy().view(np.uint64)), batch.column("df").to_numpy()
            np.minimum.at(least, at, (np.searchsorted(_STEPS, df, "right") - 1).astype(np.uint8))
            np.maximum.at(most, at, np.searchsorted(_STEPS, df, "left").astype(np.uint8))
        pieces = [p for p in range(0, _FINE, _PIECE // 4) if (least[p : p + _PIECE // 4] < 255).any()]
        yield batch_of(schema, pieces, *[[zlib.compress(x[p : p + _PIECE // 4].tobytes(), 1) for p in pieces] for x in (least, most)])

    def unite(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, most = np.full(_PIECE // 4, 255, np.uint8), np.zeros(_PIECE // 4, np.uint8)
        for batch in batches:
            for x, y in zip(batch.column("least").to_pylist(), batch.column("most").to_pylist()):
                np.minimum(least, np.frombuffer(zlib.decompress(x), np.uint8), out=least)
                np.maximum(most, np.frombuffer(zlib.decompress(y), np.uint8), out=most)
        yield batch_of(schema, [key[0].as_py()], [least.tobytes()], [most.tobytes()])

    least, most = np.full(_FINE, 255, np.uint8), np.zeros(_FINE, np.uint8)
    for r in frequency.mapInArrow(gather, kinds).groupBy("piece").applyInArrow(unite, kinds).toLocalIterator():
        least[r.piece : r.piece + _PIECE // 4] = np.frombuffer(r.least, np.uint8)
        most[r.piece : r.piece + _PIECE // 4] = np.frombuffer(r.most, np.uint8)
    return least, most


def narrowed(pairs: DataFrame, bodies: DataFrame, extreme, n: int, settings: Settings) -> DataFrame:
    """``a, b, low, high``: bounds of each pair's similarity by the least and the greatest frequency in each shingle's slot."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("low", pa.float64()), ("high", pa.float64())])
    weight = true_weights(_STEPS, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (least, most) = _Quick(), extreme.value
        for whole in batches:
            for batch in slices(whole, "text_a"):
                doc, h, gap, total = differences(batch, known, settings.words)
                at, rows = _fine_slot(h), batch.num_rows
                light, heavy = weight[most[at]], weight[least[at]]
                apart, alike = np.abs(gap), (total - np.abs(gap)) / 2
                parts = [np.bincount(doc, x * w, rows) for x, w in ((alike, light), (apart, heavy), (alike, heavy), (apart, light))]
                low, high = (x / np.maximum(x + y, 1e-9) for x, y in (parts[:2], parts[2:]))
                yield batch_of(schema, batch.column("a"), batch.column("b"), low, high)

    return in_both(pairs, bodies).mapInArrow(run, "a long, b long, low double, high double")


def exact(pairs: DataFrame, bodies: DataFrame, frequency: DataFrame, n: int, settings: Settings) -> DataFrame:
    """``a, b, similarity`` with the true document frequencies, which ``frequency`` holds for all shingles of the pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Quick()
        for whole in batches:
            for batch in slices(whole, "text_a"):
                row, h, gap, total = differences(batch, known, settings.words)
                a, b = (batch.column(c).to_numpy()[row] for c in ("a", "b"))
                yield batch_of(_TERMS_ARROW, a, b, h.view(np.int64), gap, total)

    terms = in_both(pairs, bodies).mapInArrow(run, _TERMS)
    weight = 1 + 0.5 * F.log(1 + F.lit(float(n)) / F.col("df")) / F.log(F.lit(1.0 + max(n, 1)))
    sums = terms.join(frequency, "shingle").groupBy("a", "b").agg(
        F.sum(F.abs("gap") * weight).alias("apart"), F.sum(F.col("total") * weight).alias("all")
    )
    return sums.select("a", "b", ((F.col("all") - F.col("apart")) / (F.col("all") + F.col("apart"))).alias("similarity"))


def verified(pairs: DataFrame, bodies: DataFrame, docs: DataFrame, bounds, n: int, settings: Settings, name: str) -> DataFrame:
    """``compared`` with ``close``, whether the true similarity is that of the settings or more.

    What the counters leave open is compared again with the true frequencies in the slots of a finer table, and only what
    that leaves open too is summed up over rows of pairs and shingles.
    """
    found = durable(compared(pairs, bodies, bounds, settings), name)
    sure, open_ = F.col("low") >= settings.similarity + 1e-9, F.col("high") >= settings.similarity - 1e-9
    left = found.where(~sure & open_).select("a", "b").distinct()
    if not left.limit(1).count():
        return found.withColumn("close", sure)
    frequency = frequencies(left.select(F.explode(F.array("a", "b")).alias("node")).distinct(), bodies, docs, settings)
    extreme = docs.sparkSession.sparkContext.broadcast(extremes(frequency))
    again = durable(narrowed(left, bodies, extreme, n, settings), f"{name}-narrowed")
    extreme.unpersist()
    known = exact(again.where(~sure & open_).select("a", "b"), bodies, frequency, n, settings)
    known = durable(again.join(known, ["a", "b"], "left").select(
        "a", "b", F.coalesce(F.col("similarity") >= settings.similarity, sure).alias("close")
    ), f"{name}-exact")
    return found.withColumn("sure", sure).join(known, ["a", "b"], "left").withColumn("close", F.coalesce("close", "sure")).drop("sure")


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), broadcast_rows: int = 1_000_000) -> DataFrame:
    """``doc_id, class_id, n_links, is_first`` of every row; ``class_id`` is the least id of its class.

    A class is what links of similarity ``settings.similarity`` or more connect. Texts of equal words are one node,
    so copies are never paired. Each bucket of a band has a hub, the node that meets most others, and every node
    of it is compared with the hub alone. A node x that fails there can still link to a member y of another class: only
    where both differ from the hub alike, so an equi-join on the differences that fewest members have (``heads``) finds all such
    y. Keys that one class holds alone are dropped before the join, so a large group of copies is never paired out.

    ``is_first`` marks one row of each class: least id, nulls last, then the text's hash; of rows equal in both,
    all are marked. ``n_links`` counts the verified links of the row's words. Null and empty texts, and texts
    without words, are alike only where the texts are equal. Null ids stay null.
    """
    spark = docs.sparkSession
    frequency, n = document_frequencies(docs, settings)
    weights = spark.sparkContext.broadcast(inverse_frequencies(typical(frequency), n))  # ``slots`` numbers
    one, two = true_weights(np.array([1, 2]), n).tolist()
    bounds = spark.sparkContext.broadcast((true_weights(frequency, n), one, two))
    rows = durable(signatures(docs, weights, settings), "signatures")
    weights.unpersist()
    nodes = rows.groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "copy")).alias("at"), F.first("signature").alias("signature")
    )
    # Nodes without shingles have a signature of zeros and share no band.
    filled = nodes.where(F.exists("signature", lambda s: s != 0))
    bands = [
        F.xxhash64(F.lit(b), *[F.col("signature")[b * settings.rows + i] for i in range(settings.rows)])
        for b in range(settings.bands)
    ]
    placed = filled.select("node", F.explode(F.array(*bands)).alias("bucket"))
    crowds = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = durable(placed.join(crowds, "bucket"), "buckets")
    meets = members.groupBy("node").agg(F.sum("n").alias("meets"))
    hubs = members.join(meets, "node").groupBy("bucket").agg(F.max(F.struct("meets", "node"))["node"].alias("hub"))
    pairs = members.join(hubs, "bucket").where("node <> hub").groupBy(F.col("hub").alias("a"), F.col("node").alias("b")).agg(
        (F.max("n") > 2).alias("crowded")
    )
    pairs = durable(pairs, "pairs")
    needed = durable(
        members.select("node").distinct().join(nodes, "node").select("node", "at.doc_id", "at.copy"), "candidates"
    )
    if needed.count() <= broadcast_rows:
        needed = F.broadcast(needed)  # three numbers a row; above the bound both sides are shuffled
    keyed = texts(docs).withColumn("copy", F.xxhash64("text"))
    same = F.col("d.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("d.copy") == F.col("n.copy"))
    bodies = durable(keyed.alias("d").join(needed.alias("n"), same).select("n.node", "d.text"), "candidate-texts")

    found = verified(pairs, bodies, docs, bounds, n, settings, "compared")
    links = found.where("close").select("a", "b").distinct()
    classes = durable(components(links), "classes")
    listed = heads(found, bounds, n).join(classes.select("node", "component"), "node", "left").withColumn(
        "class", F.coalesce("component", "node")
    )
    sides = F.explode(F.array(*[
        F.struct(F.lit(looks).alias("looks"), F.arrays_zip(F.col(keys).alias("key"), F.col(f"{keys}_left").alias("left")).alias("keys"))
        for looks, keys in ((True, "any"), (False, "own"))
    ]))
    keys = listed.select("hub", "node", "class", "least", sides.alias("side")).select(
        "hub", "node", "class", F.col("least").alias("need"), "side.looks", F.explode("side.keys").alias("k")
    ).select("node", "class", "need", "looks", F.xxhash64("hub", "k.key").alias("key"), "k.left")
    # Members of one class are not looked up: a key that one class holds alone goes before the join.
    group = Window.partitionBy("key")
    met = keys.withColumns({"least": F.min("class").over(group), "most": F.max("class").over(group), "looked": F.max("looks").over(group)})
    met = durable(met.where("looked AND least <> most").select("key", "looks", "node", "class", "need", "left"), "heads")
    failed = met.where("looks").select("key", *[F.col(c).alias(f"{c}_x") for c in ("node", "class", "need", "left")])
    others = met.where("NOT looks").select("key", *[F.col(c).alias(f"{c}_y") for c in ("node", "class", "need", "left")])
    reach = 2 * F.least("left_x", "left_y") * (1 + 1e-6) + 1e-6 >= F.col("need_x") + F.col("need_y")
    open_ = failed.join(others, (failed.key == others.key) & (F.col("class_x") != F.col("class_y")) & reach).select(
        F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"), F.lit(False).alias("crowded")
    ).distinct()
    late = verified(open_, bodies, docs, bounds, n, settings, "late")
    late = durable(late.where("close").select("a", "b").distinct(), "late-links")
    bounds.unpersist()
    links = links.unionByName(late)
    if late.limit(1).count():
        classes = components(links)
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    known = nodes.join(classes, "node", "left").join(ends, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "at"
    )
    first = known.groupBy("component").agg(F.min("at").alias("first"))
    per_node = known.join(first, "component").select("node", "first", "n_links")
    at = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "copy")
    return rows.select("doc_id", "copy", "node").join(per_node, "node").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "n_links", at.eqNullSafe(F.col("first")).alias("is_first"), "copy"
    )
