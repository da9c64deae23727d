"""Sequence packing: repeat counts of shallow length combinations by non-negative least squares, the rest greedily.

Documents are cut into full windows and one remainder. Remainders go to combinations of two or three lengths
that fill a window exactly; how often each combination is used is solved against the histogram of remainders.
What rounding leaves over is laid end to end and cut at the windows, the last of them into powers of two.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from struct import pack as pack_ids
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.durable import durable
from .common import batch_of, slices, texts

END_ID = 1
# How byte-level BPE splits a text of Latin letters before merging; other units go to the tokenizer itself.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = "\\t\\n\\x0b\\x0c\\r \u0085 "
_PIECE = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_OTHER = re.compile("[^\x00-ɏ]")
# Byte-level BPE writes printable bytes of Latin-1 as themselves and the n-th other one as the character 256 + n.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PLAIN)}
_WRITTEN_SPACE = chr(_BYTES[32])

_TOKENS = "doc_id long, task long, ahead long, doc_tokens long, full array<long>, rest long, rest_rank long, rest_ids binary"
_TOKENS_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("task", pa.int64()), ("ahead", pa.int64()), ("doc_tokens", pa.int64()), ("full", pa.list_(pa.int64())),
    ("rest", pa.int64()), ("rest_rank", pa.int64()), ("rest_ids", pa.binary()),
])
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_length long"
)
_PIECES_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in _PIECES.split(", ")])


@dataclass(frozen=True)
class Settings:
    window: int = 2048
    triples: int = 40_000
    steps: int = 400


class _Recent(dict):
    """``make(key)`` of the keys met last: up to ``most`` of them, and the ``most`` before these until they are full again."""

    def __init__(self, make, most: int):
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key: str) -> bytes | None:
        value = self.before[key] if key in self.before else self.make(key)
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


class Ids:
    """A byte-level BPE tokenizer's ids as little-endian unsigned 32-bit bytes; it keeps those of up to ``most`` units that it has met last.

    No piece that such a tokenizer merges within reaches from a character that is not white space into white
    space. So a text can be cut before each space or line end that has none on either side (two line ends are a
    piece each), and the ids of its units can be put together. Other texts, and those with special
    tokens, go to the tokenizer whole. A unit's first character says what stands before it: nothing, a line
    end, or else a space. A piece that begins with a space is looked up as the unit of what follows it, so that a word is kept once.
    """

    def __init__(self, vocabulary: str, most: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.apart = (*special, "\0", "\1", "\n\n\n", "\n\n ")
        self.known, self.pieces = _Recent(self.unit, max(most // 2, 1)), _Recent(self.piece, max(most // 12, 1))
        self.written = {chr(c): chr(c).encode().decode("latin-1").translate(_BYTES) for c in range(0x250)}
        self.tokenize = self.tokenizer.model.tokenize

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def units(self, text: str) -> list[str]:
        if any(s in text for s in self.apart) or text.endswith("\n\n"):
            return []
        return ("\0" + text.replace("\n", " \1")).split(" ")

    def unit(self, unit: str) -> bytes | None:
        """Ids of one unit: those of Latin letters are split here and only merged by the tokenizer's model.

        None for one that is empty or has white space at an end, where it must not be cut.
        """
        if unit.isalpha() and unit.isascii():
            return self.piece(" " + unit)
        mark, body = ("", unit[1:]) if unit[:1] == "\0" else ("\n", unit[1:]) if unit[:1] == "\1" else (" ", unit)
        if len(body.strip()) < len(body) or not (body or mark != " "):
            return None
        text = mark + body
        if _OTHER.search(text):
            return self.whole(text)
        parts = _PIECE.findall(text)
        if len(parts) == 1:
            return self.piece(text)
        return b"".join([self.known[p[1:]] if p[0] == " " and len(p) > 1 else self.pieces[p] for p in parts])

    def piece(self, text: str) -> bytes:
        if text.isascii() and text.isprintable():
            written = text.replace(" ", _WRITTEN_SPACE)
        else:
            written = "".join(map(self.written.__getitem__, text))
        ids = [t.id for t in self.tokenize(written)]
        return pack_ids(f"<{len(ids)}I", *ids)

    def of(self, bodies: list[str]) -> list[bytes]:
        return [self.joined(text, self.units(text)) for text in bodies]

    def joined(self, text: str, own: list[str]) -> bytes:
        try:
            return b"".join(map(self.known.__getitem__, own)) if own else self.whole(text)
        except TypeError:  # a unit of None
            return self.whole(text)


@lru_cache(maxsize=1)
def _ids(vocabulary: str) -> Ids:
    """One per Python worker, so that small tasks do not read the vocabulary and learn the same units again."""
    return Ids(vocabulary)


def tokens(docs: DataFrame, vocabulary: str, window: int = Settings.window) -> DataFrame:
    """Every row's ids cut into full windows (their checksums; ``ahead`` of them are full windows of earlier rows of its task)
    and the rest (its ids, and its rank among equal rests of its task)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, task, ahead, ranks = _ids(vocabulary), TaskContext.get().partitionId(), 0, {}
        end, width = np.array([END_ID], "<u4").tobytes(), 4 * window
        for batch in chain.from_iterable(slices(whole, "text") for whole in batches):
            out = []
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), ids.of(batch.column("text").to_pylist())):
                raw += end
                cut = len(raw) - len(raw) % width
                rest = (len(raw) - cut) // 4
                ranks[rest] = rank = ranks.get(rest, -1) + 1
                full = [crc32(raw[i : i + width]) for i in range(0, cut, width)]
                out.append((doc_id, task, ahead, len(raw) // 4, full, rest, rank, raw[cut:]))
                ahead += len(full)
            if out:
                yield batch_of(_TOKENS_ARROW, *zip(*out))

    return texts(docs).mapInArrow(run, _TOKENS)


def combinations(histogram: np.ndarray, settings: Settings) -> np.ndarray:
    """Rows of three lengths (0 for none) that sum to the window: all pairs, and the triples of the most frequent lengths."""
    window = settings.window
    have = np.flatnonzero(histogram[1:] > 0) + 1
    pairs = [(a, window - a, 0) for a in have if a <= window - a and histogram[window - a] > 0]
    often = have[np.argsort(-histogram[have], kind="stable")]
    triples, width = [], int(np.sqrt(2 * settings.triples)) + 1
    often = np.sort(often[:width])
    for i, a in enumerate(often):
        b = often[i:]
        c = window - a - b
        good = c >= b
        b, c = b[good], c[good]
        good = histogram[c] > 0
        triples += [(a, x, y) for x, y in zip(b[good], c[good])]
    return np.array(pairs + triples, np.int64).reshape(-1, 3)


def solve_counts(histogram: np.ndarray, columns: np.ndarray, settings: Settings) -> np.ndarray:
    """Whole repeat counts: projected gradient on |A x - h|^2 with x >= 0, rounded down where lengths run out."""
    n = settings.window
    if not len(columns):
        return np.zeros(0, np.int64)
    target = histogram.astype(float)
    times = np.stack([np.bincount(columns[:, j], minlength=n) for j in range(3)]).sum(0)
    rate = 1 / (3 * max(1, times[1:].max()))
    x, z, momentum = np.zeros(len(columns)), np.zeros(len(columns)), 1.0

    def uses(v):
        used = sum(np.bincount(columns[:, j], v, n) for j in range(3))
        used[0] = 0
        return used

    for _ in range(settings.steps):
        miss = uses(z) - target
        miss[0] = 0
        slope = sum(miss[columns[:, j]] for j in range(3))
        fresh = np.maximum(z - rate * slope, 0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        z = fresh + (momentum - 1) / following * (fresh - x)
        x, momentum = fresh, following
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    counts = np.zeros(len(columns), np.int64)
    # Round down within what is left, then let combinations take what rounding has left over.
    for wanted in (np.floor(x).astype(np.int64), np.full(len(columns), np.iinfo(np.int64).max)):
        for i in np.argsort(-x, kind="stable"):
            need = {}
            for length in columns[i]:
                if length:
                    need[length] = need.get(length, 0) + 1
            take = min(wanted[i], *(left[k] // v for k, v in need.items()))
            if take > 0:
                counts[i] += take
                for k, v in need.items():
                    left[k] -= take * v
    return counts


@dataclass(frozen=True)
class Plan:
    """Where the r-th remainder of each length goes: runs of ranks in combinations, then the common tail."""

    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # first rank, first sequence, offset
    tail_rank: np.ndarray
    tail_start: np.ndarray
    tail_total: int
    tail_sequence: int


def plan(histogram: np.ndarray, settings: Settings) -> Plan:
    """At most ``window - 1`` lengths and ``triples`` combinations, whatever the number of documents."""
    columns = combinations(histogram, settings)
    counts = solve_counts(histogram, columns, settings)
    used = np.zeros(settings.window, np.int64)
    runs: dict[int, list] = {}
    sequence = 0
    for column, times in zip(columns[counts > 0], counts[counts > 0]):
        offset = 0
        for length in column:
            if length:
                runs.setdefault(int(length), []).append((used[length], sequence, offset))
                used[length] += times
                offset += length
        sequence += int(times)
    lengths = np.arange(settings.window)
    over = (histogram - used) * (lengths > 0)
    starts = np.cumsum(over * lengths) - over * lengths
    arrays = {k: tuple(np.array(v) for v in zip(*r)) for k, r in runs.items()}
    return Plan(arrays, used, starts, int((over * lengths).sum()), sequence)


def tail_sequences(total: int, window: int) -> tuple[int, list[int]]:
    """Full windows of the tail and the powers of two that its last tokens fill."""
    last, powers = total % window, []
    while last:
        powers.append(1 << (last.bit_length() - 1))
        last -= powers[-1]
    return total // window, powers


def pack(docs: DataFrame, vocabulary: str, settings: Settings = Settings()) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length``.

    Null and empty texts have the end id alone; every row is packed, repeated ones too; ids are never looked at to
    order or match rows, so null and repeated ids do no harm. An empty table gives an empty result. Every
    sequence is full or a power of two long, so nothing is padded. Tokens are written once to the shared
    folder; the driver sees one number per length of a remainder.
    """
    window = settings.window
    cut = durable(tokens(docs, vocabulary, window), "packing-tokens")
    per_task = cut.where("rest > 0").groupBy("rest", "task").agg(F.count(F.lit(1)).alias("n"))
    histogram = np.zeros(window, np.int64)
    for row in per_task.groupBy("rest").agg(F.sum("n").alias("n")).collect():
        histogram[row.rest] = row.n
    shared = docs.sparkSession.sparkContext.broadcast(plan(histogram, settings))
    before = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_task.select(
        F.col("rest").alias("_rest"), F.col("task").alias("_task"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    ranked = cut.join(firsts, (F.col("rest") == F.col("_rest")) & (F.col("task") == F.col("_task")), "left").select(
        *cut.columns, (F.col("rest_rank") + F.coalesce("first", F.lit(0))).alias("rank")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        tail_full, powers = tail_sequences(p.tail_total, window)
        edges = np.cumsum([0, *powers]) + tail_full * window
        for batch in batches:
            out = []
            for doc_id, task, ahead, n, full, rest, _, ids, rank in zip(*(c.to_pylist() for c in batch.columns)):
                # Full windows are sequences of their own: numbered below zero by task and place among its full windows.
                for i, check in enumerate(full):
                    out.append((doc_id, i * window, window, check, n, -1 - (task << 42 | ahead + i), 0, window))
                if not rest:
                    continue
                start = n - rest
                if rank < p.tail_rank[rest]:
                    first, sequence, offset = p.runs[rest]
                    k = int(np.searchsorted(first, rank, "right")) - 1
                    out.append((doc_id, start, rest, crc32(ids), n, int(sequence[k] + rank - first[k]), int(offset[k]), window))
                    continue
                at = int(p.tail_start[rest] + (rank - p.tail_rank[rest]) * rest)
                done = 0
                while done < rest:
                    place = at + done
                    if place < tail_full * window:
                        number, begin, length = place // window, place // window * window, window
                    else:
                        k = int(np.searchsorted(edges, place, "right")) - 1
                        number, begin, length = tail_full + k, int(edges[k]), powers[k]
                    size = min(rest - done, begin + length - place)
                    piece = ids[4 * done : 4 * (done + size)]
                    out.append((doc_id, start + done, size, crc32(piece), n, p.tail_sequence + number, place - begin, length))
                    done += size
            if out:
                yield batch_of(_PIECES_ARROW, *zip(*out))

    return ranked.mapInArrow(run, _PIECES)
