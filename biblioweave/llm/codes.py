"""Vector code compression: 16 small codebooks of integers, trained and applied exactly over boxes of Hilbert-sorted vectors.

Every chunk of vectors is stored once as flat blocks: for each of the 16 parts its rows are sorted along a Hilbert curve and cut
into runs of ``LEAF``, each with its box (least and greatest components) and sum. In a round, the distances from an entry to
the near and far side of a box bound those to all vectors inside: entries whose near side is beyond another's far side are nearest
to none of them. A block that one entry is left for is assigned by its stored sum; others go through an exact integer kernel
over their shortlist only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.durable import durable
from ..operators.skew import spread_join
from .common import batch_of
from .vectors import by_length, usable

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LEAF = 64
CHUNK_BYTES = 1 << 22
#: Integers below this magnitude keep every distance, sum and error inside 64 bits.
LARGEST = 1 << 28
BROADCAST_LABELS = 100_000
_STORED = pa.schema([
    ("n", pa.int32()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string())),
    *[(c, pa.binary()) for c in ("points", "order", "low", "high", "sums")],
])
_STORED_SQL = "n int, ids array<long>, labels array<string>, points binary, order binary, low binary, high binary, sums binary"
_SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("value", pa.int64())])
_CODES = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("code", pa.string()), ("error", pa.int64())])


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points (rows of whole numbers below ``2**bits``)."""
    x = points.T.astype(np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for axis in x:
            turned = (axis & q) != 0
            swapped = np.where(turned, 0, (x[0] ^ axis) & p)
            x[0] ^= np.where(turned, p, swapped)
            axis ^= swapped
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip, q = np.zeros(x.shape[1], np.int64), 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    place = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            place = place << 1 | (axis >> bit & 1)
    return place


def _curve_order(points: np.ndarray) -> np.ndarray:
    """Rows along the curve; of long parts the leading components decide, so that a place fits 62 bits."""
    led = points[:, :31]
    bits = max(2, min(8, 62 // led.shape[1]))
    low, span = led.min(axis=0), np.ptp(led, axis=0)
    return np.argsort(hilbert((led - low) * ((1 << bits) - 1) // np.maximum(span, 1), bits), kind="stable")


def _store(length: int):
    """Chunks of integer vectors as flat blocks."""
    width, rows_a_chunk = length // PARTS, max(LEAF, CHUNK_BYTES // (4 * length))

    def packed(ids: list, labels: list, whole: np.ndarray) -> pa.RecordBatch:
        n, points, order, low, high, sums = len(ids), [], [], [], [], []
        starts = np.arange(0, n, LEAF)
        for part in whole.reshape(n, PARTS, width).transpose(1, 0, 2):
            along = _curve_order(part)
            sorted_part = part[along]
            order.append(along.astype(np.int32))
            points.append(sorted_part.astype(np.int32))
            low.append(np.minimum.reduceat(sorted_part, starts))
            high.append(np.maximum.reduceat(sorted_part, starts))
            sums.append(np.add.reduceat(sorted_part, starts))
        blobs = [np.stack(x).tobytes() for x in (points, order, low, high, sums)]
        return batch_of(_STORED, [n], [ids], [labels], *[[b] for b in blobs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, held = [], [], []
        for batch in batches:
            for rows, vectors in by_length(batch, "vector"):
                whole = np.floor(vectors * SCALE).astype(np.int64)
                ids += batch.column("vec_id").take(rows).to_pylist()
                labels += batch.column("label").take(rows).to_pylist()
                held.append(whole)
            while len(ids) >= rows_a_chunk:
                whole = np.concatenate(held)
                yield packed(ids[:rows_a_chunk], labels[:rows_a_chunk], whole[:rows_a_chunk])
                ids, labels, held = ids[rows_a_chunk:], labels[rows_a_chunk:], [whole[rows_a_chunk:]]
        if ids:
            yield packed(ids, labels, np.concatenate(held))

    return run


def _shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """``blocks x entries``: which entries can be nearest to a vector of the block (ties stay)."""
    below, above = low[:, None] - entries, entries - high[:, None]
    near = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(np.abs(below), np.abs(above))
    return (near * near).sum(axis=2) <= (far * far).sum(axis=2).min(axis=1, keepdims=True)


def _nearest(points: np.ndarray, entries: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code and squared distance of ``blocks x LEAF`` points among each block's entries, listed in ascending order."""
    codes, errors = (np.empty(points.shape[:2], np.int64) for _ in range(2))
    step = max(1, (1 << 20) // (LEAF * lists.shape[1] * points.shape[2]))
    for i in range(0, len(points), step):
        away = points[i : i + step, :, None] - entries[lists[i : i + step]][:, None]
        distance = np.einsum("blsw,blsw->bls", away, away)
        best = distance.argmin(axis=2)
        codes[i : i + step] = np.take_along_axis(lists[i : i + step], best, axis=1)
        errors[i : i + step] = np.take_along_axis(distance, best[..., None], axis=2)[..., 0]
    return codes, errors


class _Chunk:
    def __init__(self, row: dict, width: int):
        self.n, self.ids, self.labels = row["n"], row["ids"], row["labels"]
        self.points, self.order = np.frombuffer(row["points"], np.int32).reshape(PARTS, self.n, width), np.frombuffer(row["order"], np.int32).reshape(PARTS, self.n)
        self.low, self.high, self.sums = (np.frombuffer(row[c], np.int64).reshape(PARTS, -1, width) for c in ("low", "high", "sums"))
        self.sizes = np.diff([*range(0, self.n, LEAF), self.n])

    def blocks(self, part: int) -> np.ndarray:
        """``blocks x LEAF x width``; the last block is filled up with its last point."""
        padded = np.empty((len(self.sizes) * LEAF, self.points.shape[2]), np.int64)
        padded[: self.n] = self.points[part]
        padded[self.n :] = self.points[part, -1]
        return padded.reshape(len(self.sizes), LEAF, -1)

    def listed(self, part: int, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks with shortlists of about one size (a power of two), filled up with entries that are farther than all listed."""
        possible = _shortlists(self.low[part], self.high[part], entries)
        lists, counts = np.argsort(~possible, axis=1, kind="stable"), possible.sum(axis=1)
        size = 1
        while size < 2 * len(entries):
            some = np.flatnonzero((counts <= size) & (2 * counts > size))
            if len(some):
                yield some, lists[some, :size]
            size *= 2


def _sums(codebooks: np.ndarray):
    entries_a_book, width = codebooks.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, entries_a_book, width + 1), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row, width)
                for part in range(PARTS):
                    points = None
                    for some, lists in chunk.listed(part, codebooks[part]):
                        if lists.shape[1] == 1:
                            np.add.at(total[part], lists[:, 0], np.column_stack([chunk.sums[part, some], chunk.sizes[some]]))
                            continue
                        points = chunk.blocks(part) if points is None else points
                        codes, _ = _nearest(points[some], codebooks[part], lists)
                        real = np.arange(LEAF) < chunk.sizes[some][:, None]
                        np.add.at(total[part], codes[real], np.column_stack([points[some][real], np.ones(real.sum(), np.int64)]))
        used = np.argwhere(total)
        if len(used):
            yield batch_of(_SUMS, *used.T.astype(np.int32), total[tuple(used.T)])

    return run


def _encode(codebooks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row, codebooks.shape[2])
                codes, errors = np.empty((chunk.n, PARTS), np.uint8), np.zeros(chunk.n, np.int64)
                for part in range(PARTS):
                    points, own, off = chunk.blocks(part), *(np.empty((len(chunk.sizes), LEAF), np.int64) for _ in range(2))
                    for some, lists in chunk.listed(part, codebooks[part]):
                        own[some], off[some] = _nearest(points[some], codebooks[part], lists)
                    codes[chunk.order[part], part] = own.ravel()[: chunk.n]
                    errors[chunk.order[part]] += off.ravel()[: chunk.n]
                yield batch_of(_CODES, chunk.ids, chunk.labels, [c.tobytes().hex() for c in codes], errors)

    return run


def train(chunks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """One round: every part goes to its nearest entry, every used entry to the floored mean of its parts.

    Each task sends one sum per part, entry and component; the driver receives those sums, whose number does not depend on the rows.
    """
    summed = chunks.mapInArrow(_sums(codebooks), "part int, entry int, place int, value long")
    total = np.zeros((*codebooks.shape[:2], codebooks.shape[2] + 1), object)
    for r in summed.groupBy("part", "entry", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        total[r.part, r.entry, r.place] = int(r.value)
    new = codebooks.copy()
    for part, entry in np.argwhere(total[..., -1] > 0):
        new[part, entry] = [s // total[part, entry, -1] for s in total[part, entry, :-1]]
    return new


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of every vector (stored), and the final codebooks (parts x entries x components).

    Dropped are vectors that are null, hold null or non-finite components, cannot be cut into 16 equal parts or differ in length
    from the one of the smallest id, or hold an integer of ``LARGEST`` or more (their squared distances exceed 64 bits). The first
    codebook is the ``ENTRIES`` smallest ids, null ids last; rows of one id are ordered by vector, and equal rows count each. With
    fewer vectors the codebooks are shorter; without any there are no rows and the codebooks are empty.
    """
    spark = df.sparkSession
    rows = usable(df, vector_col).select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("vector"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
    )
    limit = float(LARGEST) / SCALE
    rows = rows.where((F.size("vector") > 0) & (F.size("vector") % PARTS == 0) & F.forall("vector", lambda x: F.abs(x) < limit))
    by_id = (F.col("vec_id").asc_nulls_last(), F.col("vector"))
    first = rows.orderBy(*by_id).select("vector").limit(1).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, label string, code string, error long"), np.empty((PARTS, 0, 0), np.int64)
    length = len(first[0].vector)
    rows = rows.where(F.size("vector") == length)
    chosen = np.array([r.vector for r in rows.orderBy(*by_id).select("vector").limit(ENTRIES).collect()], np.float64)
    codebooks = np.floor(chosen * SCALE).astype(np.int64).reshape(len(chosen), PARTS, -1).transpose(1, 0, 2)
    chunks = durable(rows.mapInArrow(_store(length), _STORED_SQL), "code-blocks")
    for _ in range(ROUNDS):
        codebooks = train(chunks, codebooks)
    return durable(chunks.mapInArrow(_encode(codebooks), "vec_id long, label string, code string, error long"), "codes"), codebooks


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel())).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add ``label_error``: the error summed over rows of the same label, null labels together.

    Sums are broadcast up to ``BROADCAST_LABELS`` labels; beyond, frequent labels are split for the join.
    """
    key = F.struct(F.col("label").isNull().alias("none"), F.coalesce("label", F.lit("")).alias("label")).alias("_label")
    sums = coded.groupBy(key).agg(F.sum("error").cast("long").alias("label_error"))
    keyed = coded.withColumn("_label", key)
    if sums.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        joined = keyed.join(F.broadcast(sums), "_label")
    else:
        joined = spread_join(keyed, sums, ["_label"], "vec_id", "left")
    return joined.drop("_label")
