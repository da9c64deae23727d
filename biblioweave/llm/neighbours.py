"""Approximate nearest neighbours by collision counting.

Vectors are dealt over blocks. A block keeps, for each of a set of directions, its vectors' projections in a sorted array. A
query opens a window around its own projection in every array; a vector collides once for each window that holds it. Windows grow
with the radius searched (virtual rehashing: the arrays stay, only the windows' ends move), and vectors that collide often enough
are verified by their true cosine.

The directions are rows of random rotations, so the collisions of two unit vectors at distance R within windows of half-width
``width * R / sqrt(length)`` follow one law, whatever R. The collision threshold is the number that all but ``miss`` of such
pairs reach; nearer pairs collide more often. So once the k-th best verified distance is no larger than the radius, each true
neighbour has been verified with a probability of at least ``1 - miss``. Nothing is capped: every vector above the
threshold is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.durable import durable
from .common import batch_of
from .vectors import by_length, usable

_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
_RADIUS = pa.schema([("vec_id", pa.int64()), ("radius", pa.float64())])
_FARTHEST = 2.0  # of two unit vectors
_SLACK = 1e-7  # for rounding of projections
_AT_ONCE = 256  # queries of which the windows' ends are held


@dataclass(frozen=True)
class Settings:
    """``block_rows`` bounds what a task holds; ``miss`` is the share of neighbours that the threshold may cost."""

    directions: int = 64
    width: float = 1.3
    miss: float = 0.02
    first_radius: float = 0.05
    growth: float = 1.3
    block_rows: int = 32_768
    seed: int = 7


@lru_cache(maxsize=8)
def _directions(length: int, count: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng([seed, length])
    made = []
    for _ in range(-(-count // length)):
        q, r = np.linalg.qr(rng.standard_normal((length, length)))
        made.append(q * np.where(np.diag(r) < 0, -1.0, 1.0))
    return np.concatenate(made, axis=1)[:, :count]


@lru_cache(maxsize=8)
def threshold(length: int, settings: Settings) -> int:
    """Collisions that all but ``miss`` of the pairs at the searched radius reach, from 8,000 random differences."""
    rng = np.random.default_rng([settings.seed, length, 1])
    hits, left = np.zeros(8000, np.int64), settings.directions
    while left > 0:
        ways = rng.standard_normal((len(hits), length))
        ways *= np.sqrt(length) / np.linalg.norm(ways, axis=1, keepdims=True)
        hits += (np.abs(ways[:, :left]) <= settings.width).sum(axis=1)
        left -= length
    return max(1, int(np.quantile(hits, settings.miss, method="lower")))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, which leaves every cosine as it is and keeps squares from overflowing."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True, initial=0))
    return np.ldexp(vectors, -exponent)


class _Block:
    """The sorted projections of vectors of one length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, settings: Settings):
        self.ids, self.vectors, self.settings = ids, _scaled(vectors), settings
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.length = vectors.shape[1]
        self.directions = _directions(self.length, settings.directions, settings.seed)
        self.least = threshold(self.length, settings)
        projected = ((self.vectors / self.norms[:, None]) @ self.directions).T
        self.order = np.argsort(projected, axis=1)
        self.sorted = np.take_along_axis(projected, self.order, axis=1)

    def ends(self, unit: np.ndarray, radii: np.ndarray) -> np.ndarray:
        """Of the windows of ``radii`` (queries x levels): shape (2, queries, levels, directions)."""
        half = self.settings.width * radii / np.sqrt(self.length) + _SLACK
        out = np.empty((2, *radii.shape, self.directions.shape[1]), np.int64)
        centre = unit @ self.directions
        for i, line in enumerate(self.sorted):
            out[0, ..., i] = np.searchsorted(line, centre[:, i, None] - half, "left")
            out[1, ..., i] = np.searchsorted(line, centre[:, i, None] + half, "right")
        return out

    def collisions(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        parts = [line[a:b] for line, a, b in zip(self.order, low, high) if a < b]
        return np.bincount(np.concatenate(parts), minlength=len(self.ids)) if parts else np.zeros(len(self.ids), np.int64)

    def cosines(self, rows: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
        # A product and a sum by row, whose rounding does not depend on the row's place: equal vectors get equal scores.
        return (self.vectors[rows] * query).sum(axis=1) / (self.norms[rows] * norm)

    def radius(self, own: int, query: np.ndarray, norm: float, low: np.ndarray, high: np.ndarray, radii: np.ndarray, k: int) -> float:
        """Widen the windows level by level until ``k`` others are verified; their k-th distance, or the farthest there is."""
        hits, open_rows, scores = np.zeros(len(self.ids), np.int64), self.ids != own, np.empty(0)
        if open_rows.sum() < k:
            return _FARTHEST
        last = (low[0], low[0])
        for a, b in zip(low, high):
            hits += self.collisions(a, last[0]) + self.collisions(last[1], b)
            last = a, b
            met = np.flatnonzero(open_rows & (hits >= self.least))
            open_rows[met] = False
            scores = np.concatenate([scores, self.cosines(met, query, norm)])
            if len(scores) >= k:
                kth = np.partition(scores, len(scores) - k)[-k]
                return float(np.sqrt(max(0.0, 2 - 2 * kth)))
        return _FARTHEST

    def near(self, own: int, query: np.ndarray, norm: float, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        met = np.flatnonzero((self.collisions(low, high) >= self.least) & (self.ids != own))
        scores = self.cosines(met, query, norm)
        best = np.lexsort((self.ids[met], -scores))[:k]
        return self.ids[met[best]], scores[best]


def _blocks(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[tuple[dict[int, _Block], pa.RecordBatch]]:
    """Each run of asking rows with the index of its block; rows come sorted by block, members before those that ask."""
    block, members, index = None, {}, None
    for batch in batches:
        places, asks = batch.column("block").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((places[1:] != places[:-1]) | (asks[1:] != asks[:-1])) + 1
        for start, end in zip([0, *cuts], [*cuts, len(places)]):
            part = batch.slice(start, end - start)
            if places[start] != block:
                block, members, index = places[start], {}, None
            if not asks[start]:
                ids = part.column("vec_id").to_numpy()
                for rows, vectors in by_length(part, "vector"):
                    members.setdefault(vectors.shape[1], []).append((ids[rows], vectors))
                continue
            if index is None:
                index = {n: _Block(*map(np.concatenate, zip(*held)), settings) for n, held in members.items()}
                members = {}
            yield index, part


def _asked(index: dict[int, _Block], part: pa.RecordBatch) -> Iterator[tuple[_Block | None, np.ndarray, np.ndarray, np.ndarray]]:
    for start in range(0, part.num_rows, _AT_ONCE):
        some = part.slice(start, _AT_ONCE)
        ids, radii = some.column("vec_id").to_numpy(), some.column("radius").to_numpy(zero_copy_only=False)
        for rows, vectors in by_length(some, "vector"):
            yield index.get(vectors.shape[1]), ids[rows], _scaled(vectors), radii[rows]


def _first_radius(settings: Settings, k: int):
    steps = int(np.ceil(np.log(_FARTHEST / settings.first_radius) / np.log(settings.growth)))
    levels = np.minimum(_FARTHEST, settings.first_radius * settings.growth ** np.arange(steps + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index, part in _blocks(batches, settings):
            for block, ids, vectors, _ in _asked(index, part):
                norms = np.sqrt((vectors * vectors).sum(axis=1))
                radii = np.tile(levels, (len(ids), 1))
                low, high = block.ends(vectors / norms[:, None], radii)
                found = [block.radius(ids[i], vectors[i], norms[i], low[i], high[i], levels, k) for i in range(len(ids))]
                yield batch_of(_RADIUS, ids, found)

    return run


def _search(settings: Settings, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index, part in _blocks(batches, settings):
            for block, ids, vectors, radii in _asked(index, part):
                if block is None:  # no vector of this length here
                    continue
                norms = np.sqrt((vectors * vectors).sum(axis=1))
                low, high = block.ends(vectors / norms[:, None], radii[:, None])
                found = [block.near(ids[i], vectors[i], norms[i], low[i, 0], high[i, 0], k) for i in range(len(ids))]
                sizes = [len(f[0]) for f in found]
                yield batch_of(_FOUND, np.repeat(ids, sizes), np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))

    return run


def nearest(df: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found by cosine of each row that ``queries`` (of the id) selects.

    Rows without an id and vectors that are null, zero, or hold null or non-finite components take no part. An id in several
    rows counts once, with the least of its vectors. Vectors of another length than the query's are no candidates. Fewer than
    ``k`` candidates are all returned; ties go to the smaller id; an empty table gives no rows.

    A query first widens its windows in its own block, until ``k`` vectors are verified. Their k-th distance bounds the true one,
    so it is the radius of the windows in every block. Queries travel to all blocks, 1/blocks of the rows each, and each
    block answers with ``k`` rows at most; blocks are dealt by id, so no task holds much more than ``block_rows``.
    """
    spark = df.sparkSession
    vector = F.col(f"`{vector_col}`")
    rows = usable(df, vector_col).where(F.col(f"`{id_col}`").isNotNull() & F.exists(vector, lambda x: x != 0))
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("vector"))
    rows = durable(rows.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    count = rows.count()
    spread = min(int(spark.conf.get("spark.sql.shuffle.partitions")), count // 512 + 1)
    blocks = max(spread, -(-count // settings.block_rows), 1)
    own = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    members = rows.select(own.alias("block"), F.lit(False).alias("asks"), "vec_id", "vector", F.lit(None).cast("double").alias("radius"))

    def dealt(asking: DataFrame) -> DataFrame:
        both = members.unionByName(asking.withColumn("asks", F.lit(True)))
        return both.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "asks", "vec_id")

    asking = rows.where(queries)
    inside = dealt(asking.select(own.alias("block"), "vec_id", "vector", F.lit(None).cast("double").alias("radius")))
    radii = durable(inside.mapInArrow(_first_radius(settings, k), "vec_id long, radius double"), "radii")
    everywhere = asking.join(radii, "vec_id").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = dealt(everywhere.select("block", "vec_id", "vector", "radius")).mapInArrow(
        _search(settings, k), "query_id long, vec_id long, score double"
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
