"""Removal of repeated byte strings: ranks are hashes taken at growing lengths and sorted by Spark; no prefix doubling.

A string of ``length`` bytes is ranked first by its rarest-looking ``SEED`` bytes (the least hash inside it), then by
the run of neighbouring strings that share this seed, then as a whole. Spark sorts (rank, position) rows at each
step; positions that are alone with their rank drop out, so only the edges of repeated passages are ever ranked
byte by byte. The seed of a string depends on nothing outside of it, so equal strings have equal ranks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.durable import durable
from .common import LEAST, batch_of, slices, texts

LENGTH, SEED = 100, 32
_ROWS = "kind int, rank long, run long, doc_id long, twin long, pos long, n long"
_ROWS_ARROW = pa.schema([("kind", pa.int32()), *[(c, pa.int64()) for c in ("rank", "run", "doc_id", "twin", "pos", "n")]])
_STRINGS = "rank long, doc_id long, twin long, pos long, offsets binary, hashes binary"
_STRINGS_ARROW = pa.schema([
    *[(c, pa.int64()) for c in ("rank", "doc_id", "twin", "pos")], ("offsets", pa.binary()), ("hashes", pa.binary()),
])
_FOUND = "kind int, rank long, doc_id long, twin long, pos long, n long"
_FOUND_ARROW = pa.schema([("kind", pa.int32()), *[(c, pa.int64()) for c in ("rank", "doc_id", "twin", "pos", "n")]])
_KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_KEPT_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
])
_SORTED = ("kind", "rank", "run", "doc_id", "twin", "pos")
_COVERED, _OPEN = 1, 2
_PLACE_BITS = np.uint64(28)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of the base and its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (
                np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)])) for base in (_BASE, _INVERSE)
            )
        return self.up, self.down


class _Hasher:
    """Hashes of any substrings of ``raw`` in constant time each."""

    def __init__(self, raw: bytes, powers: _Powers):
        up, self.down = powers.upto(len(raw) + 1)
        self.prefix = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[np.frombuffer(raw, np.uint8)] * up[: len(raw)], out=self.prefix[1:])

    def every(self, size: int) -> np.ndarray:
        n = len(self.prefix) - size
        return _mix((self.prefix[size:] - self.prefix[:n]) * self.down[:n])

    def at(self, start: np.ndarray, size) -> np.ndarray:
        return _mix((self.prefix[start + size] - self.prefix[start]) * self.down[start] + np.uint64(1) * np.asarray(size, np.uint64))


def cells(raw: bytes, begins: np.ndarray, ends: np.ndarray, powers: _Powers, length: int = LENGTH, seed: int = SEED):
    """Runs of string starts with one seed, for documents laid end to end: (document, first start, count, seed hash, run hash)."""
    if len(raw) < length:
        return None
    hasher = _Hasher(raw, powers)
    whole = hasher.every(seed)
    places = np.arange(len(whole), dtype=np.uint64)
    least = (whole >> _PLACE_BITS << _PLACE_BITS) | places
    width, done = length - seed + 1, 1
    while done * 2 <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if width > done:
        least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
    seed_at = (least & np.uint64((1 << int(_PLACE_BITS)) - 1)).astype(np.int64)
    sizes = ends - begins
    doc_of = np.repeat(np.arange(len(begins)), sizes)[: len(seed_at)]
    valid = np.arange(len(seed_at)) + length <= ends[doc_of]
    fresh = np.ones(len(seed_at), bool)
    fresh[1:] = (seed_at[1:] != seed_at[:-1]) | (doc_of[1:] != doc_of[:-1])
    starts = np.flatnonzero(fresh & valid)
    if not len(starts):
        return None
    total = np.concatenate([[0], np.cumsum(valid)])
    stops = np.append(np.flatnonzero(fresh), len(seed_at))
    stop = stops[np.searchsorted(stops, starts, "right")]
    n = total[stop] - total[starts]
    return doc_of[starts], starts, n, whole[seed_at[starts]], hasher.at(starts, n + length - 1)


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _first_and_rest(rank, run, doc_id, twin, pos, n, reach: int) -> list[np.ndarray]:
    """Rows for the sort: one per (rank, run), its earliest, and the others as covered bytes.

    The others have an earlier equal in the same batch, so they need not travel; neighbours are joined to
    longer runs. However common a passage is, a batch sends one row of it.
    """
    order = np.lexsort((pos, twin, doc_id, run, rank))
    rank, run, doc_id, twin, pos, n = (a[order] for a in (rank, run, doc_id, twin, pos, n))
    repeat = np.zeros(len(rank), bool)
    repeat[1:] = (rank[1:] == rank[:-1]) & (run[1:] == run[:-1])
    first = [np.zeros((~repeat).sum(), np.int32), *(a[~repeat] for a in (rank, run, doc_id, twin, pos, n))]
    d, t, p, size = (a[repeat] for a in (doc_id, twin, pos, n + reach - 1))
    order = np.lexsort((p, t, d))
    d, t, p, size = (a[order] for a in (d, t, p, size))
    if len(d):
        fresh = np.ones(len(d), bool)
        fresh[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (p[1:] > p[:-1] + size[:-1])
        heads = np.flatnonzero(fresh)
        end = np.maximum.reduceat(p + size, heads)
        d, t, p = d[heads], t[heads], p[heads]
        size = end - p
    spread = _signed(_mix(d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + p.astype(np.uint64)))
    zero = np.zeros(len(d), np.int64)
    rest = [np.ones(len(d), np.int32), spread, zero, d, t, p, size]
    return [np.concatenate([a, b]) for a, b in zip(first, rest)]


def _ranked_cells(rows: DataFrame, length: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, twins, bodies = (c.to_pylist() for c in batch.columns)
                raw = [t.encode("utf-8", "surrogatepass") for t in bodies]
                ends = np.cumsum([len(r) for r in raw])
                begins = ends - np.array([len(r) for r in raw], np.int64)
                made = cells(b"".join(raw), begins, ends, powers, length, seed)
                if made:
                    doc, start, n, rank, hashed = made
                    columns = (np.array(ids, np.int64)[doc], np.array(twins, np.int64)[doc], start - begins[doc], n)
                    yield batch_of(_ROWS_ARROW, *_first_and_rest(_signed(rank), _signed(hashed), *columns, length))

    return rows.mapInArrow(run, _ROWS)


def _scan(rows: DataFrame, reach: int) -> DataFrame:
    """Sort by rank and pass once over each partition, with one batch in memory: repeated runs are covered; ranks that
    hold different runs are given out again, since strings inside of them may still be equal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, head = None, None  # (rank, run) of the row before; the first row of its rank while its run is the only one
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, rank, runs, doc_id, twin, pos, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            done = kind == 1
            out = [[np.ones(done.sum(), np.int32), rank[done], doc_id[done], twin[done], pos[done], n[done]]]
            rank, runs, doc_id, twin, pos, n = (a[~done] for a in (rank, runs, doc_id, twin, pos, n))
            if len(rank):
                same_rank, same_run = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
                same_rank[1:], same_run[1:] = rank[1:] == rank[:-1], runs[1:] == runs[:-1]
                if last is not None:
                    same_rank[0], same_run[0] = rank[0] == last[0], runs[0] == last[1]
                repeat = same_rank & same_run
                out.append([np.ones(repeat.sum(), np.int32), *(a[repeat] for a in (rank, doc_id, twin, pos)), n[repeat] + reach - 1])
                group = np.cumsum(~same_rank)  # group 0 continues the rank of the batch before
                other = same_rank & ~same_run
                mixed = np.bincount(group[other], minlength=group[-1] + 1) > 0
                again = other | (~same_rank & mixed[group])
                out.append([np.full(again.sum(), _OPEN, np.int32), *(a[again] for a in (rank, doc_id, twin, pos, n))])
                if head is not None and mixed[0]:
                    out.append([np.array([v]) for v in (_OPEN, *head)])
                if group[-1] > 0 or mixed[0]:
                    head = None
                if group[-1] > 0 and not mixed[-1]:
                    i = int(np.flatnonzero(~same_rank)[-1])
                    head = tuple(int(a[i]) for a in (rank, doc_id, twin, pos, n))
                last = (rank[-1], runs[-1])
            yield batch_of(_FOUND_ARROW, *(np.concatenate(c) for c in zip(*out)))

    return rows.repartition("rank").sortWithinPartitions(*_SORTED).mapInArrow(run, _FOUND)


def _ranked_strings(opened: DataFrame, length: int) -> DataFrame:
    """The strings of each reopened run, ranked as a whole: one row a run, or one per share of a crowded rank.

    Equal strings have equal hashes, so a rank with too many runs for one group is dealt out by the hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for whole in batches:
            for batch in slices(whole, "text"):
                out = []
                for doc_id, twin, text, runs in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "twin", "text", "runs"))):
                    hasher = _Hasher(text.encode("utf-8", "surrogatepass"), powers)
                    for r in runs:
                        offsets = np.arange(r["n"], dtype=np.uint8)
                        hashes = hasher.at(r["pos"] + np.arange(r["n"]), length)
                        share = hashes % np.uint64(r["shares"])
                        for k in range(r["shares"]) if r["shares"] < r["n"] else np.unique(share):
                            mine = share == k
                            if mine.any():
                                rank = r["rank"] ^ (int(k) * 0x9E3779B97F4A7C15 & (1 << 63) - 1)
                                out.append((rank, doc_id, twin, r["pos"], offsets[mine].tobytes(), hashes[mine].tobytes()))
                if out:
                    yield batch_of(_STRINGS_ARROW, *zip(*out))

    return opened.mapInArrow(run, _STRINGS)


def _repeated_strings(strings: DataFrame, length: int) -> DataFrame:
    """Covered spans among ranked strings: sorted by rank and position, every hash that the rank has had before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.zeros(0, np.uint64)  # the last rank and its hashes so far
        for batch in batches:
            if not batch.num_rows:
                continue
            rank, doc_id, twin, pos = (batch.column(c).to_numpy() for c in ("rank", "doc_id", "twin", "pos"))
            offsets = [np.frombuffer(o, np.uint8) for o in batch.column("offsets").to_pylist()]
            sizes = np.array([len(o) for o in offsets])
            row = np.repeat(np.arange(len(rank)), sizes)
            at = pos[row] + np.concatenate(offsets).astype(np.int64)
            hashes = np.frombuffer(b"".join(batch.column("hashes").to_pylist()), np.uint64)
            group = np.cumsum(np.append(rank[0] != last if last is not None else True, rank[1:] != rank[:-1]))
            if group[0]:
                held = held[:0]
            # Group 0 goes on from the batch before; its hashes so far stand in front.
            key = np.concatenate([np.zeros(len(held), np.int64), group[row]])
            every = np.concatenate([held, hashes])
            order = np.lexsort((every, key))
            repeat = np.zeros(len(every), bool)
            k, e = key[order], every[order]
            repeat[order[1:]] = (k[1:] == k[:-1]) & (e[1:] == e[:-1])  # the sort is stable: the first stays
            mine = every[(key == group[-1]) & ~repeat]
            last, held = rank[-1], mine
            again = repeat[len(every) - len(hashes) :]
            row, at = row[again], at[again]
            if len(row):
                fresh = np.append(True, (row[1:] != row[:-1]) | (at[1:] > at[:-1] + length))
                heads = np.flatnonzero(fresh)
                ends = at[np.append(heads[1:] - 1, len(at) - 1)] + length
                r = row[heads]
                yield batch_of(_FOUND_ARROW, np.ones(len(r), np.int32), rank[r], doc_id[r], twin[r], at[heads], ends - at[heads])

    return strings.repartition("rank").sortWithinPartitions("rank", "doc_id", "twin", "pos").mapInArrow(run, _FOUND)


def repeated_bytes(docs: DataFrame, length: int = LENGTH, seed: int = SEED, crowd: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """``(documents, spans)``: keyed texts, and ``doc_id, twin, pos, n`` byte spans covered by strings that start earlier.

    ``twin`` tells apart rows that share an id (0 where ids are unique): they are ordered by a hash of
    their texts, and equal rows count as one document. A null id comes before all others.
    """
    rows = texts(docs)
    shared = rows.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1).count() > 0
    twin = F.xxhash64("text") if shared else F.lit(0).cast("long")
    keyed = rows.select(F.coalesce("doc_id", F.lit(LEAST)).alias("doc_id"), twin.alias("twin"), "text")
    once = keyed.dropDuplicates() if shared else keyed
    found = durable(_scan(_ranked_cells(once, length, seed), length), "suffix-runs")
    runs = found.where(f"kind = {_OPEN}")
    # A rank of more than ``crowd`` runs is dealt out in shares; there are fewer of them than runs / crowd.
    crowded = runs.groupBy("rank").count().where(F.col("count") > crowd).select(
        "rank", F.ceil(F.col("count") / crowd).cast("int").alias("shares")
    )
    runs = runs.join(F.broadcast(crowded), "rank", "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
    opened = runs.groupBy("doc_id", "twin").agg(F.collect_list(F.struct("pos", "n", "rank", "shares")).alias("runs"))
    late = _repeated_strings(_ranked_strings(once.join(opened, ["doc_id", "twin"]), length), length)
    spans = found.where(f"kind = {_COVERED}").unionByName(late).select("doc_id", "twin", "pos", "n")
    return keyed, spans


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row after each covered byte is gone.

    Null and empty texts have no bytes and keep none; texts shorter than ``length`` lose nothing; an empty
    table gives an empty result.
    """
    keyed, spans = repeated_bytes(docs, length, seed)
    per_doc = spans.groupBy("doc_id", "twin").agg(F.collect_list(F.struct("pos", "n")).alias("spans"))
    joined = keyed.join(per_doc, ["doc_id", "twin"], "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
                raw = text.encode("utf-8", "surrogatepass")
                kept, end, removed, runs = [], 0, 0, 0
                open_ = False
                for pos, stop in sorted((s["pos"], s["pos"] + s["n"]) for s in spans or ()):
                    if pos > end or not open_:
                        kept.append(raw[end:pos])
                        runs += 1
                        removed += stop - pos
                        end = stop
                        open_ = True
                    elif stop > end:
                        removed += stop - end
                        end = stop
                kept.append(raw[end:])
                own = None if doc_id == LEAST else doc_id
                out.append((own, len(raw), removed, runs, hashlib.sha256(b"".join(kept)).hexdigest()))
            if out:
                yield batch_of(_KEPT_ARROW, *zip(*out))

    return joined.mapInArrow(run, _KEPT)
