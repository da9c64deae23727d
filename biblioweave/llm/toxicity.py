"""Toxic spans by a linear-chain conditional random field; marginals give document scores and offending offsets."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import append
from .quality import labelled_sample

WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Settings:
    """``train_rows`` bounds the labelled sample that is fitted (the longest texts of it are left out above
    ``train_chars``), ``buckets`` the hashed word weights, whatever the size of the corpus."""

    train_rows: int = 3_000
    train_chars: int = 20_000
    buckets: int = 1 << 16
    window: int = 64
    steps: int = 30
    rate: float = 0.5
    ridge: float = 1e-4
    least_docs: int = 4
    least_odds: float = 3.0


@dataclass(frozen=True)
class Field:
    """Two states, 0 ordinary and 1 toxic: log weights of words in state 1, of transitions and of the start."""

    words: np.ndarray
    moves: np.ndarray
    start: np.ndarray
    document: np.ndarray


# Windows, and words, that are fitted at a time: they bound the driver's memory, as each takes some hundred bytes then.
_ROWS, _WORDS = 1 << 12, 1 << 19


def word_hash(word: str, buckets: int) -> int:
    return crc32(word.lower().encode("utf-8", "surrogatepass")) % buckets


def families(docs: list[np.ndarray]) -> np.ndarray:
    """One number per document that near-copies mostly share: the least hash of two neighbouring words."""
    def least(words: list[int]) -> int:
        return min((crc32(b"%d %d" % pair) for pair in zip(words, words[1:])), default=sum(words[:1]))

    return np.array([least(_listed(w)) for w in docs], np.int64)


def _listed(words: np.ndarray | list[int]) -> list[int]:
    return np.asarray(words, np.int64).tolist()


def token_labels(docs: list[np.ndarray], toxic: np.ndarray, settings: Settings) -> list[np.ndarray]:
    """1 where a word of a toxic document is far more frequent among toxic documents, else 0.

    Near-copies count once, so the rare words of a copied toxic document are not taken for toxic ones.
    """
    family = families(docs)
    seen, totals = np.zeros((2, settings.buckets)), np.zeros(2)
    for y in (0, 1):
        own = np.flatnonzero(toxic == y)
        kinds, kind = np.unique(family[own], return_inverse=True)
        each = np.concatenate([np.zeros(0, np.int64), *[np.unique(k * settings.buckets + np.asarray(docs[i], np.int64)) for i, k in zip(own, kind)]])
        seen[y] = np.bincount(np.unique(each) % settings.buckets, minlength=settings.buckets)
        totals[y] = len(kinds) + 1.0
    odds = np.log((seen[1] + 0.5) / totals[1]) - np.log((seen[0] + 0.5) / totals[0])
    marked = (odds >= settings.least_odds) & (seen[1] >= settings.least_docs)
    return [marked[np.asarray(words, np.int64)].astype(np.int8) * int(y) for words, y in zip(docs, toxic)]


def _log_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def fit_chain(docs: list[np.ndarray], tags: list[np.ndarray], settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximum likelihood of the chain by adaptive gradient steps; documents are cut into windows for fitting only.

    A step takes ``_ROWS`` windows at a time. Only the exponents of neighbouring words are kept until its end, so that
    sums run over the same numbers in the same order, however many windows are taken at a time.
    """
    size = settings.window
    cut = [(w[i : i + size], t[i : i + size]) for w, t in zip(docs, tags) for i in range(0, len(w), size)]
    words, moves, start = np.zeros(settings.buckets), np.zeros((2, 2)), np.zeros(2)
    if not cut:
        return words, moves, start
    rows = len(cut)
    ids, tag, held = np.zeros((rows, size), np.int32), np.zeros((rows, size), np.int8), np.zeros((rows, size), bool)
    for r, (w, t) in enumerate(cut):
        ids[r, : len(w)], tag[r, : len(w)], held[r, : len(w)] = w, t, True
    pair_held = held[:, 1:]
    true_words = np.bincount(ids[held], tag[held], settings.buckets)
    true_moves = np.bincount((tag[:, :-1] * 2 + tag[:, 1:])[pair_held], minlength=4).reshape(2, 2)
    true_start = np.bincount(tag[:, 0], minlength=2)
    frequency = np.bincount(ids[held], minlength=settings.buckets)
    words_held = held.sum()
    ends = np.append(0, np.cumsum(pair_held.sum(1)))
    joints, firsts = np.empty((2, 2, ends[-1])), np.empty(rows)
    memory = [np.full(settings.buckets, 1e-8), np.full((2, 2), 1e-8), np.full(2, 1e-8)]
    for _ in range(settings.steps):
        expected = np.zeros(settings.buckets)
        for at in range(0, rows, _ROWS):
            to = min(at + _ROWS, rows)
            own, ids_, place = held[at:to], ids[at:to], slice(ends[at], ends[to])
            emit = np.where(own, words[ids_], 0.0)
            forward, backward = np.zeros((size, to - at, 2)), np.zeros((size, to - at, 2))
            forward[0] = start
            forward[0, :, 1] += emit[:, 0]
            for t in range(1, size):
                step = np.stack([_log_sum(forward[t - 1, :, 0] + moves[0, s], forward[t - 1, :, 1] + moves[1, s]) for s in (0, 1)], 1)
                step[:, 1] += emit[:, t]
                forward[t] = np.where(own[:, t, None], step, forward[t - 1])
            for t in range(size - 2, -1, -1):
                nxt = backward[t + 1].copy()
                nxt[:, 1] += emit[:, t + 1]
                step = np.stack([_log_sum(moves[s, 0] + nxt[:, 0], moves[s, 1] + nxt[:, 1]) for s in (0, 1)], 1)
                backward[t] = np.where(own[:, t + 1, None], step, backward[t + 1])
            total = _log_sum(forward[-1, :, 0], forward[-1, :, 1])
            one = np.exp(forward[:, :, 1] + backward[:, :, 1] - total).T
            np.add.at(expected, ids_[own], one[own])
            firsts[at:to] = one[:, 0]
            for a in (0, 1):
                for b in (0, 1):
                    joint = forward[:-1, :, a] + moves[a, b] + backward[1:, :, b] - total
                    if b:
                        joint = joint + emit.T[1:]
                    joints[a, b, place] = np.exp(joint.T[pair_held[at:to]])
        pairs = np.array([[joints[a, b].sum() for b in (0, 1)] for a in (0, 1)])
        first = np.array([1 - firsts, firsts]).sum(1)
        slopes = [
            (true_words - expected) / (1 + frequency) - settings.ridge * words, (true_moves - pairs) / words_held,
            (true_start - first) / rows,
        ]
        for weight, slope, past in zip((words, moves, start), slopes, memory):
            past += slope**2
            weight += settings.rate * slope / np.sqrt(past)
    return words, moves, start


def _products(m: np.ndarray, block: int = 64) -> np.ndarray:
    """Running products ``m[0] m[1] ... m[i]`` of 2 x 2 matrices, each scaled to its largest entry.

    Blocks advance side by side and are then joined, so the loops are short however long the chain.
    """
    n = len(m)
    if n <= block:
        out = m.copy()
        for i in range(1, n):
            out[i] = out[i - 1] @ m[i]
            out[i] /= out[i].max()
        return out
    rows = -(-n // block)
    padded = np.tile(np.eye(2), (rows * block, 1, 1))
    padded[:n] = m
    padded = padded.reshape(rows, block, 2, 2)
    for i in range(1, block):
        a, b = padded[:, i - 1], padded[:, i]
        step = np.empty_like(b)
        step[:, :, 0] = a[:, :, 0] * b[:, 0, 0, None] + a[:, :, 1] * b[:, 1, 0, None]
        step[:, :, 1] = a[:, :, 0] * b[:, 0, 1, None] + a[:, :, 1] * b[:, 1, 1, None]
        padded[:, i] = step / step.max((1, 2))[:, None, None]
    lead = np.tile(np.eye(2), (rows, 1, 1))
    lead[1:] = _products(padded[:-1, -1].copy(), block)
    joined = lead[:, None] @ padded
    joined /= joined.max((2, 3))[:, :, None, None]
    return joined.reshape(-1, 2, 2)[:n]


def marginals(ids: np.ndarray, firsts: np.ndarray, field: Field) -> np.ndarray:
    """P(toxic) of every word of a run of documents, each starting at one of ``firsts``, by forward and backward."""
    n = len(ids)
    if not n:
        return np.zeros(0)
    emit = np.exp(np.clip(field.words[ids], -30, 30))
    top = np.maximum(emit, 1.0)
    weights = np.stack([1 / top, emit / top], 1)
    move, start = np.exp(field.moves - field.moves.max()), np.exp(field.start - field.start.max())
    opens = np.zeros(n, bool)
    opens[firsts] = True
    step = np.where(opens[:, None, None], start[None, None, :], move[None]) * weights[:, None, :]
    ahead = _products(step)[:, 0, :]
    back = np.ones((n, 2))
    if n > 1:
        # From the right: suffix products of the same matrices. A document's end forgets what follows.
        turned = np.swapaxes(step[1:][::-1], 1, 2)
        closing = opens[1:][::-1]
        turned = np.where(closing[:, None, None], np.ones((1, 2, 2)), turned)
        back[:-1] = _products(turned).sum(1)[::-1]
    both = ahead * back
    return both[:, 1] / both.sum(1)


def document_features(p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per document: 1, strongest marginal, log expected toxic words, their share."""
    ends = np.cumsum(counts)
    total = np.concatenate([[0.0], np.cumsum(p)])
    mass = total[ends] - total[ends - counts]
    top = np.zeros(len(counts))
    filled = counts > 0
    if filled.any():
        top[filled] = np.maximum.reduceat(p, (ends - counts)[filled])
    return np.stack([np.ones(len(counts)), top, np.log1p(mass), mass / np.maximum(counts, 1)], 1)


def _runs_of(docs: list[np.ndarray], words: int) -> Iterator[list[np.ndarray]]:
    """Neighbouring documents, up to about so many words together."""
    part, held = [], 0
    for d in docs:
        if part and held + len(d) > words:
            yield part
            part, held = [], 0
        part.append(d)
        held += len(d)
    if part:
        yield part


def _features_of(docs: list[np.ndarray], field: Field) -> np.ndarray:
    counts = np.array([len(d) for d in docs], np.int64)
    firsts = (np.cumsum(counts) - counts)[counts > 0]
    return document_features(marginals(np.concatenate(docs), firsts, field), counts)


def fit_document(features: np.ndarray, labels: np.ndarray, steps: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps: marginals to a document's probability."""
    weight = np.zeros(features.shape[1])
    keep = np.eye(len(weight)) * ridge
    for _ in range(steps if len(labels) else 0):
        p = 1 / (1 + np.exp(-np.clip(features @ weight, -30, 30)))
        slope = features.T @ (labels - p) - keep @ weight
        curve = (features * (p * (1 - p))[:, None]).T @ features + keep
        weight = weight + np.linalg.solve(curve, slope)
    return weight


def fit(bodies: list[str], labels: list[int], settings: Settings = Settings()) -> Field:
    """Field and document weights of labelled texts. Without texts, or toxic ones, nothing is toxic."""
    toxic = np.array(labels, np.int64)
    docs = [np.array([word_hash(w, settings.buckets) for w in WORD.findall(t)], np.int32) for t in bodies]
    tags = token_labels(docs, toxic, settings) if docs else []
    field = Field(*fit_chain(docs, tags, settings), document=np.zeros(4))
    features = [_features_of(part, field) for part in _runs_of(docs, _WORDS)]
    features = np.concatenate([np.zeros((0, 4)), *features])
    weight = fit_document(features, toxic.astype(float)) if toxic.any() else np.array([-5.0, 0, 0, 0])
    return Field(field.words, field.moves, field.start, weight)


def train(docs: DataFrame, labels: DataFrame, allowed: Column, settings: Settings = Settings()) -> Field:
    """Fit on a bounded sample of labelled rows that may be learned from."""
    sample = labelled_sample(docs, labels, "toxic", allowed, settings.train_rows)
    rows = sample.where(F.length("text") <= settings.train_chars).orderBy("doc_id", "text").limit(settings.train_rows).collect()
    return fit([r.text for r in rows], [r.label for r in rows], settings)


class _Hashes(dict):
    """Hash of each word, kept for the most recent 200,000 words of a task."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, word: str) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[word] = value = word_hash(word, self.buckets)
        return value


def with_score(docs: DataFrame, field: Field, text_col: str = "text", span_floor: float = 0.5) -> DataFrame:
    """Add ``score, toxic_words, spans`` to every row, from the whole text, without a shuffle.

    ``spans`` are runs of words with a marginal of at least ``span_floor``, in code points, end exclusive. Null and
    empty texts have no words; they get the score of a text without toxic words. Repeated rows give equal
    results, other columns pass through, an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)  # its size is fixed by Settings.buckets

    def make():
        own = shared.value
        hashes = _Hashes(len(own.words))

        def find(bodies: list[str]):
            found = [WORD.findall(t) for t in bodies]
            counts = np.array([len(f) for f in found], np.int64)
            flat = np.fromiter((hashes[w] for f in found for w in f), np.int64, int(counts.sum()))
            begins = np.cumsum(counts) - counts
            p = marginals(flat, begins[counts > 0], own)
            scores = 1 / (1 + np.exp(-np.clip(document_features(p, counts) @ own.document, -30, 30)))
            hot = p >= span_floor
            total = np.concatenate([[0], np.cumsum(hot)])
            hits = total[begins + counts] - total[begins]
            spans = [_runs(t, hot[b : b + n]) if k else [] for t, b, n, k in zip(bodies, begins, counts, hits)]
            return scores, hits, spans

        return find

    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return append(docs, make, {
        "score": ("double", pa.float64()), "toxic_words": ("long", pa.int64()),
        "spans": ("array<struct<start:long,end:long>>", pa.list_(span)),
    }, text_col)


def _runs(text: str, hot: np.ndarray) -> list[dict]:
    out: list[dict] = []
    last = -2
    for i, m in enumerate(WORD.finditer(text)):
        if hot[i]:
            if last == i - 1:
                out[-1]["end"] = m.end()
            else:
                out.append({"start": m.start(), "end": m.end()})
            last = i
    return out
