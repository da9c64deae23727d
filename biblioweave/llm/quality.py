"""Quality classifier: histogram gradient-boosted trees over document statistics, traversed as flat arrays."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import batch_of, texts

FEATURES = (
    "log_bytes", "log_words", "word_length", "long_words", "unique_words", "top_word", "upper", "digit", "space", "line_break",
    "symbol", "non_ascii", "bang", "pipe", "stop_end", "comma", "upper_words", "plain_words", "repeat_lines", "repeat_trigrams",
    "line_length", "entropy", "word_repeat", "brackets",
)
_SCORES = "doc_id long, score double"
_SCORES_ARROW = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


@dataclass(frozen=True)
class Settings:
    """``train_rows`` bounds the labelled sample that is fitted, whatever the size of the corpus."""

    train_rows: int = 20_000
    trees: int = 80
    depth: int = 4
    bins: int = 64
    rate: float = 0.15
    least_weight: float = 5.0
    ridge: float = 1.0


@dataclass(frozen=True)
class Trees:
    """All trees as arrays of nodes; a leaf points to itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float


def statistics(text: str) -> list[float]:
    """``FEATURES`` of a whole text; an empty text gives zeros."""
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    c = counts.tolist()
    words = text.split()
    m = len(words) or 1
    unique: dict[str, int] = {}
    for w in words:
        unique[w] = unique.get(w, 0) + 1
    lines = text.split("\n")
    triples = set(zip(words, words[1:], words[2:]))
    upper, digit = sum(c[65:91]), sum(c[48:58])
    lower, high = sum(c[97:123]), sum(c[128:])
    space = c[32] + c[9] + c[13]
    p = counts[counts > 0] / n
    return [
        math.log1p(n), math.log1p(len(words)), sum(map(len, words)) / m, sum(len(w) > 12 for w in words) / m, len(unique) / m,
        max(unique.values(), default=0) / m, upper / n, digit / n, space / n, c[10] / n,
        (n - upper - lower - digit - high - space - c[10]) / n, high / n, c[33] / n, c[124] / n,
        sum(w[-1] in ".!?" for w in words) / m, c[44] / n, sum(w.isupper() for w in words) / m, sum(w.isalpha() for w in words) / m,
        1 - len(set(lines)) / len(lines), 1 - len(triples) / (m - 2) if m > 2 else 0.0, n / len(lines),
        float(-(p * np.log2(p)).sum()), sum(a == b for a, b in zip(words, words[1:])) / m, (c[40] + c[91] + c[123] + c[60]) / n,
    ]


def with_statistics(rows: DataFrame, *kept: str) -> DataFrame:
    """``features`` of every row beside the columns ``kept`` of long type. No shuffle."""
    schema = pa.schema([*[(k, pa.int64()) for k in kept], ("features", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *own, bodies = batch.columns
            yield batch_of(schema, *own, [statistics(t.as_py()) for t in bodies])

    columns = [F.col(k).cast("long").alias(k) for k in kept]
    return rows.select(*columns, "text").mapInArrow(run, ", ".join([*[f"{k} long" for k in kept], "features array<double>"]))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, rows: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``rows`` labelled rows that may be learned from, the same at every run.

    Rows are ranked by a hash of their id, and top-k keeps ``rows`` per task before anything meets. A null label
    is no label; of several labels of an id the highest counts.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & allowed).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.max(F.col(label).cast("int")).alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(rows)
    # A bounded table, so it may be broadcast: the texts need no shuffle.
    return texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")


def fit(features: np.ndarray, labels: np.ndarray, settings: Settings = Settings()) -> Trees:
    """Logistic boosting: per level one histogram of gradients over (node, feature, bin), best cut by gain."""
    n, width = features.shape
    positive = float(labels.sum())
    base = math.log((positive + 1) / (n - positive + 1))
    parts: dict[str, list] = {k: [] for k in ("feature", "cut", "left", "right", "value")}
    roots: list[int] = []
    if n == 0 or positive in (0, n):
        return _flat(parts, roots, settings.depth, base)
    quantiles = np.linspace(0, 1, settings.bins + 1)[1:-1]
    cuts = np.stack([np.quantile(features[:, j], quantiles) for j in range(width)])
    binned = np.stack([np.searchsorted(cuts[j], features[:, j], side="left") for j in range(width)], axis=1)
    score = np.full(n, base)
    offsets = np.arange(width) * settings.bins
    for _ in range(settings.trees):
        p = 1 / (1 + np.exp(-score))
        gradient, hessian = labels - p, p * (1 - p)
        node = np.zeros(n, np.int64)  # place within the level; -1 once in a leaf
        ids = [len(parts["value"])]
        roots.append(ids[0])
        _node(parts)
        for level in range(settings.depth + 1):
            live = node >= 0
            if not live.any():
                break
            size = len(ids) * width * settings.bins
            slot = (node[live, None] * width * settings.bins + offsets + binned[live]).ravel()
            g = np.bincount(slot, np.repeat(gradient[live], width), size).reshape(len(ids), width, settings.bins)
            h = np.bincount(slot, np.repeat(hessian[live], width), size).reshape(len(ids), width, settings.bins)
            total_g, total_h = g[:, 0].sum(1), h[:, 0].sum(1)
            gl, hl = g.cumsum(2)[:, :, :-1], h.cumsum(2)[:, :, :-1]
            gr, hr = total_g[:, None, None] - gl, total_h[:, None, None] - hl
            gain = gl**2 / (hl + settings.ridge) + gr**2 / (hr + settings.ridge) - (total_g**2 / (total_h + settings.ridge))[:, None, None]
            gain[(hl < settings.least_weight) | (hr < settings.least_weight)] = -1
            best = gain.reshape(len(ids), -1).argmax(1)
            children, following = np.full((len(ids), 2), -1), []
            which, where = np.zeros(len(ids), int), np.zeros(len(ids), int)
            for i, own in enumerate(ids):
                j, b = divmod(int(best[i]), settings.bins - 1)
                if level == settings.depth or gain[i, j, b] <= 1e-6:
                    parts["value"][own] = settings.rate * total_g[i] / (total_h[i] + settings.ridge)
                    continue
                which[i], where[i] = j, b
                parts["feature"][own], parts["cut"][own] = j, cuts[j, b]
                for side, name in enumerate(("left", "right")):
                    children[i, side] = len(following)
                    parts[name][own] = len(parts["value"])
                    following.append(len(parts["value"]))
                    _node(parts)
            values = np.array([parts["value"][i] for i in ids])
            ended = live & (children[node, 0] < 0)
            score[ended] += values[node[ended]]
            right = np.zeros(n, int)
            right[live] = binned[np.flatnonzero(live), which[node[live]]] > where[node[live]]
            node = np.where(live, children[node, right], -1)
            ids = following
    return _flat(parts, roots, settings.depth, base)


def _node(parts: dict[str, list]) -> None:
    own = len(parts["value"])
    for name, start in (("feature", 0), ("cut", 0.0), ("left", own), ("right", own), ("value", 0.0)):
        parts[name].append(start)


def _flat(parts, roots, depth, base) -> Trees:
    whole = {k: np.asarray(v, np.float64 if k in ("cut", "value") else np.int64) for k, v in parts.items()}
    return Trees(**whole, roots=np.asarray(roots, np.int64), depth=depth, base=base)


def probability(trees: Trees, features: np.ndarray) -> np.ndarray:
    """All rows walk down all trees at once, one level per step."""
    at = np.repeat(trees.roots[None, :], len(features), axis=0)
    rows = np.arange(len(features))[:, None]
    for _ in range(trees.depth if len(trees.roots) else 0):
        right = features[rows, trees.feature[at]] > trees.cut[at]
        at = np.where(right, trees.right[at], trees.left[at])
    raw = trees.base + (trees.value[at].sum(1) if len(trees.roots) else 0.0)
    return 1 / (1 + np.exp(-raw)) + np.zeros(len(features))


def train(docs: DataFrame, labels: DataFrame, allowed: Column, settings: Settings = Settings()) -> Trees:
    """Fit on at most ``settings.train_rows`` labelled rows; only their statistics and labels reach the driver."""
    sample = labelled_sample(docs, labels, "quality", allowed, settings.train_rows)
    stats = with_statistics(sample, "doc_id", "label")
    rows = stats.orderBy("doc_id", "features").limit(settings.train_rows).collect()
    features = np.array([r.features for r in rows], np.float64).reshape(len(rows), len(FEATURES))
    return fit(features, np.array([r.label for r in rows], np.float64), settings)


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row: probability of good quality, from the whole text. No shuffle.

    Null and empty texts have zero statistics and are scored like any other; repeated rows give equal rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, bodies = batch.columns
                stats = np.array([statistics(t.as_py()) for t in bodies], np.float64)
                yield batch_of(_SCORES_ARROW, ids, probability(trees, stats))

    return texts(docs, id_col, text_col).mapInArrow(run, _SCORES)
