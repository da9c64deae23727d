"""Members that fail against their bucket's hub still find every partner that they link to."""

import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from biblioweave.llm import minhash


def test_heads_lose_no_link(spark):
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(90)]
    bodies = []
    for cluster in range(40):
        own = [word() for _ in range(rng.choice([5, 15, 40, 90, 200]))]
        for _ in range(rng.choice([1, 2, 4])):
            text = passage + own if cluster % 3 else own + passage[: rng.randrange(30, 90)]
            text = [word() if rng.random() < rng.choice([0.0, 0.01, 0.02]) else w for w in text]
            bodies.append(" ".join(text * 2 if rng.random() < 0.1 else text))
    bodies += [" ".join(passage), " ".join(passage[:45] * 2)]
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
    settings = minhash.Settings()
    frequency, n = minhash.document_frequencies(docs, settings)
    bounds = spark.sparkContext.broadcast((minhash.true_weights(frequency, n), *minhash.true_weights(np.array([1, 2]), n).tolist()))
    nodes = docs.select(F.col("doc_id").alias("node"), "text")
    pairs = spark.range(1, n).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"), F.lit(True).alias("crowded"))

    doc, h, count = minhash.shingles(bodies, minhash._Words(), settings.words)
    every, place = np.unique(h, return_inverse=True)
    counts = np.zeros((n, len(every)))
    counts[doc, place] = count
    weights = minhash.true_weights((counts > 0).sum(0), n)

    def alike(x, y):
        return (np.minimum(counts[x], counts[y]) * weights).sum() / (np.maximum(counts[x], counts[y]) * weights).sum()

    near = [x for x in range(1, n) if alike(0, x) >= settings.similarity]
    found = minhash.compared(pairs, nodes, bounds, settings).withColumn("close", F.col("b").isin(near))
    rows = {r.node: r for r in minhash.heads(found, bounds).collect()}
    assert set(rows) == set(range(1, n)) and not any(rows[x].any for x in near)
    failed = [x for x in range(1, n) if x not in near]
    links = [(x, y) for x in failed for y in range(1, n) if x != y and alike(x, y) >= settings.similarity]
    looks, held = {x: set(rows[x].any) for x in failed}, {y: set(rows[y].own) for y in rows}
    met = {(x, y) for x in failed for y in held if x != y and looks[x] & held[y]}
    assert len(links) > 50 and met.issuperset(links)
    assert len(met) < len(failed) * (n - 2) / 2


def plain_shingles(bodies, size):
    """By a plain programme: words by the pattern alone, shingles sorted by document and hash together."""
    rows = []
    for i, text in enumerate(bodies):
        known = [np.frombuffer(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "<u8") for w in minhash.WORD.findall(text.lower())]
        for run in [known[j : j + size] for j in range(max(1, len(known) - size + 1))] if known else []:
            h = np.zeros(1, np.uint64)
            for w in run:
                h = minhash._mix(h + w + np.uint64(0x9E3779B97F4A7C15))
            rows.append((i, int((h + np.uint64(len(known) if len(known) < size else 0))[0])))
    return sorted(Counter(rows).items())


def test_shingles_and_signatures_of_runs_equal_those_of_each_text(monkeypatch):
    rng = random.Random(3)
    pieces = ["a", "A_b", "\x1f", "\x00", "!", "é", "ß", " ", "x1", "The"]
    bodies = ["", "!!", "".join(map(chr, range(128))), *["".join(rng.choice(pieces) + rng.choice(" .\n") for _ in range(rng.randrange(0, 60))) for _ in range(80)]]
    doc, h, count = minhash.shingles(bodies, minhash._Words(), 5)
    assert [((int(d), int(x)), int(c)) for d, x, c in zip(doc, h, count)] == plain_shingles(bodies, 5)
    weight = np.linspace(0.5, 2, len(doc))
    whole = minhash._Samples(6).signatures(doc, h, weight, len(bodies))
    monkeypatch.setattr(minhash, "_NEAR", 7)
    assert (minhash._Samples(6).signatures(doc, h, weight, len(bodies)) == whole).all()
    for i in range(len(bodies)):
        own = doc == i
        assert (minhash._Samples(6).signatures(doc[own], h[own], weight[own], len(bodies))[i] == whole[i]).all()
