"""Pairs that bounds leave open: few of them are looked up or summed up, and none that links is lost."""

import random

import numpy as np
from pyspark.sql import functions as F

from biblioweave.llm import minhash


def edited(rng, words, times):
    out = list(words)
    for at in rng.sample(range(len(out)), times):
        out[at] = f"e{rng.randrange(10**9)}"
    return out


def similarities(bodies, settings):
    doc, h, count = minhash.shingles(bodies, minhash._Words(), settings.words)
    every, place = np.unique(h, return_inverse=True)
    counts = np.zeros((len(bodies), len(every)))
    counts[doc, place] = count
    weights = minhash.true_weights((counts > 0).sum(0), len(bodies))
    return lambda x, y: (np.minimum(counts[x], counts[y]) * weights).sum() / (np.maximum(counts[x], counts[y]) * weights).sum()


def group(seed, members):
    """A hub one edit off the text that all members were made from; some members share edits."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(130)]
    made = [edited(rng, base, 1)]
    while len(made) <= members:
        one = edited(rng, base, rng.randrange(0, 7))
        made += [one, edited(rng, one, 1)] if rng.random() < 0.2 else [one]
    return [" ".join(w) for w in made]


def test_members_meet_only_where_enough_is_left_to_share(spark):
    bodies, settings = group(5, 150), minhash.Settings()
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
    frequency, n = minhash.document_frequencies(docs, settings)
    bounds = spark.sparkContext.broadcast((minhash.true_weights(frequency, n), *minhash.true_weights(np.array([1, 2]), n).tolist()))
    pairs = spark.range(1, n).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"), F.lit(True).alias("crowded"))
    alike = similarities(bodies, settings)
    near = [x for x in range(1, n) if alike(0, x) >= settings.similarity]
    found = minhash.compared(pairs, docs.select(F.col("doc_id").alias("node"), "text"), bounds, settings)
    rows = {r.node: r for r in minhash.heads(found.withColumn("close", F.col("b").isin(near)), bounds, n).collect()}
    failed = [x for x in range(1, n) if x not in near]
    looks = {x: dict(zip(rows[x].any, rows[x].any_left)) for x in failed}
    held = {y: dict(zip(rows[y].own, rows[y].own_left)) for y in rows}
    shared = {(x, y) for x in failed for y in held if x != y and looks[x].keys() & held[y].keys()}
    met = {
        (x, y) for x, y in shared
        if any(2 * min(looks[x][k], held[y][k]) >= rows[x].least + rows[y].least for k in looks[x].keys() & held[y].keys())
    }
    links = {(x, y) for x in failed for y in held if x != y and alike(x, y) >= settings.similarity}
    assert len(links) > 20 and met >= links
    assert len(met) < len(shared) / 2


def test_few_pairs_are_summed_up_row_by_row(spark):
    bodies, settings = group(6, 120), minhash.Settings(slots=64)  # counters that tell nothing
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
    nodes = docs.select(F.col("doc_id").alias("node"), "text")
    frequency, n = minhash.document_frequencies(docs, settings)
    bounds = spark.sparkContext.broadcast((minhash.true_weights(frequency, n), *minhash.true_weights(np.array([1, 2]), n).tolist()))
    pairs = spark.range(1, n).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"), F.lit(False).alias("crowded"))
    alike = similarities(bodies, settings)
    open_ = minhash.compared(pairs, nodes, bounds, settings).where("low < 0.8 AND high >= 0.8").select("a", "b")
    counted = minhash.frequencies(docs.select(F.col("doc_id").alias("node")), nodes, docs, settings)
    extreme = spark.sparkContext.broadcast(minhash.extremes(counted))
    again = minhash.narrowed(open_, nodes, extreme, n, settings).collect()
    assert all(r.low <= alike(r.a, r.b) + 1e-9 and r.high >= alike(r.a, r.b) - 1e-9 for r in again)
    assert len(again) > 10 and sum(r.low < 0.8 <= r.high for r in again) < len(again) / 5
    summed = minhash.exact(open_, nodes, counted, n, settings).collect()
    assert len(summed) == len(again) and all(abs(r.similarity - alike(r.a, r.b)) < 1e-9 for r in summed)
    found = minhash.verified(pairs, nodes, docs, bounds, n, settings, "tried").collect()
    assert {r.b for r in found if r.close} == {x for x in range(1, n) if alike(0, x) >= settings.similarity}


def test_quick_hashes_tell_the_same_words_apart():
    rng = random.Random(9)
    pieces = ["a", "A_b", "\x1f", "\x00", "!", "é", "ß", " ", "x1", "The", "İ", "\n", "\ud800", "中"]
    bodies = ["", "!!", "", "".join(map(chr, range(128))), "a" * 200 + " b" + "a" * 70, "x1 the", "é x1 THE"]
    bodies += ["".join(rng.choice(pieces[: rng.choice([5, 14])]) + rng.choice(["", " ", "."]) for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    bodies += ["Word " * 30_000, "other " * 30_000, "".join(chr(97 + i % 26) + str(i) + " " for i in range(60_000))]
    flat, counts = minhash.words(bodies, minhash._Words())
    quick, quick_counts = minhash.words(bodies, minhash._Quick())
    assert (counts == quick_counts).all() and len(flat) == len(quick)
    assert len(set(flat.tolist())) == len(set(quick.tolist())) == len(set(zip(flat.tolist(), quick.tolist())))
    assert (minhash._Quick().words(bodies[5:6])[0] == minhash._Quick().words(bodies[6:7])[0][1:]).all()
    assert [x.tolist() for x in minhash._Quick().words([])] == [[], []]
