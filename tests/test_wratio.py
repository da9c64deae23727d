import random

import pytest
from pyspark.sql import functions as F

from biblioweave.functions import wratio
from biblioweave.operators.fuzzy import best_weighted


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous = 0
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], previous + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    return 2 * lcs(a, b) / (len(a) + len(b)) if a and b else 0.0


def partial(a, b):
    if not a or not b:
        return 0.0
    s, t = sorted((a, b), key=len) if len(a) != len(b) else (a, b)
    windows = [t[max(0, i) : i + len(s)] for i in range(1 - len(s), len(t))]
    return max(ratio(s, w) for w in windows)


def token_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    if x & y and (not x - y or not y - x):
        return 1.0
    both, one, two = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    whole_a, whole_b = (" ".join(filter(None, (both, s))) for s in (one, two))
    gap = 1 if both else 0
    total = len(whole_a) + len(whole_b)
    scores = [1 - (len(one) + len(two) - 2 * lcs(one, two)) / total]
    if both:
        scores += [1 - (gap + len(s)) / (len(both) + len(w)) for s, w in ((one, whole_a), (two, whole_b))]
    return max(scores)


def weighted(a, b):
    if not a or not b:
        return 0.0
    sort = lambda s: " ".join(sorted(s.split()))
    long, short = max(len(a), len(b)), min(len(a), len(b))
    if long / short < 1.5:
        return max(ratio(a, b), 0.95 * max(ratio(sort(a), sort(b)), token_set(a, b)))
    scale = 0.9 if long / short <= 8 else 0.6
    x, y = set(a.split()), set(b.split())
    tokens = 1.0 if x & y else max(partial(sort(a), sort(b)), partial(" ".join(sorted(x - y)), " ".join(sorted(y - x))))
    return max(ratio(a, b), scale * partial(a, b), 0.95 * scale * tokens)


def pairs():
    rng = random.Random(2)
    words = ["ab", "abc", "baca", "cab", "dada", "bb", "éa", "題名", "x"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    made = [(text(rng.randrange(1, 8)), text(rng.randrange(1, 8))) for _ in range(40)]
    made += [(text(40), text(38)), (text(2), text(30)), ("", "a"), ("a", ""), ("", ""), ("a b", "b a"), ("a b c", "a b"), ("a" * 62, "a" * 125), ("ab" * 70, "ba" * 62)]
    return made


@pytest.mark.parametrize(
    "column,plain",
    [(wratio.lcs, lcs), (wratio.indel_ratio, ratio), (wratio.token_set_ratio, token_set), (wratio.partial_ratio, partial), (wratio.weighted_ratio, weighted)],
)
def test_equals_the_plain_programme(spark, column, plain):
    rows = pairs()
    df = spark.createDataFrame(rows, "a string, b string").select("a", "b", column(F.col("a"), F.col("b")).alias("x"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    for r in df.collect():
        assert r.x == pytest.approx(plain(r.a, r.b)), (r.a, r.b)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


def test_best_weighted_equals_the_nested_loop(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcde fg") for _ in range(rng.randrange(3, 40))).strip() or "a" for _ in range(40)]
    choices = list(enumerate(sorted(set(base))))
    queries = []
    for i, t in enumerate(base):
        words = t.split()
        rng.shuffle(words)
        at = rng.randrange(len(t))
        queries += [(2 * i, " ".join(words)), (2 * i + 1, t[:at] + rng.choice("xyz") + t[at + 1 :])]
    sort = lambda s: " ".join(sorted(s.split()))
    close = lambda a, b: 100 * levenshtein(a, b) <= 15 * (len(a) + len(b))
    expected = {}
    for q, a in queries:
        scores = [(-weighted(a, b), c) for c, b in choices if close(a, b) or close(sort(a), sort(b))]
        if scores and min(scores)[0] <= -0.85:
            expected[q] = (min(scores)[1], -min(scores)[0])
    q, c = spark.createDataFrame(queries, "q long, qt string"), spark.createDataFrame(choices, "c long, ct string")
    found = {r.q: (r.c, r.score) for r in best_weighted(q, c, "q", "qt", "c", "ct", 85).collect()}
    assert {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in expected.items()}
    assert all(found[k][1] == pytest.approx(v[1]) for k, v in expected.items())


@pytest.mark.parametrize("block", [1, 3, 2_000])
def test_parts_of_any_size_find_the_same(spark, block):
    """Equal texts, repeated ids and nulls among them; every text in reach of another's length meets it, whatever the parts."""
    rng = random.Random(9)
    base = [" ".join("".join(rng.choice("abcdef") for _ in range(rng.randrange(2, 7))) for _ in range(rng.randrange(2, 6))) for _ in range(25)]
    choices = [(i % 23, t) for i, t in enumerate(base)] + [(50, base[0]), (None, base[1]), (51, None), (52, "")]
    queries = [(i % 21, t[:1] + "z" + t[2:]) for i, t in enumerate(base)] + [(60, base[0]), (None, base[2]), (61, None), (62, "")]
    sort = lambda s: " ".join(sorted(s.split()))
    close = lambda a, b: 100 * levenshtein(a, b) <= 15 * (len(a) + len(b))
    expected = {}
    for q, a in queries:
        for c, b in choices:
            if q is not None and c is not None and a and b and (close(a, b) or close(sort(a), sort(b))) and (x := weighted(a, b)) >= 0.85:
                expected[q] = min(expected.get(q, (0, 0)), (-x, c))
    q, c = spark.createDataFrame(queries, "q long, qt string"), spark.createDataFrame(choices, "c long, ct string")
    found = {r.q: (r.c, r.score) for r in best_weighted(q, c, "q", "qt", "c", "ct", 85, block=block).collect()}
    assert {k: v[0] for k, v in found.items()} == {k: v[1] for k, v in expected.items()} and len(found) > 10
    assert all(found[k][1] == pytest.approx(-v[0]) for k, v in expected.items())
