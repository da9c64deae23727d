import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_wratio import lcs, weighted

from biblioweave.functions import wratio
from biblioweave.operators import weighted as arrays
from biblioweave.operators.fuzzy import best_weighted


def nested_loop(queries, choices, least):
    expected = {}
    for q, a in queries:
        for c, b in choices:
            if q is not None and c is not None and a and b and (x := weighted(a, b)) >= least - 1e-12:
                expected[q] = min(expected.get(q, (0, 0)), (-x, c))
    return expected


def found_in(spark, queries, choices, percent, **settings):
    q, c = spark.createDataFrame(queries, "q long, qt string"), spark.createDataFrame(choices, "c long, ct string")
    return {r.q: (-r.score, r.c) for r in best_weighted(q, c, "q", "qt", "c", "ct", percent, **settings).collect()}


def test_pairs_of_unlike_lengths_and_token_sets_are_found(spark):
    choices = [
        (1, "solar panels of northern towns"), (2, "a history of the spinning wheel and its makers"), (3, "deep learning for rivers"),
        (4, "alpha beta gamma"), (5, "fog"), (6, "xabc defy"),
    ]
    queries = [
        (1, "solar energy"),  # one shared token
        (2, "the spinning wheel and"),  # a window of the choice
        (3, "rivers for for deep deep learning"),  # the same tokens, repeated
        (4, "spinnin whel and its maker"),  # a window with edits
        (5, "beta alpha gamma deltas"),  # the choice's tokens and one more
        (6, "abc def"),  # a window across tokens
        (7, "solar " + "z" * 300),  # a shared token, but more than eight times as long
        (8, "foggy days end"),
        (9, "nothing like it"),
    ]
    expected = nested_loop(queries, choices, 0.85)
    found = found_in(spark, queries, choices, 85)
    assert {k: v[1] for k, v in found.items()} == {k: v[1] for k, v in expected.items()} and {1, 2, 3, 5, 6} <= set(found) and 7 not in found
    assert all(found[k][0] == pytest.approx(v[0]) for k, v in expected.items())


@pytest.mark.parametrize("percent,block", [(85, 7), (60, 16_000), (100, 16_000)])
def test_whole_results_equal_the_nested_loop(spark, percent, block):
    rng = random.Random(percent)
    words = ["".join(rng.choice("abcdeé題") for _ in range(rng.randrange(1, 8))) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    choices = [(i % 28, text(rng.randrange(1, 9))) for i in range(30)] + [(40, None), (None, "a b"), (41, ""), (42, "  "), (43, "q" * 70 + " r s")]
    queries = [(60, None), (None, "a b"), (61, ""), (62, " 　"), (63, "q" * 71)]
    for i in range(30):
        b = rng.choice(choices[:30])[1]
        at = rng.randrange(len(b))
        part = rng.choice([b[at:], b[: at + 1], b + " " + text(3), b[:at] + "x" + b[at + 1 :], " ".join(b.split()[::-1]), text(2), b])
        queries.append((i % 29, part))
    expected = nested_loop(queries, choices, percent / 100)
    found = found_in(spark, queries, choices, percent, block=block)
    assert {k: v[1] for k, v in found.items()} == {k: v[1] for k, v in expected.items()} and found
    assert all(found[k][0] == pytest.approx(v[0]) for k, v in expected.items())


def test_scores_are_the_numbers_of_the_columns(spark):
    rng = random.Random(5)
    words = ["alpha", "beta", "gama", "delta", "eps", "zeta", "eta"]
    pairs = [(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 9))), " ".join(rng.choice(words) for _ in range(rng.randrange(1, 9)))) for _ in range(150)]
    pairs = [(a, b) for a, b in pairs if 2 * max(len(a), len(b)) < 3 * min(len(a), len(b)) or not set(a.split()) & set(b.split())]
    scores = spark.createDataFrame(pairs, "a string, b string").select(wratio.weighted_ratio(F.col("a"), F.col("b")).alias("x")).collect()
    for (a, b), r in zip(pairs, scores):
        found = arrays.best_of([a], [b], np.array([0.3]), np.array([0]))[2]
        assert found.tolist() == [r.x] if r.x >= 0.3 else not len(found), (a, b)


def test_common_letters_leave_few_pairs_to_compare():
    rng = random.Random(3)
    words = ["".join(rng.choice("etaoinshrdlucm") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(9)) for _ in range(600)]
    asked = [t[:5] + "z" + t[6:] for t in texts]
    alphabet = arrays.Alphabet(texts + asked)
    q, c = arrays.Texts(asked, alphabet), arrays.Texts(texts, alphabet)
    met = [(i, j) for x, y in arrays.near(q, c, np.full(600, 0.85), lambda i, j: np.ones(len(i), bool)) for i, j in zip(x.tolist(), y.tolist())]
    assert {(i, i) for i in range(600)} <= set(met) and len(met) == len(set(met)) < 600 * 600 / 100


def test_common_subsequences_of_several_words():
    rng = random.Random(8)
    text = lambda: "".join(rng.choice("abé題😀") for _ in range(rng.randrange(1, 200)))
    one, two = [text() for _ in range(40)], [text() for _ in range(40)]
    alphabet = arrays.Alphabet(one + two)
    a, b = arrays.Texts(one, alphabet), arrays.Texts(two, alphabet)
    assert arrays.lcs(a, np.arange(40), b, b.start, b.n).tolist() == [lcs(x, y) for x, y in zip(one, two)]
