import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from biblioweave.functions import similarity as sim
from biblioweave.operators import fuzzy
from biblioweave.operators.fuzzy import _forms, best_match, candidates, choice_keys, query_keys

ALPHABET = "abcdeXY3 éß"


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


def similarity(a, b):
    return 1.0 - levenshtein(a, b) / max(len(a), len(b)) if a and b else 0.0


def tokens(a):
    return " ".join(sorted(a.split()))


def brute(queries, choices, percent, token_sort_only=False, tolerance=None):
    out = {}
    for q, text, year in queries:
        best = None
        for c, other, other_year in choices:
            if tolerance is not None and year is not None and other_year is not None and abs(year - other_year) > tolerance:
                continue
            score = similarity(tokens(text), tokens(other))
            if not token_sort_only:
                score = max(score, similarity(text, other))
            if best is None or score > best[1]:
                best = (c, score)
        if best and best[1] >= percent / 100:
            out[q] = best
    return out


def damaged(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text) + 1)
        text = rng.choice([text[:at] + rng.choice(ALPHABET) + text[at:], text[:at] + text[at + 1:],
                           text[:at] + rng.choice(ALPHABET) + text[at + 1:]])
    return " ".join(text.split())


def world(seed, size):
    rng = random.Random(seed)
    year = lambda: rng.choice([None, 2019, 2020, 2021, 2022, 2023])
    base = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(1, 60))) for _ in range(size)]
    base = [" ".join(t.split()) for t in base]
    choices = sorted({t for t in base + [damaged(rng, t, rng.randrange(1, 4)) for t in base] if t})
    rng.shuffle(choices)
    queries = []
    for t in base:
        words = t.split()
        rng.shuffle(words)
        queries += [damaged(rng, t, rng.randrange(0, max(2, len(t) // 6))), " ".join(words)]
    return (
        [(i, t, year()) for i, t in enumerate(queries)],
        [(i * 3, t, year()) for i, t in enumerate(choices)],
    )


def run(spark, queries, choices, percent, **options):
    q = spark.createDataFrame(queries, "q long, qt string, qy int")
    c = spark.createDataFrame(choices, "c long, ct string, cy int")
    rows = best_match(q, c, "q", "qt", "c", "ct", percent, **options).collect()
    assert len({r.q for r in rows}) == len(rows)
    return {r.q: (r.c, r.score) for r in rows}


@pytest.mark.parametrize(
    "seed,percent,hot_rows", [(1, 85, 2000), (2, 85, 2), (3, 90, 2), (4, 70, 5), (5, 50, 2000)]
)
def test_equals_brute_force(spark, seed, percent, hot_rows):
    queries, choices = world(seed, 60)
    expected = brute(queries, choices, percent)
    assert run(spark, queries, choices, percent, hot_rows=hot_rows) == expected
    assert any(score < 1 for _, score in expected.values())


def test_token_sort_only(spark):
    queries, choices = world(7, 50)
    expected = brute(queries, choices, 90, token_sort_only=True)
    assert run(spark, queries, choices, 90, token_sort_only=True) == expected


def test_years_first(spark):
    queries, choices = world(8, 50)
    expected = brute(queries, choices, 85, tolerance=1)
    assert run(spark, queries, choices, 85, years=("qy", "cy", 1)) == expected


def test_a_third_of_the_titles_shares_a_template(spark):
    queries = [(i, f"annual report of the number {i:04d} section", None) for i in range(0, 300, 7)]
    choices = [(i, f"annual report of the number {i:04d} sections", None) for i in range(300)]
    choices += [(1000 + i, f"{i:05d} unrelated {i * 7919 % 1000} words", None) for i in range(600)]
    assert run(spark, queries, choices, 85, hot_rows=20) == brute(queries, choices, 85)


def test_a_chunk_common_among_the_queries(spark):
    queries = [(i, f"annual report of the number {i:04d} section", None) for i in range(400)]
    choices = [(i, f"annual report of the number {i:04d} sections", None) for i in range(0, 400, 40)]
    assert run(spark, queries, choices, 85, hot_rows=3) == brute(queries, choices, 85)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.sampled_from([50, 70, 85, 90, 95]))
def test_chunks_fit_and_bands_are_near(length, percent):
    longest = 100 * length // percent
    edits = (100 - percent) * longest // 100
    assert (edits + 2) * (length // (edits + 2)) <= length
    import math

    band = lambda n: math.floor(math.log(n) / math.log(100 / (percent - 1)))
    assert band(longest) - band(length) <= 1


def test_a_title_of_thirty_thousand_letters(spark):
    rng = random.Random(11)
    long = "".join(rng.choice("abcdefghij ") for _ in range(30_000)).strip()
    queries = [(1, damaged(rng, long, 40), None), (2, "short title of the usual kind", None)]
    choices = [(5, long, None), (6, "short titles of the usual kind", None), (7, long[:12_000], None)]
    found = run(spark, queries, choices, 85)
    assert {q: c for q, (c, _) in found.items()} == {1: 5, 2: 6}
    assert 0.99 < found[1][1] < 1


def test_few_pairs_meet_and_rows_carry_no_text(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randrange(4, 9))) for _ in range(300)]
    titles = [" ".join(rng.choice(vocabulary) for _ in range(7)) for _ in range(500)]
    q = spark.createDataFrame([(i, t + " rev") for i, t in enumerate(titles[:250])], "q long, qt string")
    c = spark.createDataFrame(list(enumerate(titles)), "c long, ct string")
    met = candidates(q, c, "q", "qt", "c", "ct", 85)
    rows = {tuple(r) for r in met.collect()}
    assert {(i, i) for i in range(250)} <= rows and len(rows) < 500
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner, " in line and "bit_count" in line)
    assert join.count("levenshtein(before") == 1 and join.count("levenshtein(after") == 1
    emitted = query_keys(_forms(q, "qt", 85, False), 85).columns + choice_keys(_forms(c, "ct", 85, False), _forms(q, "qt", 85, False), 85).columns
    assert not {"s", "qt", "ct", "stretch"} & set(emitted)


def test_letter_bits_bound_the_distance(spark):
    rng = random.Random(5)
    pairs = []
    for i in range(200):
        a = "".join(rng.choice("aeioubcdXé ") for _ in range(rng.randrange(1, 40)))
        pairs.append((i, a, damaged(rng, a, rng.randrange(0, 8))))
    df = spark.createDataFrame(pairs, "i int, a string, b string")
    x, y = sim.letter_bits("a"), sim.letter_bits("b")
    lost = F.greatest(F.bit_count(x.bitwiseAND(F.bitwise_not(y))), F.bit_count(y.bitwiseAND(F.bitwise_not(x))))
    assert df.where(lost > F.levenshtein("a", "b")).count() == 0


def test_similarity_columns(spark):
    df = spark.createDataFrame([("deep learning", "learning deep"), ("abcd", "abxd"), ("", "x")], "a string, b string")
    rows = df.select(sim.title_similarity(F.col("a"), F.col("b")), sim.token_sort_similarity(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in rows] == [(1.0, 1.0), (0.75, 0.75), (0.0, 0.0)]


def test_no_cross_join_and_no_python_in_the_plan(spark):
    queries, choices = world(9, 10)
    q = spark.createDataFrame(queries, "q long, qt string, qy int")
    c = spark.createDataFrame(choices, "c long, ct string, cy int")
    plan = best_match(q, c, "q", "qt", "c", "ct", 85)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [key" in plan and "BroadcastHashJoin [key" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_nearer_choices_first(spark, monkeypatch):
    """The same matches with and without the search of nearer choices first, which leaves few pairs of alike names."""
    rnd = random.Random(3)
    names = [f"Journal of Supplier {i} (print)" for i in range(0, 900, 3)] + [f"Annals of {x} letters" for x in ("optics", "acoustics", "botany")]
    asked = [f"Journal of Suplier {i} (print)" for i in range(0, 60, 5)] + ["Jornal of Suplier 299 (prnt)", "Anals of optic leters", "nothing near", "", None]
    for _ in range(20):
        letters = list(rnd.choice(names))
        for _ in range(rnd.randint(0, 4)):
            letters[rnd.randrange(len(letters))] = rnd.choice("abc 1")
        asked.append("".join(letters))
    choices = spark.createDataFrame([(i, n, n.upper()) for i, n in enumerate(names)], "c_ord long, c_text string, kept string").cache()
    queries = spark.createDataFrame(list(enumerate(asked)), "q_id long, q_text string").cache()
    searched = []
    plain = fuzzy.candidates

    def counting(*args, **kwargs):
        found = plain(*args, **kwargs)
        searched.append((args[0].count(), found.count()))
        return found

    monkeypatch.setattr(fuzzy, "candidates", counting)
    for sort_only in (True, False):
        results = [
            sorted(map(tuple, fuzzy.best_match(queries, choices, "q_id", "q_text", "c_ord", "c_text", 90, sort_only, first_percent=first).collect()))
            for first in (None, 95)
        ]
        assert results[0] == results[1] and len(results[0]) > 12
        (all_asked, all_pairs), (near_asked, near_pairs), (rest_asked, rest_pairs) = searched
        assert near_asked == all_asked > rest_asked and near_pairs + rest_pairs < all_pairs
        searched.clear()
