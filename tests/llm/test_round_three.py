"""Filter audit, collision-counting neighbours and box codes against brute force, with odd rows."""

import tracemalloc
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from biblioweave.llm import audit, codes, neighbours, queries, toxicity
from checks.verify import compare, connect

TEXTS = [
    "a b c", "A B C " * 100, "word " * 300, " ".join(f"w{i}" for i in range(250)), "x # y", "", None, "a b c", "a b c", "A" * 5000 + " %",
    " ".join(f"w{i}" for i in range(250)), "tab\tnew\nline\x0bv\x0cf\rr\x1cs",
]


def brute_audit(rows, good, toxic):
    def fails(i, t):
        w = [x for x in t.translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if x]
        return (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            any(c in "#$%&*|" for c in t), i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows),
        )

    judged = [(s or "", i, fails(i, t or "")) for i, t, s in rows]
    out = {}
    for part in {p for p, _, _ in judged}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations(range(5)):
            for step, own in enumerate(order, 1):
                f = dict.fromkeys(("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"), 0)
                for p, i, x in judged:
                    if p != part:
                        continue
                    earlier = any(x[a] for a in order[: step - 1])
                    f["kept"] += not earlier and not x[own]
                    f["removed"] += not earlier and x[own]
                    f["redundant"] += earlier and x[own]
                    f["unique_fails"] += x[own] and sum(x) == 1
                    f["good_lost"] += not earlier and x[own] and i in good
                    f["toxic_lost"] += not earlier and x[own] and i in toxic
                shapley["ABCDE"[own]] += f["removed"]
                out[part, "".join("ABCDE"[a] for a in order), step] = f
        for (p, order, step), f in out.items():
            if p == part:
                f["shapley"] = shapley[order[step - 1]]
    return out


def test_audit_equals_brute_force(spark):
    rows = [(i, t, "s" if i % 3 else None) for i, t in enumerate(TEXTS)]
    rows += [(None, "a b c", "s"), (None, "a b c", "s"), (3, TEXTS[3], "s"), (0, "a b c", "t"), (1, "a b c", "s")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, fails string, part int")
    marks = [(0, 1, 0), (0, 0, 1), (2, 1, 1), (3, 1, None), (9, None, 1), (None, 1, 1), (77, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = {(r.part, r.filter_order, r.step): r.asDict() for r in audit.audit(docs, labels).collect()}
    expected = brute_audit(rows, {0, 2, 3}, {0, 2, 9})
    assert set(found) == set(expected)
    for key, figures in expected.items():
        assert {f: found[key][f] for f in figures} == figures, key


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(docs, labels).collect() == []


def vectors_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, block int, asks string, code string")


def brute_nearest(vectors, query, k):
    def cosine(a, b):
        a, b = np.array(a, np.float64), np.array(b, np.float64)
        return (a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())

    near = sorted(((-cosine(vectors[query], v), i) for i, v in vectors.items() if i != query and len(v) == len(vectors[query])))
    return [(i, -s) for s, i in near[:k]]


def test_nearest_recall_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((1500, 24)).astype(np.float32)
    base[700:760] = base[0] + 0.05 * rng.standard_normal((60, 24))
    base[900:1100] = base[5]  # ties
    vectors = {i: [float(x) for x in v] for i, v in enumerate(base)} | {2000: [1.0, 2.0], 2001: [2.0, 1.0]}
    odd = [(3000, None), (3050, [0.0] * 24), (3100, [float("nan")] * 24), (3150, [float("inf")] + [1.0] * 23), (3200, [None] + [1.0] * 23), (3250, []), (None, vectors[0])]
    rows = [(i, v, 0, 1, "x", "y") for i, v in [*vectors.items(), *odd, (5, vectors[5])]]
    found = neighbours.nearest(vectors_frame(spark, rows), F.col("vec_id") % 50 == 0).collect()
    asked = [i for i in vectors if i % 50 == 0]
    assert {r.query_id for r in found} == set(asked)
    hits = total = 0
    for q in asked:
        got = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q)
        expected = brute_nearest(vectors, q, 5)
        assert [g[0] for g in got] == list(range(1, len(expected) + 1))
        by_id = dict(brute_nearest(vectors, q, len(vectors)))
        assert all(s == pytest.approx(by_id[i], abs=1e-12) for _, i, s in got)
        assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got)
        hits += len({i for i, _ in expected} & {g[1] for g in got})
        total += len(expected)
    assert hits >= 0.95 * total
    ties = sorted((r.rank, r.vec_id) for r in found if r.query_id == 950)
    assert ties == [(1, 5), (2, 900), (3, 901), (4, 902), (5, 903)]
    assert neighbours.nearest(vectors_frame(spark, []), F.col("vec_id") % 50 == 0).collect() == []


def test_collision_threshold_holds_at_any_radius():
    settings = neighbours.Settings()
    rng = np.random.default_rng(5)
    turned = neighbours._directions(48, settings.directions, settings.seed)
    for radius in (0.1, 0.9, 1.9):
        ways = rng.standard_normal((4000, 48))
        ways *= radius / np.linalg.norm(ways, axis=1, keepdims=True)
        hits = (np.abs(ways @ turned) <= settings.width * radius / np.sqrt(48)).sum(axis=1)
        assert (hits >= neighbours.threshold(48, settings)).mean() >= 1 - 2 * settings.miss


def brute_codes(rows, entries=64, rounds=2):
    kept = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = np.array([[int(np.floor(256 * np.float64(np.float32(x)))) for x in v] for _, v, _ in kept], object).reshape(len(kept), 16, -1)
    books = [[list(whole[e, p]) for e in range(min(entries, len(kept)))] for p in range(16)]

    def assign():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(whole[i, p], c)), e) for e, c in enumerate(books[p])) for p in range(16)] for i in range(len(kept))
        ]

    for _ in range(rounds):
        near = assign()
        for p in range(16):
            for e in range(len(books[p])):
                own = [whole[i, p] for i in range(len(kept)) if near[i][p][1] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    return sorted((str(r[0]), str(r[2]), "".join(f"{n[1]:02x}" for n in near[i]), sum(n[0] for n in near[i])) for i, r in enumerate(kept)), books


@pytest.mark.parametrize(("count", "length"), [(400, 32), (30, 64), (150, 16)])
def test_codes_equal_brute_force(spark, count, length):
    rng = np.random.default_rng(count)
    base = rng.standard_normal((count, length)).astype(np.float32)
    base[10:20] = base[9]
    base[20] = 0
    base[21] *= 500
    rows = [(int(i), [float(x) for x in v], [None, 1, 2][i % 3]) for i, v in enumerate(base)]
    rows += [rows[3], (3, rows[4][1], 1), (None, rows[5][1], None)]
    odd = [(-9, None, 1), (-8, [float("nan")] * length, 1), (-7, [None] * length, 1), (-6, [1.0, 2.0], 2), (-5, [], 1), (-4, [4e6] * length, 1)]
    coded, books = codes.compress(vectors_frame(spark, [(*r, 1, "x", "y") for r in rows + odd]))
    expected, expected_books = brute_codes(rows)
    assert books.tolist() == expected_books
    found = codes.with_label_error(coded).collect()
    assert sorted((str(r.vec_id), str(r.label), r.code, r.error) for r in found) == expected
    for r in found:
        assert r.label_error == sum(x.error for x in found if x.label == r.label)


def test_codes_of_nothing(spark):
    coded, books = codes.compress(vectors_frame(spark, []))
    assert codes.with_label_error(coded).collect() == [] and books.size == 0
    assert len(codes.digest(books)) == 64


@pytest.mark.parametrize("dims", [1, 2, 3, 4])
def test_hilbert_curve_visits_neighbours(dims):
    side = np.stack(np.meshgrid(*[np.arange(4)] * dims), -1).reshape(-1, dims)
    along = side[np.argsort(codes.hilbert(side, 2))]
    assert sorted(codes.hilbert(side, 2)) == list(range(4**dims))
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("name", ["op11_filter_audit", "op13_box_codes"])
def test_query_equals_its_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    assert compare(spark, connect(sf_dir), sf_dir, queries.QUERIES[name], queries.ORACLES[name]) is None


def test_fit_of_toxicity_takes_little_memory(monkeypatch):
    """The driver fits it: what a step makes of all windows at once must not add up."""
    rng = np.random.RandomState(5)
    docs = [rng.randint(0, 5_000, 640) for _ in range(400)]
    tags = [(d < 50).astype(np.int8) for d in docs]
    settings = toxicity.Settings(steps=3)
    whole = toxicity.fit_chain(docs, tags, settings)
    monkeypatch.setattr(toxicity, "_ROWS", 256, raising=False)
    tracemalloc.start()
    parts = toxicity.fit_chain(docs, tags, settings)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(np.array_equal(x, y) for x, y in zip(whole, parts))
    assert peak / (400 * 640) < 70  # bytes a word
