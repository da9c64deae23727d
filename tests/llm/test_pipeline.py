"""Stages of the corpus pipeline on a small folder of tables, with columns named as the stages name theirs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from biblioweave.llm import queries

CLASHING = [
    "score", "toxic_words", "spans", "_in_block", "contaminated", "_id", "_copy", "_own", "_spans", "_base", "_random", "copy",
    "is_first", "label", "toxic", "a.b", "_passed_0",
]
SECRET = "password: 0123456789abcdef0123"


def prose(rng, n):
    return " ".join(f"{a}{b}" for a, b in zip(rng.choice(["ba", "lo", "mi", "tur", "ves"], n), rng.randint(0, 400, n)))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.RandomState(11)
    bodies = [prose(rng, 40) + (" vile scum vile " if i % 4 == 0 else " ") + prose(rng, 20) for i in range(120)]
    items = [prose(rng, 24), prose(rng, 15)]
    hurt = items[0].split()
    for i in (3, 9, 14, 19):
        hurt[i] = "zzz"
    near = prose(rng, 150).split()
    more = {
        200: " ".join(near), 201: " ".join([*near[:70], "zzz", *near[71:]]), 202: prose(rng, 9) + " " + " ".join(hurt),
        203: items[1], 204: f"{prose(rng, 30)} {SECRET} {prose(rng, 3)}", 205: "", 206: None, 207: prose(rng, 50),
    }
    rows = [*enumerate(bodies), *more.items(), (207, more[207])]
    docs = spark.createDataFrame([(i, t, None if t is None else len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    docs = docs.withColumns({name: F.concat(F.lit(f"{name} of "), "doc_id") for name in CLASHING})
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(100)], "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet"
    )
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, dict(rows)


# 206 has a null text, which counts as a copy of the empty one of 205.
GONE = {"toxicity": set(range(0, 120, 4)), "near_dedup": {201, 206}, "decontamination": {202, 203}, "secrets": set()}


@pytest.mark.parametrize("name", GONE)
def test_stage_keeps_every_column(spark, folder, name):
    path, bodies = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    made = dict(corpus_pipeline.STAGES)[name](spark, docs, path)
    assert made.columns == docs.columns
    rows = [r.asDict() for r in made.collect()]
    twice = [] if name == "near_dedup" else [207]
    assert sorted(r["doc_id"] for r in rows) == sorted([*(set(bodies) - GONE[name]), *twice])
    for r in rows:
        text = bodies[r["doc_id"]]
        if name == "secrets" and r["doc_id"] == 204:
            text = text.replace(SECRET, "[SECRET]")
        assert r["text"] == text and r["n_chars"] == (None if text is None else len(text))
        assert all(r[c] == f"{c} of {r['doc_id']}" for c in CLASHING)


def test_run_packs_what_the_stages_leave(spark, folder):
    from tokenizers import Tokenizer

    path, bodies = folder
    left = {i: t for i, t in bodies.items() if not any(i in gone for gone in GONE.values())}
    left[204] = left[204].replace(SECRET, "[SECRET]")
    tokenizer = Tokenizer.from_file(queries.VOCABULARY)
    expected = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in left.items()}
    found = {}
    for r in corpus_pipeline.run(spark, path).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
        assert r.doc_tokens == expected[r.doc_id]
    assert found == expected
