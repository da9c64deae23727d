"""Texts of millions of characters and of many matches pass in about linear time."""

import hashlib
import re
import time

from pyspark.sql import functions as F

from biblioweave.llm import chat, secrets


def test_a_message_of_three_million_characters(spark):
    text = "".join(chr(97 + i * i % 26) if i % 9 else "é" for i in range(3_200_000))
    rows = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", "short"), (2, 0, "user", None)], "conv_id long, turn long, role string, text string")
    start = time.time()
    found = {r.conv_id: r for r in chat.digests(chat.render(chat.fold(chat.table_events(rows)))).collect()}
    assert time.time() - start < 60
    said = f"user\n{text}\nassistant\nshort\n".encode()
    assert found[1].turns_sha256 == hashlib.sha256(said).hexdigest() and found[1].n_turns == 2
    assert found[2].n_turns == 1 and found[1].loss_chars == 5


def test_deltas_cover_texts_of_any_length(spark):
    lengths = [0, 1, 7, 8, 9, 63, 64, 65, 1000, 5000]
    rows = spark.createDataFrame([(n, 0, "user", "".join(chr(48 + i % 75) for i in range(n))) for n in lengths], "conv_id long, turn long, role string, text string")
    events = chat.table_events(rows, delta_chars=8)
    assert events.where(F.length("text") > 8).count() == 0
    assert events.groupBy("conv_id").agg(F.count("seq").alias("n"), F.max("seq").alias("last")).where("n <> last + 1").count() == 0
    folded = {r.conv_id: r.text for r in chat.fold(events).collect()}
    assert folded == {n: "".join(chr(48 + i % 75) for i in range(n)) for n in lengths}


def test_thirty_two_thousand_matches(spark):
    text = " ".join(f"x{i % 7}é {i:016x}" for i in range(32_000))
    df = spark.createDataFrame([(text,), ("",), ("none",)], "text string")
    start = time.time()
    spans = df.select(secrets.rule_spans(F.col("text"))["hex"].alias("s")).collect()
    assert time.time() - start < 60
    assert [(s.start, s.end) for s in spans[0].s] == [m.span() for m in re.finditer("[0-9a-f]{16,}", text)]
    assert spans[1].s == [] and spans[2].s == []
