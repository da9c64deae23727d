"""The tokenizer's units: words stay known while new ones pass by, and ids are those of whole texts."""

import random
import string

from biblioweave.llm import packing
from biblioweave.llm.queries import VOCABULARY


def test_words_are_merged_once_while_others_pass(monkeypatch):
    merged, piece = [], packing.Ids.piece
    monkeypatch.setattr(packing.Ids, "piece", lambda self, text: merged.append(text) or piece(self, text))
    rng = random.Random(3)
    word = lambda: "".join(rng.choices(string.ascii_lowercase, k=12))
    common = [word() for _ in range(40)]
    ids = packing.Ids(VOCABULARY, 300)
    for _ in range(30):
        passing = [word() for _ in range(20)]
        marked = [w + rng.choice(["", ",", ".", "é", "\n", "7", "'s"]) for w in rng.sample(common, 20) + passing]
        text = "x " + " ".join(common + marked) + " ça"
        assert ids.of([text]) == [ids.whole(text)]
    assert all(merged.count(" " + w) <= 1 for w in common)
    assert len(ids.known) <= 150 and len(ids.known.before) <= 150
