"""The counts of the op3 query against its own spans, and against plain patterns."""

import hashlib
import re

from biblioweave.llm import queries

PATTERNS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)


def test_counts_are_of_kinds(spark, tmp_path):
    key, hexes = "AKIA" + "B7" * 8, "0123456789abcdef" * 2
    texts = [
        None, "", "none", hexes, f"{hexes} {hexes} x", key, f"{key} {hexes}", f"Password = 'abc-DEF-ghi.123' {key} {hexes} {hexes}",
        "token=short secret:abcdefghijkl API_KEY=abcdefghijkl passwd: \"0123456789ab", f"{key},{key},{key}", f"\U0001f600\u0001{hexes}",
    ]
    rows = [(i // 2, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for doc_id, text in rows:
        found = sorted(
            (m.start(), kind, m.end()) for kind, (_, pattern, group, least) in enumerate(PATTERNS)
            for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least
        )
        named = ",".join(f"{PATTERNS[kind][0]}:{start}:{end}" for start, kind, end in found)
        counts = [sum(kind == k for _, kind, _ in found) for k in range(3)]
        expected.append((doc_id, *counts, hashlib.sha256(named.encode()).hexdigest()))
    got = queries.op3_markov_secrets(spark, str(tmp_path)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert sorted(map(tuple, got.collect())) == sorted(expected)
