"""The same results in DuckDB SQL, by brute force, for the operators that SQL can express."""

from __future__ import annotations

_LETTERS = ", ".join(f"(VALUES ('A', 0), ('B', 1), ('C', 2), ('D', 3), ('E', 4)) AS {name}(l, i)" for name in "abcde")

FILTER_AUDIT = rf"""
WITH words AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marks AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
judged AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
    len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
    regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS f FROM words LEFT JOIN marks USING (doc_id)),
counted AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM judged GROUP BY ALL),
orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS o, [a.i, b.i, c.i, d.i, e.i] AS p
    FROM {_LETTERS}
    WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT o, s, p[s] + 1 AS own, coalesce(list_transform(p[1 : s - 1], lambda i: i + 1), []) AS before FROM orders, range(1, 6) AS r(s)),
one AS (SELECT part, o, s, own, n, good, toxic, f[own] AS failing, len(list_filter(before, lambda i: f[i])) AS earlier,
    len(list_filter(f, lambda x: x)) AS all_fails FROM counted, steps),
figures AS (SELECT part, o, s, own, coalesce(sum(n) FILTER (NOT failing AND earlier = 0), 0) AS kept,
    coalesce(sum(n) FILTER (failing AND earlier = 0), 0) AS removed, coalesce(sum(n) FILTER (failing AND earlier > 0), 0) AS redundant,
    coalesce(sum(n) FILTER (failing AND all_fails = 1), 0) AS unique_fails, coalesce(sum(good) FILTER (failing AND earlier = 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (failing AND earlier = 0), 0) AS toxic_lost FROM one GROUP BY part, o, s, own)
SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
    CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM figures
"""


def _box_codes(rounds: int = 2) -> str:
    steps = [
        """kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """parts AS MATERIALIZED (SELECT vec_id, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM kept, range(16) AS r(p))""",
        """firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64)""",
        """book0 AS MATERIALIZED (SELECT p, e, x AS c FROM parts JOIN firsts USING (vec_id))""",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""near{r} AS MATERIALIZED (SELECT vec_id, p, min(row(d, e)) AS best FROM (SELECT vec_id, parts.p, e,
    CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM parts JOIN book{r} USING (p)) GROUP BY vec_id, p)"""
        )
        if r < rounds:
            steps.append(
                f"""mean{r} AS (SELECT p, e, list(m ORDER BY i) AS c FROM (SELECT p, e, i, (s - ((s % n) + n) % n) // n AS m FROM (
    SELECT parts.p, best[2] AS e, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM parts JOIN near{r} USING (vec_id, p),
    unnest(range(1, len(x) + 1)) AS u(i) GROUP BY ALL)) GROUP BY p, e)"""
            )
            steps.append(f"book{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN mean{r} m ON b.p = m.p AND b.e = m.e)")
    steps.append(
        f"""coded AS (SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error
    FROM near{rounds} GROUP BY vec_id)"""
    )
    steps.append(f"books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), books"""


BOX_CODES = _box_codes()
