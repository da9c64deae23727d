"""Document fingerprints from closed syncmers, in column expressions only.

A window of ``k`` words is an anchor when the smallest of its inner ``s``-word hashes lies at its left or right
edge. That depends on the window's own words alone, so the same words give the same anchors in any document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import LEAST, texts

# White space separates; signs of scripts that are written without it are words of their own.
WORD_BREAK = r"\s+|(?<=[\x{2E80}-\x{10FFFF}])"
K, S, SIZE = 5, 2, 64


def with_anchors(df: DataFrame, text_col: str, out: str, k: int = K, s: int = S) -> DataFrame:
    """Add ``out``: the anchors of a text as ``array<struct<start: int, hash: long>>``, in the order of the words.

    A text of fewer than ``k`` words is one anchor; one without words (null, empty, white space) has none.
    """
    words, inner = f"_{out}_words", f"_{out}_inner"
    edge = k - s
    df = df.withColumn(words, F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), WORD_BREAK), ""))
    whole = F.transform(
        F.sequence(F.lit(0), F.size(words) - s), lambda i: F.xxhash64(*[F.col(words)[i + j] for j in range(s)])
    )
    df = df.withColumn(inner, F.when(F.size(words) >= k, whole))
    h = F.col(inner)

    def is_anchor(i):
        ends = F.least(h[i], h[i + edge])
        return ends <= F.least(*[h[i + j] for j in range(1, edge)]) if edge > 1 else F.lit(True)

    def anchor(i):
        return F.struct(
            i.alias("start"), F.shiftrightunsigned(F.xxhash64(*[h[i + j] for j in range(edge + 1)]), 32).alias("hash")
        )

    found = F.transform(F.filter(F.sequence(F.lit(0), F.size(h) - edge - 1), is_anchor), anchor)
    short = F.array(F.struct(F.lit(0).alias("start"), F.shiftrightunsigned(F.xxhash64(words), 32).alias("hash")))
    none = F.array().cast("array<struct<start:int,hash:bigint>>")
    return df.withColumn(
        out, F.when(h.isNotNull(), found).when(F.size(words) > 0, short).otherwise(none)
    ).drop(words, inner)


def sketch(anchors: Column, size: int = SIZE) -> Column:
    """The ``size`` smallest different anchor hashes, sorted: a sample of the anchor set that any two texts share."""
    return F.slice(F.array_sort(F.array_distinct(anchors["hash"])), 1, size)


def likeness(one: Column, two: Column, size: int = SIZE) -> Column:
    """Estimated Jaccard similarity of two anchor sets from their sketches; two empty ones are alike."""
    both = F.slice(F.array_sort(F.array_union(one, two)), 1, size)
    shared = F.size(F.array_intersect(F.array_intersect(one, two), both))
    return F.when(F.size(one) + F.size(two) == 0, 1.0).otherwise(shared / F.size(both)).cast("double")


def fingerprint(sketch_: Column) -> Column:
    """A sketch as text: eight hexadecimal digits per anchor."""
    return F.lower(F.array_join(F.transform(sketch_, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, sketch, fingerprint`` of every row. No shuffle."""
    rows = with_anchors(texts(docs, id_col, text_col), "text", "anchors")
    return rows.select("doc_id", "text", sketch(F.col("anchors")).alias("sketch")).withColumn(
        "fingerprint", fingerprint(F.col("sketch"))
    )


def with_next(rows: DataFrame, carried: dict[str, str], buckets: int) -> DataFrame:
    """Add the columns ``carried`` of the next row in descending ``doc_id`` (after the last: of the first).

    Rows are dealt to ranges of ids cut at quantiles, one shuffle, and a window looks ahead inside a range. The
    highest row of a range also visits the range above as a guest, so no range needs its neighbour. Null ids come
    last; equal ids are ordered by text. Only range bounds reach the driver, at most ``buckets`` of them.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(LEAST))
    shares = [i / buckets for i in range(1, buckets)]
    cut = rows.select(F.percentile_approx(key, shares or [0.5], 10 * buckets)).first()[0] or []
    bounds = sorted(set(cut)) or [0]
    bucket = F.size(F.filter(F.lit(bounds), lambda b: b < key))
    tops = rows.groupBy(bucket.alias("b")).agg(F.max(key).alias("top")).orderBy("b").collect()
    above = [t.b for t in tops[1:]] + [t.b for t in tops[:1]]
    visit = F.array_position(F.lit([t.top for t in tops] or [0]), key)
    seats = F.when(
        visit > 0,
        F.array(F.struct(bucket.alias("b"), F.lit(0).alias("guest")), F.struct(F.lit(above or [0])[visit.cast("int") - 1].alias("b"), F.lit(1).alias("guest"))),
    ).otherwise(F.array(F.struct(bucket.alias("b"), F.lit(0).alias("guest"))))
    order = Window.partitionBy("_seat.b").orderBy("_seat.guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    seated = rows.withColumn("_seat", F.explode(seats))
    ahead = seated.select("*", *[F.lead(c).over(order).alias(n) for c, n in carried.items()])
    return ahead.where("_seat.guest = 0").drop("_seat")


def edited(text: Column, following: Column) -> Column:
    """The last third of the code points replaced by as many first ones (or all) of the following text."""
    n = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - n), F.substr(following, F.lit(1), n))
