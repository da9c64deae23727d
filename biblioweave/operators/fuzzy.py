"""Best fuzzy match of every query text among all choice texts, without a cross join.

Exact by construction. Of the k + 2 disjoint chunks of a choice at least two survive k edits. Reading from the left,
take the first chunk i that is unharmed with no more edits before it than i, and the next one in the same way: before
chunk i of the two there are at most i edits and after it at most k + 1 - i, which bounds how far it can have moved.
Choices emit their chunks at the places they can move to, queries all their substrings of chunk size at their own place, and an
equi-join on (length band, place, chunk) meets them. Its rows have a bounded size: ids, numbers, letter flags and the few letters
on either side of the chunk, which may differ by twice the edits of their side. Pairs of ids that share two different
chunks are left; their texts are fetched and compared once, and the best of each query is pre-aggregated before
the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..functions import similarity as sim
from ..functions.text import WHITESPACE
from . import weighted
from .durable import durable

_PLAIN, _SORTED = 0, 1
# Pairs, not rows, are the work of a key, so its rows are split finer than elsewhere. Fewer keys than this can be hot on a side.
_HOT_SHARE = 4096
# Texts are cut into stretches before they are exploded, so that no emitted place walks a text from its start.
_STRETCH = 512
# Letters before and after a chunk that its rows carry.
_AROUND = 16
# Letters of a side that a block of whole texts holds.
_BLOCK_LETTERS = 4_000_000


def _forms(df: DataFrame, text: str, percent: int, token_sort_only: bool) -> DataFrame:
    """One row per text and form (as written, tokens sorted) with its length, band, letters and place width."""
    forms = [F.struct(F.lit(_SORTED).alias("form"), sim.sorted_tokens(F.col(text)).alias("s"))]
    if not token_sort_only:
        forms.append(F.struct(F.lit(_PLAIN).alias("form"), F.col(text).alias("s")))
    return (
        df.withColumn("_form", F.explode(F.array(*forms)))
        .select(*[c for c in df.columns if c != text], "_form.form", "_form.s")
        .withColumn("n", F.length("s"))
        .where("n > 0")
        .withColumn("band", sim.length_band(F.col("n"), percent))
    )


def _width(band: str, percent: int) -> str:
    """Places in a key are counted in steps of this width: half the edits that its length band allows."""
    return f"greatest(4, cast(floor(pow({100.0 / (percent - 1)}, {band}) * {(100 - percent) / 200}) AS int))"


def _around(at: str, size: str) -> list[Column]:
    """The hash of the chunk at a place of the stretch, and the letters before and after it."""
    return [
        F.expr(f"xxhash64(substring(stretch, {at} + 1, {size})) AS chunk"),
        F.expr(f"substring(stretch, greatest({at} - {_AROUND}, 0) + 1, least({at}, {_AROUND})) AS before"),
        F.expr(f"substring(stretch, {at} + {size} + 1, {_AROUND}) AS after"),
    ]


def choice_keys(c: DataFrame, queries: DataFrame, percent: int) -> DataFrame:
    """``most_edits + 2`` chunks (``i``, ``pos``) per choice, for each band that queries have and each place they can move to.

    Lengths fit into 31 bits, so there are under ln(2**31) / ln(100 / (T - 1)) bands:
    a few hundred rows at the very most, whatever the data.
    """
    near = F.explode(F.array(*[F.col("band") + d for d in (-1, 0, 1)]))
    bands = (
        queries.select("form", "band").distinct()
        .select("form", near.alias("c_band"), F.col("band").alias("q_band"))
        .groupBy(F.col("form").alias("c_form"), "c_band")
        .agg(F.collect_set("q_band").alias("q_bands"))
    )
    chunks = f"(cast({sim.most_edits('n', percent)} AS int) + 2)"
    at_once = f"cast(greatest(1, {_STRETCH} div greatest(size, 1)) AS int)"
    own = [x for x in c.columns if x not in ("s", "band")]
    width = _width("q_band", percent)
    return (
        c.join(F.broadcast(bands), F.expr("form = c_form AND band = c_band"))
        .select(*own, "s", "q_bands", sim.letter_bits("s").alias("letters"), F.expr(f"cast({sim.chunk_size('n', percent)} AS int) AS size"))
        .selectExpr("*", f"explode(sequence(0, {chunks} - 1, {at_once})) AS first")
        .selectExpr("*", f"greatest(first * size - {_AROUND}, 0) AS start")
        .selectExpr("*", f"substring(s, start + 1, size * {at_once} + {2 * _AROUND}) AS stretch")
        .selectExpr("*", f"explode(sequence(0, least({at_once}, {chunks} - first) - 1)) AS next")
        .selectExpr("*", "first + next AS i", "(first + next) * size AS pos")
        .select(*own, "letters", "q_bands", "i", "pos", *_around("pos - start", "size"))
        .selectExpr("*", "explode(q_bands) AS q_band")
        .selectExpr("*", f"explode(sequence(greatest(0, pos - i) div {width}, (pos + i) div {width})) AS place")
        .select(*own, "letters", "i", "pos", "before", "after", F.xxhash64("form", "q_band", "place", "chunk").alias("key"))
    )


def query_keys(q: DataFrame, percent: int) -> DataFrame:
    """Every substring of a query that has the chunk size of a possible partner."""
    shortest = f"(({percent} * n + 99) div 100)"
    longest = f"((100 * n) div {percent})"
    sizes = f"array_distinct(transform(sequence({shortest}, {longest}), l -> cast({sim.chunk_size('l', percent)} AS int)))"
    own = [x for x in q.columns if x not in ("s", "band")]
    return (
        q.select(*own, "s", "band", sim.letter_bits("s").alias("letters"), F.explode(F.expr(sizes)).alias("size"))
        .selectExpr("*", f"{_width('band', percent)} AS width", f"explode(sequence(0, n - 1, {_STRETCH})) AS first")
        .selectExpr("*", f"greatest(first - {_AROUND}, 0) AS start")
        .selectExpr("*", f"substring(s, start + 1, {_STRETCH + 2 * _AROUND} + size) AS stretch")
        .selectExpr("*", f"explode(sequence(0, least({_STRETCH}, n - first) - 1)) AS next")
        .where("first + next + size <= n")
        .select(*own, "letters", "band", "width", F.expr("first + next AS pos"), *_around("first + next - start", "size"))
        .select(*own, "letters", "pos", "before", "after", F.expr("xxhash64(form, band, pos div width, chunk) AS key"))
    )


def _hot_pairs(c_keys: DataFrame, q_keys: DataFrame, hot_rows: int) -> list[Row]:
    """Keys of both sides that many choices or very many queries share, with the splits each side needs."""
    sides = c_keys.select("key", F.lit(1).alias("_c"), F.lit(0).alias("_q")).unionByName(
        q_keys.select("key", F.lit(0).alias("_c"), F.lit(1).alias("_q"))
    )
    counts = sides.groupBy("key").agg(F.sum("_c").alias("_c"), F.sum("_q").alias("_q"))
    # The totals follow from the counts, so one pass finds keys above the fixed bounds and the totals that raise them.
    large = counts.where(f"_c > 0 AND _q > 0 AND (_c > {hot_rows} OR _q > {50 * hot_rows})")
    if not large.limit(1).count():
        return []
    total = counts.agg(F.sum("_c").alias("c"), F.sum("_q").alias("q")).first()
    per_c, per_q = max(total.c / _HOT_SHARE, hot_rows), max(total.q / _HOT_SHARE, 50 * hot_rows)
    return (
        large.where(f"_c > {per_c} OR _q > {per_q}")
        .select("key", F.ceil(F.col("_c") / per_c).cast("int").alias("c_splits"), F.ceil(F.col("_q") / per_q).cast("int").alias("q_splits"))
        .collect()
    )


def _split(keys: DataFrame, hot: DataFrame, row_id: str, own: str, other: str) -> DataFrame:
    """Rows of a hot key are dealt over their own side's splits and repeated for each split of the other side."""
    dealt = F.pmod(F.xxhash64(row_id), F.coalesce(f"{own}_splits", F.lit(1))).alias(f"{own}_salt")
    repeated = F.explode(F.sequence(F.lit(0), F.coalesce(f"{other}_splits", F.lit(1)) - 1)).alias(f"{other}_salt")
    salted = F.when(F.col("c_splits").isNull(), F.col("key")).otherwise(F.xxhash64("key", F.col("c_salt").cast("long"), F.col("q_salt").cast("long")))
    return (
        keys.join(F.broadcast(hot), "key", "left").select("*", dealt, repeated)
        .withColumn("key", salted).drop("c_splits", "q_splits", "c_salt", "q_salt")
    )


def _loss(one: Column, other: Column, percent: int) -> Column:
    """The negative similarity, or NULL where there are more edits than allowed."""
    longer = F.greatest(F.length(one), F.length(other))
    some = (F.length(one) > 0) & (F.length(other) > 0)
    allowed = F.floor((100 - percent) * longer / F.lit(100)).cast("int")
    edits = F.call_function("levenshtein", one, other, allowed)
    return F.when(some & (edits >= 0), -(1.0 - edits / longer))


def _within_reach(queries: DataFrame, choices: DataFrame, query_text: str, choice_text: str, percent: int) -> DataFrame:
    """Choices that are not too long for the longest query in either form: white space aside, no form has fewer letters."""
    longest = queries.agg(F.max(F.length(query_text))).first()[0] or 0
    letters = F.length(F.translate(F.col(choice_text), WHITESPACE, ""))
    return choices.where(letters <= 100 * longest // percent)


def candidates(
    queries: DataFrame, choices: DataFrame, query_id: str, query_text: str, choice_order: str, choice_text: str, percent: int,
    token_sort_only: bool = False, years: tuple[str, str, int] | None = None, hot_rows: int = 2_000,
) -> DataFrame:
    """The distinct pairs of ids that share two chunks of one form and pass the tests on places and letters.

    A superset of all pairs that can pass.
    """
    same_year = f"coalesce(abs(q.{years[0]} - c.{years[1]}) <= {years[2]}, true)" if years else "true"
    q_year, c_year = ([years[0]], [years[1]]) if years else ([], [])
    c = _forms(choices.select(choice_order, *c_year, choice_text), choice_text, percent, token_sort_only)
    q = _forms(queries.select(query_id, *q_year, query_text), query_text, percent, token_sort_only)
    c_keys, q_keys = choice_keys(c, q, percent), query_keys(q, percent)
    spark = queries.sparkSession
    if hot := _hot_pairs(c_keys, q_keys, hot_rows):
        table = spark.createDataFrame(hot, "key long, c_splits int, q_splits int")
        c_keys, q_keys = _split(c_keys, table, choice_order, "c", "q"), _split(q_keys, table, query_id, "q", "c")
    edits = f"(({100 - percent} * greatest(q.n, c.n)) div 100)"
    condition = F.expr(
        f"""q.key = c.key AND q.form <= c.form AND q.form >= c.form
        AND abs(q.pos - c.pos) <= c.i
        AND abs((q.n - q.pos) - (c.n - c.pos)) <= cast({sim.most_edits('c.n', percent)} AS int) + 1 - c.i
        AND abs(q.pos - c.pos) + abs((q.n - q.pos) - (c.n - c.pos)) <= {edits}
        AND bit_count(q.letters & ~c.letters) <= {edits}
        AND bit_count(c.letters & ~q.letters) <= {edits}
        AND {same_year}
        AND levenshtein(q.before, c.before, least(2 * c.i, {_AROUND})) >= 0
        AND levenshtein(q.after, c.after, least(2 * (cast({sim.most_edits('c.n', percent)} AS int) + 1 - c.i), {_AROUND})) >= 0"""
    )
    # Sizes do not tell the work of this join, which is pairs: neither side is broadcast, and small partitions are not merged.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = q_keys.repartition(parts, "key").alias("q").join(c_keys.repartition(parts, "key").alias("c").hint("merge"), condition)
    shared = met.groupBy(F.col(f"q.{query_id}").alias(query_id), F.col(f"c.{choice_order}").alias(choice_order), F.col("q.form").alias("_form")).agg(
        F.min("c.i").alias("_low"), F.max("c.i").alias("_high")
    )
    return shared.where("_low < _high").select(query_id, choice_order).distinct()


def _by_shared_token(queries: DataFrame, choices: DataFrame, choice_order: str, least: float) -> DataFrame:
    """``_q, loss, choice_order``: the first choice that shares a token with a query and is at least half as long again, or the query is.

    One shared token gives such a pair the same score as any other. Tokens meet by the few lengths of the texts that hold them, not by text.
    """
    def words(x: DataFrame, *own: str) -> DataFrame:
        word = F.explode(F.array_distinct(F.split(sim.sorted_tokens(F.col("_text")), " "))).alias("word")
        return x.select(*own, F.length("_text").alias("n"), word).where("word <> ''")

    asked = words(queries, "_q")
    offered = words(choices, choice_order).groupBy("word", "n").agg(F.min(choice_order).alias(choice_order))
    longer, shorter = F.greatest("q.n", "c.n"), F.least("q.n", "c.n")
    score = 1.0 * weighted.TOKENS * F.when(longer <= 8 * shorter, weighted.WINDOW).otherwise(weighted.FAR_WINDOW)
    met = asked.select("word", "n").distinct().alias("q").join(
        offered.alias("c").hint("merge"), (F.col("q.word") == F.col("c.word")) & (2 * longer >= 3 * shorter) & (score >= least)
    )
    first = met.groupBy("q.word", "q.n").agg(F.min(F.struct((-score).alias("loss"), F.col(f"c.{choice_order}").alias(choice_order))).alias("_first"))
    return asked.join(first, ["word", "n"]).groupBy("_q").agg(F.min("_first").alias("_first")).select("_q", "_first.*")


def _whole_pairs(queries: DataFrame, choices: DataFrame, choice_order: str, block: int) -> DataFrame:
    """``_q, loss, choice_order``: the best choice of every query in every block of choices, of those that reach the score ``least`` of the query.

    Each side is dealt into parts of about ``block`` texts, and every part meets every part of the other side in a task of its own,
    which holds that many texts at a time and searches them by arrays (``weighted.best_of``).
    """
    spark = queries.sparkSession
    parts = lambda x, most: max(1, *[-(-int(v or 0) // m) for v, m in zip(x.agg(F.count(F.lit(1)), F.sum(F.length("_text"))).first(), (block, most))])
    q_parts, c_parts = parts(queries, _BLOCK_LETTERS), parts(choices, _BLOCK_LETTERS)
    part = lambda many: F.pmod(F.xxhash64("_text"), F.lit(many))
    every = lambda many: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long")))
    order = choices.schema[choice_order].dataType
    q = queries.select("_q", "_text", "least", F.lit(None).cast(order).alias(choice_order), part(q_parts).alias("_own"), every(c_parts).alias("_other"))
    c = choices.select(
        F.lit(None).cast("long").alias("_q"), "_text", F.lit(None).cast("double").alias("least"), choice_order, every(q_parts).alias("_own"), part(c_parts).alias("_other")
    )
    # Sizes do not tell the work of a block, which is pairs: small partitions are not merged.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(2 * q_parts * c_parts, 1000))
    dealt = q.unionByName(c).withColumn("_cell", F.col("_own") * c_parts + F.col("_other")).drop("_own", "_other").repartition(tasks, "_cell")

    def run(rows: pa.Table) -> pa.Table:
        return _best_of_block(rows, choice_order)

    schema = StructType([StructField("_q", LongType()), StructField("loss", DoubleType()), StructField(choice_order, order)])
    return dealt.groupBy("_cell").applyInArrow(run, schema)


def _best_of_block(block: pa.Table, choice_order: str) -> pa.Table:
    asked = pc.is_valid(block["_q"])
    q, c = block.filter(asked), block.filter(pc.invert(asked))
    order = c[choice_order].combine_chunks()
    rank = np.empty(len(order), np.int64)
    rank[pc.sort_indices(order).to_numpy()] = np.arange(len(order))
    i, j, score = weighted.best_of(q["_text"].to_pylist(), c["_text"].to_pylist(), q["least"].to_numpy(), rank)
    return pa.table({"_q": q["_q"].combine_chunks().take(pa.array(i)), "loss": pa.array(-score), choice_order: order.take(pa.array(j))})


def best_weighted(
    queries: DataFrame, choices: DataFrame, query_id: str, query_text: str, choice_order: str, choice_text: str, percent: int,
    block: int = 16_000,
) -> DataFrame:
    """The choice of the highest weighted ratio for every query, the first one on ties: the optional scorer.

    Returns ``query_id, choice_order, score`` for best scores of ``percent`` (1 or more) or more. No pair is left out: equal texts are met
    by a join, pairs that pass by one shared token by its lengths, and what may exceed these scores is searched in blocks, for the score
    that the query has already. Equal texts are compared once. The numbers are those of ``functions.wratio.weighted_ratio``.
    """
    asked = durable(queries.where(F.col(query_id).isNotNull()).select(query_id, F.col(query_text).alias("_text")), "queries")
    texts = durable(asked.where("_text <> ''").select("_text").distinct().withColumn("_q", F.monotonically_increasing_id()), "query-texts")
    offered = choices.where(F.col(choice_order).isNotNull() & (F.col(choice_text) != "")).groupBy(F.col(choice_text).alias("_text"))
    offered = offered.agg(F.min(choice_order).alias(choice_order))
    least = percent / 100
    if least > weighted.FAR_WINDOW:
        # A choice more than eight times as long or as short has no number above this.
        short, long = texts.agg(F.min(F.length("_text")), F.max(F.length("_text"))).first()
        offered = offered.where((F.length("_text") <= 8 * (long or 0)) & (8 * F.length("_text") >= (short or 0)))
    offered = durable(offered, "choices")
    equal = texts.join(offered, "_text").select("_q", F.lit(-1.0).alias("loss"), choice_order)
    best = F.min(F.struct("loss", choice_order)).alias("_best")
    known = durable(equal.unionByName(_by_shared_token(texts, offered, choice_order, least)).groupBy("_q").agg(best), "known-scores")
    # Only equal texts score 1, so there is nothing to be found for those.
    open_texts = texts.join(known, "_q", "left").where("_best IS NULL OR _best.loss > -1").select(
        "_q", "_text", F.greatest(F.lit(least), -F.col("_best.loss")).alias("least")
    )
    found = _whole_pairs(durable(open_texts, "open-texts"), offered, choice_order, block).unionByName(known.select("_q", "_best.*"))
    best = found.groupBy("_q").agg(best).join(texts, "_q").select("_text", "_best")
    best = asked.join(best, "_text").groupBy(query_id).agg(F.min("_best").alias("_best"))
    return best.select(query_id, f"_best.{choice_order}", (-F.col("_best.loss")).alias("score")).where(F.col("score") >= least)


def best_match(
    queries: DataFrame,
    choices: DataFrame,
    query_id: str,
    query_text: str,
    choice_order: str,
    choice_text: str,
    percent: int,
    token_sort_only: bool = False,
    years: tuple[str, str, int] | None = None,
    hot_rows: int = 2_000,
    first_percent: int | None = None,
) -> DataFrame:
    """The most similar choice of every query, the first one on ties.

    Returns the columns of both sides (but for ``choice_text``) and ``score``, for
    the queries whose best match scores at least ``percent``. ``query_id`` and
    ``choice_order`` are unique; the lowest ``choice_order`` wins a tie. With
    ``years`` (query column, choice column, tolerance) choices of another year
    are no candidates. Both inputs are read several times: pass stored tables, or
    cheap plans on them. A key that more than ``hot_rows`` choices share is
    split over several tasks. With ``first_percent``, above ``percent``, all queries are
    searched for choices that near first, and only those without one for the others: the
    best choice and all that tie with it are within any bound that one choice is within.
    """
    carried = [choice_order] + [c for c in choices.columns if c not in (choice_order, choice_text)]
    match = F.struct(*carried)
    same_year = f"coalesce(abs({years[0]} - {years[1]}) <= {years[2]}, true)" if years else "true"
    q_year, c_year = ([years[0]], [years[1]]) if years else ([], [])

    choices = _within_reach(queries, choices, query_text, choice_text, percent)
    # Equal up to token order is the best score there is: an equi-join settles it.
    c_equal = (
        choices.withColumn("_s", sim.sorted_tokens(F.col(choice_text)))
        .where("_s <> ''")
        .groupBy("_s", *c_year)
        .agg(F.min(match).alias("_equal"))
    )
    asked = queries.withColumn("_q", sim.sorted_tokens(F.col(query_text)))
    settled = asked.join(c_equal, F.expr(f"_q = _s AND {same_year}"), "left").drop("_q", "_s", *c_year)
    if years:
        settled = settled.groupBy(*queries.columns).agg(F.min("_equal").alias("_equal"))
    settled = durable(settled, "queries")
    still_open = settled.where("_equal IS NULL").select(query_id, *q_year, query_text)

    offered = choices.select(F.col(choice_order), match.alias("_match"), F.col(choice_text).alias("_c"))

    def nearest(asked: DataFrame, percent: int) -> DataFrame:
        met = candidates(asked, choices, query_id, query_text, choice_order, choice_text, percent, token_sort_only, years, hot_rows)
        both = met.join(asked.select(query_id, F.col(query_text).alias("_q")), query_id).join(offered, choice_order)
        loss = _loss(sim.sorted_tokens(F.col("_q")), sim.sorted_tokens(F.col("_c")), percent)
        if not token_sort_only:
            loss = F.least(loss, _loss(F.col("_q"), F.col("_c"), percent))
        return (
            both.select(query_id, loss.alias("loss"), F.col("_match").alias("match"))
            .groupBy(query_id).agg(F.min(F.when(F.col("loss").isNotNull(), F.struct("loss", "match"))).alias("_near"))
        )

    if first_percent is None:
        near = nearest(still_open, percent)
    else:
        first = durable(nearest(still_open, first_percent).where("_near IS NOT NULL"), "nearest")
        rest = durable(still_open.join(first.select(query_id), query_id, "left_anti"), "queries")
        near = first.unionByName(nearest(rest, percent))
    found = settled.join(near, query_id, "left").where("_equal IS NOT NULL OR _near IS NOT NULL")
    chosen = F.coalesce("_equal", "_near.match")
    return found.select(
        *queries.columns,
        *[chosen[x].alias(x) for x in carried],
        F.coalesce(-F.col("_near.loss"), F.lit(1.0)).alias("score"),
    )
