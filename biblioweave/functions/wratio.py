"""The weighted ratio as column expressions: similarity by common subsequences, of texts, of their tokens, and of the best window.

The longest common subsequence is counted bit by bit: a word holds 62 places of the first text, and each letter of the second
takes one addition per word. Scores run from 0 to 1 and are 0 where either text is empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from . import similarity as sim

_BITS = 62
_FULL = (1 << _BITS) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.transform(F.array(value), body)[0]


def _chars(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def _zero(kind: str) -> Column:
    return F.lit(0).cast(kind)


def lcs(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence."""

    def counted(chars: Column) -> Column:
        words = F.greatest(F.ceil(F.size(chars) / _BITS), F.lit(1)).cast("int")
        places = F.sequence(F.lit(0), words - 1)

        def mask(c: Column) -> Column:
            def word(w: Column) -> Column:
                own = F.slice(chars, w * _BITS + 1, F.lit(_BITS))
                bits = F.transform(own, lambda x, i: F.when(x == c, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(_zero("long")))
                return F.aggregate(bits, _zero("long"), lambda s, x: s.bitwiseOR(x))

            return F.transform(places, word)

        distinct = F.array_distinct(chars)
        start = F.array_repeat(F.lit(_FULL).cast("long"), words)

        def letter(state: Column, found: Column) -> Column:
            def add(s: Column, w: Column) -> Column:
                def parts(v: Column) -> Column:
                    hit = v.bitwiseAND(F.get(found, w))
                    return _let(v + hit + s.carry, lambda total: F.struct(
                        F.call_function("shiftright", total, F.lit(_BITS)).alias("carry"),
                        F.concat(s.out, F.array(total.bitwiseAND(F.lit(_FULL).cast("long")).bitwiseOR(v - hit))).alias("out"),
                    ))

                return _let(F.get(state, w), parts)

            none = F.struct(_zero("long").alias("carry"), F.array().cast("array<long>").alias("out"))
            return F.aggregate(places, none, add, lambda s: s.out)

        def run(masks: Column) -> Column:
            step = lambda state, c: _let(F.try_element_at(masks, c), lambda m: F.when(m.isNull(), state).otherwise(letter(state, m)))
            left = F.aggregate(_chars(b), start, step)
            return words * _BITS - F.aggregate(left, _zero("int"), lambda n, v: n + F.bit_count(v))

        return _let(F.map_from_arrays(distinct, F.transform(distinct, mask)), run)

    return F.when((F.length(a) > 0) & (F.length(b) > 0), _let(_chars(a), counted)).otherwise(F.lit(0))


def indel_ratio(a: Column, b: Column) -> Column:
    """Twice the common subsequence over both lengths; 0 where either text is empty."""
    some = (F.length(a) > 0) & (F.length(b) > 0)
    return F.when(some, 2.0 * lcs(a, b) / (F.length(a) + F.length(b))).otherwise(F.lit(0.0))


def _token_parts(a: Column, b: Column) -> tuple[Column, Column, Column]:
    """The common tokens, and those of either text alone, each sorted and joined."""
    sets = [F.array_distinct(F.split(sim.sorted_tokens(c), " ")) for c in (a, b)]
    own = [F.filter(s, lambda t: t != "") for s in sets]
    return tuple(
        F.array_join(F.array_sort(part), " ")
        for part in (F.array_intersect(*own), F.array_except(own[0], own[1]), F.array_except(own[1], own[0]))
    )


def token_set_ratio(a: Column, b: Column) -> Column:
    """1 where the tokens of one text are among those of the other, else the best of the three ways to compare them."""

    def scored(p: Column) -> Column:
        both, one, two = (F.length(x) for x in (p.both, p.one, p.two))
        gap = F.when(both > 0, 1).otherwise(0)
        apart = one + two - 2 * lcs(p.one, p.two)
        whole = 1.0 - apart / (2 * (both + gap) + one + two)
        partial = F.greatest(*[1.0 - (gap + x) / (2 * both + gap + x) for x in (one, two)])
        return F.when((both > 0) & ((one == 0) | (two == 0)), 1.0).when(both > 0, F.greatest(whole, partial)).otherwise(whole)

    some = (F.length(sim.sorted_tokens(a)) > 0) & (F.length(sim.sorted_tokens(b)) > 0)
    both, one, two = _token_parts(a, b)
    return F.when(some, _let(F.struct(both.alias("both"), one.alias("one"), two.alias("two")), scored)).otherwise(F.lit(0.0))


def partial_ratio(a: Column, b: Column) -> Column:
    """The best ratio of the shorter text with a window of the longer one: as long as the shorter, or cut by an end."""

    def best(p: Column) -> Column:
        size, room = F.length(p.short), F.length(p.long)
        starts = F.sequence(1 - size + 1, room)
        cut = lambda i: F.substring(p.long, F.greatest(i, F.lit(1)), size - F.greatest(1 - i, F.lit(0)))
        return F.array_max(F.transform(starts, lambda i: indel_ratio(p.short, cut(i))))

    first = F.length(a) <= F.length(b)
    pair = F.struct(F.when(first, a).otherwise(b).alias("short"), F.when(first, b).otherwise(a).alias("long"))
    some = (F.length(a) > 0) & (F.length(b) > 0)
    return F.when(some, _let(pair, best)).otherwise(F.lit(0.0))


def partial_token_ratio(a: Column, b: Column) -> Column:
    """1 where a token is shared, else the better partial ratio of the sorted tokens and of the different ones."""
    both, one, two = _token_parts(a, b)
    return F.when(F.length(both) > 0, 1.0).otherwise(
        F.greatest(partial_ratio(sim.sorted_tokens(a), sim.sorted_tokens(b)), partial_ratio(one, two))
    )


def weighted_ratio(a: Column, b: Column) -> Column:
    """The plain ratio, or a scaled one of tokens (texts of similar length) or windows (one at least half as long again)."""

    def scored(p: Column) -> Column:
        longer, shorter = F.greatest(F.length(p.a), F.length(p.b)), F.least(F.length(p.a), F.length(p.b))
        plain = indel_ratio(p.a, p.b)
        tokens = F.greatest(indel_ratio(sim.sorted_tokens(p.a), sim.sorted_tokens(p.b)), token_set_ratio(p.a, p.b))
        scale = F.when(longer <= 8 * shorter, 0.9).otherwise(0.6)
        windows = F.greatest(partial_ratio(p.a, p.b) * scale, partial_token_ratio(p.a, p.b) * 0.95 * scale)
        return F.greatest(plain, F.when(2 * longer < 3 * shorter, tokens * 0.95).otherwise(windows))

    some = (F.length(a) > 0) & (F.length(b) > 0)
    return F.when(some, _let(F.struct(a.alias("a"), b.alias("b")), scored)).otherwise(F.lit(0.0))
