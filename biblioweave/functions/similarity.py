"""Edit similarity of titles, and the exact bounds a scalable join needs.

``percent`` is a whole-number threshold T. Two texts of lengths l and n pass when
``levenshtein * 100 <= (100 - T) * max(l, n)``.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, functions as F

from .text import WHITESPACE


def sorted_tokens(c: Column) -> Column:
    spaced = F.translate(c, WHITESPACE, " " * len(WHITESPACE))
    return F.array_join(F.array_sort(F.filter(F.split(spaced, " "), lambda t: t != "")), " ")


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - levenshtein / longer length; 0 where either text is empty."""
    longer = F.greatest(F.length(a), F.length(b))
    some = (F.length(a) > 0) & (F.length(b) > 0)
    return F.when(some, 1.0 - F.levenshtein(a, b) / longer).otherwise(F.lit(0.0))


def token_sort_similarity(a: Column, b: Column) -> Column:
    return edit_similarity(sorted_tokens(a), sorted_tokens(b))


def title_similarity(a: Column, b: Column) -> Column:
    """The better of the plain and the token-sorted similarity."""
    return F.greatest(edit_similarity(a, b), token_sort_similarity(a, b))


def length_band(size: Column, percent: int) -> Column:
    """Lengths of two passing texts differ by at most one band.

    The base is a little wider than the threshold, so rounding at a band edge
    cannot part a pair.
    """
    return F.floor(F.log(size.cast("double")) / math.log(100.0 / (percent - 1))).cast("int")


def allowed_edits(longer: str, percent: int) -> str:
    return f"({100 - percent} * {longer}) div 100"


def most_edits(size: str, percent: int) -> str:
    """Edits allowed against the longest text that can still pass."""
    return allowed_edits(f"((100 * {size}) div {percent})", percent)


def chunk_size(size: str, percent: int) -> str:
    """Longest chunk of which ``most_edits + 2`` fit side by side into the text; two of them survive."""
    return f"({size} div ({most_edits(size, percent)} + 2))"


def letter_bits(column: str) -> Column:
    """63 flags: which letters occur once, twice and (the common ones) three times.

    One edit clears at most one flag and sets at most one, so the flags that only
    one of two texts has are a lower bound of their distance.
    """
    levels = [(x, n) for x in string.ascii_lowercase for n in (1, 2)] + [(x, 3) for x in "acdehilnost"]
    flags = [
        f"if(length({column}) - length(replace(lower({column}), '{x}', '')) >= {n}, {1 << bit}L, 0L)"
        for bit, (x, n) in enumerate(levels)
    ]
    return F.expr(" | ".join(flags))
