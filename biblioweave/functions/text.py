"""Cleaning rules as Column expressions: everything here stays in the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from ..config import COUNTRY_RULE_TEXTS, DEFAULTS, Settings

# Every character that counts as white space when trimming.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE = f"[{WHITESPACE}]"  # the same characters in a pattern, where \\s knows only the ASCII ones


_DECIMAL = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def ws_trim(c: Column) -> Column:
    """Trim every kind of white space (the built-in ``trim`` knows only the space)."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return F.coalesce(ws_trim(c), F.lit("")) == ""


def safe_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def null_if_token(c: Column, tokens: Sequence[str] = DEFAULTS.null_tokens) -> Column:
    """Read the usual missing-cell texts as NULL."""
    return F.when(~c.isin(list(tokens)), c)


def _joined_parts(c: Column) -> Column:
    parts = F.transform(F.split(c, ";"), ws_trim)
    return F.array_join(F.filter(parts, lambda p: p != ""), "; ")


def _without_parentheses(c: Column) -> Column:
    return F.regexp_replace(c, r"\([^)]*\)", "")


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def title_tokens(column: str, settings: Settings = DEFAULTS) -> str:
    """SQL text of a title's tokens: ASCII letters, lower case, no stop words."""
    stops = ", ".join(_sql_text(w) for w in settings.stop_words)
    # White space of every kind becomes the space first: patterns of ASCII characters alone are several times faster.
    spaced = f"translate(coalesce(cast(`{column}` AS string), ''), {_sql_text(WHITESPACE)}, '{' ' * len(WHITESPACE)}')"
    letters = f"lower(regexp_replace({spaced}, '[^a-zA-Z ]', ''))"
    return f"filter(split({letters}, ' '), t -> t <> '' AND t NOT IN ({stops}))"


def lemma(t: str, settings: Settings = DEFAULTS) -> str:
    """SQL text of a token's lemma by the irregular forms and the plural rules."""
    forms = ", ".join(_sql_text(form) for form, _ in settings.lemmas) or "''"
    irregular = " ".join(f"WHEN {_sql_text(form)} THEN {_sql_text(lemma)}" for form, lemma in settings.lemmas)
    drop_es = " OR ".join(f"endswith({t}, '{e}')" for e in ("sses", "xes", "zes", "ches", "shes"))
    return f"""CASE WHEN length({t}) <= 3 THEN {t}
        WHEN {t} IN ({forms}) THEN CASE {t} {irregular or "WHEN '' THEN ''"} END
        WHEN NOT endswith({t}, 's') OR endswith({t}, 'ss') OR endswith({t}, 'us') OR endswith({t}, 'is') THEN {t}
        WHEN endswith({t}, 'ies') AND length({t}) > 4 THEN concat(substring({t}, 1, length({t}) - 3), 'y')
        WHEN {drop_es} THEN substring({t}, 1, length({t}) - 2)
        ELSE substring({t}, 1, length({t}) - 1) END"""


def title_key(column: str, settings: Settings = DEFAULTS) -> Column:
    """Normalised title: ASCII letters, lower case, no stop words, lemmas.

    Written as one SQL text: the stop words become a hash-set test and the long
    rule list costs a single call into the JVM.
    """
    stops = ", ".join(_sql_text(w) for w in settings.stop_words)
    lemmas = f"transform({title_tokens(column, settings)}, t -> {lemma('t', settings)})"
    return F.expr(f"array_join(filter({lemmas}, t -> t NOT IN ({stops})), ' ')")


def author_names(c: Column) -> Column:
    """Drop ``(id)`` groups and blank entries of a ``;`` list; NULL stays NULL."""
    return _joined_parts(_without_parentheses(c))


def categories(c: Column) -> Column:
    """Drop ``(Qn)`` marks and blank entries of a ``;`` list; NULL becomes ''."""
    return _joined_parts(_without_parentheses(safe_text(c)))


def document_type(c: Column) -> Column:
    """Spell conference papers one way and normalise the spacing of ``;``."""
    renamed = F.replace(c, F.lit("Proceedings Paper"), F.lit("Conference paper"))
    whole = F.when(F.lower(renamed).contains("conference paper"), "Conference Paper").otherwise(renamed)
    return ws_trim(F.regexp_replace(whole, f"{SPACE}*;{SPACE}*", "; "))


def doi(c: Column) -> Column:
    return ws_trim(F.lower(safe_text(c)))


def without_commas(c: Column) -> Column:
    return F.translate(c, ",", "")


def ampersand_to_and(c: Column) -> Column:
    return F.replace(c, F.lit("&"), F.lit("and"))


def number(c: Column) -> Column:
    """Numeric value of a decimal number, or NULL where the text is none (the cast alone takes ``12d``, ``0x1p3``, ``Infinity``)."""
    trimmed = ws_trim(c.cast("string"))
    return F.when(trimmed.rlike(_DECIMAL), trimmed.try_cast("double"))


def year(c: Column) -> Column:
    return number(c).try_cast("int")


def cited_by(c: Column) -> Column:
    return F.coalesce(number(c).try_cast("long"), F.lit(0).cast("long"))


def issn(c: Column) -> Column:
    return F.regexp_replace(F.upper(safe_text(c)), "[^0-9X]", "")


def issn_list(c: Column) -> Column:
    """The distinct cleaned ISSNs of a ``,`` or ``;`` list."""
    return F.array_distinct(F.filter(F.transform(F.split(c, "[,;]"), issn), lambda x: x != ""))


def issn_cell(c: Column) -> Column:
    """A record's ISSN cell with every ISSN of its list cleaned, in order; '' where there is none."""
    return F.coalesce(F.array_join(issn_list(c), "; "), F.lit(""))


def document_types(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, ";"), ws_trim), lambda x: x != "")


def filled_from(c: Column, other: Column) -> Column:
    """``other`` where ``c`` is blank and ``other`` is not."""
    return F.when(is_blank(c) & ~is_blank(other), other).otherwise(c)


def bracket_commas(c: Column) -> Column:
    """Delete the commas inside ``[...]`` groups (from a ``[`` to the next ``]``)."""
    pieces = F.split(c, "\\]")
    last = F.size(pieces) - 1

    def clean(piece: Column, i: Column) -> Column:
        start = F.instr(piece, "[")
        head = F.substring(piece, F.lit(1), start - 1)
        group = F.translate(F.substring(piece, start, F.length(piece)), ",", "")
        return F.when((i < last) & (start > 0), F.concat(head, group)).otherwise(piece)

    return F.array_join(F.transform(pieces, clean), "]")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.transform(F.array(value), body)[0]


# Characters that a pattern of either case takes for ASCII letters.
_ODD_LETTERS = "\u0130\u0131\u017f\u212a"


def _any_country(patterns: Sequence[str]) -> str | None:
    """A cheap pattern that is found wherever one of the country patterns is, or None where their texts are not known."""
    if any(p not in COUNTRY_RULE_TEXTS for p in patterns):
        return None
    ends: dict[str, set[str]] = {}
    for t in (t for p in patterns for t in COUNTRY_RULE_TEXTS[p]):
        ends.setdefault(t[0], set()).add("".join(re.escape(x) if x.isascii() else "." for x in t[1:]))
    return f"(?i)\\b(?:{'|'.join(f'{first}(?:{"|".join(sorted(rest))})' for first, rest in sorted(ends.items()))})|[{_ODD_LETTERS}]"


def countries(c: Column, settings: Settings = DEFAULTS) -> Column:
    """Apply the ordered country rules. Cheap patterns find the texts that all, six or one of them are for: the rules cost far more."""

    def apply(rules, t: Column, at_once: int) -> Column:
        out = t
        for i in range(0, len(rules), at_once):
            part = rules[i : i + at_once]
            if at_once > 1:
                out = _let(out, group(part))
            else:
                out = F.regexp_replace(out, *part[0])
        found = _any_country([pattern for pattern, _ in rules])
        return F.when(t.rlike(found), out).otherwise(t) if found else out

    def group(rules) -> Callable[[Column], Column]:
        return lambda t: apply(rules, t, 6 if len(rules) > 6 else 1)

    rules = settings.country_rules
    return _let(c, group(rules)) if rules else c


def affiliations(c: Column, settings: Settings = DEFAULTS) -> Column:
    return countries(bracket_commas(c), settings)


def open_access(c: Column) -> Column:
    return F.when(is_blank(c), "subscription").otherwise(c)


def journal_name(c: Column) -> Column:
    return ws_trim(_without_parentheses(c))


def percentage(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(F.lit(100.0) * part / whole, 1)).otherwise(F.lit(0.0))
