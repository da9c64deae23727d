"""Settings and the fixed value lists every job shares."""

from __future__ import annotations

from dataclasses import dataclass

# Spark ML's default English stop words (181 words).
ENGLISH_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don should now
    i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's
    it's we're they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't
    hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot
    could here's how's let's ought that's there's what's when's where's who's why's would
    """.split()
)

# Irregular word forms the suffix rules of the title key cannot reach.
IRREGULAR_LEMMAS = {
    "analyses": "analysis",
    "bases": "basis",
    "children": "child",
    "crises": "crisis",
    "criteria": "criterion",
    "feet": "foot",
    "hypotheses": "hypothesis",
    "indices": "index",
    "matrices": "matrix",
    "men": "man",
    "mice": "mouse",
    "phenomena": "phenomenon",
    "series": "series",
    "species": "species",
    "syntheses": "synthesis",
    "teeth": "tooth",
    "theses": "thesis",
    "vertices": "vertex",
    "women": "woman",
}

# Texts that spreadsheet and CSV exports use for a missing cell.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Ordered (pattern, replacement) pairs. Each pattern is matched
# case-insensitively between word boundaries; later rules see earlier output.
STRICT_COUNTRY_RULES = (
    (r"(?:usa|u\.s\.a\.|united states of america|united states)", "United States"),
    (r"(?:uk|u\.k\.|united kingdom)", "United Kingdom"),
    (r"united arab emirates", "United Arab Emirates"),
    (r"republic of korea", "South Korea"),
    (r"peoples r china", "China"),
    (r"russian federation", "Russia"),
    (r"england", "United Kingdom"),
    (r"scotland", "United Kingdom"),
    (r"wales", "United Kingdom"),
    (r"northern ireland", "United Kingdom"),
    (r"viet\s?nam", "Vietnam"),
    (r"Côte d'Ivoire", "Ivory Coast"),
    (r"Cote d'Ivoire", "Ivory Coast"),
    (r"Cote Ivoire", "Ivory Coast"),
    (r"Dominican Rep", "Dominican Republic"),
    (r"Trinidad Tobago", "Trinidad and Tobago"),
    (r"Timor Leste", "Timor-Leste"),
    (r"St Vincent", "Saint Vincent and the Grenadines"),
    (r"Germany \(Democratic Republic, DDR\)", "Germany"),
    (r"Sao Tome & Prin", "Sao Tome and Principe"),
    (r"St Lucia", "Saint Lucia"),
    (r"St Kitts & Nevi", "Saint Kitts and Nevis"),
    (r"Papua N Guinea", "Papua New Guinea"),
    (r"Guinea Bissau", "Guinea-Bissau"),
    (r"Cent Afr Republ", "Central African Republic"),
    (r"Cape Verde", "Cabo Verde"),
    (r"Brunei", "Brunei Darussalam"),
    (r"Nigeria", "Niger"),
    (r"DEM REP CONGO", "Congo"),
    (r"Democratic Republic of the Congo", "Congo"),
    (r"Turkiye", "Turkey"),
    (r"St Martin", "Saint Martin"),
    (r"Saint Martin", "Saint Martin"),
)

# Rules that over-reach (or never fire) as listed above, and what the default
# list does instead: None drops the rule, a text is a complete regex.
_RULE_FIXES = {
    STRICT_COUNTRY_RULES[0][0]: r"\b(?:usa|united states of america|united states)\b|\bu\.s\.a\.",
    STRICT_COUNTRY_RULES[1][0]: r"\b(?:uk|united kingdom)\b|\bu\.k\.",
    "wales": r"(?<!new south )\bwales\b",
    r"Germany \(Democratic Republic, DDR\)": r"\bGermany \(Democratic Republic, DDR\)",
    "Brunei": r"\bBrunei\b(?! Darussalam)",
    "Nigeria": None,
}


def _bounded(rules):
    return tuple((rf"(?iU)\b{p}\b", r) for p, r in rules)


def _fixed(rules):
    out = []
    for pattern, replacement in rules:
        regex = _RULE_FIXES.get(pattern, rf"\b{pattern}\b")
        if regex is not None:
            out.append((f"(?iU){regex}", replacement))
    return tuple(out)


COUNTRY_RULES_STRICT = _bounded(STRICT_COUNTRY_RULES)
COUNTRY_RULES_DEFAULT = _fixed(STRICT_COUNTRY_RULES)

# Lower-case texts one of which stands in every match of a rule that is more than a plain text.
_RULE_TEXTS = {
    STRICT_COUNTRY_RULES[0][0]: ("usa", "u.s.a.", "united states"),
    STRICT_COUNTRY_RULES[1][0]: ("uk", "u.k.", "united kingdom"),
    r"viet\s?nam": ("viet",),
    r"Germany \(Democratic Republic, DDR\)": ("germany (democratic republic, ddr)",),
}
# The same by the complete regex. A rule that is not listed is simply tried on every text.
COUNTRY_RULE_TEXTS = {
    regex: _RULE_TEXTS.get(pattern, (pattern.lower(),))
    for rules in (_bounded, _fixed) for pattern, replacement in STRICT_COUNTRY_RULES for regex, _ in rules([(pattern, replacement)])
}

# Column names of the second source and their names in the first.
B_TO_A_COLUMNS = {
    "UT (Unique WOS ID)": "EID",
    "Author(s) ID": "Author(s) ID",
    "Document Type": "Document Type",
    "Language": "Language of Original Document",
    "Author Keywords": "Author Keywords",
    "Keywords Plus": "Index Keywords",
    "Abstract": "Abstract",
    "DOI": "DOI",
    "Author Full Names": "Author full names",
    "Authors": "Authors",
    "Cited Reference Count": "Cited by",
    "Publication Year": "Year",
    "Source Title": "Source title",
    "Article Title": "Title",
    "Addresses": "Authors with affiliations",
    "Open Access Designations": "Open Access",
    "ISSN": "ISSN",
    "Publisher": "Publisher",
    "DOI Link": "Link",
    "Source": "Source",
    "Publication Stage": "Publication Stage",
}

# Columns kept from the second source, in output order.
TARGET_COLUMNS = (
    "Publication Stage", "Authors", "Author(s) ID", "Source", "EID", "Document Type",
    "Language of Original Document", "Author Keywords", "Index Keywords", "Abstract", "DOI",
    "Cited by", "Year", "Source title", "Title", "Affiliations", "ISSN", "Publisher", "Link",
    "Open Access", "Author full names", "Scopus_SubjectArea", "Authors with affiliations",
    "title_key", "In_Both",
)

# Journal metrics that fill a gap in the record's own column.
METRIC_COLUMNS = (
    "SJR", "SJR Best Quartile", "H index", "Country", "Region", "Publisher", "Categories", "Areas",
)

# Document types that have a column of their own in the report by year.
DOCUMENT_TYPES = (
    "Article", "Book", "Book Chapter", "Conference Paper", "Early Access", "Editorial", "Letter", "Note", "Proceedings Paper", "Review",
)

SOURCE_A = "Scopus"
SOURCE_B = "Web of science"


@dataclass(frozen=True)
class Settings:
    """Parameters of a run. Thresholds are whole percents of similarity."""

    year_start: int = 2015
    year_end: int = 2025
    title_threshold: int = 85
    journal_threshold: int = 90
    canonical_threshold: int = 90
    year_tolerance: int = 1
    min_title_length: int = 5
    year_first: bool = False
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS
    lemmas: tuple[tuple[str, str], ...] = tuple(IRREGULAR_LEMMAS.items())
    country_rules: tuple[tuple[str, str], ...] = COUNTRY_RULES_DEFAULT
    null_tokens: tuple[str, ...] = NULL_TOKENS
    b_to_a: tuple[tuple[str, str], ...] = tuple(B_TO_A_COLUMNS.items())
    target_columns: tuple[str, ...] = TARGET_COLUMNS
    document_types: tuple[str, ...] = DOCUMENT_TYPES


DEFAULTS = Settings()
