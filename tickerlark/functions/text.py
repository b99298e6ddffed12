"""Text cleaning and normalisation as column expressions.

Character classes are written out, because ``\\w`` and ``\\s`` mean different things in
different regex engines. A word character is a letter, a combining mark, a number or ``_``;
counting marks keeps words of Indic scripts whole.
"""

from __future__ import annotations

import html
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"\p{L}\p{M}\p{N}_"
WORD_WITHOUT_MARKS = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x{1c}-\x{20}\x{85}\p{Z}"

# --- fixed values: link hosts removed from posts, in this order -------------
URL_PATTERNS = [
    rf"https?://[^{SPACE}]+",
    rf"www\.[^{SPACE}]+",
    rf"t\.co/[{WORD}]+",
    rf"pic\.twitter\.com/[{WORD}]+",
    rf"tinyurl\.com/[{WORD}]+",
    rf"bit\.ly/[{WORD}]+",
]
# --- fixed values: characters kept beside word characters and space ---------
KEPT_PUNCTUATION = r"\-+%₹$#@.,!?():/"
# --- fixed values: market terms and their standard spelling, in this order --
STANDARD_TERMS = [
    ("nse", "NSE"),
    ("bse", "BSE"),
    (rf"nifty[{SPACE}]*50", "NIFTY50"),
    (rf"bank[{SPACE}]*nifty", "BANKNIFTY"),
    (rf"fin[{SPACE}]*nifty", "FINNIFTY"),
    ("rupees?", "₹"),
]
RUPEE_PREFIX = (rf"rs\.?[{SPACE}]*(\p{{Nd}}+)", "₹$1")
# --- fixed values: entity catalogue -----------------------------------------
ENTITY_PATTERNS = {
    "symbols": (
        rf"(?<![{WORD}])(?:NIFTY|SENSEX|BANKNIFTY|FINNIFTY|RELIANCE|TCS|INFY|HDFC|ICICI)"
        rf"(?![{WORD}])"
    ),
    "prices": (
        rf"₹?\p{{Nd}}+(?:[.,]\p{{Nd}}+)*"
        rf"(?:[{SPACE}]*(?:cr|crore|lakh|k|million|billion))?"
    ),
    "percentages": r"[+-]?\p{Nd}+(?:\.\p{Nd}+)?%",
    "timings": r"(?:9:15|9\.15|15:30|15\.30|pre-market|post-market|opening|closing)",
}
PERCENTAGE = ENTITY_PATTERNS["percentages"]


def word_class(keep_marks: bool = True) -> str:
    return WORD if keep_marks else WORD_WITHOUT_MARKS


@F.pandas_udf(T.StringType())
def _decode(texts: pd.Series) -> pd.Series:
    return texts.map(
        lambda t: unicodedata.normalize("NFKC", html.unescape(t)), na_action="ignore"
    )


def normalize_unicode(c: Column) -> Column:
    """Decode HTML entities and apply NFKC.

    Spark has no built-in for either. Texts which cannot change (ASCII without ``&``) reach
    Python as NULL, so they cost neither transfer nor work there.
    """
    return F.coalesce(_decode(F.when(c.rlike(r"&|[^\x{0}-\x{7f}]"), c)), c)


def collapse_whitespace(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"[{SPACE}]+", " "))


def remove_urls(c: Column) -> Column:
    """Remove links, pattern after pattern; texts without a link pay for one test only."""
    hint = c.rlike(r"(?i)https?://|www\.|t\.co/|pic\.twitter\.com/|tinyurl\.com/|bit\.ly/")
    without = reduce(lambda t, p: F.regexp_replace(t, f"(?i){p}", ""), URL_PATTERNS, c)
    return F.when(hint, without).otherwise(c)


def remove_mentions(c: Column, keep_marks: bool = True) -> Column:
    return F.regexp_replace(c, f"@[{word_class(keep_marks)}]+", "")


def remove_hashtags(c: Column, keep_marks: bool = True) -> Column:
    return F.regexp_replace(c, f"#[{word_class(keep_marks)}]+", "")


def collapse_punctuation(c: Column) -> Column:
    c = F.regexp_replace(c, r"\.{3,}", "...")
    c = F.regexp_replace(c, r"!{2,}", "!")
    return F.regexp_replace(c, r"\?{2,}", "?")


def strip_special_chars(c: Column, keep_marks: bool = True) -> Column:
    kept = f"{word_class(keep_marks)}{SPACE}{KEPT_PUNCTUATION}"
    return F.regexp_replace(c, f"[^{kept}]", " ")


def _at_word_start(pattern: str, w: str) -> str:
    """The pattern where no word character precedes it.

    If it starts with a plain letter, the look-behind is put after that letter: it is then
    tried at the few places where the letter occurs instead of at every character.
    """
    if "|" in pattern or not pattern[:2].isalpha():
        return f"(?i)(?<![{w}])(?:{pattern})"
    return f"(?i){pattern[0]}(?<![{w}]{pattern[0]}){pattern[1:]}"


def standardize_terms(c: Column, terms=None, keep_marks: bool = True) -> Column:
    """Spell market terms in one way. ``terms`` is an ordered list of (regex, text)."""
    w = word_class(keep_marks)
    for pattern, spelling in STANDARD_TERMS if terms is None else terms:
        c = F.regexp_replace(c, f"{_at_word_start(pattern, w)}(?![{w}])", spelling)
    if terms is None:
        c = F.regexp_replace(c, _at_word_start(RUPEE_PREFIX[0], w), RUPEE_PREFIX[1])
    return c


def extract_tags(c: Column, marker: str) -> Column:
    """All ``#words`` or ``@words`` of the lower-cased text."""
    return F.regexp_extract_all(F.lower(c), F.lit(f"{marker}[{WORD}]+"), F.lit(0))


def clean_username(c: Column, keep_marks: bool = True) -> Column:
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), f"[^{word_class(keep_marks)}]", "")
    return F.lower(bare)


def normalize_hashtags(c: Column) -> Column:
    edge = f"^[{SPACE}]+|[{SPACE}]+$"
    bare = F.transform(
        c, lambda t: F.lower(F.regexp_replace(F.replace(t, F.lit("#"), F.lit("")), edge, ""))
    )
    tags = F.transform(
        F.filter(bare, lambda t: F.length(t) > 1), lambda t: F.concat(F.lit("#"), t)
    )
    return F.coalesce(F.array_sort(F.array_distinct(tags)), F.array().cast("array<string>"))


def normalize_mentions(c: Column, keep_marks: bool = True) -> Column:
    bare = F.transform(
        F.filter(c, lambda m: m.isNotNull()), lambda m: clean_username(m, keep_marks)
    )
    names = F.transform(
        F.filter(bare, lambda m: m != F.lit("")), lambda m: F.concat(F.lit("@"), m)
    )
    return F.coalesce(F.array_sort(F.array_distinct(names)), F.array().cast("array<string>"))


def non_negative_count(c: Column) -> Column:
    """A count: whole and at least 0; anything else is 0."""
    return F.greatest(F.lit(0).cast("bigint"), F.coalesce(c.try_cast("bigint"), F.lit(0)))


def comparison_text(c: Column, keep_marks: bool = True) -> Column:
    """The form in which two posts are compared: lower case, words only."""
    w = word_class(keep_marks)
    bare = F.regexp_replace(
        F.lower(F.coalesce(c, F.lit(""))),
        rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+",
        "",
    )
    bare = F.regexp_replace(F.regexp_replace(bare, f"@[{w}]+", ""), f"#[{w}]+", "")
    return F.trim(F.regexp_replace(bare, f"[^{w}]+", " "))


# --- fixed values: timestamp formats, tried in this order -------------------
TIMESTAMP_FORMATS = [
    "yyyy-M-d H:m:s",
    "yyyy-M-d'T'H:m:s",
    "yyyy-M-d'T'H:m:s.SSSSSS",
    "yyyy-M-d",
    "d/M/yyyy H:m:s",
    "d-M-yyyy H:m:s",
]
ABSOLUTE_FORMATS = [TIMESTAMP_FORMATS[i] for i in (0, 1, 3)]


def parse_timestamp(c: Column, fallback: Column, formats=tuple(TIMESTAMP_FORMATS)) -> Column:
    parsed = [F.try_to_timestamp(c, F.lit(f)) for f in formats]
    return F.coalesce(*parsed, fallback)


def parse_relative_timestamp(c: Column, now: Column) -> Column:
    """``30s``, ``5m``, ``2h``, ``3d`` before ``now``, or an absolute time, or ``now``."""
    relative = r"^(\p{Nd}+)([smhd])$"
    amount = F.regexp_extract(c, relative, 1).try_cast("bigint")
    unit = F.regexp_extract(c, relative, 2)
    seconds = amount * (
        F.when(unit == "s", 1).when(unit == "m", 60).when(unit == "h", 3600)
        .when(unit == "d", 86400)
    )
    before = F.timestamp_add("SECOND", -seconds, now)
    return F.coalesce(before, parse_timestamp(c, now, ABSOLUTE_FORMATS))
