"""Lexicon scores as column expressions over the tokens of a post."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerlark import constants as const
from tickerlark.functions.text import PERCENTAGE, WORD

MARKET_WEIGHTS: dict[str, float] = {
    **dict.fromkeys(const.BULLISH_STRONG, const.STRONG_WEIGHT),
    **dict.fromkeys(const.BULLISH_MODERATE + const.BULLISH_HINDI, const.OTHER_WEIGHT),
    **dict.fromkeys(const.BEARISH_STRONG, -const.STRONG_WEIGHT),
    **dict.fromkeys(const.BEARISH_MODERATE + const.BEARISH_HINDI, -const.OTHER_WEIGHT),
}
# The default general lexicon: the market words at half their weight, as
# (polarity, subjectivity). Another one can be passed as a mapping or as a table.
GENERAL_LEXICON: dict[str, tuple[float, float]] = {
    word: (weight / 2, abs(weight) / 2) for word, weight in MARKET_WEIGHTS.items()
}


def tokens(c: Column) -> Column:
    """Maximal runs of word characters of the lower-cased text."""
    return F.split(F.lower(F.coalesce(c, F.lit(""))), f"[^{WORD}]+")


def lexicon_hits(token_array: Column, *lexicons: Mapping[str, object]) -> Column:
    """The tokens that any lexicon knows: a hash-set test per token, once per post."""
    known = sorted(set().union(*lexicons))
    return F.filter(token_array, lambda t: t.isin(known))


def _weights(mapping: Mapping[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def _scored(hits: Column, mapping: Mapping[str, float]) -> Column:
    weights = _weights(mapping)
    return F.filter(F.transform(hits, lambda t: weights[t]), lambda v: v.isNotNull())


def _mean(values: Column) -> Column:
    n = F.size(values)
    return F.when(n > 0, _total(values) / n).otherwise(F.lit(0.0))


def market_sentiment(hits: Column) -> Column:
    """(bullish - bearish) / (bullish + bearish), by weighted occurrences."""
    scored = _scored(hits, MARKET_WEIGHTS)
    size = _total(F.transform(scored, F.abs))
    return F.when(size > 0, _total(scored) / size).otherwise(F.lit(0.0))


def action_sentiment(hits: Column) -> Column:
    return _mean(_scored(hits, const.ACTION_WEIGHTS))


def price_sentiment(c: Column) -> Column:
    """Mean of the percentages in the text, each clamped to +-10 and scaled to +-1."""
    found = F.regexp_extract_all(c, F.lit(PERCENTAGE), F.lit(0))
    changes = F.transform(
        found,
        lambda p: F.coalesce(
            F.greatest(
                F.lit(-10.0),
                F.least(F.lit(10.0), F.regexp_replace(p, "%", "").try_cast("double")),
            )
            / 10.0,
            F.lit(0.0),
        ),
    )
    return F.coalesce(_mean(changes), F.lit(0.0))


def general_sentiment(hits: Column, lexicon=None) -> tuple[Column, Column]:
    """(polarity, subjectivity): means over the matched tokens, 0 when none matches."""
    lexicon = GENERAL_LEXICON if lexicon is None else lexicon
    polarity = {word: float(pair[0]) for word, pair in lexicon.items()}
    subjectivity = {word: float(pair[1]) for word, pair in lexicon.items()}
    return _mean(_scored(hits, polarity)), _mean(_scored(hits, subjectivity))


def sentiment_score(basic: Column, market: Column, action: Column, price: Column) -> Column:
    combined = basic * 0.3 + market * 0.4 + action * 0.2 + price * 0.1
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), combined))


def urgency_score(c: Column, whole_word: bool = False) -> Column:
    """Sum of the scores of the markers in the text, divided by 5, at most 1."""
    text = F.lower(F.coalesce(c, F.lit("")))
    total = F.lit(0.0)
    for marker, score in const.URGENCY_SCORES.items():
        if whole_word and marker.isalpha():
            present = text.rlike(f"(?<![{WORD}]){marker}(?![{WORD}])")
        else:
            present = F.contains(text, F.lit(marker))
        total = total + F.when(present, score).otherwise(0.0)
    return F.least(F.lit(1.0), total / 5.0)
