"""Per-post features: one narrow stage over the cleaned posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlark import constants as const
from tickerlark.functions import sentiment as st
from tickerlark.functions import text as tx
from tickerlark.operators.similarity import split_join
from tickerlark.params import DEFAULTS, Params
from tickerlark.schema import ENGAGEMENT, require
from tickerlark.session import materialise


def _with_hits(df: DataFrame, lexicon=None) -> DataFrame:
    general = st.GENERAL_LEXICON if lexicon is None else lexicon
    hits = st.lexicon_hits(
        st.tokens(F.col("content")), st.MARKET_WEIGHTS, const.ACTION_WEIGHTS, general
    )
    return require(df, "content").withColumn("_hits", hits)


def market_sentiment(df: DataFrame) -> DataFrame:
    scored = _with_hits(df).withColumn("market_sentiment", st.market_sentiment(F.col("_hits")))
    return scored.drop("_hits")


def action_sentiment(df: DataFrame) -> DataFrame:
    scored = _with_hits(df).withColumn("action_sentiment", st.action_sentiment(F.col("_hits")))
    return scored.drop("_hits")


def price_sentiment(df: DataFrame) -> DataFrame:
    return df.withColumn("price_sentiment", st.price_sentiment(F.col("content")))


def basic_sentiment(df: DataFrame, lexicon=None, id_col: str = "id") -> DataFrame:
    """Add ``basic_sentiment`` and ``sentiment_confidence`` from a general lexicon.

    ``lexicon`` is a mapping ``{term: (polarity, subjectivity)}``, evaluated in place, or a
    table (term, polarity, subjectivity) of any size, joined on the term.
    """
    if isinstance(lexicon, DataFrame):
        return _basic_sentiment_from_table(df, lexicon, id_col)
    polarity, subjectivity = st.general_sentiment(F.col("_hits"), lexicon)
    scored = _with_hits(df, lexicon).withColumns(
        {"basic_sentiment": polarity, "sentiment_confidence": subjectivity}
    )
    return scored.drop("_hits")


def _basic_sentiment_from_table(df: DataFrame, lexicon: DataFrame, id_col: str) -> DataFrame:
    # A frequent term may be a third of all tokens: terms are joined by their frequency.
    words = materialise(df.select(id_col, F.explode(st.tokens(F.col("content"))).alias("term")))
    frequency = words.groupBy("term").agg(F.count("*").alias("n"))
    entries = lexicon.select("term", "polarity", "subjectivity").join(frequency, "term")
    scores = (
        split_join(words, entries, "term", "n")
        .groupBy(id_col)
        .agg(F.avg("polarity").alias("_pol"), F.avg("subjectivity").alias("_subj"))
    )
    return (
        df.join(scores, id_col, "left")
        .withColumn("basic_sentiment", F.coalesce("_pol", F.lit(0.0)))
        .withColumn("sentiment_confidence", F.coalesce("_subj", F.lit(0.0)))
        .drop("_pol", "_subj")
    )


def sentiment_score(df: DataFrame, lexicon=None) -> DataFrame:
    """Add the five sentiment columns and ``sentiment_score``, their weighted sum."""
    polarity, subjectivity = st.general_sentiment(F.col("_hits"), lexicon)
    parts = {
        "basic_sentiment": polarity,
        "sentiment_confidence": subjectivity,
        "market_sentiment": st.market_sentiment(F.col("_hits")),
        "action_sentiment": st.action_sentiment(F.col("_hits")),
        "price_sentiment": st.price_sentiment(F.coalesce("content", F.lit(""))),
    }
    score = st.sentiment_score(
        *[F.col(f"{p}_sentiment") for p in ("basic", "market", "action", "price")]
    )
    return _with_hits(df, lexicon).withColumns(parts).withColumn("sentiment_score", score).drop("_hits")


def text_stats(df: DataFrame) -> DataFrame:
    """Characters, words, tags and mentions per post."""
    words = F.regexp_count("content", F.lit(f"[^{tx.SPACE}]+"))
    return df.withColumns(
        {
            "content_length": F.length("content"),
            "word_count": words,
            "hashtag_count": F.coalesce(F.size("hashtags"), F.lit(0)),
            "mention_count": F.coalesce(F.size("mentions"), F.lit(0)),
        }
    )


def has_price_mention(df: DataFrame) -> DataFrame:
    found = F.coalesce(F.col("content").rlike(r"₹|\$|\p{Nd}+%"), F.lit(False))
    return df.withColumn("has_price_mention", found)


def has_target_hashtag(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    wanted = F.array(*[F.lit(t) for t in params.target_hashtags])
    found = F.arrays_overlap(F.transform("hashtags", F.lower), wanted)
    return df.withColumn("has_target_hashtag", F.coalesce(found, F.lit(False)))


def urgency_score(df: DataFrame, whole_word: bool = False) -> DataFrame:
    return df.withColumn("urgency_score", st.urgency_score(F.col("content"), whole_word))


def engagement_log(df: DataFrame) -> DataFrame:
    """ln(1 + count) of the four counts."""
    return df.withColumns(
        {f"{c}_log": F.log1p(F.coalesce(c, F.lit(0)).cast("double")) for c in ENGAGEMENT}
    )


def time_features(df: DataFrame, ts: str = "post_ts") -> DataFrame:
    """Hour, weekday (Monday = 0) and whether the hour lies in trading time."""
    hour: Column = F.hour(ts)
    return df.withColumns(
        {"hour": hour, "day_of_week": F.weekday(ts), "is_market_hours": hour.between(9, 15)}
    )


def extract_features(df: DataFrame, params: Params = DEFAULTS, lexicon=None) -> DataFrame:
    """All features in one pass; the input columns are kept."""
    scored = sentiment_score(df, lexicon).drop("action_sentiment", "price_sentiment")
    priced = has_price_mention(text_stats(scored))
    tagged = has_target_hashtag(priced, params)
    return time_features(engagement_log(urgency_score(tagged)))
