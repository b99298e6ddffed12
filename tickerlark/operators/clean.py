"""Cleaning of whole posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlark.functions import text as tx
from tickerlark.params import DEFAULTS, Params
from tickerlark.schema import ENGAGEMENT, require


def _clean_text(df: DataFrame, params: Params) -> DataFrame:
    """Add ``_text``. Steps are separate projections where a test guards a costly branch."""
    marks = params.keep_marks
    df = df.withColumn("_decoded", tx.normalize_unicode(F.coalesce("content", F.lit(""))))
    df = df.withColumn("_text", tx.collapse_whitespace(F.col("_decoded"))).drop("_decoded")
    text = F.col("_text")
    text = tx.remove_urls(text) if params.remove_urls else text
    text = tx.remove_mentions(text, marks) if params.remove_mentions else text
    text = tx.remove_hashtags(text, marks) if params.remove_hashtags else text
    text = tx.strip_special_chars(tx.collapse_punctuation(text), marks)
    text = F.regexp_replace(text, f"[{tx.SPACE}]+", " ")
    return df.withColumn("_text", F.trim(tx.standardize_terms(text, keep_marks=marks)))


def _timestamp(df: DataFrame, ref_ts: Column) -> Column:
    if isinstance(df.schema["post_ts"].dataType, T.StringType):
        return tx.parse_timestamp(F.col("post_ts"), ref_ts)
    return F.coalesce(F.col("post_ts").cast("timestamp"), ref_ts)


def default_fields(df: DataFrame) -> DataFrame:
    """Fill absent identity fields."""
    return require(df, "id", "username", "display_name", "url", "is_retweet", "language").withColumns(
        {
            "display_name": F.coalesce("display_name", tx.clean_username(F.col("username"))),
            "id": F.coalesce("id", F.lit("")),
            "url": F.coalesce("url", F.lit("")),
            "is_retweet": F.coalesce("is_retweet", F.lit(False)),
            "language": F.coalesce("language", F.lit("en")),
        }
    )


def validate_engagement(df: DataFrame) -> DataFrame:
    """The four counts as whole numbers of at least 0."""
    return df.withColumns({c: tx.non_negative_count(F.col(c)) for c in ENGAGEMENT})


def min_length_filter(df: DataFrame, column: str = "content", min_length: int = 10) -> DataFrame:
    return df.filter(F.length(F.trim(column)) >= min_length)


def cleaned(df: DataFrame, ref_ts=None, params: Params = DEFAULTS) -> DataFrame:
    """Cleaned posts, before short ones are dropped. Lengths are those of the text."""
    require(df, "id", "username", "post_ts", "content", *ENGAGEMENT, "hashtags", "mentions")
    now = F.current_timestamp() if ref_ts is None else F.lit(ref_ts).cast("timestamp")
    filled = validate_engagement(default_fields(df))
    marks = params.keep_marks
    return _clean_text(filled, params).select(
        "id",
        tx.clean_username(F.col("username"), marks).alias("username"),
        "display_name",
        _timestamp(df, now).alias("post_ts"),
        F.col("_text").alias("content"),
        *ENGAGEMENT,
        tx.normalize_hashtags(F.col("hashtags")).alias("hashtags"),
        tx.normalize_mentions(F.col("mentions"), marks).alias("mentions"),
        "url",
        "is_retweet",
        "language",
        now.alias("cleaned_at"),
        F.coalesce(F.length("content"), F.lit(0)).alias("original_length"),
        F.length("_text").alias("cleaned_length"),
    )


def clean_posts(df: DataFrame, ref_ts=None, params: Params = DEFAULTS) -> DataFrame:
    """Clean every field; posts whose text is too short afterwards are dropped.

    One narrow stage: no shuffle, and no Python beyond the Unicode step. A plain filter on the
    cleaned text would be pushed below its projection, and Spark would then clean every text
    twice; a generator that yields the text or nothing stays where it is.
    """
    long_enough = F.col("cleaned_length") >= params.min_content_length
    rows = cleaned(df, ref_ts, params)
    kept = rows.withColumn("content", F.explode(F.when(long_enough, F.array("content"))))
    return kept.select(*rows.columns)


def cleaning_stats(df: DataFrame, ref_ts=None, params: Params = DEFAULTS) -> DataFrame:
    """One row: counts before and after, mean relative shortening, success rate."""
    kept = F.col("cleaned_length") >= params.min_content_length
    shortening = (F.col("original_length") - F.col("cleaned_length")) / F.col("original_length")
    measured = kept & (F.col("original_length") > 0)
    counts = cleaned(df, ref_ts, params).agg(
        F.count("*").alias("original_count"),
        F.count_if(kept).alias("cleaned_count"),
        F.coalesce(F.avg(F.when(measured, shortening)), F.lit(0.0)).alias("avg_length_reduction"),
    )
    rate = F.when(F.col("original_count") > 0, F.col("cleaned_count") / F.col("original_count"))
    return counts.select(
        "original_count",
        "cleaned_count",
        (F.col("original_count") - F.col("cleaned_count")).alias("removed_count"),
        "avg_length_reduction",
        F.coalesce(rate, F.lit(0.0)).alias("success_rate"),
    )


def extract_market_entities(df: DataFrame, column: str = "content") -> DataFrame:
    """Add ``entities``: index symbols, prices, percentages and market times in the text."""
    found = [
        F.regexp_extract_all(F.col(column), F.lit(pattern), F.lit(0)).alias(name)
        for name, pattern in tx.ENTITY_PATTERNS.items()
    ]
    return df.withColumn("entities", F.struct(*found))


def high_confidence_filter(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return df.filter(F.col("signal_confidence") >= params.min_confidence)
