"""Fixed schemas and the check each operator runs at its entry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ENGAGEMENT = ["replies_count", "retweets_count", "likes_count", "views_count"]
# The three counts that drive the volume signal and the engagement confidence.
SIGNAL_ENGAGEMENT = ENGAGEMENT[:3]

POST_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("username", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("post_ts", T.TimestampType()),
        T.StructField("content", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in ENGAGEMENT],
        T.StructField("hashtags", T.ArrayType(T.StringType())),
        T.StructField("mentions", T.ArrayType(T.StringType())),
        T.StructField("url", T.StringType()),
        T.StructField("is_retweet", T.BooleanType()),
        T.StructField("language", T.StringType()),
    ]
)

CLEAN_SCHEMA = T.StructType(
    POST_SCHEMA.fields
    + [
        T.StructField("cleaned_at", T.TimestampType()),
        T.StructField("original_length", T.IntegerType()),
        T.StructField("cleaned_length", T.IntegerType()),
    ]
)

STORED_SCHEMA = T.StructType(
    POST_SCHEMA.fields
    + [
        T.StructField("collected_at", T.TimestampType()),
        T.StructField("data_version", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
    ]
)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Fail with a readable message when an input lacks a column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; got {df.columns}")
    return df
