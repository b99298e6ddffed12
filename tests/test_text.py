"""Table-driven cases for cleaning and parsing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickerlark.functions import text as tx
from tickerlark.operators import clean
from tickerlark.schema import POST_SCHEMA

REF = "2024-01-31 00:00:00"
NOON = dt.datetime(2024, 1, 5, 12, 0)


def post(**given):
    row = {f.name: None for f in POST_SCHEMA}
    row.update(id="1", username="User 1!", content="", post_ts=NOON, hashtags=[], mentions=[])
    row.update(given)
    return tuple(row[f.name] for f in POST_SCHEMA)


def apply(spark, fn, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("a&amp;b is fullwidth ５％", "a b is fullwidth 5%"),
        ("see https://t.co/x1 now and WWW.a.b here", "see now and here"),
        ("wow!!! why??? well......ok", "wow! why? well...ok"),
        ("up 📈 now and later", "up now and later"),
        ("आज तेजी है बाजार में", "आज तेजी है बाजार में"),
        ("bank nifty and nifty 50 and FIN NIFTY", "BANKNIFTY and NIFTY50 and FINNIFTY"),
        ("paid rs. 500 or 20 rupees on nse", "paid ₹500 or 20 ₹ on NSE"),
        ("unsent offset bse", "unsent offset BSE"),
        ("  tabs\tand spaces  ", "tabs and spaces"),
    ],
)
def test_clean_text(spark, given, expected):
    df = spark.createDataFrame([post(content=given)], POST_SCHEMA)
    assert clean.clean_posts(df, REF).first()["content"] == expected


def test_short_posts_are_dropped_and_fields_filled(spark):
    rows = [post(id="1", content="ok"), post(id="2", content="exactly ten", likes_count=-3)]
    out = clean.clean_posts(spark.createDataFrame(rows, POST_SCHEMA), REF).collect()
    assert [r["id"] for r in out] == ["2"]
    assert (out[0]["username"], out[0]["display_name"]) == ("user1", "user1")
    assert (out[0]["likes_count"], out[0]["language"], out[0]["is_retweet"]) == (0, "en", False)
    assert (out[0]["original_length"], out[0]["cleaned_length"]) == (11, 11)


def test_cleaning_stats(spark):
    rows = [post(id="1", content="ok"), post(id="2", content="12345678901234 &amp;")]
    stats = clean.cleaning_stats(spark.createDataFrame(rows, POST_SCHEMA), REF).first()
    assert (stats["original_count"], stats["cleaned_count"], stats["removed_count"]) == (2, 1, 1)
    assert stats["success_rate"] == 0.5 and stats["avg_length_reduction"] == pytest.approx(6 / 20)


def test_marks_can_be_broken(spark):
    kept, broken = (
        apply(spark, lambda c, m=m: tx.strip_special_chars(c, m), "तेजी")[0] for m in (True, False)
    )
    assert kept == "तेजी" and broken != kept


def test_counts(spark):
    assert apply(spark, tx.non_negative_count, "-3", "12x", "3.7", None, "41") == [0, 0, 0, 0, 41]


def test_tags_and_mentions(spark):
    df = spark.createDataFrame([(["#A", "a", "#x", "##b c", "Bc"], ["@U 1!", "u1", "@!"])], "h array<string>, m array<string>")
    row = df.select(tx.normalize_hashtags(F.col("h")), tx.normalize_mentions(F.col("m"))).first()
    assert row[0] == ["#b c", "#bc"] and row[1] == ["@u1"]


def test_timestamps(spark):
    ref = F.lit(REF).cast("timestamp")
    parsed = apply(
        spark, lambda c: tx.parse_timestamp(c, ref),
        "2024-1-5 3:04:05", "2024-01-05T03:04:05", "2024-01-05T03:04:05.25", "2024-01-05",
        "5/1/2024 3:04:05", "05-01-2024 03:04:05", "soon",
    )
    at = dt.datetime(2024, 1, 5, 3, 4, 5)
    assert parsed == [at, at, at.replace(microsecond=250000), dt.datetime(2024, 1, 5), at, at, dt.datetime(2024, 1, 31)]
    relative = apply(spark, lambda c: tx.parse_relative_timestamp(c, ref), "30s", "5m", "2h", "3d", "2w", "2024-01-05")
    end = dt.datetime(2024, 1, 31)
    deltas = [dt.timedelta(seconds=30), dt.timedelta(minutes=5), dt.timedelta(hours=2), dt.timedelta(days=3), dt.timedelta(0)]
    assert relative == [end - d for d in deltas] + [dt.datetime(2024, 1, 5)]


def test_comparison_text(spark):
    assert apply(spark, tx.comparison_text, "RT @u: See www.x.y  #tag Up-5%!", "#a @b", None) == ["rt see up 5", "", ""]


def test_entities(spark):
    df = spark.createDataFrame([("NIFTY at ₹1,500 cr, +2.5% by 9:15",)], "content string")
    e = clean.extract_market_entities(df).first()["entities"]
    assert (e["symbols"], e["percentages"], e["timings"]) == (["NIFTY"], ["+2.5%"], ["9:15"])
    assert e["prices"][0] == "₹1,500 cr"
