"""Scores, batch statistics and their edge cases."""

import math
import statistics as stt

import pytest
from pyspark.sql import functions as F

from tickerlark.functions.numeric import round_half_even
from tickerlark.operators import aggregate as ag
from tickerlark.operators import features as ft
from tickerlark.operators import recommend, signals


def score(spark, operator, column, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, content string")
    return [r[column] for r in operator(df).orderBy("id").collect()]


def test_market_sentiment(spark):
    got = score(spark, ft.market_sentiment, "market_sentiment",
                "buy good sell", "BUY buy buyer", "nothing", "", "तेजी मंदी loss")
    assert got == pytest.approx([(2 + 1 - 2) / 5, 1.0, 0.0, 0.0, (1 - 1 - 2) / 4])


def test_action_and_price_sentiment(spark):
    assert score(spark, ft.action_sentiment, "action_sentiment", "buy buy hold", "x") == pytest.approx([4 / 3, 0])
    assert score(spark, ft.price_sentiment, "price_sentiment", "+25% -5%", "5 percent") == pytest.approx([0.25, 0])


def test_basic_sentiment_table_equals_mapping(spark):
    lexicon = {"up": (0.5, 1.0), "down": (-1.0, 0.25)}
    rows = [(w, p, s) for w, (p, s) in lexicon.items()]
    table = spark.createDataFrame(rows, "term string, polarity double, subjectivity double")
    df = spark.createDataFrame([(1, "up up down"), (2, "flat"), (3, "down")], "id int, content string")
    columns = ["id", "basic_sentiment", "sentiment_confidence"]
    a = ft.basic_sentiment(df, lexicon).select(*columns).orderBy("id").collect()
    b = ft.basic_sentiment(df, table).select(*columns).orderBy("id").collect()
    assert a == b and a[0]["basic_sentiment"] == 0.0 and a[2]["sentiment_confidence"] == 0.25


def test_urgency(spark):
    got = score(spark, ft.urgency_score, "urgency_score", "urgent alert now", "I know", "wow!!!", "calm")
    assert got == pytest.approx([1.0, 0.4, 0.4, 0.0])
    whole = score(spark, lambda d: ft.urgency_score(d, whole_word=True), "urgency_score", "I know", "now")
    assert whole == pytest.approx([0.0, 0.4])


def test_rounding_is_half_even_and_free_of_noise(spark):
    df = spark.createDataFrame([(0.00125,), (0.00125 + 1e-17,), (0.00135,), (-0.00001,)], "x double")
    got = [r[0] for r in df.select(round_half_even(F.col("x"), 4)).collect()]
    assert got == [0.0012, 0.0012, 0.0014, 0.0] and math.copysign(1, got[3]) == 1


def test_categories_are_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in (-0.3, -0.1, 0.1, 0.3, 0.31)], "x double")
    got = [r[0] for r in df.select(signals.signal_category(F.col("x"))).collect()]
    assert got == ["strong_bearish", "weak_bearish", "neutral", "weak_bullish", "strong_bullish"]


FEATURES = "id int, sentiment_score double, sentiment_confidence double, urgency_score double, has_target_hashtag boolean, replies_count_log double, retweets_count_log double, likes_count_log double, post_ts timestamp"


def batch(spark, rows):
    full = [(i, *r, None) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, FEATURES).withColumn("post_ts", F.timestamp_seconds(F.col("id")))


def two_pass(rows):
    """The signal by definition: standardise, combine, standardise again."""
    logs = list(zip(*[r[4:7] for r in rows]))
    z = [[(v - stt.mean(col)) / (stt.stdev(col) + 1e-8) for v in col] for col in logs]
    comp = [0.4 * r[0] + 0.1 * sum(c[i] for c in z) + 0.3 * r[2] for i, r in enumerate(rows)]
    mean, std = stt.mean(comp), stt.stdev(comp)
    return [math.tanh((c - mean) / std) for c in comp]


def test_one_pass_statistics_equal_two_passes(spark):
    rows = [(0.1 * i - 0.3, 0.5, 0.2 * (i % 3), i % 2 == 0, math.log1p(i), math.log1p(i * i), math.log1p(7 - i)) for i in range(8)]
    out = signals.generate_signals(batch(spark, rows)).orderBy("id").collect()
    assert [r["signal_strength"] for r in out] == pytest.approx(two_pass(rows), abs=1e-9)
    top = max(sum(r[4:7]) for r in rows)
    r0 = out[0]
    mean = (0.5 + sum(rows[0][4:7]) / top + 1.0 + 1 - math.exp(-2 * abs(r0["signal_strength"]))) / 4
    assert r0["signal_confidence"] == pytest.approx(mean)


def test_single_row_and_constant_batches(spark):
    one = signals.generate_signals(batch(spark, [(0.5, 0.5, 0.0, True, 1.0, 1.0, 1.0)])).first()
    assert one["signal_strength"] == pytest.approx(0.2)
    same = signals.generate_signals(batch(spark, [(0.5, 0.5, 0.0, True, 0.0, 0.0, 0.0)] * 3)).collect()
    assert {round(r["signal_strength"], 9) for r in same} == {0.2}
    # without any engagement the engagement factor is left out
    assert same[0]["signal_confidence"] == pytest.approx((0.5 + 1.0 + 1 - math.exp(-0.4)) / 3)


SIGNALS = "id int, signal_strength double, signal_confidence double, sentiment_score double, urgency_score double, hashtags array<string>, replies_count long, retweets_count long, likes_count long, views_count long, t long"


def signal_rows(spark, rows):
    full = [(i, s, c, s, 0.0, tags, 1, 2, 3, 4, t) for i, (s, c, tags, t) in enumerate(rows)]
    return spark.createDataFrame(full, SIGNALS).withColumn("signal_timestamp", F.timestamp_seconds("t"))


def test_min_support_and_windows(spark):
    rows = [(0.5, 0.6, ["#A"], t) for t in (0, 10, 899)] + [(0.5, 0.9, ["#b"], 900), (0.5, 0.59, ["#b"], 901), (0.1, 0.9, ["#b"], 902)]
    df = signal_rows(spark, rows)
    out = ag.aggregate_by_time(df, "15min").collect()
    assert [(r["signal_strength_count"], r["replies_count_sum"]) for r in out] == [(3, 3)]
    tags = ag.aggregate_by_hashtag(df).collect()
    assert [(r["hashtag"], r["signal_strength_count"]) for r in tags] == [("#a", 3)]
    assert tags[0]["hashtag_momentum"] == pytest.approx(0.5 * math.log(4))


def test_recommendations_from_rollup_equal_their_parts(spark):
    rows = [((i % 7 - 2) / 5, 0.5 + i % 5 / 10, [f"#t{i % 4}", "#all"], i * 97) for i in range(200)]
    df = signal_rows(spark, rows)
    whole = {r["type"]: r for r in recommend.recommendations(df).collect()}
    direction = recommend.market_direction(df).first()
    assert whole["market_direction"]["description"] == direction["description"]
    assert whole["market_direction"]["confidence"] == direction["confidence"]
    risk = recommend.assess_risk(df).first()
    assert (whole["risk_assessment"]["risk_level"], whole["risk_assessment"]["risk_score"]) == (risk["risk_level"], risk["risk_score"])
    assert whole["overall_score"]["overall_score"] == recommend.overall_score(df).first()[0]
    times = recommend.time_recommendation(ag.multi_window_rollup(df)).collect()
    assert {t["type"]: t["latest_signal"] for t in times} == {t["type"]: whole[t["type"]]["latest_signal"] for t in times}


def test_status_and_risk_of_small_batches(spark):
    few = signal_rows(spark, [(0.5, 0.9, ["#a"], 0), (0.5, 0.9, ["#a"], 1), (0.5, 0.1, ["#a"], 2)])
    assert recommend.recommendation_status(few).first()["status"] == "insufficient_data"
    assert recommend.recommendation_status(few.limit(0)).first()["status"] == "no_data"
    assert [r["type"] for r in recommend.recommendations(few).collect()] == ["status"]
    # 0.5 + 0.2 + 0.1 stays just below 0.8 in doubles
    mixed = signal_rows(spark, [(0.9, 0.9, ["#a"], 0), (-0.9, 0.9, ["#a"], 1), (0.9, 0.9, ["#a"], 2)])
    risk = recommend.assess_risk(mixed).first()
    assert risk["risk_level"] == "medium" and risk["risk_score"] == 0.8
