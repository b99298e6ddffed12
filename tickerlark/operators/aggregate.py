"""Aggregation of signals by time window and by hashtag.

Everything here is a hash aggregation with a partial stage before the shuffle, so a window or
tag that holds most of the rows sends one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlark.constants import WINDOW_SIZES
from tickerlark.functions.numeric import round_half_even
from tickerlark.operators.clean import high_confidence_filter
from tickerlark.params import DEFAULTS, Params
from tickerlark.schema import ENGAGEMENT, require

_SIGNAL_COLUMNS = ["signal_strength", "signal_confidence", "sentiment_score", "urgency_score"]


def _measures(engagement: Sequence[str]) -> dict[str, Column]:
    """The measures common to windows and tags, before rounding."""
    return {
        "signal_strength_mean": F.avg("signal_strength"),
        "signal_strength_std": F.stddev_samp("signal_strength"),
        "signal_strength_count": F.count("signal_strength"),
        "signal_confidence_mean": F.avg("signal_confidence"),
        "sentiment_score_mean": F.avg("sentiment_score"),
        "sentiment_score_std": F.stddev_samp("sentiment_score"),
        **{f"{c}_sum": F.sum(F.coalesce(c, F.lit(0))) for c in engagement},
        "urgency_score_mean": F.avg("urgency_score"),
        "direction_consistency": F.avg(F.when(F.col("signal_strength") > 0, 1.0).otherwise(0.0)),
    }


def _rounded(df: DataFrame) -> DataFrame:
    """Means and deviations to four digits, ties to even."""
    names = [c for c in df.columns if c.endswith(("_mean", "_std"))]
    return df.withColumns({c: round_half_even(F.col(c), 4) for c in names})


def signal_intensity(df: DataFrame) -> DataFrame:
    size = F.log1p(F.col("signal_strength_count").cast("double"))
    return df.withColumn(
        "signal_intensity", F.abs("signal_strength_mean") * F.col("signal_confidence_mean") * size
    )


def signal_volatility(df: DataFrame) -> DataFrame:
    return df.withColumn("signal_volatility", F.coalesce("signal_strength_std", F.lit(0.0)))


def hashtag_momentum(df: DataFrame) -> DataFrame:
    size = F.log1p(F.col("signal_strength_count").cast("double"))
    return df.withColumn("hashtag_momentum", F.col("signal_strength_mean") * size)


def having_min_support(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return df.filter(F.col("signal_strength_count") >= params.min_support)


def _stamp(ref_ts) -> Column:
    return F.current_timestamp() if ref_ts is None else F.lit(ref_ts).cast("timestamp")


def _finish_windows(grouped: DataFrame, ref_ts, params: Params) -> DataFrame:
    supported = having_min_support(_rounded(grouped), params)
    shaped = signal_volatility(signal_intensity(supported))
    return shaped.withColumn("aggregation_timestamp", _stamp(ref_ts)).select(
        "time_window",
        "window_size",
        "signal_strength_mean",
        "signal_strength_std",
        "signal_strength_count",
        "signal_confidence_mean",
        "sentiment_score_mean",
        "sentiment_score_std",
        *[f"{c}_sum" for c in ENGAGEMENT],
        "urgency_score_mean",
        "signal_intensity",
        "direction_consistency",
        "signal_volatility",
        "aggregation_timestamp",
    )


def _window_start(size: str) -> Column:
    return F.window("signal_timestamp", WINDOW_SIZES[size]).getField("start")


def aggregate_by_time(
    signals: DataFrame, window: str = "15min", ref_ts=None, params: Params = DEFAULTS
) -> DataFrame:
    """Tumbling windows over the high-confidence signals; windows with too few are dropped."""
    require(signals, "signal_timestamp", *_SIGNAL_COLUMNS)
    grouped = (
        high_confidence_filter(signals, params)
        .groupBy(F.window("signal_timestamp", WINDOW_SIZES[window]).alias("w"))
        .agg(*[m.alias(n) for n, m in _measures(ENGAGEMENT).items()])
        .withColumns({"time_window": F.col("w.start"), "window_size": F.lit(window)})
        .drop("w")
    )
    return _finish_windows(grouped, ref_ts, params)


def _window_start_micros(size: str) -> Column:
    """The start of the tumbling window, counted from the epoch, as ``window`` does."""
    number, unit = WINDOW_SIZES[size].split()
    micros = int(number) * {"minute": 60, "hour": 3600}[unit.rstrip("s")] * 1_000_000
    at = F.unix_micros("signal_timestamp")
    return F.timestamp_micros(at - F.pmod(at, F.lit(micros)))


def multi_window_rollup(
    signals: DataFrame, windows: Sequence[str] = ("15min", "1hour"), ref_ts=None,
    params: Params = DEFAULTS,
) -> DataFrame:
    """``aggregate_by_time`` for several sizes in one scan and one shuffle."""
    sizes = F.array(
        *[
            F.struct(F.lit(w).alias("window_size"), _window_start_micros(w).alias("time_window"))
            for w in windows
        ]
    )
    grouped = (
        high_confidence_filter(require(signals, "signal_timestamp", *_SIGNAL_COLUMNS), params)
        .select(*_SIGNAL_COLUMNS, *ENGAGEMENT, F.inline(sizes))
        .groupBy("time_window", "window_size")
        .agg(*[m.alias(n) for n, m in _measures(ENGAGEMENT).items()])
    )
    return _finish_windows(grouped, ref_ts, params)


def explode_hashtags(df: DataFrame) -> DataFrame:
    """One row per tag, lower-cased; posts without tags are dropped."""
    return require(df, "hashtags").withColumn(
        "hashtag", F.explode(F.transform("hashtags", F.lower))
    )


def aggregate_by_hashtag(
    signals: DataFrame, params: Params = DEFAULTS, ordered: bool = True
) -> DataFrame:
    """Measures per tag over the high-confidence signals, by falling momentum."""
    narrow = high_confidence_filter(signals, params).select(
        "hashtags", *_SIGNAL_COLUMNS, *ENGAGEMENT[:3]
    )
    measures = _measures(ENGAGEMENT[:3])
    del measures["sentiment_score_std"], measures["direction_consistency"]
    grouped = (
        explode_hashtags(narrow)
        .groupBy("hashtag")
        .agg(*[m.alias(n) for n, m in measures.items()])
    )
    result = hashtag_momentum(having_min_support(_rounded(grouped), params))
    return result.orderBy(F.desc("hashtag_momentum"), "hashtag") if ordered else result


def signal_summary(signals: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return signals.agg(
        F.count("*").alias("total_signals"),
        F.count_if(F.col("signal_confidence") >= params.min_confidence).alias(
            "high_confidence_signals"
        ),
        F.avg("signal_strength").alias("average_signal_strength"),
        F.avg("signal_confidence").alias("average_confidence"),
    )


def analysis_period(signals: DataFrame, ts: str = "signal_timestamp") -> DataFrame:
    span = signals.agg(F.min(ts).alias("start_time"), F.max(ts).alias("end_time"))
    micros = F.unix_micros("end_time") - F.unix_micros("start_time")
    return span.withColumn("duration_hours", micros / 3_600_000_000)


def consistency(positive: Column, negative: Column, total: Column) -> Column:
    """Share of the dominant direction; 0 when there are no signals."""
    return F.when(total > 0, F.greatest(positive, negative) / total).otherwise(F.lit(0.0))


def sentiment_consistency(signals: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    counts = high_confidence_filter(signals, params).agg(
        F.count_if(F.col("signal_strength") > 0).alias("positive"),
        F.count_if(F.col("signal_strength") < 0).alias("negative"),
        F.count("*").alias("total"),
    )
    share = consistency(F.col("positive"), F.col("negative"), F.col("total"))
    return counts.withColumn("consistency", share)


def distinct_ratio(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Distinct values by rows, per column.

    Exact counts go column by column through (column, value) pairs with a partial distinct;
    ``exact=False`` uses one pass of HyperLogLog sketches.
    """
    require(df, *columns)
    if not exact:
        sketches = df.agg(
            F.count("*").alias("n"), *[F.approx_count_distinct(c).alias(c) for c in columns]
        )
        pairs = F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("k")) for c in columns]
        )
        counted = sketches.select("n", F.inline(pairs))
    else:
        pairs = F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                for c in columns
            ]
        )
        values = df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count("*").alias("m"))
        counted = values.groupBy("column").agg(
            F.sum("m").alias("n"), F.count("value").alias("k")
        )
    return counted.select(
        "column",
        F.col("k").alias("distinct_values"),
        F.col("n").alias("rows"),
        F.when(F.col("n") > 0, F.col("k") / F.col("n")).alias("ratio"),
    )


def signal_rollup(
    signals: DataFrame, windows: Sequence[str] = ("15min", "1hour"), params: Params = DEFAULTS
) -> DataFrame:
    """All, per-window and per-tag measures of one signal table in a single pass.

    Each row is counted once under ``all`` and, when it has high confidence, under
    ``confident``, its windows and its tags. One scan and one shuffle feed every
    recommendation; the result has one row per window and tag.
    """
    confident = F.col("signal_confidence") >= params.min_confidence

    def member(kind: str, key: Column = F.lit(None).cast("string"), at: Column | None = None):
        at = F.lit(None).cast("timestamp") if at is None else at
        return F.struct(
            F.lit(kind).alias("kind"), key.alias("key"), at.alias("time_window")
        )

    everyone = F.array(member("all"))
    groups = F.array(
        member("confident"), *[member(w, at=_window_start_micros(w)) for w in windows]
    )
    tags = F.transform(
        F.coalesce("hashtags", F.array().cast("array<string>")),
        lambda t: member("hashtag", F.lower(t)),
    )
    members = F.when(confident, F.concat(everyone, groups, tags)).otherwise(everyone)
    grouped = (
        require(signals, "signal_timestamp", "hashtags", *_SIGNAL_COLUMNS)
        .withColumn("_members", members)
        .select(*_SIGNAL_COLUMNS, *ENGAGEMENT, "signal_timestamp", F.inline("_members"))
        .groupBy("kind", "key", "time_window")
        .agg(
            *[m.alias(n) for n, m in _measures(ENGAGEMENT).items()],
            F.count_if(F.col("signal_strength") > 0).alias("positive"),
            F.count_if(F.col("signal_strength") < 0).alias("negative"),
            F.count("*").alias("n"),
            F.min("signal_timestamp").alias("start_time"),
            F.max("signal_timestamp").alias("end_time"),
        )
    )
    return grouped
