"""The data behind each chart; nothing is drawn."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerlark.constants import BEARISH_COLOUR, BULLISH_COLOUR
from tickerlark.operators.indexing import partition_offsets, sorted_positions
from tickerlark.params import DEFAULTS, Params

_TIMELINE = ["signal_strength", "signal_confidence", "sentiment_score"]


def sort_by_time(df: DataFrame, ts: str = "signal_timestamp", id_col: str = "id") -> DataFrame:
    return df.orderBy(ts, id_col)


def timeline_downsample(
    signals: DataFrame, mode: str = "windowed", size: str = "5 minutes"
) -> DataFrame:
    """The signal timeline: means per window, or every point with mode ``raw``."""
    if mode not in ("windowed", "raw"):
        raise ValueError(f"unknown mode {mode!r}")
    points = signals.select("signal_timestamp", *_TIMELINE)
    if mode == "raw":
        return points
    means = points.groupBy(F.window("signal_timestamp", size).alias("w")).agg(
        *[F.avg(c).alias(c) for c in _TIMELINE]
    )
    return means.select(F.col("w.start").alias("signal_timestamp"), *_TIMELINE).dropna()


def trend_line(
    signals: DataFrame, value: str = "signal_strength", ts: str = "signal_timestamp",
    id_col: str = "id",
) -> DataFrame:
    """Least-squares slope and intercept of ``value`` over the time-ordered row number.

    Row numbers are never assigned globally: each range partition contributes its sums over
    local positions, and the few partial rows are shifted by their offsets.
    """
    placed = sorted_positions(signals.select(ts, id_col, value), [ts, id_col])
    y = F.col(value)
    partial = placed.groupBy("_part").agg(
        F.count("*").alias("_n"),
        F.sum(y).alias("y"),
        F.sum(F.col("_pos") * y).alias("py"),
    )
    shifted = partition_offsets(partial)
    total = shifted.agg(
        F.sum("_n").cast("double").alias("n"),
        F.sum("y").alias("y"),
        F.sum(F.col("py") + F.col("_offset") * F.col("y")).alias("xy"),
    )
    n = F.col("n")
    x = n * (n - 1) / 2
    xx = (n - 1) * n * (2 * n - 1) / 6
    fitted = total.filter(n > 1).withColumn(
        "slope", (n * F.col("xy") - x * F.col("y")) / (n * xx - x * x)
    )
    return fitted.select(
        n.cast("bigint").alias("points"),
        "slope",
        ((F.col("y") - F.col("slope") * x) / n).alias("intercept"),
    )


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed, with the mean."""
    values = df.select(F.col(value).cast("double").alias("v")).dropna()
    bounds = values.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.avg("v").alias("mean"))
    flat = F.col("low") == F.col("high")
    bounds = bounds.select(
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
        "mean",
    )
    stats = bounds.select(F.struct("*").alias("s")).scalar()
    low, high = F.col("_s.low"), F.col("_s.high")
    raw = F.floor((F.col("v") - low) / (high - low) * bins)
    binned = values.withColumn("_s", stats).withColumn("bin", F.least(raw, F.lit(bins - 1)))
    counts = binned.groupBy("bin").agg(F.count("*").alias("frequency"))
    edges = df.sparkSession.range(bins).withColumnRenamed("id", "bin").withColumn("_s", stats)
    width = (high - low) / bins
    filled = edges.join(counts, "bin", "left").filter(F.col("_s.mean").isNotNull())
    return filled.select(
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("frequency", F.lit(0)).alias("frequency"),
        F.col("_s.mean").alias("mean"),
    )


def category_counts(signals: DataFrame, column: str = "signal_category") -> DataFrame:
    """Rows and share per category, most frequent first."""
    counts = signals.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count("*").alias("frequency")
    )
    total = counts.select(F.sum("frequency").alias("t")).scalar()
    return counts.withColumn("share", F.col("frequency") / total).orderBy(
        F.desc("frequency"), column
    )


def confidence_scatter(signals: DataFrame, id_col: str = "id", per_category: int | None = None) -> DataFrame:
    """The points of confidence against strength, coloured by sentiment; all of them by default.

    With ``per_category`` so many points of each signal category: those with the smallest md5 of
    their id, the same points however the rows are partitioned. Cut inside each task first.
    """
    columns = [id_col, "signal_confidence", "signal_strength", "sentiment_score"]
    if per_category is None:
        return signals.select(*columns)
    order = Window.partitionBy("signal_category").orderBy(F.md5(F.col(id_col).cast("string")), id_col)
    ranked = signals.select(*columns, "signal_category", F.row_number().over(order).alias("_rank"))
    return ranked.filter(F.col("_rank") <= per_category).select(*columns, "signal_category")


def top_hashtags(by_hashtag: DataFrame, top: int = 10) -> DataFrame:
    """The leading tags with bar colour and bubble size."""
    momentum = F.col("hashtag_momentum")
    best = by_hashtag.orderBy(F.desc("hashtag_momentum"), "hashtag").limit(top)
    return best.select(
        "hashtag",
        "hashtag_momentum",
        "signal_strength_count",
        "signal_strength_mean",
        F.when(momentum > 0, BULLISH_COLOUR).otherwise(BEARISH_COLOUR).alias("colour"),
        (F.abs(momentum) * 100).alias("bubble_size"),
    )


def window_trend_series(windows: DataFrame) -> DataFrame:
    """Mean strength and confidence per window and size."""
    return windows.select(
        "window_size", "time_window", "signal_strength_mean", "signal_confidence_mean"
    )


def recommendation_type_counts(recommended: DataFrame) -> DataFrame:
    """Recommendations per type; the risk, score and status rows are not recommendations."""
    facts = ["risk_assessment", "overall_score", "status"]
    return (
        recommended.filter(~F.col("type").isin(facts))
        .groupBy("type")
        .agg(F.count("*").alias("frequency"))
    )


def limit_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in the order given: a top-k per task, then one merge."""
    return df.orderBy(*order).limit(n)
