"""Batch-normalised signals.

A post's signal is relative to its whole batch. The composite is a linear combination of five
features, so its mean and variance follow from their means and covariances: one aggregation
over the features yields everything, instead of one pass per normalisation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlark.operators.features import extract_features
from tickerlark.params import DEFAULTS, Params
from tickerlark.schema import SIGNAL_ENGAGEMENT, require
from tickerlark.session import materialise

EPSILON = 1e-8
_LOGS = [f"{c}_log" for c in SIGNAL_ENGAGEMENT]
_TERMS = ["sentiment_score", *_LOGS, "urgency_score"]

# --- fixed values: upper bounds of the categories, the bound included --------
CATEGORY_BOUNDS = [
    (-0.3, "strong_bearish"), (-0.1, "weak_bearish"), (0.1, "neutral"), (0.3, "weak_bullish"),
]
TOP_CATEGORY = "strong_bullish"


def _total(columns: list[Column]) -> Column:
    total = columns[0]
    for c in columns[1:]:
        total = total + c
    return total


_PAIRS = [(a, b) for i, a in enumerate(_TERMS) for b in _TERMS[i:]]


def feature_moments(features: DataFrame) -> DataFrame:
    """One row: count, means and covariances of the five features, and the largest engagement."""
    require(features, *_TERMS)
    value = {t: F.coalesce(F.col(t), F.lit(0.0)) for t in _TERMS}
    return features.agg(
        F.count("*").alias("n"),
        *[F.avg(value[t]).alias(f"{t}_mean") for t in _TERMS],
        *[
            (F.var_samp(value[a]) if a == b else F.covar_samp(value[a], value[b])).alias(f"{a}*{b}")
            for a, b in _PAIRS
        ],
        F.max(_total([value[t] for t in _LOGS])).alias("engagement_max"),
    )


def merged_moments(parts: DataFrame) -> DataFrame:
    """The moments of all rows from the moments of parts of them; parts without rows are harmless.

    Co-moments are added with what the parts' means differ from the mean of all, so nothing
    large cancels.
    """
    n, mean = F.col("n"), {t: F.coalesce(f"{t}_mean", F.lit(0.0)) for t in _TERMS}
    total = F.sum("n")
    centre = parts.agg(*[F.coalesce(F.sum(n * mean[t]) / F.nullif(total, F.lit(0)), F.lit(0.0)).alias(t) for t in _TERMS])
    centred = parts.withColumn("_centre", centre.select(F.struct("*").alias("s")).scalar())
    off = {t: mean[t] - F.col("_centre").getField(t) for t in _TERMS}
    inside = lambda a, b: F.coalesce(F.col(f"`{a}*{b}`"), F.lit(0.0)) * (n - 1)
    return centred.agg(
        F.coalesce(total, F.lit(0)).alias("n"),
        *[F.max(F.col("_centre").getField(t)).alias(f"{t}_mean") for t in _TERMS],
        *[
            F.when(total > 1, F.sum(F.when(n > 0, inside(a, b) + n * off[a] * off[b])) / F.nullif(total - 1, F.lit(0))).alias(f"{a}*{b}")
            for a, b in _PAIRS
        ],
        F.max("engagement_max").alias("engagement_max"),
    )


def stats_of_moments(moments: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """The statistics of :func:`batch_stats` from the moments of its rows."""
    spread = {f"{t}_std": F.coalesce(F.sqrt(F.col(f"`{t}*{t}`")), F.lit(0.0)) for t in _LOGS}
    weight = {
        "sentiment_score": F.lit(params.sentiment_weight),
        **{t: params.volume_weight / 3 / (F.col(f"{t}_std") + EPSILON) for t in _LOGS},
        "urgency_score": F.lit(params.urgency_weight),
    }
    variance = _total(
        [
            weight[a] * weight[b] * F.col(f"`{a}*{b}`") * (1.0 if a == b else 2.0)
            for a, b in _PAIRS
        ]
    )
    centre = (
        params.sentiment_weight * F.col("sentiment_score_mean")
        + params.urgency_weight * F.col("urgency_score_mean")
    )
    return moments.withColumns(spread).select(
        "n",
        *[f"{t}_{m}" for t in _LOGS for m in ("mean", "std")],
        F.coalesce("engagement_max", F.lit(0.0)).alias("engagement_max"),
        F.coalesce(centre, F.lit(0.0)).alias("composite_mean"),
        F.coalesce(F.sqrt(F.greatest(variance, F.lit(0.0))), F.lit(0.0)).alias("composite_std"),
    )


def batch_stats(features: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """One row: means and standard deviations of the log counts, the largest engagement,
    and mean and standard deviation of the composite signal."""
    return stats_of_moments(feature_moments(features), params)


def _with_stats(features: DataFrame, stats: DataFrame | None, params: Params) -> DataFrame:
    """Attach the one-row statistics as a scalar subquery: no join, and more than one row is
    an error."""
    stats = batch_stats(features, params) if stats is None else stats
    return features.withColumn("_stats", stats.select(F.struct("*").alias("s")).scalar())


def _stat(name: str) -> Column:
    return F.col("_stats").getField(name)


def _volume() -> Column:
    z = [
        (F.coalesce(t, F.lit(0.0)) - _stat(f"{t}_mean")) / (_stat(f"{t}_std") + EPSILON)
        for t in _LOGS
    ]
    return F.when(_stat("n") > 1, _total(z) / 3).otherwise(F.lit(0.0))


def _composite(params: Params) -> Column:
    return (
        F.coalesce("sentiment_score", F.lit(0.0)) * params.sentiment_weight
        + F.col("volume_signal") * params.volume_weight
        + F.coalesce("urgency_score", F.lit(0.0)) * params.urgency_weight
    )


def _strength() -> Column:
    z = (F.col("composite_signal") - _stat("composite_mean")) / _stat("composite_std")
    return F.when(_stat("composite_std") > 0, F.tanh(z)).otherwise(F.col("composite_signal"))


def _confidence() -> Column:
    engaged = _stat("engagement_max") > 0
    share = F.when(
        engaged, _total([F.coalesce(t, F.lit(0.0)) for t in _LOGS]) / _stat("engagement_max")
    ).otherwise(F.lit(0.0))
    tagged = F.when(F.col("has_target_hashtag"), 1.0).otherwise(0.5)
    certain = 1 - F.exp(-F.abs("signal_strength") * 2)
    total = F.coalesce("sentiment_confidence", F.lit(0.0)) + share + tagged + certain
    mean = total / F.when(engaged, 4.0).otherwise(3.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), mean))


def signal_category(strength: Column) -> Column:
    """Five classes; each bound belongs to the class below it."""
    chain = F.when(strength.isNull(), None)
    for bound, name in CATEGORY_BOUNDS:
        chain = chain.when(strength <= bound, name)
    return chain.otherwise(TOP_CATEGORY)


def volume_signal(features: DataFrame, stats=None, params: Params = DEFAULTS) -> DataFrame:
    """Mean of the three standardised log counts."""
    return _with_stats(features, stats, params).withColumn("volume_signal", _volume()).drop("_stats")


def composite_signal(features: DataFrame, stats=None, params: Params = DEFAULTS) -> DataFrame:
    return volume_signal(features, stats, params).withColumn("composite_signal", _composite(params))


def signal_strength(features: DataFrame, stats=None, params: Params = DEFAULTS) -> DataFrame:
    stats = batch_stats(features, params) if stats is None else stats
    composed = composite_signal(features, stats, params)
    return (
        _with_stats(composed, stats, params).withColumn("signal_strength", _strength()).drop("_stats")
    )


def signal_confidence(features: DataFrame, stats=None, params: Params = DEFAULTS) -> DataFrame:
    stats = batch_stats(features, params) if stats is None else stats
    strong = signal_strength(features, stats, params)
    return (
        _with_stats(strong, stats, params).withColumn("signal_confidence", _confidence()).drop("_stats")
    )


def apply_signals(with_stats: DataFrame, params: Params = DEFAULTS, ts: str = "post_ts") -> DataFrame:
    """The signal columns for rows that carry their batch statistics in ``_stats``."""
    confident = F.col("signal_confidence") >= params.min_confidence
    return (
        with_stats.withColumn("volume_signal", _volume())
        .withColumn("composite_signal", _composite(params))
        .withColumn("signal_strength", _strength())
        .withColumn("signal_confidence", _confidence())
        .withColumns(
            {
                "signal_category": signal_category(F.col("signal_strength")),
                "high_confidence": confident,
                "signal_timestamp": F.col(ts),
                "signal_hour": F.hour(ts),
            }
        )
        .drop("_stats", "volume_signal", "composite_signal")
    )


def generate_signals(features: DataFrame, stats=None, params: Params = DEFAULTS) -> DataFrame:
    """Signals for a batch of features.

    Statistics and signals both read ``features``, so these should be a stored table, as
    ``posts_to_signals`` makes them. ``stats`` may be a stored one-row table too.
    """
    return apply_signals(_with_stats(features, stats, params), params)


def posts_to_signals(
    posts: DataFrame, params: Params = DEFAULTS, stats=None, store_features: bool = True
) -> DataFrame:
    """Features, then signals.

    Features are stored in the shared folder, so each text is scored once and not again for
    the statistics and for every later filter on a signal.
    """
    features = extract_features(posts, params)
    return generate_signals(materialise(features) if store_features else features, stats, params)
