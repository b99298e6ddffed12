"""Recommendations, risk and report facts: rules over a few aggregated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlark import constants as const
from tickerlark.functions.numeric import round_half_even
from tickerlark.operators.aggregate import consistency, signal_rollup
from tickerlark.params import DEFAULTS, Params
from tickerlark.session import materialise

# --- fixed values: strength classes of the mean signal -----------------------
STRENGTH_CLASSES = [(0.8, "strong"), (0.5, "moderate"), (0.2, "weak")]
# --- fixed values: signals that count as full volume -------------------------
FULL_VOLUME = 50
# --- fixed values: risk --------------------------------------------------------
BASE_RISK = 0.5
RISK_LEVELS = [(0.8, "high"), (0.6, "medium")]

RESULT_COLUMNS = {
    "seq": "int", "type": "string", "direction": "string", "strength": "string",
    "confidence": "double", "signal_score": "double", "consistency": "double",
    "supporting_signals": "bigint", "time_window": "string", "latest_signal": "double",
    "signal_intensity": "double", "volatility": "double", "hashtag": "string",
    "momentum": "double", "signal_strength": "double", "average_confidence": "double",
    "risk_level": "string", "risk_score": "double", "risk_factors": "array<string>",
    "overall_score": "double", "status": "string", "description": "string",
}


def overall_metrics(signals: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """One row over the high-confidence signals, with the total count beside it."""
    good = F.col("signal_confidence") >= params.min_confidence
    strength = F.when(good, F.col("signal_strength"))
    totals = signals.agg(
        F.count("*").alias("total"),
        F.count_if(good).alias("n"),
        F.avg(strength).alias("mean"),
        F.stddev_samp(strength).alias("std"),
        F.avg(F.when(good, F.col("signal_confidence"))).alias("confidence"),
        F.count_if(strength > 0).alias("positive"),
        F.count_if(strength < 0).alias("negative"),
    )
    return totals.withColumn(
        "consistency", consistency(F.col("positive"), F.col("negative"), F.col("n"))
    )


def _metrics_from_rollup(rollup: DataFrame) -> DataFrame:
    """The same row from the rollup, which holds one row of each kind used here."""

    def of(kind: str, name: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(name)))

    row = rollup.filter(F.col("kind").isin("all", "confident")).agg(
        F.coalesce(of("all", "n"), F.lit(0)).alias("total"),
        F.coalesce(of("confident", "n"), F.lit(0)).alias("n"),
        of("confident", "signal_strength_mean").alias("mean"),
        of("confident", "signal_strength_std").alias("std"),
        of("confident", "signal_confidence_mean").alias("confidence"),
        F.coalesce(of("confident", "positive"), F.lit(0)).alias("positive"),
        F.coalesce(of("confident", "negative"), F.lit(0)).alias("negative"),
    )
    return row.withColumn(
        "consistency", consistency(F.col("positive"), F.col("negative"), F.col("n"))
    )


def _enough(metrics: DataFrame, params: Params) -> DataFrame:
    return metrics.filter(F.col("n") >= params.min_support)


def _volume_score() -> Column:
    return F.least(F.lit(1.0), F.col("n") / FULL_VOLUME)


def _direction(metrics: DataFrame) -> DataFrame:
    mean = F.col("mean")
    strength = F.lit("neutral")
    for bound, name in reversed(STRENGTH_CLASSES):
        strength = F.when(F.abs(mean) >= bound, name).otherwise(strength)
    direction = F.when(mean > 0, "bullish").when(mean < 0, "bearish").otherwise("neutral")
    certainty = (
        F.col("confidence") * 0.4 + F.col("consistency") * 0.3 + _volume_score() * 0.3
    )
    text = F.format_string(
        const.DIRECTION_SENTENCE,
        F.initcap("strength"), F.col("direction"),
        round_half_even(F.col("raw_consistency") * 100, 1), F.col("n"),
    )
    shaped = metrics.select(
        F.lit("market_direction").alias("type"),
        direction.alias("direction"),
        strength.alias("strength"),
        round_half_even(certainty, 3).alias("confidence"),
        round_half_even(mean, 3).alias("signal_score"),
        round_half_even(F.col("consistency"), 3).alias("consistency"),
        F.col("n").alias("supporting_signals"),
        F.col("consistency").alias("raw_consistency"),
        "n",
    )
    return shaped.withColumn("description", text).drop("raw_consistency", "n")


def market_direction(signals: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return _direction(_enough(overall_metrics(signals, params), params))


def _risk(metrics: DataFrame) -> DataFrame:
    # --- fixed values: risk factors in the order in which they are added ---------
    factors = [
        (F.col("std") > 0.5, 0.2, "High signal volatility detected"),
        (F.col("consistency") < 0.6, 0.2, "Low sentiment consistency"),
        (F.col("n") < 10, 0.1, "Low signal volume"),
        (F.col("confidence") < 0.7, 0.15, "Below average signal confidence"),
    ]
    score = F.lit(BASE_RISK)
    for present, weight, _ in factors:
        score = F.when(present, score + weight).otherwise(score)
    names = F.filter(
        F.array(*[F.when(present, name) for present, _, name in factors]),
        lambda name: name.isNotNull(),
    )
    level = F.lit("low")
    for bound, name in reversed(RISK_LEVELS):
        level = F.when(F.col("raw") >= bound, name).otherwise(level)
    text = F.format_string(
        const.RISK_SENTENCE, F.upper("risk_level"), round_half_even(F.col("raw"), 2)
    )
    return (
        metrics.select(score.alias("raw"), names.alias("risk_factors"))
        .withColumn("risk_level", level)
        .select(
            "risk_level",
            round_half_even(F.col("raw"), 3).alias("risk_score"),
            "risk_factors",
            text.alias("description"),
        )
    )


def assess_risk(signals: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Risk level, score and the factors that raised it; no row without signals."""
    return _risk(overall_metrics(signals, params).filter(F.col("n") > 0))


def _score(metrics: DataFrame) -> DataFrame:
    score = (
        F.abs("mean") * 0.3
        + F.col("consistency") * 0.25
        + F.col("confidence") * 0.25
        + _volume_score() * 0.2
    )
    return metrics.select(round_half_even(score, 3).alias("overall_score"))


def overall_score(signals: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return _score(_enough(overall_metrics(signals, params), params))


def _status(metrics: DataFrame, params: Params) -> DataFrame:
    status = (
        F.when(F.col("total") == 0, "no_data")
        .when(F.col("n") < params.min_support, "insufficient_data")
        .otherwise("success")
    )
    return metrics.select(
        status.alias("status"),
        F.col("total").alias("total_signals_analyzed"),
        F.col("n").alias("high_confidence_signals"),
    )


def recommendation_status(signals: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return _status(overall_metrics(signals, params), params)


def time_recommendation(windows: DataFrame) -> DataFrame:
    """The latest window of each size, from ``multi_window_rollup``."""
    latest = windows.groupBy("window_size").agg(
        F.max_by(
            F.struct(
                "signal_strength_mean", "signal_intensity", "signal_strength_count",
                "direction_consistency", "signal_volatility",
            ),
            "time_window",
        ).alias("w")
    )
    mean, n = F.col("w.signal_strength_mean"), F.col("w.signal_strength_count")
    mood = F.when(mean > 0, "Bullish").otherwise("Bearish")
    return latest.select(
        F.concat(F.lit("time_based_"), "window_size").alias("type"),
        F.col("window_size").alias("time_window"),
        round_half_even(mean, 3).alias("latest_signal"),
        round_half_even(F.col("w.signal_intensity"), 3).alias("signal_intensity"),
        n.alias("supporting_signals"),
        round_half_even(F.col("w.direction_consistency"), 3).alias("consistency"),
        round_half_even(F.col("w.signal_volatility"), 3).alias("volatility"),
        F.format_string(
            const.TIME_SENTENCE, F.col("window_size"), mood, n
        ).alias("description"),
    )


def hashtag_recommendation(by_hashtag: DataFrame, top: int = 3) -> DataFrame:
    """The tags with the highest momentum, from ``aggregate_by_hashtag``."""
    best = by_hashtag.orderBy(F.desc("hashtag_momentum"), "hashtag").limit(top)
    return best.select(
        F.lit("hashtag_momentum").alias("type"),
        "hashtag",
        round_half_even(F.col("hashtag_momentum"), 3).alias("momentum"),
        round_half_even(F.col("signal_strength_mean"), 3).alias("signal_strength"),
        F.col("signal_strength_count").alias("supporting_signals"),
        round_half_even(F.col("signal_confidence_mean"), 3).alias("average_confidence"),
        F.format_string(
            const.HASHTAG_SENTENCE,
            F.col("hashtag"), F.col("signal_strength_count"),
        ).alias("description"),
    )


def _conform(part: DataFrame, seq: Column) -> DataFrame:
    """A part of the result, brought to the common columns."""
    numbered = part.withColumn("seq", seq)
    return numbered.select(
        *[
            (F.col(c) if c in numbered.columns else F.lit(None)).cast(t).alias(c)
            for c, t in RESULT_COLUMNS.items()
        ]
    )


def rollup_windows(rollup: DataFrame, sizes: Sequence[str], params: Params) -> DataFrame:
    from tickerlark.operators import aggregate as ag

    rows = rollup.filter(F.col("kind").isin(*sizes)).withColumn("window_size", F.col("kind"))
    kept = ag.having_min_support(ag._rounded(rows), params)
    return ag.signal_volatility(ag.signal_intensity(kept))


def rollup_hashtags(rollup: DataFrame, params: Params) -> DataFrame:
    from tickerlark.operators import aggregate as ag

    rows = rollup.filter(F.col("kind") == "hashtag").withColumn("hashtag", F.col("key"))
    return ag.hashtag_momentum(ag.having_min_support(ag._rounded(rows), params))


def recommendations(
    signals: DataFrame, windows: Sequence[str] = ("15min", "1hour"), params: Params = DEFAULTS
) -> DataFrame:
    """Direction, time, hashtag, risk, score and status rows in one table.

    The signals are read once: their rollup is stored and every row is derived from it.
    """
    rollup = materialise(signal_rollup(signals, windows, params))
    metrics = _metrics_from_rollup(rollup)
    enough = _enough(metrics, params)
    guard = enough.select(F.count("*").alias("k")).scalar()
    times = time_recommendation(rollup_windows(rollup, windows, params)).filter(guard > 0)
    tags = hashtag_recommendation(rollup_hashtags(rollup, params)).filter(guard > 0)
    window_rank = F.array_position(
        F.array(*[F.lit(w) for w in windows]), F.col("time_window")
    ).cast("int")
    rank = F.array_position(
        tags.select(
            F.array_sort(
                F.collect_list(F.struct((-F.col("momentum")).alias("m"), "hashtag"))
            ).alias("ranked")
        ).select(F.transform("ranked", lambda r: r["hashtag"])).scalar(),
        F.col("hashtag"),
    ).cast("int")
    n = len(windows)
    parts = [
        _conform(_direction(enough), F.lit(1)),
        _conform(times, window_rank + 1),
        _conform(tags, rank + 1 + n),
        _conform(_risk(enough).withColumn("type", F.lit("risk_assessment")), F.lit(n + 5)),
        _conform(_score(enough).withColumn("type", F.lit("overall_score")), F.lit(n + 6)),
        _conform(_status(metrics, params).withColumn("type", F.lit("status")), F.lit(n + 7)),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def analysis_summary(signals: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """The facts of the report as (section, metric, value) rows, from one stored row of sums."""
    good = F.col("signal_confidence") >= params.min_confidence
    strength = F.when(good, F.col("signal_strength"))
    sums = signals.agg(
        F.count("*").alias("total"),
        F.count_if(good).alias("n"),
        F.avg("signal_strength").alias("all_mean"),
        F.avg("signal_confidence").alias("all_confidence"),
        F.avg(strength).alias("mean"),
        F.stddev_samp(strength).alias("std"),
        F.avg(F.when(good, F.col("signal_confidence"))).alias("confidence"),
        F.count_if(strength > 0).alias("positive"),
        F.count_if(strength < 0).alias("negative"),
    ).withColumn("consistency", consistency(F.col("positive"), F.col("negative"), F.col("n")))
    base = materialise(sums)
    summary = base.select(
        F.inline(
            _facts(
                ("summary", "total_signals", F.col("total").cast("string")),
                ("summary", "high_confidence_signals", F.col("n").cast("string")),
                ("summary", "average_signal_strength", _shown(F.col("all_mean"))),
                ("summary", "average_confidence", _shown(F.col("all_confidence"))),
            )
        )
    )
    enough = _enough(base, params)
    direction = _direction(enough).select(
        F.inline(
            _facts(
                ("direction", "description", F.col("description")),
                ("direction", "confidence", _shown(F.col("confidence"))),
            )
        )
    )
    risk = _risk(enough).select(
        F.inline(
            _facts(
                ("risk", "level", F.upper("risk_level")),
                ("risk", "score", _shown(F.col("risk_score"))),
                ("risk", "factors", F.array_join("risk_factors", "; ")),
            )
        )
    )
    score = _score(enough).select(
        F.inline(_facts(("score", "overall_score", _shown(F.col("overall_score")))))
    )
    return summary.union(direction).union(risk).union(score)


def _facts(*facts: tuple[str, str, Column]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(s).alias("section"), F.lit(m).alias("metric"), v.alias("value"))
            for s, m, v in facts
        ]
    )


def _shown(c: Column) -> Column:
    return F.format_string("%.3f", round_half_even(F.coalesce(c, F.lit(0.0)), 3))
