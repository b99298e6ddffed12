"""Rolling measures over a log of requests.

A plain window per key would sort a busy key in one task. Each key is cut into slices instead;
a slice also receives the few rows before its start that its first rows look back on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlark.functions.numeric import snap
from tickerlark.operators.indexing import with_row_index
from tickerlark.schema import require

# --- fixed values: limits of the request rate and its adjustment -------------
REQUESTS_PER_MINUTE = 60
RATE_STEP, RATE_CEILING, RATE_FLOOR = 5, 120, 20
SUCCESS_ROWS, RESPONSE_ROWS, MIN_SAMPLES = 100, 50, 10


def _with_lookback(df: DataFrame, position: Column, width: int, lookback: int) -> DataFrame:
    """Copy each row to its slice of ``width`` and, as context, to every later slice whose
    rows look back on it."""
    own = F.floor(position / width)
    reached = F.floor((position + lookback) / width)
    return df.withColumn("_own", own).withColumn("_slice", F.explode(F.sequence(own, reached)))


def trailing_request_count(
    log: DataFrame, key: str, ts: str = "ts", seconds: int = 60, limit: int = REQUESTS_PER_MINUTE,
    slice_seconds: int | None = None,
) -> DataFrame:
    """Requests of the same key in the last ``seconds``, the current one included, and whether
    the limit was already reached before it. A slice is ten look-backs long unless given."""
    slice_seconds = slice_seconds or 10 * seconds
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    at = require(log, key, ts).withColumn("_at", micros)
    span = seconds * 1_000_000
    sliced = _with_lookback(at, F.col("_at"), slice_seconds * 1_000_000, span)
    trailing = Window.partitionBy(key, "_slice").orderBy("_at").rangeBetween(-span, 0)
    counted = sliced.withColumn("trailing_requests", F.count("*").over(trailing))
    return (
        counted.filter(F.col("_slice") == F.col("_own"))
        .withColumn("over_limit", F.col("trailing_requests") - 1 >= limit)
        .drop("_at", "_own", "_slice")
    )


def rolling_success_rate(
    log: DataFrame, key: str, success: Column, response: Column,
    order: Sequence[str] = ("ts", "event_id"), slice_rows: int = 1_000_000,
) -> DataFrame:
    """Success share of the last 100 and mean response of the last 50 rows of each key."""
    rows = log.select(
        key, *order, success.cast("double").alias("_ok"), response.cast("double").alias("_took")
    )
    indexed = with_row_index(rows, [key, *order])
    # Rows of a key are consecutive in the index, so index slices cut a busy key into pieces.
    sliced = _with_lookback(indexed, F.col("row_index"), slice_rows, SUCCESS_ROWS - 1)
    ordered = Window.partitionBy(key, "_slice").orderBy("row_index")
    recent = ordered.rowsBetween(-(SUCCESS_ROWS - 1), 0)
    measured = sliced.withColumns(
        {
            "samples": F.count("_ok").over(recent),
            "success_rate": F.avg("_ok").over(recent),
            "mean_response": F.avg("_took").over(ordered.rowsBetween(-(RESPONSE_ROWS - 1), 0)),
        }
    )
    return measured.filter(F.col("_slice") == F.col("_own")).select(
        key, *order, "samples", "success_rate", "mean_response"
    )


def throttle_advice(rolling: DataFrame, current_rate: int = REQUESTS_PER_MINUTE) -> DataFrame:
    """Raise, lower or hold the request rate, row by row."""
    enough = F.col("samples") >= MIN_SAMPLES
    success, response = snap(F.col("success_rate")), snap(F.col("mean_response"))
    good = (success > 0.9) & (response < 2.0)
    poor = (success < 0.7) | (response > 5.0)
    advice = F.when(enough & good, "raise").when(enough & poor, "lower").otherwise("hold")
    raised = min(current_rate + RATE_STEP, RATE_CEILING)
    lowered = max(current_rate - RATE_STEP, RATE_FLOOR)
    rate = (
        F.when(F.col("advice") == "raise", raised)
        .when(F.col("advice") == "lower", lowered)
        .otherwise(current_rate)
    )
    return rolling.withColumn("advice", advice).withColumn("advised_rate", rate)
