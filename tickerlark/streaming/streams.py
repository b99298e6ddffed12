"""Aggregation, deduplication and signals over streams of posts.

Sinks are files or ``foreachBatch``; no port is opened. State is bounded by the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickerlark.operators.aggregate import aggregate_by_time
from tickerlark.operators.dedup import content_hash
from tickerlark.operators.features import extract_features
from tickerlark.operators.signals import apply_signals, feature_moments, merged_moments, stats_of_moments
from tickerlark.params import DEFAULTS, Params
from tickerlark.session import delete, materialise

LATENESS = "10 minutes"


def stream_signals(posts: DataFrame, stats: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Signals of a stream, relative to the frozen statistics of an earlier batch.

    ``stats`` is the one-row result of ``batch_stats``; its values become constants of the
    query, so a running stream does not change its scale.
    """
    frozen = stats.first().asDict()
    constants = F.struct(*[F.lit(v).alias(k) for k, v in frozen.items()])
    return apply_signals(extract_features(posts, params).withColumn("_stats", constants), params)


def stream_time_agg(
    signals: DataFrame, window: str = "15min", lateness: str = LATENESS, ref_ts=None,
    params: Params = DEFAULTS,
) -> DataFrame:
    """Windows over a stream; rows behind the watermark are dropped."""
    marked = signals.withWatermark("signal_timestamp", lateness)
    return aggregate_by_time(marked, window, ref_ts, params)


def stream_dedup(posts: DataFrame, lateness: str = LATENESS, ts: str = "post_ts", order: str = "id") -> DataFrame:
    """The first row by (time, ``order``) of each text, with ``copies``, for each run of the text.

    A run ends where the text does not come again for ``lateness``. It is held until the
    watermark has passed that end, then its first row goes out and the state is dropped, so the
    order in which rows arrive makes no difference. On a batch the same expression gives the
    same rows.
    """
    hashed = content_hash(posts.withWatermark(ts, lateness))
    runs = hashed.groupBy(F.session_window(ts, lateness).alias("run"), "content_hash")
    first = F.min_by(F.struct(*posts.columns), F.struct(ts, order)).alias("first")
    return runs.agg(first, F.count("*").alias("copies")).select("first.*", "content_hash", "copies")


def latest_points(signals: DataFrame, n: int = DEFAULTS.max_points) -> DataFrame:
    """The latest ``n`` points of a table of signals: a top-k."""
    points = signals.select(
        "id",
        "signal_timestamp",
        "signal_strength",
        "sentiment_score",
        (F.col("retweets_count") + F.col("likes_count")).alias("volume"),
    )
    return points.orderBy(F.desc("signal_timestamp"), "id").limit(n)


def write_latest_points(
    signals: DataFrame, base: str, checkpoint: str, n: int = DEFAULTS.max_points
) -> DataStreamWriter:
    """Keep the latest ``n`` points of a stream: batch k writes ``base/batch=k`` from its rows
    and the points of the batch before, then removes that of the batch before the last.

    The batch before stays until the next has ended, so a batch that is run again finds it;
    ``run_to_end`` callers read the newest folder.
    """

    def merge(batch: DataFrame, number: int) -> None:
        current = latest_points(batch, n)
        if number > 0:
            previous = batch.sparkSession.read.parquet(f"{base}/batch={number - 1}")
            current = current.unionByName(previous)
        newest = current.orderBy(F.desc("signal_timestamp"), "id").limit(n)
        newest.write.mode("overwrite").parquet(f"{base}/batch={number}")
        if number > 1:
            delete(batch.sparkSession, f"{base}/batch={number - 2}")

    return signals.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def write_refreshed_stats(features: DataFrame, base: str, checkpoint: str) -> DataStreamWriter:
    """Keep the moments of all features of a stream so far: batch k merges its own with those of
    the batch before into ``base/batch=k``.

    One row is read and written for each batch. The batch before stays until the next has ended,
    so a batch that is run again gives the same row; see :func:`latest_stats`.
    """

    def merge(batch: DataFrame, number: int) -> None:
        moments = feature_moments(batch)
        if number > 0:
            before = batch.sparkSession.read.parquet(f"{base}/batch={number - 1}")
            moments = merged_moments(materialise(moments).unionByName(before))
        moments.write.mode("overwrite").parquet(f"{base}/batch={number}")
        if number > 1:
            delete(batch.sparkSession, f"{base}/batch={number - 2}")

    return features.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def latest_stats(spark: SparkSession, base: str, params: Params = DEFAULTS) -> DataFrame:
    """The statistics after the newest batch, for :func:`stream_signals` of a later query."""
    stored = spark.read.parquet(base)
    newest = stored.agg(F.max("batch").alias("b")).scalar()
    return stats_of_moments(stored.filter(F.col("batch") == newest).drop("batch"), params)


def stream_feed(
    df: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds"
) -> DataStreamWriter:
    """Append a stream to Parquet for a dashboard. Without ``every`` all available data is
    processed and the query ends."""
    writer = df.writeStream.format("parquet").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def run_to_end(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is available and wait for the end."""
    query = writer.start()
    query.awaitTermination()
    return query
