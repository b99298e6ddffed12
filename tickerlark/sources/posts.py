"""Posts derived from the event table; one list of expressions serves Spark and the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlark.functions import text as tx
from tickerlark.session import scratch_path

# Rows of a table that one task works on.
TASK_ROWS = 100_000

POST_EXPRESSIONS = {
    "id": "'p' || CAST(event_id AS VARCHAR(20))",
    "username": "'User_' || CAST(user_id AS VARCHAR(20))",
    "post_ts": "CAST(ts AS TIMESTAMP)",
    "content": """CASE CAST(floor(event_id / 3) AS BIGINT) % 8
         WHEN 0 THEN 'Buy the breakout in bank nifty now, up +' || CAST(user_id % 9 AS VARCHAR(20)) || '.5% &amp; rising #BankNifty @desk'
         WHEN 1 THEN 'RT @desk: sell the rally, weak close and loss ahead!!! #sensex'
         WHEN 2 THEN 'Support holds near rs. ' || CAST(user_id AS VARCHAR(20)) || ' for nifty 50 https://t.co/x' || CAST(event_id AS VARCHAR(20)) || ' #nifty50'
         WHEN 3 THEN 'तेजी on nse today, profit booked 📈 #intraday #nifty50'
         WHEN 4 THEN 'crash alert: -' || CAST(user_id % 15 AS VARCHAR(20)) || '% drop, urgent exit ' || event_type || ' #sensex'
         WHEN 5 THEN 'ok #a'
         WHEN 6 THEN 'Quiet session, traders hold and wait for ' || event_type || ' news from desk ' || CAST(user_id AS VARCHAR(20))
         ELSE event_type || ' volume growth looks good but resistance is near #FinNifty #banknifty'
       END""",
    "replies_count": "CAST(event_id % 51 AS BIGINT)",
    "retweets_count": "CAST(event_id % 101 AS BIGINT)",
    "likes_count": "CAST(floor(value) AS BIGINT)",
    "views_count": "CAST(event_id * 7 % 1000 AS BIGINT)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Times are compared in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts_from_events(events: DataFrame) -> DataFrame:
    """The event table (batch or stream) as raw posts."""
    raw = events.selectExpr(*[f"{sql} AS {name}" for name, sql in POST_EXPRESSIONS.items()])
    return raw.select(
        "id",
        "username",
        F.col("username").alias("display_name"),
        "post_ts",
        "content",
        "replies_count",
        "retweets_count",
        "likes_count",
        "views_count",
        tx.extract_tags(F.col("content"), "#").alias("hashtags"),
        tx.extract_tags(F.col("content"), "@").alias("mentions"),
        F.lit("").alias("url"),
        F.startswith("content", F.lit("RT @")).alias("is_retweet"),
        F.lit("en").alias("language"),
    )


def spread(df: DataFrame, *key: str, rows: int = TASK_ROWS) -> DataFrame:
    """Give every core a share of a table, and no task much more than ``rows`` rows.

    Text work is bound by CPU, not by the bytes of the splits: a compressed file makes few splits,
    and a split without a whole row group is empty. So rows are counted by split, which reads
    footers only; a table that is dealt well already is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    of_split = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count("*").alias("n"))
    most, total = of_split.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    tasks = max(cores, -(-total // rows))
    return df.repartition(tasks, *key) if most * tasks > 2 * total else df


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts_from_events(spread(table(spark, sf_dir, "events"), "event_id"))


def stream_events(spark: SparkSession, sf_dir: str, ends: bool = False) -> DataFrame:
    """The event table as a file stream of three micro-batches in order of time.

    With ``ends`` a fourth holds one event a day later, so that the watermark passes every
    window of the table.
    """
    events = table(spark, sf_dir, "events")
    base = scratch_path(spark, "event-stream")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    thirds = F.percentile_approx(at, F.array(F.lit(1 / 3), F.lit(2 / 3)))
    low, high = events.select(thirds).first()[0]
    # Each batch has the same number of files, so that none is taken with a later batch: rows go round,
    # and there are far fewer files than rows.
    total, cores = events.count(), spark.sparkContext.defaultParallelism
    files = max(1, min(max(cores, -(-total // (3 * TASK_ROWS))), total // 3000))
    for number, part in enumerate((at <= low, (at > low) & (at <= high), at > high)):
        events.filter(part).repartition(files).write.parquet(f"{base}/part={number}")
    if ends:
        last = events.agg(F.max("ts").alias("ts"), *[F.first(c).alias(c) for c in events.columns if c != "ts"])
        later = last.withColumns({"event_id": F.lit(0).cast("bigint"), "ts": F.expr("ts + INTERVAL 1 DAY")})
        later.select(*events.columns).write.parquet(f"{base}/part=3")
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files)
    return reader.parquet(base).drop("part")
