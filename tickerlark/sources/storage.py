"""Date-partitioned storage of posts: write, read, profile, retain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlark.constants import COLLECTED_HASHTAGS
from tickerlark.schema import STORED_SCHEMA, require

DATE_COLUMNS = ["year", "month", "day"]
TIME_COLUMNS = ["timestamp", "post_ts", "created_at", "collected_at"]
DATA_VERSION = "1.0"


def scan_posts(
    spark: SparkSession, base: str, schema: T.StructType = STORED_SCHEMA, skip_corrupt: bool = False
) -> DataFrame:
    """All posts below ``base``. The schema is given, so no file is opened to infer it.

    With ``skip_corrupt`` a file that cannot be read is passed over; :func:`skipped_files` lists
    those. Of a file that breaks off in the middle the row groups before that place are read.
    """
    reader = spark.read.schema(schema)
    return (reader.option("ignoreCorruptFiles", "true") if skip_corrupt else reader).parquet(base)


def skipped_files(
    spark: SparkSession, base: str, schema: T.StructType = STORED_SCHEMA, most: int = 1000
) -> DataFrame:
    """(path, bytes, reason) of the Parquet files below ``base`` that give no rows to a tolerant scan.

    The listing of the folder against the files that came back. Each of the rest, ``most`` at
    most, is opened by itself to tell one that is broken from one that is valid and empty; a
    table with more of them is an error rather than a report.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(base)
    listed = listed.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), F.col("length").alias("bytes"))
    read = scan_posts(spark, base, schema, True).select("_metadata.file_path").distinct()
    read = read.select(F.regexp_replace(F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B"))), "^file:/+", "/").alias("path"))
    missing = listed.join(read, "path", "left_anti").limit(most + 1).collect()
    if len(missing) > most:
        raise ValueError(f"more than {most} files below {base} cannot be read")
    rows = []
    for path, size in missing:
        try:
            spark.read.schema(schema).parquet(path).limit(1).collect()
            rows.append((path, size, "empty"))
        except Exception as error:  # noqa: BLE001 - whatever the reader says of a broken file is the reason
            rows.append((path, size, "corrupt: " + str(error).split("\n", 1)[0][:200]))
    return spark.createDataFrame(rows, "path string, bytes long, reason string")


def date_sketches(df: DataFrame, columns: Sequence[str], ts: str = "post_ts", lg_k: int = 12) -> DataFrame:
    """(year, month, day, rows, one sketch per column): the distinct values of each date, mergeable.

    To be stored beside the table. A sketch takes a few kilobytes, and an estimate from any
    number of them is off by about 1.04 / sqrt(2 ** lg_k) (1.6 % at 12) in two of three cases.
    """
    dated = with_partition_columns(require(df, ts, *columns), ts)
    own = [F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(c) for c in columns]
    return dated.groupBy(*DATE_COLUMNS).agg(F.count("*").alias("rows"), *own)


def range_profile(sketches: DataFrame, columns: Sequence[str], start, end) -> DataFrame:
    """(column, rows, distinct, ratio) of the dates from ``start`` to ``end``, from sketches alone."""
    date = _partition_date()
    own = sketches.filter(date.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    merged = own.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns]
    )
    each = [F.struct(F.lit(c).alias("column"), F.col("rows"), F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias("distinct")) for c in columns]
    listed = merged.select(F.inline(F.array(*each)))
    return listed.withColumn("ratio", F.when(F.col("rows") > 0, F.col("distinct") / F.col("rows")).otherwise(0.0))


def _partition_date() -> Column:
    return F.make_date("year", "month", "day")


def filter_date_range(df: DataFrame, start, end, ts: str = "post_ts") -> DataFrame:
    """Keep ``start <= ts <= end``.

    On a date-partitioned table the same range is stated on the partition columns too, so
    directories outside it are never listed or read.
    """
    require(df, ts)
    low, high = (F.lit(x).cast("timestamp") if not isinstance(x, Column) else x for x in (start, end))
    kept = df.filter(F.col(ts).between(low, high))
    if set(DATE_COLUMNS) <= set(df.columns):
        kept = kept.filter(_partition_date().between(F.to_date(low), F.to_date(high)))
    return kept


def filter_hashtags(df: DataFrame, hashtags: Sequence[str]) -> DataFrame:
    """Keep posts with any of the tags, ignoring case."""
    wanted = F.array(*[F.lit(t.lower()) for t in hashtags])
    return require(df, "hashtags").filter(
        F.arrays_overlap(F.transform("hashtags", F.lower), wanted)
    )


def coerce_storage_types(df: DataFrame) -> DataFrame:
    """Turn textual times into timestamps; what cannot be read becomes NULL."""
    textual = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    times = [c for c in TIME_COLUMNS if c in textual]
    return df.withColumns({c: F.try_to_timestamp(F.col(c)) for c in times})


def with_partition_columns(df: DataFrame, ts: str = "post_ts") -> DataFrame:
    parts = {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
    return df.withColumns(parts)


def write_posts_partitioned(
    df: DataFrame, base: str, ts: str = "post_ts", files_per_day: int | None = None,
    mode: str = "append",
) -> str:
    """Append to ``base/year=/month=/day=``.

    Rows are gathered by date and adaptive execution cuts large dates into several writers by
    their size. With ``files_per_day`` each date gets that many, by a hash of the whole row.
    """
    parts = with_partition_columns(require(df, ts), ts)
    if files_per_day is None:
        gathered = parts.hint("rebalance", *DATE_COLUMNS)
    else:
        spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_day))
        gathered = parts.repartition(*DATE_COLUMNS, spread)
    (
        gathered.write.mode(mode)
        .partitionBy(*DATE_COLUMNS)
        .option("compression", "snappy")
        .parquet(base)
    )
    return base


def write_single(df: DataFrame, path: str) -> str:
    """One file; only for small results such as a report."""
    df.coalesce(1).write.mode("errorifexists").option("compression", "snappy").parquet(path)
    return path


def save_posts(
    df: DataFrame, base: str, collected_at=None, partition_by_date: bool = True, **options
) -> str:
    """Stamp with the time of collection and the data version, then write: by date, or as
    plain files that adaptive execution sizes."""
    stamp = F.current_timestamp() if collected_at is None else F.lit(collected_at)
    stamped = coerce_storage_types(df).withColumns(
        {"collected_at": stamp.cast("timestamp"), "data_version": F.lit(DATA_VERSION)}
    )
    if partition_by_date and "post_ts" in stamped.columns:
        return write_posts_partitioned(stamped, base, **options)
    stamped.hint("rebalance").write.mode("errorifexists").parquet(base)
    return base


def save_processed(df: DataFrame, path: str, metadata: dict | None = None) -> str:
    """Write a result with its metadata as constant ``meta_*`` columns."""
    meta = {f"meta_{k}": F.lit(v) for k, v in (metadata or {}).items()}
    coerce_storage_types(df).withColumns(meta).write.parquet(path)
    return path


def save_output(data: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a final result as Parquet or as JSON lines."""
    if not isinstance(data, DataFrame) or fmt not in ("parquet", "json"):
        raise ValueError(f"cannot save {type(data).__name__} as {fmt!r}")
    data.write.format(fmt).save(path)
    return path


def partition_profile(stored: DataFrame) -> DataFrame:
    """Rows, files and megabytes per date of a table read from files."""
    per_file = (
        require(stored, *DATE_COLUMNS)
        .select(*DATE_COLUMNS, "_metadata.file_path", "_metadata.file_size")
        .groupBy(*DATE_COLUMNS, "file_path", "file_size")
        .agg(F.count("*").alias("rows"))
    )
    return per_file.groupBy(*DATE_COLUMNS).agg(
        F.sum("rows").alias("rows"),
        F.count("*").alias("files"),
        F.round(F.sum("file_size") / (1024 * 1024), 2).alias("megabytes"),
    )


def _cutoff(ref_ts, days: int) -> Column:
    return F.timestamp_add("DAY", F.lit(-days), F.lit(ref_ts).cast("timestamp"))


def retention_filter(df: DataFrame, ref_ts, days: int = 7, ts: str = "post_ts") -> DataFrame:
    """Rows not older than ``days`` before ``ref_ts``; prunes partitions like the date filter."""
    cutoff = _cutoff(ref_ts, days)
    kept = require(df, ts).filter(F.col(ts) >= cutoff)
    if set(DATE_COLUMNS) <= set(df.columns):
        kept = kept.filter(_partition_date() >= F.to_date(cutoff))
    return kept


def expired_partitions(stored: DataFrame, ref_ts, days: int = 7) -> DataFrame:
    """Dates that lie wholly before the cut-off. Nothing is deleted here."""
    dates = require(stored, *DATE_COLUMNS).select(*DATE_COLUMNS).distinct()
    return dates.filter(_partition_date() < F.to_date(_cutoff(ref_ts, days)))


def collect_union(*sources: DataFrame) -> DataFrame:
    """All rows of several sources, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def search_by_hashtag(
    df: DataFrame, hashtag: str, ref_ts, hours_back: int = 24, max_posts: int = 100
) -> DataFrame:
    """The newest posts with a tag in the last hours: a top-k, not a full sort."""
    now = F.lit(ref_ts).cast("timestamp")
    recent = filter_date_range(df, F.timestamp_add("HOUR", F.lit(-hours_back), now), now)
    found = filter_hashtags(recent, [hashtag])
    return found.orderBy(F.col("post_ts").desc(), "id").limit(max_posts)


def per_source_quota(
    df: DataFrame,
    sources: Sequence[str] = tuple(COLLECTED_HASHTAGS),
    target: int = 2000,
    source: str | None = None,
    order: Sequence[str] = ("post_ts", "id"),
    slices: int | None = None,
) -> DataFrame:
    """The newest ``target // len(sources)`` rows of each source, then at most ``target``.

    Without ``source`` the sources are hashtags and a post counts for each tag it carries.
    Each source is first cut to its quota within hash slices (as many as shuffle partitions,
    unless given), so even a source with most of the rows sends at most ``quota`` rows per slice
    to its final ranking.
    """
    from pyspark.sql import Window

    quota = target // len(sources)
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if source is None:
        wanted = F.array(*[F.lit(s) for s in sources])
        tags = F.array_intersect(F.transform("hashtags", F.lower), wanted)
        rows = df.withColumn("source_tag", F.explode(tags))
        source = "source_tag"
    else:
        rows = df.filter(F.col(source).isin(*sources))
    newest = [F.col(order[0]).desc(), *order[1:]]
    sliced = rows.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(slices)))
    for keys in ([source, "_slice"], [source]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
        sliced = sliced.withColumn("_rank", rank).filter(F.col("_rank") <= quota)
    return sliced.drop("_slice", "_rank").orderBy(source, *newest).limit(target)
