"""One registered query per operator, each over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlark.constants import COLLECTED_HASHTAGS
from tickerlark.functions import text as tx
from tickerlark.functions.numeric import tidy
from tickerlark.operators import aggregate as ag
from tickerlark.operators import charts, clean, dedup, recommend, rolling, signals, vectors
from tickerlark.operators import features as ft
from tickerlark.plans import flows
from tickerlark.session import materialise, scratch_path
from tickerlark.sources import pages as pg
from tickerlark.sources import storage
from tickerlark.sources.posts import posts, posts_from_events, spread, stream_events, table
from tickerlark.streaming import streams

REF_TS = "2024-01-31 00:00:00"
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# --- inputs -------------------------------------------------------------------


def _clean(spark, sf):
    return clean.clean_posts(posts(spark, sf), REF_TS)


def _features(spark, sf):
    return ft.extract_features(_clean(spark, sf))


def _stored_features(spark, sf):
    return materialise(_features(spark, sf))


def _signals(spark, sf):
    return signals.posts_to_signals(_clean(spark, sf))


def _stored(spark, sf):
    base = scratch_path(spark, "posts")
    storage.save_posts(posts(spark, sf), base, collected_at=REF_TS)
    return storage.scan_posts(spark, base)


def _texts(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def _digest(df: DataFrame, key: str, value) -> DataFrame:
    """Long texts are compared by their md5 and length."""
    return df.select(key, F.md5(value).alias("digest"), F.length(value).alias("chars"))


def _joined(name: str):
    return F.array_join(name, " ").alias(name)


# --- sources and sinks ----------------------------------------------------------


@query
def scan_posts(spark, sf):
    return _stored(spark, sf).select("id", "username", "post_ts", "content", "views_count", _joined("hashtags"))


@query
def scan_posts_tolerant(spark, sf):
    """Rows and skipped files by date of a table in which one file is broken."""
    base = storage.write_posts_partitioned(posts(spark, sf), scratch_path(spark, "posts"))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/year=2024/month=1/day=7/broken.parquet")
    broken = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    broken.writeBytes("no footer")
    broken.close()
    day = F.regexp_extract("path", "day=([0-9]+)", 1).cast("int")
    skipped = storage.skipped_files(spark, base).groupBy(day.alias("day")).agg(F.count("*").alias("skipped"))
    rows = storage.scan_posts(spark, base, skip_corrupt=True).groupBy("year", "month", "day").agg(F.count("*").alias("rows"))
    return rows.join(F.broadcast(skipped), "day", "left").fillna(0, ["skipped"]).select("year", "month", "day", "rows", "skipped")


@query
def filter_date_range(spark, sf):
    kept = storage.filter_date_range(_stored(spark, sf), "2024-01-05 06:00:00", "2024-01-12 18:00:00")
    return kept.select("id", "post_ts", "year", "month", "day")


@query
def filter_hashtags(spark, sf):
    return storage.filter_hashtags(posts(spark, sf), ["#NIFTY50", "#finnifty"]).select("id", _joined("hashtags"))


@query
def write_posts_partitioned(spark, sf):
    base = scratch_path(spark, "partitioned")
    storage.write_posts_partitioned(posts(spark, sf), base, files_per_day=2)
    stored = spark.read.parquet(base)
    return stored.select("id", "content", "likes_count", "year", "month", "day")


@query
def write_single(spark, sf):
    path = scratch_path(spark, "single")
    storage.write_single(ag.signal_summary(_signals(spark, sf)), path)
    return tidy(spark.read.parquet(path))


@query
def save_posts(spark, sf):
    return _stored(spark, sf).select("id", "collected_at", "data_version", "year", "month", "day")


@query
def save_processed(spark, sf):
    path = scratch_path(spark, "processed")
    storage.save_processed(_features(spark, sf), path, {"run": "nightly", "version": 3})
    return tidy(spark.read.parquet(path).select("id", "urgency_score", "meta_run", "meta_version"))


@query
def save_output_json(spark, sf):
    path = scratch_path(spark, "output")
    storage.save_output(charts.category_counts(_signals(spark, sf)), path, "json")
    schema = "signal_category string, frequency bigint, share double"
    return tidy(spark.read.schema(schema).json(path))


@query
def partition_profile(spark, sf):
    return storage.partition_profile(_stored(spark, sf)).select("year", "month", "day", "rows")


@query
def retention_filter(spark, sf):
    return storage.retention_filter(_stored(spark, sf), REF_TS, 7).select("id", "post_ts")


@query
def expired_partitions(spark, sf):
    return storage.expired_partitions(_stored(spark, sf), REF_TS, 7)


@query
def coerce_storage_types(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("event_id"),
        F.when(F.col("event_id") % 7 == 0, "not a time").otherwise(F.col("ts").cast("string")).alias("created_at"),
    )
    return storage.coerce_storage_types(events)


@query
def collect_union(spark, sf):
    raw = posts(spark, sf)
    parts = [
        storage.filter_hashtags(raw, [t]).select("id", "content", F.lit(t).alias("tag")) for t in COLLECTED_HASHTAGS
    ]
    return storage.collect_union(*parts)


@query
def search_by_hashtag(spark, sf):
    found = storage.search_by_hashtag(_stored(spark, sf), "#Sensex", REF_TS, hours_back=72, max_posts=100)
    return found.select("id", "post_ts", "content")


@query
def per_source_quota(spark, sf):
    return storage.per_source_quota(posts(spark, sf), target=400).select("id", "post_ts", "source_tag")


@query
def per_role_quota(spark, sf):
    turns = table(spark, sf, "conversations")
    picked = storage.per_source_quota(
        turns, ["user", "assistant"], target=100, source="role", order=("conv_id", "turn")
    )
    return picked.select("conv_id", "turn", "role", F.md5("text").alias("digest"))


@query
def page_articles(spark, sf):
    return pg.page_articles(spread(table(spark, sf, "pages"), "page_id"))


@query
def pages_to_posts(spark, sf):
    found = pg.pages_to_posts(spread(table(spark, sf, "pages"), "page_id"), REF_TS)
    return found.select("id", "username", "post_ts", "content", "url", *pg.ENGAGEMENT)


# --- cleaning -------------------------------------------------------------------


@query
def clean_posts(spark, sf):
    return _clean(spark, sf).select(
        "id", "username", "display_name", "post_ts", "content", "replies_count", "retweets_count",
        "likes_count", "views_count", _joined("hashtags"), _joined("mentions"), "url", "is_retweet",
        "language", "cleaned_at", "original_length", "cleaned_length",
    )


@query
def cleaning_stats(spark, sf):
    return tidy(clean.cleaning_stats(posts(spark, sf), REF_TS))


@query
def normalize_unicode(spark, sf):
    return posts(spark, sf).select("id", tx.normalize_unicode(F.col("content")).alias("content"))


@query
def collapse_whitespace(spark, sf):
    return _digest(_texts(spark, sf), "doc_id", tx.collapse_whitespace(F.col("text")))


@query
def remove_urls(spark, sf):
    return posts(spark, sf).select("id", tx.remove_urls(F.col("content")).alias("content"))


@query
def remove_mentions(spark, sf):
    return posts(spark, sf).select("id", tx.remove_mentions(F.col("content")).alias("content"))


@query
def remove_hashtags(spark, sf):
    return posts(spark, sf).select("id", tx.remove_hashtags(F.col("content")).alias("content"))


@query
def collapse_punctuation(spark, sf):
    return _digest(_texts(spark, sf), "doc_id", tx.collapse_punctuation(F.col("text")))


@query
def strip_special_chars(spark, sf):
    return _digest(_texts(spark, sf), "doc_id", tx.strip_special_chars(F.col("text")))


@query
def standardize_terms(spark, sf):
    return posts(spark, sf).select("id", tx.standardize_terms(F.col("content")).alias("content"))


@query
def min_length_filter(spark, sf):
    return clean.min_length_filter(posts(spark, sf), min_length=60).select("id", "content")


@query
def clean_username(spark, sf):
    given = F.concat(F.lit("@"), "username", F.lit(" !é"))
    return posts(spark, sf).select("id", tx.clean_username(given).alias("username"))


_RAW_TAGS = ["'#' || event_type", "upper(event_type)", "'#x'", "'##b c '", "'#U' || CAST(user_id AS VARCHAR(20))"]


@query
def normalize_hashtags(spark, sf):
    events = table(spark, sf, "events").selectExpr("event_id", f"array({', '.join(_RAW_TAGS)}) AS tags")
    return events.select("event_id", F.array_join(tx.normalize_hashtags(F.col("tags")), " ").alias("tags"))


@query
def normalize_mentions(spark, sf):
    events = table(spark, sf, "events").selectExpr("event_id", f"array({', '.join(_RAW_TAGS)}, '@!') AS names")
    return events.select("event_id", F.array_join(tx.normalize_mentions(F.col("names")), " ").alias("names"))


RAW_COUNT = """CASE event_id % 5 WHEN 0 THEN '-3' WHEN 1 THEN CAST(user_id AS VARCHAR(20)) || 'x'
    WHEN 2 THEN CAST(user_id AS VARCHAR(20)) || '.7' WHEN 3 THEN CAST(user_id AS VARCHAR(20)) ELSE NULL END"""


@query
def validate_engagement(spark, sf):
    events = table(spark, sf, "events").selectExpr("event_id", f"{RAW_COUNT} AS given")
    return events.select("event_id", tx.non_negative_count(F.col("given")).alias("likes_count"))


@query
def parse_timestamp(spark, sf):
    ts = F.col("ts").cast("timestamp")
    shapes = [
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.date_format(ts, "yyyy-MM-dd"),
        F.date_format(ts, "dd/MM/yyyy HH:mm:ss"), F.date_format(ts, "dd-MM-yyyy HH:mm:ss"),
    ]
    given = F.lit("no time")
    for i, shape in enumerate(shapes):
        given = F.when(F.col("event_id") % 7 == i, shape).otherwise(given)
    events = table(spark, sf, "events").select("event_id", given.alias("given"))
    return events.select(
        "event_id", tx.parse_timestamp(F.col("given"), F.lit(REF_TS).cast("timestamp")).alias("parsed")
    )


@query
def parse_relative_timestamp(spark, sf):
    shown = F.concat(F.col("user_id").cast("string"), F.substring(F.lit("smhd?"), (F.col("event_id") % 5 + 1).cast("int"), F.lit(1)))
    events = table(spark, sf, "events").select("event_id", shown.alias("shown"))
    now = F.lit(REF_TS).cast("timestamp")
    return events.select("event_id", tx.parse_relative_timestamp(F.col("shown"), now).alias("parsed"))


@query
def default_fields(spark, sf):
    holes = posts(spark, sf).withColumns(
        {
            "display_name": F.lit(None).cast("string"), "url": F.lit(None).cast("string"),
            "language": F.when(F.col("is_retweet"), "hi"), "is_retweet": F.when(F.col("is_retweet"), True),
        }
    )
    return clean.default_fields(holes).select("id", "display_name", "url", "is_retweet", "language")


@query
def extract_hashtags(spark, sf):
    tags = tx.extract_tags(F.col("content"), "#")
    return posts(spark, sf).select("id", F.array_join(tags, " ").alias("hashtags"))


@query
def extract_mentions(spark, sf):
    names = tx.extract_tags(F.col("content"), "@")
    return posts(spark, sf).select("id", F.array_join(names, " ").alias("mentions"))


@query
def extract_market_entities(spark, sf):
    found = clean.extract_market_entities(_clean(spark, sf))
    return found.select("id", *[F.array_join(f"entities.{n}", "|").alias(n) for n in tx.ENTITY_PATTERNS])


@query
def high_confidence_filter(spark, sf):
    return tidy(clean.high_confidence_filter(_signals(spark, sf)).select("id", "signal_confidence"))


# --- deduplication ----------------------------------------------------------------


@query
def comparison_text(spark, sf):
    return _digest(_texts(spark, sf), "doc_id", tx.comparison_text(F.col("text")))


@query
def content_hash(spark, sf):
    return dedup.content_hash(posts(spark, sf)).select("id", "content_hash")


@query
def user_content_hash(spark, sf):
    return dedup.user_content_hash(posts(spark, sf)).select("id", "user_content_hash")


@query
def dedup_exact(spark, sf):
    return dedup.dedup_exact(posts(spark, sf)).select("id", "post_ts", "content")


@query
def dedup_exact_documents(spark, sf):
    texts = _texts(spark, sf).withColumnRenamed("text", "content")
    return dedup.dedup_exact(texts, order=("doc_id",)).select("doc_id")


@query
def dedup_user_content(spark, sf):
    return dedup.dedup_user_content(posts(spark, sf)).select("id", "username", "content")


@query
def dedup_collect(spark, sf):
    return dedup.dedup_collect(posts(spark, sf)).select("id", "content")


@query
def pair_similarity(spark, sf):
    a = _texts(spark, sf).select(F.col("doc_id").alias("id_a"), F.col("text").alias("content_a"))
    b = _texts(spark, sf).select((F.col("doc_id") - 1).alias("id_a"), F.col("doc_id").alias("id_b"), F.col("text").alias("content_b"))
    return tidy(dedup.similar_texts(a.join(b, "id_a")).select("id_a", "id_b", "similarity"))


@query
def is_repost_pair(spark, sf):
    numbered = posts(spark, sf).select(F.substring("id", 2, 20).cast("bigint").alias("n"), "content")
    a = numbered.select(F.col("n").alias("id_a"), F.col("content").alias("content_a"))
    b = numbered.select((F.col("n") - 1).alias("id_a"), F.col("n").alias("id_b"), F.col("content").alias("content_b"))
    return dedup.is_repost_pair(a.join(b, "id_a")).select("id_a", "id_b", "is_repost_pair")


@query
def near_duplicate_pairs(spark, sf):
    docs = _texts(spark, sf)
    return tidy(dedup.near_duplicate_pairs(docs, id_col="doc_id", content="text", order=("doc_id",), every_copy=True))


@query
def near_duplicates_between(spark, sf):
    docs = _texts(spark, sf).select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("content"))
    return tidy(dedup.near_duplicates_between(items, docs, 0.3))


@query
def near_duplicate_posts(spark, sf):
    return tidy(dedup.near_duplicate_pairs(posts(spark, sf)))


@query
def dedup_similarity(spark, sf):
    return dedup.dedup_similarity(posts(spark, sf)).select("id", "post_ts", "content")


@query
def dedup_temporal(spark, sf):
    return dedup.dedup_temporal(posts(spark, sf)).select("id", "post_ts", "content")


@query
def dedup_pipeline(spark, sf):
    return dedup.dedup_pipeline(posts(spark, sf)).select("id", "post_ts", "content")


@query
def dedup_stats(spark, sf):
    return tidy(dedup.dedup_stats(posts(spark, sf)))


@query
def dedup_pipeline_stats(spark, sf):
    return tidy(dedup.dedup_pipeline_stats(posts(spark, sf)))


# --- features ---------------------------------------------------------------------


@query
def market_sentiment(spark, sf):
    return tidy(ft.market_sentiment(_clean(spark, sf)).select("id", "market_sentiment"))


@query
def action_sentiment(spark, sf):
    return tidy(ft.action_sentiment(_clean(spark, sf)).select("id", "action_sentiment"))


@query
def price_sentiment(spark, sf):
    return tidy(ft.price_sentiment(_clean(spark, sf)).select("id", "price_sentiment"))


@query
def basic_sentiment(spark, sf):
    scored = ft.basic_sentiment(_clean(spark, sf))
    return tidy(scored.select("id", "basic_sentiment", "sentiment_confidence"))


@query
def basic_sentiment_from_table(spark, sf):
    rows = [(f"{w}", p, s) for w, p, s in LEXICON_TABLE]
    lexicon = spark.createDataFrame(rows, "term string, polarity double, subjectivity double")
    scored = ft.basic_sentiment(_clean(spark, sf), lexicon)
    return tidy(scored.select("id", "basic_sentiment", "sentiment_confidence"))


LEXICON_TABLE = [("the", 0.25, 0.5), ("near", -0.5, 0.25), ("desk", 1.0, 1.0), ("today", 0.75, 0.125)]


@query
def sentiment_score(spark, sf):
    return tidy(ft.sentiment_score(_clean(spark, sf)).select("id", "sentiment_score"))


@query
def text_stats(spark, sf):
    return ft.text_stats(_clean(spark, sf)).select(
        "id", "content_length", "word_count", "hashtag_count", "mention_count"
    )


@query
def text_stats_documents(spark, sf):
    none = F.lit(None).cast("array<string>")
    docs = _texts(spark, sf).select("doc_id", F.col("text").alias("content"), none.alias("hashtags"), none.alias("mentions"))
    return ft.text_stats(docs).select("doc_id", "content_length", "word_count", "hashtag_count")


@query
def has_price_mention(spark, sf):
    return ft.has_price_mention(_clean(spark, sf)).select("id", "has_price_mention")


@query
def has_target_hashtag(spark, sf):
    return ft.has_target_hashtag(_clean(spark, sf)).select("id", "has_target_hashtag")


@query
def urgency_score(spark, sf):
    return tidy(ft.urgency_score(posts(spark, sf)).select("id", "urgency_score"))


@query
def engagement_log(spark, sf):
    logs = ["replies_count_log", "retweets_count_log", "likes_count_log", "views_count_log"]
    return tidy(ft.engagement_log(posts(spark, sf)).select("id", *logs))


@query
def time_features(spark, sf):
    return ft.time_features(posts(spark, sf)).select("id", "hour", "day_of_week", "is_market_hours")


FEATURE_COLUMNS = [
    "sentiment_score", "sentiment_confidence", "basic_sentiment", "market_sentiment", "content_length",
    "word_count", "hashtag_count", "mention_count", "has_price_mention", "has_target_hashtag",
    "urgency_score", "replies_count_log", "retweets_count_log", "likes_count_log", "views_count_log",
    "hour", "day_of_week", "is_market_hours",
]


@query
def extract_features(spark, sf):
    return tidy(_features(spark, sf).select("id", *FEATURE_COLUMNS))


@query
def tfidf_vectors(spark, sf):
    return tidy(vectors.tfidf_vectors(_clean(spark, sf)))


@query
def count_vectors(spark, sf):
    docs = _texts(spark, sf).withColumnRenamed("text", "content")
    return vectors.count_vectors(docs, "doc_id")


@query
def reduce_dimensions(spark, sf):
    posts_ = _clean(spark, sf)
    reduced = vectors.reduce_dimensions(materialise(vectors.tfidf_vectors(posts_)), posts_.select("id"), k=10)
    return tidy(reduced.select("id", *[F.col("components")[i].alias(f"c{i}") for i in range(10)]))


# --- signals ------------------------------------------------------------------------


@query
def batch_stats(spark, sf):
    return tidy(signals.batch_stats(_features(spark, sf)))


@query
def volume_signal(spark, sf):
    return tidy(signals.volume_signal(_stored_features(spark, sf)).select("id", "volume_signal"))


@query
def composite_signal(spark, sf):
    return tidy(signals.composite_signal(_stored_features(spark, sf)).select("id", "composite_signal"))


@query
def signal_strength(spark, sf):
    return tidy(signals.signal_strength(_stored_features(spark, sf)).select("id", "signal_strength"))


@query
def signal_confidence(spark, sf):
    return tidy(signals.signal_confidence(_stored_features(spark, sf)).select("id", "signal_confidence"))


@query
def signal_category(spark, sf):
    strong = signals.signal_strength(_stored_features(spark, sf))
    return strong.select("id", signals.signal_category(F.col("signal_strength")).alias("signal_category"))


SIGNAL_COLUMNS = [
    "signal_strength", "signal_confidence", "signal_category", "high_confidence", "signal_timestamp", "signal_hour",
]


@query
def generate_signals(spark, sf):
    return tidy(_signals(spark, sf).select("id", *SIGNAL_COLUMNS))


@query
def posts_to_signals(spark, sf):
    scored = signals.posts_to_signals(posts(spark, sf))
    return tidy(scored.select("id", "sentiment_score", *SIGNAL_COLUMNS))


# --- aggregation ----------------------------------------------------------------------


@query
def aggregate_by_time(spark, sf):
    return tidy(ag.aggregate_by_time(_signals(spark, sf), "15min", REF_TS))


@query
def signal_intensity(spark, sf):
    return tidy(ag.aggregate_by_time(_signals(spark, sf), "30min", REF_TS).select("time_window", "signal_intensity"))


@query
def direction_consistency(spark, sf):
    return tidy(ag.aggregate_by_time(_signals(spark, sf), "1hour", REF_TS).select("time_window", "direction_consistency"))


@query
def signal_volatility(spark, sf):
    return tidy(ag.aggregate_by_time(_signals(spark, sf), "4hour", REF_TS).select("time_window", "signal_volatility"))


@query
def multi_window_rollup(spark, sf):
    return tidy(ag.multi_window_rollup(_signals(spark, sf), ref_ts=REF_TS))


@query
def explode_hashtags(spark, sf):
    return ag.explode_hashtags(posts(spark, sf)).select("id", "hashtag")


@query
def aggregate_by_hashtag(spark, sf):
    return tidy(ag.aggregate_by_hashtag(_signals(spark, sf)))


@query
def hashtag_momentum(spark, sf):
    return tidy(flows.hashtag_momentum(posts(spark, sf), REF_TS).select("hashtag", "signal_strength_count", "hashtag_momentum"))


@query
def having_min_support(spark, sf):
    counted = _signals(spark, sf).groupBy("username").agg(F.count("*").alias("signal_strength_count"))
    return ag.having_min_support(counted)


@query
def signal_summary(spark, sf):
    return tidy(ag.signal_summary(_signals(spark, sf)))


@query
def analysis_period(spark, sf):
    return tidy(ag.analysis_period(_signals(spark, sf)))


@query
def sentiment_consistency(spark, sf):
    return tidy(ag.sentiment_consistency(_signals(spark, sf)))


@query
def range_profile(spark, sf):
    columns = ["username", "content", "likes_count"]
    sketches = materialise(storage.date_sketches(posts(spark, sf), columns))
    return tidy(storage.range_profile(sketches, columns, "2024-01-05", "2024-01-12"))


@query
def distinct_ratio(spark, sf):
    return tidy(ag.distinct_ratio(posts(spark, sf), ["username", "content", "likes_count", "language"]))


# --- recommendations ---------------------------------------------------------------------


@query
def market_direction(spark, sf):
    return tidy(recommend.market_direction(_signals(spark, sf)))


@query
def time_recommendation(spark, sf):
    return tidy(recommend.time_recommendation(ag.multi_window_rollup(_signals(spark, sf), ref_ts=REF_TS)))


@query
def hashtag_recommendation(spark, sf):
    by_tag = ag.aggregate_by_hashtag(_signals(spark, sf), ordered=False)
    return tidy(recommend.hashtag_recommendation(by_tag))


@query
def assess_risk(spark, sf):
    risk = recommend.assess_risk(_signals(spark, sf))
    return tidy(risk.withColumn("risk_factors", F.array_join("risk_factors", "; ")))


@query
def overall_score(spark, sf):
    return tidy(recommend.overall_score(_signals(spark, sf)))


@query
def recommendation_status(spark, sf):
    return recommend.recommendation_status(_signals(spark, sf))


@query
def full_analysis(spark, sf):
    results = flows.analyse(posts(spark, sf), scratch_path(spark, "analysis"), REF_TS)
    return tidy(results["hashtags"].select("hashtag", "signal_strength_count", "hashtag_momentum"))


@query
def recommendations(spark, sf):
    result = recommend.recommendations(_signals(spark, sf))
    return tidy(result.withColumn("risk_factors", F.array_join("risk_factors", "; ")))


@query
def analysis_summary(spark, sf):
    return recommend.analysis_summary(_signals(spark, sf))


# --- charts -------------------------------------------------------------------------------


@query
def sort_by_time(spark, sf):
    return charts.sort_by_time(posts(spark, sf), "post_ts").select("id", "post_ts")


@query
def timeline_downsample(spark, sf):
    return tidy(charts.timeline_downsample(_signals(spark, sf)))


@query
def trend_line(spark, sf):
    fitted = charts.trend_line(_signals(spark, sf))
    return tidy(fitted.select("points", (F.col("slope") * 1e6).alias("slope_per_million"), "intercept"))


@query
def histogram(spark, sf):
    return tidy(charts.histogram(_signals(spark, sf), "signal_strength", 30))


@query
def category_counts(spark, sf):
    return tidy(charts.category_counts(_signals(spark, sf)))


@query
def confidence_scatter(spark, sf):
    return tidy(charts.confidence_scatter(_signals(spark, sf)))


@query
def confidence_scatter_sample(spark, sf):
    return tidy(charts.confidence_scatter(_signals(spark, sf), per_category=100))


@query
def top_hashtags(spark, sf):
    return tidy(charts.top_hashtags(ag.aggregate_by_hashtag(_signals(spark, sf), ordered=False)))


@query
def window_trend_series(spark, sf):
    return tidy(charts.window_trend_series(ag.multi_window_rollup(_signals(spark, sf), ref_ts=REF_TS)))


@query
def recommendation_type_counts(spark, sf):
    return charts.recommendation_type_counts(recommend.recommendations(_signals(spark, sf)))


@query
def limit_rows(spark, sf):
    return charts.limit_rows(posts(spark, sf), 50, "post_ts", "id").select("id", "post_ts")


# --- rolling ---------------------------------------------------------------------------------


@query
def trailing_request_count(spark, sf):
    log = table(spark, sf, "events").select("event_id", "event_type", "ts")
    counted = rolling.trailing_request_count(log, "event_type", seconds=3600, limit=5)
    return counted.select("event_id", "event_type", "trailing_requests", "over_limit")


def _rolling(spark, sf):
    log = table(spark, sf, "events")
    return rolling.rolling_success_rate(
        log, "user_id", F.col("event_type") != "error", F.col("value") / 20, slice_rows=1_000_000
    )


@query
def rolling_success_rate(spark, sf):
    return tidy(_rolling(spark, sf).drop("ts"))


@query
def throttle_advice(spark, sf):
    return rolling.throttle_advice(_rolling(spark, sf)).select("event_id", "samples", "advice", "advised_rate")


# --- streaming ---------------------------------------------------------------------------------


def _signal_stream(spark, sf, ends=False):
    stats = signals.batch_stats(_features(spark, sf))
    stream = clean.clean_posts(posts_from_events(stream_events(spark, sf, ends)), REF_TS)
    return streams.stream_signals(stream, stats)


def _landed(spark, stream):
    path = scratch_path(spark, "stream")
    streams.run_to_end(streams.stream_feed(stream, path, scratch_path(spark, "stream-state"), None))
    return spark.read.schema(stream.schema).parquet(path)


@query
def stream_time_agg(spark, sf):
    windows = streams.stream_time_agg(_signal_stream(spark, sf, True), "15min", ref_ts=REF_TS)
    last = table(spark, sf, "events").select(F.max("ts").alias("ts")).scalar()
    return tidy(_landed(spark, windows).filter(F.col("time_window") <= last))


@query
def stream_dedup(spark, sf):
    unique = streams.stream_dedup(posts_from_events(stream_events(spark, sf, True)))
    last = table(spark, sf, "events").select(F.max("ts").alias("ts")).scalar()
    landed = _landed(spark, unique).filter(F.col("post_ts") <= last)
    return landed.select("id", "post_ts", "content_hash", "copies")


@query
def stream_stats(spark, sf):
    """The statistics that a stream refreshes with each batch, after the last one."""
    features = ft.extract_features(clean.clean_posts(posts_from_events(stream_events(spark, sf)), REF_TS))
    base = scratch_path(spark, "moments")
    writer = streams.write_refreshed_stats(features, base, scratch_path(spark, "moments-state"))
    streams.run_to_end(writer.trigger(availableNow=True))
    return tidy(streams.latest_stats(spark, base))


@query
def latest_points(spark, sf):
    return tidy(streams.latest_points(_signals(spark, sf)))


@query
def stream_latest_points(spark, sf):
    base = scratch_path(spark, "points")
    writer = streams.write_latest_points(_signal_stream(spark, sf), base, scratch_path(spark, "points-state"))
    streams.run_to_end(writer.trigger(availableNow=True))
    stored = spark.read.parquet(base)
    newest = stored.select(F.max("batch").alias("b")).scalar()
    return tidy(stored.filter(F.col("batch") == newest).drop("batch"))


@query
def stream_signals(spark, sf):
    return tidy(_landed(spark, _signal_stream(spark, sf)).select("id", *SIGNAL_COLUMNS))


@query
def stream_feed(spark, sf):
    return _landed(spark, posts_from_events(stream_events(spark, sf))).select("id", "post_ts", "content")
