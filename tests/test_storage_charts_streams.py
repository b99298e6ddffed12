"""Storage, charts, rolling measures, streams, and plan checks."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tickerlark.operators import charts, clean, rolling, signals
from tickerlark.operators.aggregate import aggregate_by_time
from tickerlark.operators.features import extract_features
from tickerlark.operators.indexing import with_row_index
from tickerlark.plans import queries as q
from tickerlark.session import materialise, scratch_path
from tickerlark.sources import pages, storage
from tickerlark.sources.posts import posts
from tickerlark.streaming import streams

REF = q.REF_TS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_are_pruned(spark, small):
    base = scratch_path(spark, "test")
    storage.save_posts(posts(spark, small), base, collected_at=REF)
    stored = storage.scan_posts(spark, base)
    cut = storage.filter_date_range(stored, "2024-01-05", "2024-01-06 12:00:00")
    assert "PartitionFilters: [isnotnull(" in plan(cut) and "make_date" in plan(cut)
    profile = storage.partition_profile(stored)
    assert profile.agg(F.sum("rows")).first()[0] == posts(spark, small).count()
    assert storage.expired_partitions(stored, REF).count() == 23


def test_a_broken_file_is_skipped_and_listed(spark):
    base = scratch_path(spark, "broken")
    rows = spark.range(40).select(F.concat(F.lit("p"), "id").alias("id"), F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id % 4 as int))").alias("post_ts"))
    storage.write_posts_partitioned(rows, base)
    empty = f"{base}/year=2024/month=1/day=9"
    rows.limit(0).coalesce(1).write.parquet(empty)
    with open(f"{base}/year=2024/month=1/day=2/zz+ %1.parquet", "wb") as f:
        f.write(b"PAR1 no footer")
    schema = "id string, post_ts timestamp, year int, month int, day int"
    with pytest.raises(Exception):
        storage.scan_posts(spark, base, schema).collect()
    tolerant = storage.scan_posts(spark, base, schema, skip_corrupt=True)
    assert tolerant.count() == 40
    assert "PartitionFilters: [isnotnull(" in plan(storage.filter_date_range(tolerant, "2024-01-02", "2024-01-02"))
    skipped = {r["path"].rsplit("/", 1)[1]: r["reason"].split(":")[0] for r in storage.skipped_files(spark, base, schema).collect()}
    assert skipped.pop("zz+ %1.parquet") == "corrupt" and set(skipped.values()) == {"empty"}
    with pytest.raises(ValueError):
        storage.skipped_files(spark, base, schema, most=0)


def test_profile_of_a_range_from_sketches(spark):
    rows = spark.range(20_000).selectExpr("timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id % 10 as int)) AS post_ts", "id % 7000 AS a", "'x' AS b")
    sketches = materialise(storage.date_sketches(rows, ["a", "b"]))
    assert sketches.count() == 10
    got = {r["column"]: r for r in storage.range_profile(sketches, ["a", "b"], "2024-01-02", "2024-01-05").collect()}
    want = rows.filter("post_ts BETWEEN '2024-01-02' AND '2024-01-05 23:00:00'").agg(F.countDistinct("a")).first()[0]
    assert got["a"]["rows"] == 8000 and got["b"]["distinct"] == 1
    assert abs(got["a"]["distinct"] / want - 1) < 0.05
    none = storage.range_profile(sketches, ["a"], "2030-01-01", "2030-01-02").first()
    assert (none["rows"], none["distinct"], none["ratio"]) == (0, 0, 0.0)


def test_scatter_sample_does_not_depend_on_partitions(spark):
    rows = spark.range(500).selectExpr("cast(id as string) AS id", "0.1 AS signal_confidence", "0.2 AS signal_strength", "0.3 AS sentiment_score", "if(id % 5 = 0, 'BUY', 'HOLD') AS signal_category")
    one, many = (charts.confidence_scatter(rows.repartition(n), per_category=20).collect() for n in (1, 7))
    assert sorted(r["id"] for r in one) == sorted(r["id"] for r in many) and len(one) == 40


def test_outputs(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        storage.save_output({"a": 1}, "/nowhere")
    path = storage.save_output(df, scratch_path(spark, "out"), "json")
    assert spark.read.json(path).count() == 3


def test_pages(spark):
    html = """<html><head><title>T &amp; U</title><script>var x="<a href=1>"</script></head><body>
    <article><b>Bold<br>text <a href="/x">link</a></article>
    <div><span data-testid="User-Name">@ann</span><div data-testid="tweetText">Buy #Gold now https://t.co/a1</div>
    <time datetime="2024-01-02T03:04:05">x</time><i data-testid="like">12</i><i data-testid="reply">n/a</i></div>
    <div><a class="username">bob</a><div class="tweet-text">hello @ann</div><time>2h</time></div>
    <div><span data-testid="User-Name">nobody</span></div></body></html>"""
    df = spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string")
    article = pages.page_articles(df).first()
    assert (article["title"], article["content"], article["links"]) == ("T & U", "Boldtext link", 1)
    ann, bob = sorted(pages.pages_to_posts(df, REF).collect(), key=lambda r: r["username"])
    assert (ann["username"], ann["content"], ann["likes_count"], ann["replies_count"]) == ("ann", "Buy #Gold now", 12, 0)
    assert ann["post_ts"] == dt.datetime(2024, 1, 2, 3, 4, 5) and ann["hashtags"] == ["#gold"]
    assert bob["post_ts"] == dt.datetime(2024, 1, 30, 22) and bob["mentions"] == ["@ann"]


def test_row_index_and_trend(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(50), i, rng.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "signal_timestamp int, id int, signal_strength double").repartition(7)
    got = [r["id"] for r in with_row_index(df, ["signal_timestamp", "id"]).orderBy("row_index").collect()]
    assert got == [i for _, i, _ in sorted(rows)]
    y = [v for _, _, v in sorted(rows)]
    n, mx, my = len(y), (len(y) - 1) / 2, sum(y) / len(y)
    slope = sum((i - mx) * (v - my) for i, v in enumerate(y)) / sum((i - mx) ** 2 for i in range(n))
    fitted = charts.trend_line(df).first()
    assert fitted["slope"] == pytest.approx(slope) and fitted["intercept"] == pytest.approx(my - slope * mx)


def test_timeline_and_histogram(spark):
    rows = [(i, float(i), 0.5, 0.0) for i in range(20)]
    df = spark.createDataFrame(rows, "t int, signal_strength double, signal_confidence double, sentiment_score double")
    df = df.withColumn("signal_timestamp", F.timestamp_seconds(F.col("t") * 60))
    assert charts.timeline_downsample(df, "raw").count() == 20
    assert charts.timeline_downsample(df).count() == 4
    bins = charts.histogram(df, "signal_strength", 4).orderBy("bin").collect()
    assert [b["frequency"] for b in bins] == [5, 5, 5, 5] and bins[3]["bin_end"] == 19.0
    flat = charts.histogram(df, "signal_confidence", 2).orderBy("bin").collect()
    assert [b["frequency"] for b in flat] == [0, 20] and flat[0]["bin_start"] == 0.0


@pytest.mark.parametrize("slice_rows", [10, 120, 10_000])
def test_rolling_over_slices(spark, slice_rows):
    rng = random.Random(2)
    rows = [(rng.choice("aab"), i, rng.random() < 0.8, rng.random()) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, ts int, ok boolean, took double")
    out = rolling.rolling_success_rate(df, "k", F.col("ok"), F.col("took"), ["ts"], slice_rows).collect()
    by_key = {k: [r for r in rows if r[0] == k] for k in "ab"}
    want = {}
    for mine in by_key.values():
        for i, r in enumerate(mine):
            w, v = mine[max(0, i - 99): i + 1], mine[max(0, i - 49): i + 1]
            want[r[1]] = (len(w), sum(x[2] for x in w) / len(w), sum(x[3] for x in v) / len(v))
    assert len(out) == 900
    for r in out:
        assert (r["samples"], r["success_rate"], r["mean_response"]) == pytest.approx(want[r["ts"]])


def test_trailing_count_over_slices(spark):
    rng = random.Random(3)
    times = sorted(rng.sample(range(5000), 400))
    df = spark.createDataFrame([("k", t) for t in times], "k string, t int").withColumn("ts", F.timestamp_seconds("t"))
    out = rolling.trailing_request_count(df, "k", seconds=60, limit=5, slice_seconds=100).collect()
    got = {r["t"]: (r["trailing_requests"], r["over_limit"]) for r in out}
    want = {t: (n := sum(t - 60 <= u <= t for u in times), n - 1 >= 5) for t in times}
    assert got == want and len(out) == 400


def test_trailing_count_looks_back_over_many_slices(spark):
    df = spark.range(200).select(F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    for slice_seconds in (600, None):
        out = rolling.trailing_request_count(df, "k", seconds=3600, slice_seconds=slice_seconds)
        assert out.count() == 200 and out.agg(F.max("trailing_requests")).first()[0] == 61


def test_hashtag_search_is_pruned(spark, small):
    text = plan(q.REGISTRY["search_by_hashtag"](spark, small))
    assert "PartitionFilters: []" not in text


def test_text_is_cleaned_once(spark, small):
    text = plan(q.REGISTRY["clean_posts"](spark, small))
    assert text.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in text


def test_no_joins_for_batch_statistics(spark, small):
    text = plan(q.REGISTRY["generate_signals"](spark, small))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Subquery" in text


def test_stream_equals_batch_and_drops_late_rows(spark, small):
    raw = posts(spark, small)
    features = materialise(extract_features(clean.clean_posts(raw, REF)))
    stats = signals.batch_stats(features)
    rows = sorted(raw.collect(), key=lambda r: r["post_ts"])
    late = rows[0].asDict() | {"id": "late", "post_ts": dt.datetime(2023, 12, 1)}
    sentinel = rows[0].asDict() | {"id": "end", "post_ts": dt.datetime(2024, 3, 1)}
    base = scratch_path(spark, "in")
    third = len(rows) // 3
    parts = [rows[:third], rows[third: 2 * third], rows[2 * third:], [late], [sentinel]]
    for number, part in enumerate(parts):
        batch = spark.createDataFrame([tuple(r.values()) if isinstance(r, dict) else tuple(r) for r in part], raw.schema)
        batch.coalesce(1).write.parquet(f"{base}/part={number}")
    reader = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1)
    stream = reader.parquet(base).drop("part")
    scored = streams.stream_signals(clean.clean_posts(stream, REF), stats)
    path = scratch_path(spark, "windows")
    windows = streams.stream_time_agg(scored, "15min", ref_ts=REF)
    streams.run_to_end(streams.stream_feed(windows, path, scratch_path(spark, "state"), None))
    got = spark.read.parquet(path).filter("time_window < '2024-02-01'").drop("aggregation_timestamp")
    want = aggregate_by_time(signals.generate_signals(features, stats), "15min", REF).drop("aggregation_timestamp")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_statistics_refreshed_by_batches(spark):
    rng = random.Random(2)
    names = [*signals._TERMS]
    rows = [tuple(rng.choice([None, rng.gauss(5, 2)]) for _ in names) for _ in range(60)]
    schema = ", ".join(f"{n} double" for n in names)
    base, src = scratch_path(spark, "moments"), scratch_path(spark, "moments-in")
    for i, part in enumerate((rows[:1], rows[1:40], rows[40:])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{src}/p={i}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src).drop("p")
    writer = streams.write_refreshed_stats(stream, base, scratch_path(spark, "s3")).trigger(availableNow=True)
    streams.run_to_end(writer)
    want = signals.batch_stats(spark.createDataFrame(rows, schema)).first().asDict()
    assert streams.latest_stats(spark, base).first().asDict() == pytest.approx(want, rel=1e-12)
    # The last batch once more: the same row.
    before, again = (spark.read.parquet(f"{base}/batch={k}") for k in (1, 2))
    own = signals.feature_moments(spark.createDataFrame(rows[40:], schema))
    assert signals.merged_moments(own.unionByName(before)).first().asDict() == pytest.approx(again.first().asDict(), rel=1e-12)
    nothing = signals.feature_moments(spark.createDataFrame([], schema))
    both = signals.merged_moments(nothing.unionByName(nothing))
    assert both.first()["n"] == 0 and signals.stats_of_moments(both).first()["composite_std"] == 0.0


def test_stream_dedup_and_latest_points(spark, small):
    # The first of a text arrives after a later copy; the last row lets the watermark pass all others.
    rows = [("b", 60, "same"), ("c", 90, "other"), ("a", 0, "same"), ("a2", 0, "same")]
    rows += [("e", 3000, "third"), ("f", 3500, "fourth"), ("d", 4000, "same"), ("z", 99_000, "last")]
    base = scratch_path(spark, "dedup-in")
    for i, (key, t, text) in enumerate(rows):
        row = [(key, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=t), text)]
        spark.createDataFrame(row, "id string, post_ts timestamp, content string").coalesce(1).write.parquet(f"{base}/p={i}")
    schema = "id string, post_ts timestamp, content string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(base)
    path = scratch_path(spark, "dedup-out")
    streams.run_to_end(streams.stream_feed(streams.stream_dedup(stream), path, scratch_path(spark, "s"), None))
    got = sorted((r["id"], r["copies"]) for r in spark.read.parquet(path).collect())
    assert got == [("a", 3), ("c", 1), ("d", 1), ("e", 1), ("f", 1)]
    batch = streams.stream_dedup(spark.read.schema(schema).parquet(base).drop("p")).collect()
    assert sorted((r["id"], r["copies"]) for r in batch) == [*got, ("z", 1)]

    name = uuid.uuid4().hex
    points = "id string, signal_timestamp timestamp, signal_strength double, sentiment_score double, retweets_count long, likes_count long"
    src = scratch_path(spark, f"points-{name}")
    for i in range(3):
        part = [(f"{i}{j}", dt.datetime(2024, 1, 1, i, j), 0.1, 0.2, i, j) for j in range(4)]
        spark.createDataFrame(part, points).coalesce(1).write.parquet(f"{src}/p={i}")
    signal_stream = spark.readStream.schema(points).option("maxFilesPerTrigger", 1).parquet(src)
    out = scratch_path(spark, "latest")
    writer = streams.write_latest_points(signal_stream, out, scratch_path(spark, "s2"), 5).trigger(availableNow=True)
    streams.run_to_end(writer)
    newest = spark.read.parquet(f"{out}/batch=2")
    assert sorted(r["id"] for r in newest.collect()) == ["13", "20", "21", "22", "23"]
