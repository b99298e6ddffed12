"""What has to stay small as tables grow: blocks, tasks, plans and batches."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickerlark.operators import dedup, families
from tickerlark.operators import similarity as sm
from tickerlark.operators import vectors
from tickerlark.sources import pages as pg
from tickerlark.sources import posts as ps


def _index(spark, texts):
    rows = spark.createDataFrame([(f"u{i:04d}", t) for i, t in enumerate(texts)], "uid string, text string")
    return sm.SimilarityIndex.build(rows, "uid", "text")


def test_texts_that_differ_in_a_rare_word_leave_no_block(spark):
    texts = [f"quiet session traders hold wait click news desk {1000 + i // 2} {i % 2}" for i in range(600)]
    blocks = _index(spark, texts).blocks(0.85).filter("second <> ''")
    assert blocks.isEmpty()


def test_one_text_that_is_near_to_all_is_met_in_pairs_with_it(spark):
    texts = ["quiet session traders hold wait click news desk"]
    texts += [f"{texts[0]} {1000 + i // 2} {i % 2}" for i in range(500)]
    index = _index(spark, texts)
    blocks = index.blocks(0.85)
    assert blocks.agg(F.max("m")).first()[0] <= 2
    met = {(r["uid_a"], r["uid_b"]) for r in index.pairs(0.85, True, blocks).collect()}
    copies = {(f"u{i:04d}", f"u{i + 1:04d}") for i in range(1, 501, 2)}
    assert met == {("u0000", f"u{i:04d}") for i in range(1, 501)} | copies


def test_edges_are_made_once_for_both_directions(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(row):
        made.add(1)
        return row

    edges = spark.sparkContext.parallelize([("a", "b"), ("b", "c"), ("x", "y")], 2).map(counted).toDF("u string, v string")
    got = {r["uid"]: r["family"] for r in families.connected(edges).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}
    assert made.value == 3


def test_pairs_of_posts_take_no_index_of_all_shingles(spark, monkeypatch):
    def forbidden(*_):
        raise AssertionError("an index of all shingles is built")

    monkeypatch.setattr(sm.SimilarityIndex, "build", forbidden)
    texts = ["gold up bank nifty rally", "Gold up, bank nifty rally!", "gold up bank nifty rally rally", "unlike"]
    rows = spark.createDataFrame([(f"p{i}", i, t) for i, t in enumerate(texts)], "id string, post_ts int, content string")
    pairs = [(r["id_a"], r["id_b"]) for r in dedup.near_duplicate_pairs(rows, 0.7).collect()]
    assert pairs == [("p0", "p1"), ("p0", "p2")]


def test_similarity_of_pairs_moves_nothing(spark, capsys):
    rows = [(1, 2, "bank nifty up", "bank nifty up"), (1, 3, "bank nifty", "gold"), (1, 4, "", None)]
    scored = sm.pair_similarity(spark.createDataFrame(rows, "id_a int, id_b int, a string, b string"), "a", "b")
    assert [r["similarity"] for r in scored.orderBy("id_b").collect()] == [pytest.approx(1), 0, 0]
    scored.explain()
    assert "Exchange" not in capsys.readouterr().out


def test_terms_of_unique_rows_are_counted_where_they_are(spark, capsys):
    counts = vectors.count_vectors(spark.createDataFrame([(1, "gold gold bank"), (2, "gold")], "id int, content string"))
    counts.explain()
    assert "Exchange" not in capsys.readouterr().out
    twice = spark.createDataFrame([(1, "gold gold"), (1, "gold"), (None, None), (None, "gold")], "id int, content string")
    got = {(r["id"], r["term"]): r["count"] for r in vectors.count_vectors(twice).collect()}
    assert len(got) == 3 and sorted(got.values()) == [1, 1, 3]


def test_a_file_of_one_row_group_is_dealt_by_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20_000).coalesce(1).write.parquet(path)
    dealt = ps.spread(spark.read.parquet(path), "id", rows=500)
    assert dealt.rdd.getNumPartitions() == 40
    assert max(dealt.rdd.glom().map(len).collect()) < 1000
    again = ps.spread(dealt, "id", rows=500)
    assert again.rdd.getNumPartitions() == 40


def test_each_batch_of_the_stream_has_several_files(spark, tmp_path):
    events = spark.range(9000).selectExpr("id AS event_id", "timestamp_seconds(1700000000 + id) AS ts", "id AS user_id", "'a' AS event_type", "1.0D AS value")
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    shown = []
    real = ps.scratch_path
    ps.scratch_path = lambda *a: shown.append(real(*a)) or shown[-1]
    try:
        ps.stream_events(spark, str(tmp_path))
    finally:
        ps.scratch_path = real
    assert [len(spark.read.parquet(f"{shown[0]}/part={i}").inputFiles()) for i in range(3)] == [3, 3, 3]


def test_few_pages_are_held_at_once():
    given = pa.RecordBatch.from_pydict({"page_id": range(200), "url": ["u"] * 200, "html": ["<title>t</title>"] * 199 + [None]})
    assert [b.num_rows for b in pg._parse([given])] == [64, 64, 64, 8]
