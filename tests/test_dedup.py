"""Deduplication and similarity against plain sequential models written here."""

import datetime as dt
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerlark.operators import blockwise, dedup, families, similarity
from tickerlark.params import Params

K2 = (1 + math.log(1.5)) ** 2
START = dt.datetime(2024, 1, 1)
PLAIN = Params(stop_words=("the",))


def grams(text):
    words = [w for w in text.split(" ") if len(w) >= 2 and w != "the"]
    return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])


def cosine(x, y):
    a, b = grams(x), grams(y)
    both = a.keys() & b.keys()
    if not both:
        return 0.0
    sa, sb = sum(a[s] ** 2 for s in both), sum(b[s] ** 2 for s in both)
    ta, tb = sum(v * v for v in a.values()), sum(v * v for v in b.values())
    dot = sum(a[s] * b[s] for s in both)
    return dot / (math.sqrt(sa + K2 * (ta - sa)) * math.sqrt(sb + K2 * (tb - sb)))


def is_repost(text):
    return text.startswith("RT @u:")


def compared(text):
    text = text.lower().replace("@u", "").replace(":", " ")
    return " ".join(text.split())


def greedy_similarity(rows):
    kept = []
    for i, t, text in rows:
        for _, _, other in kept:
            near = cosine(compared(text), compared(other)) > 0.85
            both = is_repost(text) and is_repost(other)
            if near or both and cosine(compared(text[6:]), compared(other[6:])) > 0.9:
                break
        else:
            kept.append((i, t, text))
    return {i for i, _, _ in kept}


def greedy_temporal(rows, minutes=5):
    kept = []
    for i, t, text in rows:
        recent = [o for _, u, o in kept if t - u <= minutes * 60]
        if not any(cosine(compared(text), compared(o)) > 0.8 for o in recent):
            kept.append((i, t, text))
    return {i for i, _, _ in kept}


def random_rows(seed, n, span, reposts=0.2):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa"]
    bases = [[rng.choice(words) for _ in range(rng.randint(1, 14))] for _ in range(max(3, n // 10))]
    rows = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            text[rng.randrange(len(text))] = rng.choice(words + ["the", "x"])
        prefix = "RT @u: " if rng.random() < reposts else ""
        rows.append((f"{i:04d}", rng.randrange(span), prefix + " ".join(text)))
    return sorted(rows, key=lambda r: (r[1], r[0]))


def frame(spark, rows):
    full = [(i, "u", START + dt.timedelta(seconds=t), text) for i, t, text in rows]
    return spark.createDataFrame(full, "id string, username string, post_ts timestamp, content string")


def ids(df):
    return {r["id"] for r in df.select("id").collect()}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("crowded", [2, 200])
def test_pairs_are_exact(spark, seed, crowded):
    texts = sorted({compared(t) for _, _, t in random_rows(seed, 150, 1000, 0.0)})
    df = spark.createDataFrame(list(enumerate(texts)), "uid int, t string")
    index = similarity.SimilarityIndex.build(df, "uid", "t", PLAIN.stop_words)
    for threshold in (0.8, 0.9):
        found = index.pairs(threshold, False, index.blocks(threshold, crowded)).collect()
        got = {tuple(sorted((r["uid_a"], r["uid_b"]))): r["similarity"] for r in found}
        want = {
            (i, j): c
            for i, a in enumerate(texts)
            for j, b in enumerate(texts[i + 1:], i + 1)
            if (c := cosine(a, b)) >= threshold
        }
        assert got == pytest.approx(want)
        assert len(got) == len(found)


def test_pair_similarity_edges(spark):
    pairs = [(1, 2, "up we go", "up we go"), (3, 4, "up down", "left right"), (5, 6, "the the", "the the")]
    df = spark.createDataFrame(pairs, "id_a int, id_b int, content_a string, content_b string")
    got = {r["id_a"]: r["similarity"] for r in dedup.similar_texts(df, PLAIN).collect()}
    assert got == pytest.approx({1: 1.0, 3: 0.0, 5: 0.0})


def test_exact_stages(spark):
    rows = [("b", 5, "Up now #x"), ("a", 5, "up NOW!"), ("c", 1, "#only"), ("d", 2, "@tags www.x.y"), ("e", 0, "else")]
    df = frame(spark, rows)
    assert ids(dedup.dedup_exact(df)) == {"a", "c", "e"}
    assert ids(dedup.dedup_collect(df)) == {"a", "b", "c", "d", "e"}
    stats = {r["stage"]: r for r in dedup.dedup_stats(df).collect()}
    assert stats["exact_content"]["duplicates_removed"] == 2
    assert stats["user_content"]["duplicates_removed"] == 0


def test_hot_text_is_aggregated_before_the_shuffle(spark):
    plan = dedup.dedup_exact(frame(spark, [("a", 0, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


def test_greedy_keeps_what_is_only_similar_to_a_dropped_row(spark):
    base = [f"w{i}w" for i in range(24)]
    a, b, c = list(base), list(base), list(base)
    b[0] = "bb"
    c[0], c[23] = "bb", "cc"
    texts = [" ".join(x) for x in (a, b, c)]
    assert cosine(texts[0], texts[1]) > 0.85 < cosine(texts[1], texts[2])
    assert cosine(texts[0], texts[2]) < 0.85
    df = frame(spark, [(str(i), i, t) for i, t in enumerate(texts)])
    assert ids(dedup.dedup_similarity(df, PLAIN)) == {"0", "2"}


@pytest.mark.parametrize("seed, crowded", [(3, 200), (4, 3)])
def test_similarity_equals_the_sequential_model(spark, seed, crowded):
    rows = random_rows(seed, 120, 5000)
    got = ids(dedup.dedup_similarity(frame(spark, rows), PLAIN, crowded=crowded))
    assert got == greedy_similarity(rows)


def test_large_families_take_rounds_with_the_same_result(spark):
    rows = random_rows(8, 120, 5000)
    got = ids(dedup.dedup_similarity(frame(spark, rows), PLAIN, crowded=3, most_texts=4))
    assert got == greedy_similarity(rows)


@pytest.mark.parametrize("seed, sweep_rows", [(5, 10**6), (6, 8)])
def test_temporal_equals_the_sequential_model(spark, seed, sweep_rows):
    rows = random_rows(seed, 150, 6000)
    got = ids(dedup.dedup_temporal(frame(spark, rows), PLAIN, sweep_rows, crowded=3 if sweep_rows < 100 else 200))
    assert got == greedy_temporal(rows)


def test_stages_label_each_text_once(spark):
    rows = random_rows(11, 80, 3000)
    stages = dedup.dedup_stages(frame(spark, rows), PLAIN, sweep_rows=5, crowded=3, most_texts=3)
    labels = {r["id"]: (r["copies"], r["removed_at_stage"]) for r in stages.collect()}
    seen, exact = Counter(), {}
    for r in rows:
        seen[compared(r[2])] += 1
        exact.setdefault(compared(r[2]), r)
    assert {i: n for i, (n, _) in labels.items()} == {r[0]: seen[t] for t, r in exact.items()}
    timed = greedy_temporal(list(exact.values()))
    final = greedy_similarity([r for r in exact.values() if r[0] in timed])
    assert {i for i, (_, s) in labels.items() if s != "temporal_clustering"} == timed
    assert {i for i, (_, s) in labels.items() if s is None} == final


def test_families_cut_only_at_pauses(spark):
    width, times = 10, [0, 9, 19, 30, 40, 41, 52, 100]
    df = spark.createDataFrame([("f", t) for t in times], "family string, t long")
    got = {r["t"]: r["segment"] for r in families.cut_at_pauses(df, width).collect()}
    assert [len([t for t in times if got[t] == s]) for s in sorted(set(got.values()))] == [3, 3, 1, 1]


def test_families_that_are_alike_throughout(spark):
    words = [f"w{i}" for i in range(20)]
    chain = [[*words[: 20 - i], *[f"x{j}" for j in range(i)]] for i in range(4)]
    rows = [("same", "a", words), ("same", "b", [*words, "y"]), *[("chain", str(i), w) for i, w in enumerate(chain)], *[("large", str(i), words) for i in range(6)]]
    df = spark.createDataFrame(rows, "family string, text string, words array<string>")
    assert [r["family"] for r in families.alike_throughout(df, 0.8, 5).collect()] == ["same"]


def test_long_chain_of_copies(spark):
    rng = random.Random(9)
    times = sorted(rng.randrange(200_000) for _ in range(1500))
    rows = [(f"{i:05d}", t, "same words again") for i, t in enumerate(times)]
    assert ids(dedup.dedup_temporal(frame(spark, rows), PLAIN)) == greedy_temporal(rows)


def test_pipeline_and_its_counts(spark):
    rows = random_rows(7, 100, 4000)
    df = frame(spark, rows)
    seen, exact = set(), []
    for r in rows:
        if compared(r[2]) not in seen:
            seen.add(compared(r[2]))
            exact.append(r)
    timed = greedy_temporal(exact)
    final = greedy_similarity([r for r in exact if r[0] in timed])
    assert ids(dedup.dedup_pipeline(df, PLAIN)) == final
    stats = {r["stage"]: r["unique_count"] for r in dedup.dedup_pipeline_stats(df, PLAIN).collect()}
    assert stats == {
        "exact_content": len(exact), "user_content": len(exact), "temporal_clustering": len(timed),
        "similarity": len(final), "summary": len(final),
    }


def test_near_duplicates_represent_copies_by_the_first(spark):
    rows = [("c", 9, "alpha beta gamma"), ("a", 1, "Alpha beta gamma!"), ("b", 5, "alpha beta  gamma")]
    pairs = dedup.near_duplicate_pairs(frame(spark, rows), params=PLAIN)
    got = [(r["id_a"], r["id_b"], r["similarity"]) for r in pairs.collect()]
    assert got == [("a", "b", 1.0), ("a", "c", 1.0)]
    empty = frame(spark, [("a", 1, "the the"), ("b", 2, "the the")])
    assert dedup.near_duplicate_pairs(empty, params=PLAIN).count() == 0


def test_every_copy_is_paired(spark):
    texts = ["alpha beta gamma delta epsilon zeta"] * 3 + ["alpha beta gamma delta epsilon zeta zeta"] * 2 + ["unlike", "the", None]
    rows = [(i // 2 if i < 2 else i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, content string")
    pairs = dedup.near_duplicate_pairs(df, 0.7, PLAIN, order=("id",), every_copy=True)
    got = [(r["id_a"], r["id_b"], round(r["similarity"], 9)) for r in pairs.collect()]
    near = round(cosine(texts[0], texts[3]), 9)
    assert 0.7 < near < 1
    want = [(a, b, 1.0 if x == y else near) for i, (a, x) in enumerate(rows[:5]) for b, y in rows[i + 1 : 5]]
    assert got == sorted(want, key=lambda r: (-r[2], r[0], r[1]))


def long_and_short_texts():
    rng = random.Random(14)
    texts = {compared(t) for _, _, t in random_rows(1, 120, 1000, 0.0)}
    long = [[rng.choice("abcdefgh") * 2 + str(int(rng.expovariate(0.05))) for _ in range(rng.randint(40, 400))] for _ in range(12)]
    for base in long:
        for _ in range(4):
            changed = [w if rng.random() < 0.97 else f"new{rng.randrange(50)}" for w in base] * rng.choice([1, 1, 2])
            texts.add(" ".join(changed))
    return sorted(t for t in texts if grams(t))


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95])
@pytest.mark.parametrize("meetings, slot_bits", [(1000, 5), (10**6, 18)])
def test_pairs_of_two_blocks_are_exact(monkeypatch, threshold, meetings, slot_bits):
    monkeypatch.setattr(blockwise, "MEETINGS", meetings)
    monkeypatch.setattr(blockwise, "SLOT_BITS", slot_bits)
    texts = long_and_short_texts()
    name = lambda w: int.from_bytes(hashlib.md5(w.encode()).digest()[:8])
    named = [np.array([name(w) for w in t.split(" ") if len(w) >= 2 and w != "the"], np.uint64) for t in texts]
    parts = [range(0, len(texts), 2), range(1, len(texts), 2)]
    blocks = [blockwise.Block.of([named[i] for i in part]) for part in parts]
    got = {}
    for i, j in ((0, 0), (0, 1), (1, 1)):
        for a, b, value in zip(*blockwise.similar(blocks[i], blocks[j], threshold), strict=True):
            pair = tuple(sorted((parts[i][a], parts[j][b])))
            assert pair not in got
            got[pair] = value
    want = {(i, j): c for i, a in enumerate(texts) for j, b in enumerate(texts[i + 1 :], i + 1) if (c := cosine(a, b)) >= threshold}
    assert got == pytest.approx(want) and want


def test_pairs_of_a_table_in_blocks_are_exact(spark):
    texts = long_and_short_texts()
    rows = [(hashlib.md5(t.encode()).digest(), [w for w in t.split(" ") if len(w) >= 2 and w != "the"]) for t in texts]
    df = spark.createDataFrame(rows, "uid binary, words array<string>").repartition(3)
    found = blockwise.similar_pairs(df, 0.8, 3000, 1000).collect()
    text = {uid: t for (uid, _), t in zip(rows, texts)}
    got = {tuple(sorted((text[bytes(r["uid_a"])], text[bytes(r["uid_b"])]))): r["similarity"] for r in found}
    want = {(a, b): c for i, a in enumerate(texts) for b in texts[i + 1 :] if (c := cosine(a, b)) >= 0.8}
    assert got == pytest.approx(want) and len(got) == len(found) > 50


def test_split_join_sends_hot_keys_by_broadcast(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 3000, 0).otherwise(F.col("id")).alias("k"), "id")
    lookup = rows.groupBy("k").agg(F.count("*").alias("n"))
    joined = similarity.split_join(rows, lookup, "k", "n")
    assert joined.count() == 5000 and joined.filter("k = 0 and n = 3000").count() == 3000


def test_template_with_a_running_number_ends_in_few_rounds(spark):
    rows = [(f"{i:05d}", i, f"shipment dispatched northern warehouse arrives monday morning truck n{100000 + i}") for i in range(5000)]
    assert cosine(rows[0][2], rows[1][2]) < 0.85
    assert dedup.dedup_similarity(frame(spark, rows), PLAIN).count() == 5000


def test_large_block_of_dissimilar_texts_and_copies(spark):
    rng = random.Random(12)
    head = [f"common{i}" for i in range(10)]
    rows = []
    for i in range(90):
        tail = [f"t{rng.randrange(12)}" for _ in range(rng.choice([1, 3, 8]))]
        rows.append((f"{i:04d}", i, " ".join(head + tail)))
    got = ids(dedup.dedup_similarity(frame(spark, rows), PLAIN, crowded=5))
    assert got == greedy_similarity(rows)


def test_two_similar_texts_alternating_for_thirty_days(spark):
    a, b = "alpha beta gamma delta epsilon zeta eta theta iota kappa", "alpha beta gamma delta epsilon zeta eta theta iota kappa the x"
    assert 0.8 < cosine(a, b)
    n = 30 * 24 * 60
    rows = [(f"{i:06d}", 60 * i, (a, b)[i % 2]) for i in range(n)]
    kept = ids(dedup.dedup_temporal(frame(spark, rows), PLAIN))
    assert kept == {f"{i:06d}" for i in range(0, n, 6)}


def test_similar_rows_of_two_tables(spark):
    left = [(1, "alpha beta gamma delta epsilon zeta"), (2, "Alpha beta gamma delta epsilon zeta!"), (3, "the"), (4, None), (5, "unlike all others here")]
    right = [("x", "alpha beta gamma delta epsilon eta"), ("y", "alpha beta gamma delta epsilon zeta"), ("z", "the"), ("w", "alpha beta gamma delta epsilon eta")]
    a = spark.createDataFrame(left, "id int, content string")
    b = spark.createDataFrame(right, "id string, content string")
    got = {(r["id_a"], r["id_b"]): r["similarity"] for r in dedup.near_duplicates_between(a, b, 0.5, PLAIN).collect()}
    near = cosine(left[0][1], right[0][1])
    assert 0.5 < near < 1
    assert got == pytest.approx({(i, k): v for i in (1, 2) for k, v in (("x", near), ("w", near), ("y", 1.0))})
    assert dedup.near_duplicates_between(a.limit(0), b, 0.5, PLAIN).count() == 0


def test_rows_are_compared_with_few_texts_where_they_are(spark, monkeypatch):
    texts = [t for _, _, t in random_rows(5, 120, 1000, 0.2)] + ["up up up gold", "the", None]
    left = spark.createDataFrame([(i, t) for i, t in enumerate(texts[::4])], "id int, content string")
    right = spark.createDataFrame([(f"r{i}" if i % 9 else None, t) for i, t in enumerate(texts)], "id string, content string")
    by_index = dedup.near_duplicates_between(left, right, 0.4, PLAIN, held_chars=-1).collect()

    def forbidden(*_):
        raise AssertionError("an index of all texts is built")

    monkeypatch.setattr(similarity.SimilarityIndex, "build", forbidden)
    held = dedup.near_duplicates_between(left, right, 0.4, PLAIN).collect()
    key = lambda r: (r["id_a"], r["id_b"] or "", r["similarity"])
    assert len(held) == len(by_index) > 30
    for got, want in zip(sorted(held, key=key), sorted(by_index, key=key), strict=True):
        assert got[:2] == want[:2] and got[2] == pytest.approx(want[2])
