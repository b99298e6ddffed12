"""Near duplicates, components, nearest neighbours, exact top-k and URL rules against brute force."""

import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickerlark.llm import ann, minhash, oracles, queries, scratch, topk, urls
from tickerlark.llm.components import connected_components
from tickerlark.llm.scratch import flagged


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    k = min(k, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute(docs, k):
    """{doc_id: (set size, smallest linked doc_id)}"""
    sets = {d: shingles(t, k) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: (len(s), find(d)) for d, s in sets.items()}


def check(spark, docs, p):
    df = spark.createDataFrame([(d, t, "clash", "clash") for d, t in docs], "doc_id long, text string, u string, comp string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df, p).collect()}
    want = {d: (n, c, d == c) for d, (n, c) in brute(docs, p.shingle_words).items()}
    assert got == want


def shuffles(df, capsys):
    df.explain()
    return capsys.readouterr().out.count("Exchange hashpartitioning")


def test_keys_move_once_and_those_met_once_end_there(spark, capsys):
    reps = spark.createDataFrame([(5, 2, [1, 2]), (3, 4, [1, 3]), (4, 6, [1, 4]), (9, 1, [3, 5])], "doc_id long, n_shingles long, band_keys array<long>")
    met = minhash._buckets(reps)
    assert sorted(tuple(r) for r in met.select("key", "doc_id", "v", "n_shingles").collect()) == [(1, 3, 3, 4), (1, 4, 3, 6), (1, 5, 3, 2), (3, 3, 3, 4), (3, 9, 3, 1)]
    assert shuffles(met, capsys) == 1


def test_rows_without_a_flag_are_not_among_the_keys_and_stay(spark, capsys):
    rows = spark.createDataFrame([(i if i % 7 else None, f"t{i}") for i in range(500)], "a long, __word string")
    keys = spark.createDataFrame([(i,) for i in range(0, 500, 50)], "a long")
    marked = flagged(rows, keys, "near")
    assert marked.columns == ["a", "__word", "near"] and shuffles(marked.select("a", "near"), capsys) <= 1
    got = {r["a"]: r["near"] for r in marked.collect()}
    assert all(got[i] for i in range(50, 500, 50) if i % 7) and sum(got.values()) < 15
    assert not any(r["near"] for r in flagged(rows, keys.limit(0), "near").collect())


def family(rnd, base, n, changes):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rnd.choice(changes)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block", [4, 512])
def test_near_duplicates_equal_brute_force(spark, block):
    rnd = random.Random(2)
    texts = [None, "", " \n\t", "One", "one", "ONE two", "one  two", "É é", "x" * 40_000, "ab " * 20_000]
    for size in (6, 20, 60, 200):
        base = [f"w{rnd.randrange(500)}" for _ in range(size)]
        # near the threshold, so that many pairs of a family are not linked directly
        texts += family(rnd, base, 60, range(0, 2 + size // 8))
    docs = list(enumerate(texts, 100))
    rnd.shuffle(docs)
    check(spark, docs, minhash.NearDup(shingle_words=2, block=block))


def test_chain_through_a_member_that_is_not_the_centre(spark):
    """Each text is linked with the next only, and the smallest id stands at the end."""
    words = [f"w{i}" for i in range(100)]
    docs = [(i, " ".join(words[4 * i : 4 * i + 60] if i < 11 else words[:5])) for i in range(11)]
    p = minhash.NearDup(shingle_words=1)
    assert brute(docs, 1)[10][1] == 0
    check(spark, docs, p)


def test_near_duplicates_nulls_and_repeats(spark):
    rows = [(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "A B C"), (3, None), (3, None)]
    got = sorted(tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), minhash.NearDup(2)).where("doc_id is not null").collect())
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    left = minhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), minhash.NearDup(2)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left if r["text"]) == [(0, "a b c"), (1, "a b c")]
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rows_that_repeat_an_id_keep_their_own_texts(spark):
    rows = [(1, "one text of its own here", "x"), (1, "another text altogether it is", "y"), (1, "another text altogether it is", "y"), (2, "Another text altogether it is", "z"), (0, "another TEXT altogether it is", "w"), (None, "another text altogether it is", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __ID string")
    got = sorted(tuple(r) for r in minhash.near_duplicates(df.where("doc_id is not null"), minhash.NearDup(2)).collect())
    assert got == [(0, 4, 0, True), (1, 4, 0, False), (1, 5, 1, True), (2, 4, 0, False)]
    left = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"], r["__ID"]) for r in minhash.drop_near_duplicates(df, minhash.NearDup(2)).collect())
    assert left == [(-1, "another text altogether it is", "n"), (0, "another TEXT altogether it is", "w"), (1, "one text of its own here", "x")]
    again = minhash.drop_near_duplicates(df.where("doc_id = 1"), minhash.NearDup(2)).collect()
    assert sorted(r["text"] for r in again) == ["another text altogether it is", "one text of its own here"]


def test_components_equal_union_find(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)] + [(5, 5), (7, 401), (401, 7)] + [(i, i + 1) for i in range(1000, 1200)]
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in nodes}


# --- vectors -------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")


ODD_VECTORS = [(9000, None, ""), (9050, [float("nan")] * 8, ""), (9100, [None] * 8, ""), (9150, [float("inf")] + [1.0] * 7, ""), (None, [1.0] * 8, ""), (9200, [], "")]


def some_vectors(n=900):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=8)], "") for i in range(n)]
    return rows + [(20_000 + i, rows[0][1], "") for i in range(400)]


def test_top_products_equal_brute_force(spark):
    rows = some_vectors()
    got = topk.top_products(vectors(spark, rows + ODD_VECTORS), 50, shard_rows=64, tile_rows=8).collect()
    made = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v, _ in rows}
    want = []
    for q in made:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(made[q], made[c])), c) for c in made if c != q)[:5]
            want += [(q, r, c, -s) for r, (s, c) in enumerate(best, 1)]
    assert sorted(tuple(r) for r in got if r["query_id"] != 9200) == sorted(want)


def test_products_beyond_doubles_are_exact():
    q, v = np.array([[2.0**40, 3.0]]), np.array([[2.0**20, 1.0], [2.0**40, 0.0]])
    assert topk.scores(q, v).tolist() == [[2**60 + 3, 2**63 - 1]]


@pytest.mark.parametrize("op", [lambda d: topk.top_products(d, 50), lambda d: ann.nearest(d, 50)])
def test_few_or_no_vectors(spark, op):
    assert op(vectors(spark, [])).count() == 0
    assert op(vectors(spark, ODD_VECTORS[:5])).count() == 0
    few = op(vectors(spark, [(0, [1.0, 0.0], ""), (1, [1.0, 0.0], ""), (2, [0.0, 1.0], "")])).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(few, key=lambda r: r["rank"])] == [(1, 1), (2, 2)]


def test_nearest_recall_and_scores(spark):
    found = {}
    for r in queries.op8_nearest(spark, "/root/testdata/sf0.01").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    x = np.array([r["embedding"] for r in rows], float)
    ids = np.array([r["vec_id"] for r in rows])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    for q, got in found.items():
        near = unit @ unit[ids == q][0]
        near[ids == q] = -2
        want = set(ids[np.argsort(-near)[:5]].tolist())
        hits, total = hits + len(want & {v for _, v, _ in got}), total + 5
        assert all(abs(s - near[ids == v][0]) < 1e-12 for _, v, s in got)
        assert sorted(got) == sorted(got, key=lambda g: (-g[2], g[1])) and len(got) == 5
    assert len(found) == (ids % 50 == 0).sum() and hits / total >= 0.9


def test_nearest_with_a_very_common_vector(spark):
    rows = some_vectors()
    got = ann.nearest(vectors(spark, rows + ODD_VECTORS), 50, s=ann.AnnSettings(block=64)).collect()
    same = {r["query_id"]: [] for r in got}
    for r in sorted(got, key=lambda r: r["rank"]):
        same[r["query_id"]].append(r["vec_id"])
    assert same[0] == [20_000, 20_001, 20_002, 20_003, 20_004]
    assert same[20_050] == [0, 20_000, 20_001, 20_002, 20_003]


def test_vectors_of_other_lengths_are_searched_among_themselves(spark):
    rng = np.random.default_rng(3)
    rows = some_vectors() + [(30_000 + i, [float(x) for x in rng.normal(size=5)], "") for i in range(120)] + [(40_000, [1.0], "")]
    got = {}
    for r in ann.nearest(vectors(spark, rows), 50).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    x = {i: np.array(np.float32(v), float) for i, v, _ in rows if len(v) == 5}
    for q in (30_000, 30_050, 30_100):
        cos = {i: -(v @ x[q]) / np.linalg.norm(v) for i, v in x.items() if i != q}
        assert [i for _, i in sorted(got[q])] == sorted(cos, key=lambda i: (cos[i], i))[:5]
    assert 40_000 not in got and len(got) == 18 + 8 + 3


def test_isolated_queries_get_all_their_neighbours(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in np.r_[10.0, 0.01 * rng.normal(size=7)]], "") for i in range(1, 800)]
    rows += [(0, [-1.0] + [0.0] * 7, ""), (850, [0.0] * 7 + [1.0], "")]
    got = ann.nearest(vectors(spark, rows), 50).groupBy("query_id").count().collect()
    assert {r["query_id"]: r["count"] for r in got} == {q: 5 for q in [*range(0, 800, 50), 850]}


@pytest.mark.parametrize("rows", [51_282, 1_000_000, 3_000_000])
@pytest.mark.parametrize("spread", [0.03, 1.0])
def test_probes_reach_the_target_at_any_number_of_rows(rows, spread):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(100, 64))[rng.integers(0, 100, 2000)] + spread * rng.normal(size=(2000, 64)) if spread < 1 else rng.normal(size=(2000, 64))
    s = ann.AnnSettings(sample_queries=100)
    h = ann.fit(x, rows, 5, s)
    assert h is not None
    if h is not None:
        x = ann.unit(x)
        cells, reached = np.floor(h.places(x)), []
        for q in range(100):
            probes = [{c.tobytes() for c in ann.probe_cells(p, h.probes)} for p in h.places(x[q : q + 1])[0]]
            near = np.argsort(-(x @ x[q]), kind="stable")[1:6]
            reached += [any(cells[i, t].tobytes() in probes[t] for t in range(len(probes))) for i in near]
        assert np.mean(reached) >= s.target


def test_nearest_recall_with_many_hashes(spark):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(2500, 64)).astype(np.float32)
    rows = [(i, [float(c) for c in v], "") for i, v in enumerate(x)]
    got = ann.nearest(vectors(spark, rows), 50, s=ann.AnnSettings(per_bucket=1, most_probes=400)).collect()
    unit, hits = ann.unit(x.astype(float)), 0
    for q in range(0, 2500, 50):
        near = unit @ unit[q]
        near[q] = -2
        hits += len(set(np.argsort(-near)[:5].tolist()) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hits / 250 >= 0.98


def test_probes_come_in_order_of_cost():
    place = np.array([0.1, 5.45, -2.8])
    cells = ann.probe_cells(place, 27)
    assert len({tuple(c) for c in cells}) == 27
    cost = [sum(((p - np.floor(p)) if d < 0 else (np.floor(p) + 1 - p)) ** 2 for p, d in zip(place, c - np.floor(place)) if d) for c in cells]
    assert cost == sorted(cost) and cost[0] == 0


# --- URLs ----------------------------------------------------------------------

URLS = [
    (1, "https://Sub.Example.ORG/es/1?x#y", "sub.example.org", "/es/1", "example.org/es/", "block"),
    (2, "http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    (3, "http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    (4, "http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    (5, "http://a.com/fr/x", "a.com", "/fr/x", "com/fr/", "allow"),
    (6, "http://a.com/de/", "a.com", "/de/", "com/de/", "block"),
    (7, "http://a.com?/de/", "a.com", "", None, None),
    (8, None, "", "", None, None),
    (9, "no scheme", "", "", None, None),
    (10, "x://y://z/p", "y:", "//z/p", None, None),
    (11, "http://example.org", "example.org", "", None, None),
    (12, "http://ÄB.com/", "Äb.com", "/", None, None),
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u, *_ in URLS], "page_id long, url string, host string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (99, 1), (3, None)], "page_id long, bad int")
    got = {r["page_id"]: r for r in urls.judge_urls(pages, labels, queries.RULES).collect()}
    for i, _, host, path, rule, verdict in URLS:
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert verdict is None or got[i]["verdict"] == verdict
    assert urls.judge_urls(pages.limit(0), labels.limit(0), queries.RULES).count() == 0


def test_reputation_shrinks_small_hosts_to_their_domain(spark):
    rows = [("big.bad.example.com", 1)] * 400 + [("x.bad.example.com", 0)] + [("good.example.net", 0)] * 400 + [("new.example.net", None)]
    got = {r["host"]: r for r in urls.host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert got["big.bad.example.com"]["bound"] > 0.9 > 0.3 > got["good.example.net"]["mean"]
    assert got["x.bad.example.com"]["mean"] > got["new.example.net"]["mean"] and got["new.example.net"]["n"] == 0


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_its_sql(spark, small, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = queries.REGISTRY[name](spark, small)
    columns = sorted(df.columns)
    cursor = duck.execute(oracles.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(tuple(repr(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert sorted(tuple(repr(r[c]) for c in columns) for r in df.collect()) == want


def test_only_rows_that_may_be_among_the_keys_are_made(spark, capsys):
    rows = spark.createDataFrame([(i if i % 7 else None, f"t{i % 400}") for i in range(500)] * 2, "a long, __word string")
    keys = spark.createDataFrame([(i,) for i in range(0, 500, 50)] + [(None,)], "a long")
    found = scratch.among(rows, keys)
    assert found.columns == rows.columns and shuffles(found, capsys) <= 1
    flags = flagged(rows, keys, "near").where("near").drop("near")
    assert sorted(map(str, found.collect())) == sorted(map(str, flags.collect()))
    assert scratch.among(rows, keys.limit(0)).isEmpty()
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(9)], "doc_id long, text string")
    sig = minhash.signatures(docs, minhash.NearDup()).withColumn("given_id", F.col("doc_id"))
    for df in (found, minhash._texts_of(docs, sig, docs.select("doc_id").limit(3))):
        capsys.readouterr()
        df.explain()
        plan = capsys.readouterr().out
        assert "LeftSemi" in plan and "LeftOuter" not in plan
