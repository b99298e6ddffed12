"""Set join, source divergence and spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tickerlark.llm import divergence, setjoin, variants


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    k = min(k, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def test_sets_move_once_to_the_rows_that_want_them(spark, capsys):
    nodes = spark.createDataFrame([(i % 40, [i % 40, 7]) for i in range(60)], "id long, tokens array<long>")
    wanted = spark.createDataFrame([(3, 1), (3, 2), (41, 1), (30, 5)], "id long, v long")
    found = setjoin._sets_of(nodes, wanted)
    found.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning(id") == 2
    assert sorted((r["id"], r["v"], r["tokens"]) for r in found.collect()) == [(3, 1, [3, 7]), (3, 2, [3, 7]), (30, 5, [30, 7])]


def brute_join(rows, p):
    """Multiset of (doc_id, size, smallest linked doc_id, links)."""
    sets = [(d, shingles(t, p.shingle_words)) for d, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (d, x) in enumerate(sets):
        for j in range(i):
            e, y = sets[j]
            if x and y and d is not None and e is not None and 100 * len(x & y) >= p.percent * len(x | y):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(x), least.get(find(i)) if d is not None else None, links[i]) for i, (d, x) in enumerate(sets))


def families(rnd, n_families, size, changes, length):
    out = []
    for f in range(n_families):
        base = [f"f{f}w{rnd.randrange(10**6)}" for _ in range(rnd.randrange(*length))]
        for _ in range(size):
            words = list(base)
            for _ in range(rnd.choice(changes)):
                words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
            out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block", [4, 512])
def test_set_join_equals_brute_force(spark, block):
    rnd = random.Random(5)
    passage = " ".join(f"shared{i}" for i in range(20))
    texts = families(rnd, 3, 25, [0, 1, 1, 2, 3], (60, 90)) + families(rnd, 2, 12, [0, 1], (5, 12))
    # Chains whose ends differ, texts that share a passage, short and empty ones, exact copies.
    long = [f"c{i}" for i in range(80)]
    texts += [" ".join(long[: 80 - i]) for i in range(0, 40, 2)]
    texts += [f"{passage} " + " ".join(f"own{rnd.randrange(10**6)}" for _ in range(10)) for _ in range(20)]
    texts += [None, "", " \t\n", "One", "one", "a b", "A  b", "a b c", "a b c d", texts[0], texts[0], texts[0].upper()]
    rnd.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "another text of a repeated id"), (5, texts[5]), (5, texts[5]), (None, texts[7]), (None, None)]
    p = setjoin.SetJoin(block=4, slice_rows=3, order_buckets=64, list_rows=20) if block == 4 else setjoin.SetJoin()
    df = spark.createDataFrame([(d, t, "clash", "clash") for d, t in rows], "doc_id long, text string, id string, token string")
    got = Counter(tuple(r) for r in setjoin.set_similarity_join(df, p).select("doc_id", "n_shingles", "component_id", "n_links").collect())
    assert got == brute_join(rows, p)


def test_sketches_never_differ_more_than_sets():
    rng = np.random.default_rng(2)
    for n, m in ((100, 100), (127, 140), (400, 700), (3000, 3100)):
        base = rng.integers(0, 1 << 63, n + m).astype(np.uint64)
        x, y = np.unique(base[:n]), np.unique(base[n // 2 : n // 2 + m])
        assert 0 < setjoin._differing(setjoin._parities(x), setjoin._parities(y)) <= len(np.setxor1d(x, y))


def test_set_join_of_nothing(spark):
    assert setjoin.set_similarity_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    alone = spark.createDataFrame([(1, "no word is shared"), (2, None)], "doc_id long, text string")
    assert sorted(tuple(r) for r in setjoin.set_similarity_join(alone).collect()) == [(1, 1, 1, 0), (2, 0, 2, 0)]


def brute_divergence(rows, p):
    find = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+").findall
    docs = [(lang or "", source or "", Counter(find(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))) for lang, source, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in d[2])
        kept = sorted(t for t in df if df[t] >= p.least_documents)

        def share(counts, kept=kept):
            n, v = sum(counts[t] for t in kept), len(kept)
            return {t: 1 + p.scale * (counts[t] + p.pseudo) // (n + p.pseudo * v) for t in kept}

        by_source = defaultdict(Counter)
        for _, source, counts in own:
            by_source[source].update(counts)
        whole, shares = share(sum(by_source.values(), Counter())), {s: share(c) for s, c in by_source.items()}
        for s, mine in shares.items():
            pairs = sorted((-sum(abs(mine[t] - other[t]) for t in kept), o.encode(), o) for o, other in shares.items() if o != s)
            terms = sorted((whole[t] - mine[t], t.encode(), t) for t in kept if by_source[s][t] and mine[t] > whole[t])
            out |= {(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)}
            out |= {(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(terms[: p.most_terms])}
    return out


@pytest.mark.parametrize("p", [divergence.Divergence(least_documents=3, most_terms=4, held=50, slice_bytes=60, block_entries=7, block_sources=2), divergence.Divergence(least_documents=3)])
def test_divergence_equals_brute_force(spark, p):
    rnd = random.Random(3)
    words = ["a", "Zebra", "eightlet", "ninelette", "sixteenletterss", "sixteenletterssx", "seventeenletters!x", "ünïcödé", "数据处理引擎数据处理", "x" * 40, "x" * 41, "İ", "don't", "a1b"]
    rows = [(rnd.choice(["en", "de"]), rnd.choice(["s1", "s2", "s3", "s4", None]), " ".join(rnd.choices(words, k=rnd.randrange(8)))) for _ in range(60)]
    rows += [(None, "s1", "a a a"), (None, None, None), ("xx", "lonely", ""), ("yy", "p", "1 2"), ("yy", "q", None), ("en", "s1", "a " * 3000)]
    rows += rows[:5]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "lang string, source string, text string, term string, count int")
    got = [tuple(r) for r in divergence.source_divergence(df, p).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_divergence(rows, p)


def test_divergence_of_nothing(spark):
    assert divergence.source_divergence(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_radix_order_is_stable():
    rng = np.random.default_rng(1)
    key, group = rng.integers(0, 1 << 63, 500).astype(np.uint64) >> np.uint64(50), rng.integers(0, 3, 500).astype(np.uint32)
    assert (divergence.radix_order([key, group]) == np.lexsort((key, group))).all()


def brute_variants(rows, p):
    counts = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % p.drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= p.least_length and c >= p.least_count}
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]

    def near(w):
        out = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        return {x for x in out | {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters} if x in n and x != w}

    form = {}
    for w in n:
        best = min(near(w), key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= p.ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near(w)), n[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("p", [variants.Variants(drop_every=5), variants.Variants(drop_every=5, filter_bytes=40, bits=8, shards=7, chunk=13)])
def test_variants_equal_brute_force(spark, p):
    rnd = random.Random(4)
    base = ["market", "markets", "garden", "gardens", "hello", "hallo", "straße", "Größe", "Æther", "letter", "aaaaaa", "aaaaaaa", "wörter", "÷×÷×÷×", "z" * 30, "four", "čeština"]
    rows = [(rnd.randrange(50), " ".join(rnd.choices(base, weights=range(1, len(base) + 1), k=rnd.randrange(1, 40)))) for _ in range(120)]
    rows += [(None, "market market"), (7, None), (8, ""), (9, "market1market-hello_hello"), rows[0]]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, word string, n int")
    got = [tuple(r) for r in variants.spelling_variants(df, p).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_variants(rows, p)


def test_variants_chain_and_nothing(spark):
    text = " ".join(["abcdefgh"] * 48 + ["abcdefg"] * 24 + ["abcdef"] * 12 + ["abcde"] * 6 + ["abcdx"] * 3)
    p = variants.Variants(drop_every=1 << 40)
    got = {r["word"]: (r["form"], r["root"]) for r in variants.spelling_variants(spark.createDataFrame([(1, text)], "doc_id long, text string"), p).collect()}
    assert got == {"abcdefgh": (None, "abcdefgh"), "abcdefg": ("abcdefgh", "abcdefgh"), "abcdef": ("abcdefg", "abcdefgh"), "abcde": ("abcdef", "abcdefgh"), "abcdx": ("abcde", "abcdefgh")}
    assert variants.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
