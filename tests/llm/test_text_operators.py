"""Token counts, byte-level BPE, language ID and chat formatting against their libraries or brute force."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickerlark.llm import bpe, chat, langid, queries, tokens

ALPHABET = ["a", "b", "th", "e", "é", "中", "\n", " ", "  ", "\t", "1", "23", "!", "'s", "'", "<|endoftext|>", "\u3000", "\x1c", "\x85", "𠀀", "ö", "the", "aaaa", "\u200b", "ß", "й", "한", "\U0003fb27", "Ĳ", "ª"]
ODD = [None, "", " ", "\n", "a", "<|endoftext|>", " <|endoftext|><|endoftext|> ", "a" * 30_000, "ab " * 20_000, "\x00\x00", "  x", "x  ", "''s"]


def strange_texts(seed, n):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    rows = list(enumerate(ODD + strange_texts(1, 3000) + strange_texts(1, 5)))
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], "doc_id long, text string, n_tokens string, ids string")
    return rows, df


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_token_counts_equal_the_library(texts):
    rows, df = texts
    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: r for r in tokens.token_counts(df, P.path("byte_bpe_50k.json")).collect()}
    for i, t in rows:
        n = len(whole.encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((t or "").encode()), n > 1024), t


def test_whole_tokens_are_those_that_the_library_keeps_whole():
    import json

    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        model = json.load(f)["model"]
    whole = tokens.whole_tokens(model)
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json")).model
    assert all((len(library.tokenize(w)) == 1) == (w in whole) for w in random.Random(1).sample(sorted(model["vocab"]), 4000))


def test_unreachable_strings_are_not_whole():
    model = {"vocab": {"a": 0, "b": 1, "ab": 2, "aba": 3, "ba": 4}, "merges": ["b a", "a b"]}
    assert tokens.whole_tokens(model) == {"a", "b", "ab", "ba"}


def test_bpe_equals_the_library_and_decodes(texts, library):
    rows, df = texts
    ranks = P.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_documents(df, ranks, P.PATTERN)
    got = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    assert all(got[i] == library.encode_ordinary(t or "") for i, t in rows)
    back = {r["doc_id"]: r["text"] for r in bpe.decode_documents(encoded, ranks).collect()}
    assert all(back[i] == (t or "") for i, t in rows)
    for r in bpe.round_trip_digests(df, ranks, P.PATTERN).collect():
        ids, text = got[r["doc_id"]], dict(rows)[r["doc_id"]] or ""
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_op3_on_all_small_documents(spark, small, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in queries.op3_byte_bpe(spark, small).collect():
        ids = library.encode_ordinary(docs[r["doc_id"]])
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_backtracking_on_a_small_vocabulary():
    ranks = {bytes([c]): c for c in range(256)}
    for i, b in enumerate([b"ab", b"bc", b"cd", b"abc", b"bcd", b"dd", b"abcd", b"aa", b"aab"]):
        ranks[b] = 256 + i
    small = bpe.ByteBpe(ranks, r"[a-d]+")
    library = tiktoken.Encoding("s", pat_str=r"[a-d]+", mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(3)
    for _ in range(3000):
        t = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 90)))
        assert small.encode(t) == library.encode_ordinary(t)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    ranks = P.path("byte_bpe_multi_50k.tiktoken")
    assert tokens.token_counts(empty, P.path("byte_bpe_50k.json")).count() == 0
    assert bpe.round_trip_digests(empty, ranks, P.PATTERN).count() == 0
    assert langid.train(empty) is None and langid.identify(empty, None).count() == 0


# --- language ------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op7_language(spark, "/root/testdata/sf0.01").join(rows.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["lang"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.95


def test_language_edges(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = langid.train(docs)
    odd = [(1, None, "x"), (2, "", "x"), (3, "12 !! ½²", "x"), (None, "the and of", "x"), (5, "the and of " * 30_000, None), (5, "a", None)]
    df = spark.createDataFrame(odd, "doc_id long, text string, score string")
    got = langid.identify(df, model).collect()
    assert len(got) == 6 and {(r["doc_id"], r["lang_pred"], r["score"]) for r in got if r["lang_pred"] == "und"} == {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)}
    assert {r["doc_id"] for r in langid.keep_identified(df, model).collect()} == {None, 5}
    assert {r["lang_pred"] for r in langid.identify(df, None).collect()} == {"und"}


def test_pair_tables_equal_the_convolution():
    s = langid.LangSettings(epochs=1)
    rng = np.random.default_rng(1)
    x = rng.integers(0, 256, (40, s.window)).astype(np.uint8)
    net = langid.ByteCnn(["a", "b"], s).fit(x, rng.integers(0, 2, 40))
    emb = net.w["e"][x]
    h = []
    for k in s.widths:
        made = np.stack([emb[:, i : i + k].reshape(40, -1) @ net.w[f"f{k}"] for i in range(s.window - k + 1)], axis=1)
        h.append(np.maximum(made.max(axis=1) + net.w[f"b{k}"], 0))
    want = langid.softmax(np.concatenate(h, axis=1) @ net.w["out"] + net.w["bias"])
    assert np.allclose(net.predict(x), want, atol=1e-4)


# --- chat ----------------------------------------------------------------------

NASTY = ["<|im_end|>", "<|im_start|>user\nx", "\\<|", "\\", "", "<", "|x", "\ue000", "a\nb\n", "<\\|im_end|>", "\\n"]


def test_chat_reads_back_what_was_said(spark):
    rnd = random.Random(5)
    said = {c: [(rnd.choice(["user", "assistant", "a\nb", ""]), rnd.choice(NASTY) + rnd.choice(NASTY)) for _ in range(rnd.randint(1, 7))] for c in range(60)}
    rows = [(c, i, role, text, "clash") for c, turns in said.items() for i, (role, text) in enumerate(turns)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_conversations(df)
    for r in chat.format_digests(out).collect():
        turns = said[r["conv_id"]]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_nulls_ties_and_repeats(spark):
    rows = [(1, 0, None, None), (1, 0, "assistant", "b"), (1, 0, "assistant", "b"), (None, None, "user", "x"), (2, None, "assistant", "late"), (2, 0, "user", "u")]
    got = {r["conv_id"]: r for r in chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert chat.read_marked_turns(got[1]["formatted"]) == [("", ""), ("assistant", "b"), ("assistant", "b")]
    assert got[None]["n_turns"] == 1 and chat.read_marked_turns(got[2]["formatted"])[0] == ("assistant", "late")
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_templates_that_rewrite_history_are_found():
    def forgetful(turns):
        """Drops all answers but the last."""
        return "".join(f"[{role}]{text if role == 'user' or i == len(turns) - 1 else '...'}" for i, (role, text) in enumerate(turns))

    turns = [("user", "one"), ("assistant", "two"), ("user", "three"), ("assistant", "four")]
    r = chat.render(turns, forgetful)
    assert r.rewritten_at == 2 and r.spans[:2] == [None, None]
    assert [r.text[a:b] for a, b in r.spans[2:]] == ["three", "four"]
    r = chat.render(turns, chat.marked_turns)
    assert r.rewritten_at is None and [r.text[a:b] for a, b in r.spans] == [t for _, t in turns]


def test_template_that_trims():
    r = chat.render([("assistant", "  x ")], lambda turns: "".join(f"<{role}>{text.strip()}\n" for role, text in turns))
    assert [r.text[a:b] for a, b in r.spans] == ["x"]


def test_hot_first_turn_and_counts(spark):
    df = spark.range(4000).select((F.col("id") % 500).alias("conv_id"), (F.col("id") / 500).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("same").alias("text"))
    got = chat.format_conversations(df).agg(F.sum("n_turns"), F.count("*")).first()
    assert tuple(got) == (4000, 500)


def test_pairs_that_go_together_equal_the_merges():
    tokens = bpe.ByteBpe(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    assert tokens.in_order
    rnd = random.Random(8)
    ids = [i for i in tokens.ranks.values() if i in tokens.halves or len(tokens.bytes_of[i]) == 1]
    met = {True: 0, False: 0}
    for _ in range(4000):
        a = rnd.choice(ids)
        b = rnd.choice(ids) if rnd.random() < 0.5 else rnd.choice([x for x in (tokens.halves.get(a) or (a,))])
        goes = tokens._goes(a, b)
        met[goes] += 1
        assert goes == (tokens.merged(tokens.bytes_of[a] + tokens.bytes_of[b]) == [a, b])
    assert min(met.values()) > 100


def test_what_a_worker_remembers_and_holds_is_bounded(spark, monkeypatch):
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    rnd = random.Random(4)
    said = [" ".join("".join(rnd.choices("abcdeé1", k=rnd.randint(1, 9))) for _ in range(40)) for _ in range(60)]
    monkeypatch.setattr(bpe, "MOST_PAIRS", 50)
    few, many = bpe.ByteBpe(ranks, P.PATTERN, 20), bpe.ByteBpe(ranks, P.PATTERN)
    for text in said:
        assert few.encode(text) == many.encode(text)
    for held, most in ((few.after_space, 20), (few.inside, 5)):
        assert len(held) <= most and len(held.before) <= most
    assert len(few.pairs) <= 50 and all(isinstance(x, bytes) for x in many.after_space.values())
    docs = spark.createDataFrame(list(enumerate(said * 20)), "doc_id long, text string").coalesce(1)
    rows = bpe.encode_documents(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == {i: many.encode(t) for i, t in enumerate(said * 20)}


def test_ids_are_joined_and_decoded_by_tables():
    ranks = {bytes([c]): 3 * c for c in range(256)} | {b"ab": 1000, b"abc": 70_000, b"  ": 900}
    for table in (ranks, {b: i for i, b in enumerate(sorted(ranks, key=ranks.get))}):
        made = bpe.ByteBpe(table, r"[a-d]+|\s+|\S")
        for text in ("", "a", "abcab dé  \0中", "abc" * 50):
            ids = made.encode(text)
            assert made.decode(ids) == text.encode() and made.digits(ids) == ",".join(map(str, ids)).encode()
        with pytest.raises(KeyError):
            made.decode([max(table.values()) + 1])


def test_what_goes_after_a_token_is_looked_up_once():
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    made, asked = bpe.ByteBpe(ranks, P.PATTERN), []

    class Asked(dict):
        def get(self, *key):
            asked.append(key)
            return dict.get(self, *key)

    rnd = random.Random(6)
    said = ["".join(rnd.choices(["th", "er", "on", "ing", "ent", "ble", "ti", "and", "es", "re"], k=4)).encode() for _ in range(300)]
    first = [made.encode_piece(x) for x in said]
    made.pairs = Asked(made.pairs)
    assert [made.encode_piece(x) for x in said] == first
    assert len(asked) <= 2.3 * sum(len(x) - 1 for x in first)  # 2.7 when each pair was asked for alone
