"""Token counts with a whole-token shortcut."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from tickerlark.llm.chunks import PLAIN, ByChunk, Remembered, once


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level files: itself if it prints, else one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(0x100 + i) for i, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


class Merger:
    """Counts the tokens of one pre-token by merging pairs in rank order."""

    def __init__(self, merges: list, vocab: dict[str, int]):
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.rank = {(vocab[a], vocab[b]): (i, vocab[a + b]) for i, (a, b) in enumerate(pairs)}
        self.vocab = vocab

    def ids(self, word: str) -> list[int]:
        parts = [self.vocab[c] for c in word]
        known = self.rank
        while len(parts) > 1:
            pairs = list(zip(parts, parts[1:], strict=False))
            ranks = [known[p] for p in pairs if p in known]
            if not ranks:
                break
            best = min(ranks)
            out, i, n = [], 0, len(parts)
            while i < n:
                if i + 1 < n and known.get((parts[i], parts[i + 1])) == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts


def whole_tokens(model: dict) -> frozenset[str]:
    """The vocabulary strings that encode alone as the one token they are.

    Each string is merged by the ranks; those that end as several tokens (no chain of merges
    reaches them) or hold a character without an own token are left out.
    """
    vocab = model["vocab"]
    merger = Merger(model["merges"], vocab)
    return frozenset(w for w in vocab if all(c in vocab for c in w) and merger.ids(w) == [vocab[w]])


class Counter:
    """Counts the tokens of texts as the tokenizer file ``spec`` does.

    Texts are cut at the special strings, as the library does by default, then into pre-tokens by
    the library's own pre-tokenizer. A pre-token that is a whole token counts as one; the rest
    goes through the library's merges.
    """

    def __init__(self, spec: str, whole: frozenset[str]):
        said = json.loads(spec)
        added = said["added_tokens"]
        plain = said["pre_tokenizer"] or {}
        if said["normalizer"] or plain.get("type") != "ByteLevel" or plain.get("add_prefix_space") or not plain.get("use_regex", True) or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("only byte-level tokenizer files with plain special tokens")
        self.model, self.whole = Tokenizer.from_str(spec).model, whole
        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
        self.special = sorted((t["content"] for t in added), key=len, reverse=True)
        self.rest = Remembered(lambda word: len(self.model.tokenize(word)))
        self.by_chunk = ByChunk(self._count)

    def _count(self, chunk: str) -> int:
        if plain := PLAIN(chunk):
            words = [x.encode().decode("latin-1").translate(BYTE_LETTERS) for x in plain.groups() if x]
        else:
            words = [word for word, _ in self.split(chunk)]
        return sum(1 if word in self.whole else self.rest[word] for word in words)

    def count(self, text: str) -> int:
        for mark in self.special:
            if mark in text:
                first, *others = text.split(mark)
                return self.count(first) + sum(1 + self.count(x) for x in others)
        return sum(self.by_chunk(text))


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs(doc_id, text)``.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library; the driver reads
    it, proves the whole tokens once, and broadcasts both (bounded by the vocabulary). One narrow
    pass: no shuffle, texts are whole. Null text counts as empty (0 tokens). Repeated and null
    doc_id rows are counted row by row; other columns are ignored.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    sent = docs.sparkSession.sparkContext.broadcast((spec, whole_tokens(json.loads(spec)["model"])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = once((tokenizer, len(sent.value[0])), lambda: Counter(*sent.value))
        for batch in batches:
            sizes, counts = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                sizes.append(len(text.encode()))
                counts.append(counter.count(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
