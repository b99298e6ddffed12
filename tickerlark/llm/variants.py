"""Spelling variants: words one edit apart, found by probing edits against Bloom filters."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlark.llm.bytetext import BYTE_CODE, INVERSE, _up_to, mix
from tickerlark.llm.scratch import dropped, stored
from tickerlark.operators.similarity import split_join


@dataclass(frozen=True)
class Variants:
    """Settings."""

    least_length: int = 5  # code points, and
    least_count: int = 3  # occurrences of a word
    ratio: int = 2  # a form occurs at least so many times as often as its word
    drop_every: int = 97  # a run loses a code point if this divides its checksum
    bits: int = 16  # of a filter, for each word
    filter_bytes: int = 64 << 20  # of all filters of one wave; a larger vocabulary takes several waves
    shards: int = 64  # by length; words of that many code points or more share the last
    chunk: int = 16_384  # places of words edited at once


#: Letters of words, lower-cased; each is one byte of Latin-1.
ALPHABET = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint8)
RUN = "[A-Za-zÀ-ÿ]+"
BLOCK = 512  # bits, all bits of a key lie in one block
PROBES = 6
SEGMENT = 1024  # blocks built by one task


def words_of(docs: DataFrame, p: Variants) -> DataFrame:
    """(word, n): runs of letters with the planted misspellings, long and frequent enough."""
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(F.translate(F.col("text").cast("string"), upper, lower), F.lit(f"({RUN})"), F.lit(1))).alias("run"),
    )
    sum32 = F.crc32(F.encode(F.concat("doc", F.lit(":"), "run"), "UTF-8"))
    runs = runs.select("run", sum32.alias("h"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % p.drop_every == 0, less).otherwise(F.col("run"))
    counts = runs.select(word.alias("word")).where(F.length("word") >= p.least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= p.least_count)


class _Ragged:
    """Words as one array of letters, and the hash of each word: sum of code(letter) * BASE ** place."""

    def __init__(self, words: list[str]):
        self.letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.word = np.repeat(np.arange(len(words)), self.sizes)
        self.place = np.arange(len(self.letters)) - (self.ends - self.sizes)[self.word]
        with np.errstate(over="ignore"):
            self.power = _up_to(int(self.sizes.max(initial=0)))[self.place]
            self.part = BYTE_CODE[self.letters] * self.power
            self.until = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.part)])
            self.start = self.until[self.ends - self.sizes]
            self.whole = self.until[self.ends] - self.start


def _spot(h: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block of a key among ``blocks``, and the number that holds its bit places."""
    h = mix(h)
    return ((h >> np.uint64(32)) * blocks) >> np.uint64(32), mix(h ^ np.uint64(0x5851F42D4C957F2D))


def _bit(rest: np.ndarray, i: int) -> np.ndarray:
    return (rest >> np.uint64(9 * i)) & np.uint64(BLOCK - 1)


class Filters:
    """Blocked Bloom filters, one for each length, one after another in one array of bits."""

    def __init__(self, counts: dict[int, int], p: Variants):
        total = sum(counts.values()) * p.bits // 8
        self.waves = max(1, -(-total // p.filter_bytes))
        self.blocks = np.zeros(p.shards + 1, np.uint64)
        for shard, n in counts.items():
            self.blocks[shard] = -(-n * p.bits // (BLOCK * self.waves)) + 1
        self.base = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.blocks)])
        self.last = p.shards
        self.bits = np.zeros(0, np.uint64)

    def shard(self, sizes: np.ndarray) -> np.ndarray:
        return np.minimum(sizes, self.last)

    def wave_of(self, h: np.ndarray) -> np.ndarray:
        return (mix(h + np.uint64(0x2545F4914F6CDD1D)) % np.uint64(self.waves)).astype(np.int64)

    def locate(self, h: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the block in the whole array and the number with the bit places."""
        shard = self.shard(sizes)
        block, rest = _spot(h, self.blocks[shard])
        return self.base[shard] + block, rest

    def hits(self, h: np.ndarray, sizes: np.ndarray, wave: int) -> np.ndarray:
        """Indices of the keys that may be words of this wave."""
        at = np.flatnonzero(self.blocks[self.shard(sizes)] > 0)
        if self.waves > 1:
            at = at[self.wave_of(h[at]) == wave]
        block, rest = self.locate(h[at], sizes[at])
        for i in range(PROBES):
            bit = _bit(rest, i)
            found = (self.bits[(block * np.uint64(BLOCK // 64) + (bit >> np.uint64(6))).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)
            keep = found.astype(bool)
            at, block, rest = at[keep], block[keep], rest[keep]
        return at


def _built(vocabulary: DataFrame, filters: Filters, wave: int) -> np.ndarray:
    """The bits of one wave; segments of blocks are filled by tasks and fit ``filter_bytes`` together."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _Ragged(batch.column(0).to_pylist())
            own = np.flatnonzero(filters.wave_of(words.whole) == wave)
            block, rest = filters.locate(words.whole[own], words.sizes[own])
            columns = [pa.array((block // np.uint64(SEGMENT)).astype(np.int64)), pa.array((block % np.uint64(SEGMENT)).astype(np.int64)), pa.array(rest.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["segment", "block", "rest"])

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(SEGMENT * BLOCK // 64, np.uint64)
        block, rest = rows["block"].to_numpy().astype(np.uint64), rows["rest"].to_numpy().view(np.uint64)
        for i in range(PROBES):
            bit = _bit(rest, i)
            np.bitwise_or.at(bits, (block * np.uint64(BLOCK // 64) + (bit >> np.uint64(6))).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        return pd.DataFrame({"segment": rows["segment"].iloc[:1], "bits": [bits.tobytes()]})

    placed = vocabulary.select("word").mapInArrow(place, "segment long, block long, rest long")
    made = placed.groupBy("segment").applyInPandas(fill, "segment long, bits binary").collect()
    size = SEGMENT * BLOCK // 64
    out = np.zeros((int(filters.base[-1]) // SEGMENT + 1) * size, np.uint64)
    for row in made:
        out[row["segment"] * size : (row["segment"] + 1) * size] = np.frombuffer(row["bits"], np.uint64)
    return out


def _edits(words: _Ragged, names: list[str], filters: Filters, wave: int, p: Variants) -> Iterator[tuple[list[int], list[str]]]:
    """(number of a word, edit of it) for the edits that may be words.

    Deletions, and replacements by a greater letter: every two words one edit apart are met
    once, from the longer or the smaller one.
    """
    with np.errstate(over="ignore"):
        for a in range(0, len(words.letters), p.chunk):
            cut = slice(a, a + p.chunk)
            word, place, letter = words.word[cut], words.place[cut], words.letters[cut]
            size, power = words.sizes[word], words.power[cut]
            change = BYTE_CODE[ALPHABET][None, :] - BYTE_CODE[letter][:, None]
            row, column = np.nonzero(ALPHABET[None, :] > letter[:, None])
            h = words.whole[word[row]] + change[row, column] * power[row]
            hit = filters.hits(h, size[row], wave)
            row, column = row[hit], column[hit]
            yield word[row].tolist(), [names[w][:i] + chr(c) + names[w][i + 1 :] for w, i, c in zip(word[row].tolist(), place[row].tolist(), ALPHABET[column].tolist(), strict=True)]
            # Of equal neighbours one deletion is enough.
            before = np.where(place > 0, words.letters[np.maximum(np.arange(a, a + len(place)) - 1, 0)], 0)
            own = np.flatnonzero((letter != before) & (size > p.least_length))
            head = words.until[a + own] - words.start[word[own]]
            tail = words.whole[word[own]] - head - words.part[a + own]
            own = own[filters.hits(head + tail * INVERSE, size[own] - 1, wave)]
            yield word[own].tolist(), [names[w][:i] + names[w][i + 1 :] for w, i in zip(word[own].tolist(), place[own].tolist(), strict=True)]


def near_words(vocabulary: DataFrame, p: Variants) -> DataFrame:
    """(word, n, other, other_n) for each two words one edit apart, in both directions.

    ``vocabulary`` is (word, n) with distinct words over ALPHABET. Edits are probed against the
    filters, which one wave holds within ``filter_bytes``; only the positive ones meet the
    vocabulary in an exact join, which removes the false ones.
    """
    shard = F.least(F.length("word"), F.lit(p.shards))
    counts = vocabulary.groupBy(shard.alias("shard")).count().collect()  # at most p.shards rows
    filters = Filters({r["shard"]: r["count"] for r in counts}, p)
    context, found = vocabulary.sparkSession.sparkContext, None
    for wave in range(filters.waves):
        sent = context.broadcast(_built(vocabulary, filters, wave))

        def probe(batches: Iterator[pa.RecordBatch], sent=sent, wave=wave) -> Iterator[pa.RecordBatch]:
            filters.bits = sent.value
            for batch in batches:
                names, n = batch.column(0).to_pylist(), batch.column(1)
                for at, edits in _edits(_Ragged(names), names, filters, wave, p):
                    at = pa.array(at, pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), n.take(at), pa.array(edits, pa.string())], names=["word", "n", "other"])

        positive = vocabulary.select("word", "n").mapInArrow(probe, "word string, n long, other string")
        found = positive if found is None else found.unionAll(positive)
    exact = vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = stored(found.join(exact, "other").select("word", "n", "other", "other_n"), "near")
    return pairs.unionAll(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)``, whose links rise in count: pointers followed by doubling.

    A link at least doubles the count, so a chain of links has at most 62 and this ends after 7 rounds.
    Many words may point at one: it is met by a split join.
    """
    now = stored(forms.select("word", F.col("form").alias("at")), "pointers")
    while True:
        load = now.groupBy("at").agg(F.count("*").alias("rows"))
        ahead = load.join(now.select(F.col("word").alias("at"), F.col("at").alias("far")), "at", "left")
        moved = split_join(now, stored(ahead, "ahead"), "at", "rows")
        after = stored(moved.select("word", F.coalesce("far", "at").alias("at"), F.col("far").isNotNull().alias("moved")), "pointers")
        if after.where("moved").isEmpty():
            return after.select("word", F.col("at").alias("root"))
        dropped(now)
        now = after.drop("moved")


def spelling_variants(docs: DataFrame, p: Variants | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the words of ``docs(doc_id, text)``.

    Words are runs of Latin letters, A-Z lower-cased; a run whose checksum with its doc_id
    ``drop_every`` divides has lost a letter. A word's form is its near word (one inserted,
    deleted or replaced code point) of largest count, the smallest of equals, if that count is
    ``ratio`` times its own; its root is the last of its forms, or itself.

    Null texts have no words, a null doc_id counts as ''. Repeated rows count again, other columns
    are ignored; an empty table gives no rows.
    """
    p = p or Variants()
    vocabulary = stored(words_of(docs, p), "vocabulary")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = near_words(vocabulary, p).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    fits = -F.col("best.less") >= p.ratio * F.col("n")
    rows = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"),
    )
    rows = stored(rows, "variants")
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
