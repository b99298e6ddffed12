"""How the terms of one source differ from those of the other sources of its language."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlark.llm.bytetext import LOWER
from tickerlark.llm.scratch import stored
from tickerlark.operators.similarity import split_join


@dataclass(frozen=True)
class Divergence:
    """Settings."""

    least_documents: int = 30  # of a language, for a term to be kept
    pseudo: int = 5  # added to each count
    scale: int = 1_000_000_000  # of the integer shares
    most_terms: int = 50  # ranks of the part ``term``
    held: int = 1_000_000  # distinct terms that a task holds before it merges them or hands them on
    slice_bytes: int = 4_000_000  # of text whose terms are packed at once (a longer text alone)
    block_entries: int = 20_000  # (source, term) entries compared at once, and
    block_sources: int = 128  # sources on each side


#: Bytes of terms: letters and all bytes of characters beyond ASCII.
TERM = np.zeros(256, bool)
TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
WORD = 8


def _places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and row of each term of texts that lie one after another in ``data``."""
    inside = TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[1:-1] |= ~inside[:-1] | ~inside[1:]
    starts = np.flatnonzero(inside & edge[:-1])
    ends = np.flatnonzero(inside & edge[1:]) + 1
    return starts, ends - starts, np.searchsorted(offsets, starts, side="right") - 1


def _packed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, words: int) -> list[np.ndarray]:
    """Terms as ``words`` big-endian numbers, filled up with zeros; the last one holds a byte at least.

    ``data`` has at least ``words`` * 8 bytes after the last term. No term has a zero byte, so
    different terms give different numbers.
    """
    at_each = np.ndarray((len(data) - WORD + 1,), ">u8", data, strides=(1,))
    out = []
    for i in range(words):
        missing = np.clip((i + 1) * WORD - lengths, 0, WORD - 1).astype(np.uint64) * np.uint64(8)
        out.append(at_each[starts + i * WORD].astype(np.uint64) >> missing << missing)
    return out


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The stable order by ``keys``, least significant key first.

    Numbers are sorted 16 bits at a time, lowest first (numpy sorts those by radix); digits that
    all rows share are skipped. Byte strings are sorted as such.
    """
    order = np.arange(len(keys[0]))
    for key in keys:
        if key.dtype.kind == "S":
            order = order[np.argsort(key[order], kind="stable")]
            continue
        for shift in range(0, key.dtype.itemsize * 8, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _runs(keys: list[np.ndarray], rows: np.ndarray | None, count: np.ndarray | None, docs: np.ndarray | None) -> tuple:
    """Equal keys counted: (keys, count, docs). ``rows`` ascend and tell documents apart; or counts are summed."""
    order = radix_order(keys)
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    if rows is not None:
        rows = rows[order]
        other = new.copy()
        other[1:] |= rows[1:] != rows[:-1]
        count, docs = np.ones(len(order), np.int64), other.astype(np.int64)
    else:
        count, docs = count[order], docs[order]
    return [k[at] for k in keys], np.add.reduceat(count, at), np.add.reduceat(docs, at)


class _Counts:
    """Counts of terms by group, in buckets: one word, two words, and one for each greater length."""

    def __init__(self) -> None:
        self.parts: dict[int, list[tuple]] = defaultdict(list)
        self.size = 0

    def add(self, data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> None:
        starts, lengths, rows = _places(data, offsets)
        data = np.concatenate([LOWER[data], np.zeros(2 * WORD, np.uint8)])
        bucket = np.where(lengths <= WORD, 1, np.where(lengths <= 2 * WORD, 2, lengths))
        for b in np.unique(bucket):
            own = np.flatnonzero(bucket == b)
            if b <= 2:
                keys = _packed(data, starts[own], lengths[own], b)[::-1]
            else:
                keys = [np.lib.stride_tricks.sliding_window_view(data, b)[starts[own]].view(f"S{b}").ravel()]
            part = _runs([*keys, group[rows[own]]], rows[own], None, None)
            self.parts[int(b)].append(part)
            self.size += len(part[1])

    def merge(self) -> None:
        for b, parts in self.parts.items():
            if len(parts) > 1:
                keys = [np.concatenate(k) for k in zip(*[p[0] for p in parts], strict=True)]
                self.parts[b] = [_runs(keys, None, *[np.concatenate([p[i] for p in parts]) for i in (1, 2)])]
        self.size = sum(len(p[1]) for parts in self.parts.values() for p in parts)

    def rows(self) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
        """(terms, group, count, docs) of the merged buckets, which are then empty."""
        for b, parts in self.parts.items():
            for keys, count, docs in parts:
                for i in range(0, len(count), 100_000):
                    cut = slice(i, i + 100_000)
                    if b <= 2:
                        words = np.stack([k[cut] for k in keys[-2::-1]], axis=1).astype(">u8")
                        terms = words.view(f"S{b * WORD}").ravel().tolist()
                    else:
                        terms = keys[0][cut].tolist()
                    yield terms, keys[-1][cut], count[cut], docs[cut]
        self.parts.clear()
        self.size = 0


def _slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes; a longer row alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def term_counts(docs: DataFrame, p: Divergence) -> DataFrame:
    """(lang, source, term, count, docs): occurrences of each term, and how many rows have it.

    A row with the empty term and zeros stands for each (lang, source) that occurs. Terms are
    counted in each task first, so a frequent term or a hot source sends a row for a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[tuple[str, str], int] = {}
        found = _Counts()

        def out() -> Iterator[pa.RecordBatch]:
            names = list(numbers)

            def made(terms: list[bytes], group: list[int], count, docs) -> pa.RecordBatch:
                langs, sources = pa.array([x for x, _ in names], pa.string()), pa.array([x for _, x in names], pa.string())
                at = pa.array(group, pa.int64())
                columns = [langs.take(at), sources.take(at), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(count, pa.int64()), pa.array(docs, pa.int64())]
                return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "count", "docs"])

            if names:
                zeros = np.zeros(len(names), np.int64)
                yield made([b""] * len(names), np.arange(len(names)), zeros, zeros)
            for terms, group, count, of_docs in found.rows():
                yield made(terms, group.astype(np.int64), count, of_docs)
            numbers.clear()

        for batch in batches:
            pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            column = batch.column(2)
            wide = pa.types.is_large_string(column.type)
            _, ends, data = column.buffers()
            ends = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
            data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            for i, j in _slices(ends, p.slice_bytes):
                group = np.array([numbers.setdefault(x, len(numbers)) for x in pairs[i:j]], np.uint32)
                if ends[j] > ends[i]:
                    found.add(data[ends[i] : ends[j]], ends[i : j + 1] - ends[i], group)
                if found.size + len(numbers) > p.held:
                    found.merge()
                    if found.size + len(numbers) > p.held // 2:
                        yield from out()
        found.merge()
        yield from out()

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    parts = docs.select(*text).mapInArrow(run, "lang string, source string, term string, count long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _share(count: Column, n: Column, v: Column, p: Divergence) -> Column:
    """1 + floor(scale * (count + pseudo) / (n + pseudo * v)), exact."""
    above = (count + p.pseudo).cast("decimal(20,0)") * F.lit(p.scale).cast("decimal(10,0)")
    return 1 + F.call_function("div", above, (n + p.pseudo * v).cast("decimal(20,0)"))


def _distances(entries: DataFrame, groups: DataFrame, p: Divergence) -> DataFrame:
    """(lang, source, item, value): differences summed over all kept terms, for each two sources.

    ``entries`` is (lang, source, term, p, zero, of_lang, sides): share of the term and of one that
    doesn't occur, entries and sources of the language. ``groups`` is (lang, source, zero, v,
    of_lang, sides), v the number of kept terms. Entries are dealt into blocks by term, and by
    sources where there are many; a block adds up its terms, and what no block of two sources
    has seen neither has.
    """
    parts, sides = F.ceil(F.col("of_lang") / p.block_entries), F.ceil(F.col("sides") / p.block_sources).cast("int")
    own = F.pmod(F.xxhash64("source"), sides).cast("int")
    columns = ["lang", "source", "zero", "sides", "term", "p", "part"]
    rows = entries.withColumn("part", F.pmod(F.xxhash64("term"), parts)).select(*columns)
    # A source is there in each block, with or without terms.
    there = groups.where("of_lang > 0").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    there = there.select("lang", "source", "zero", "sides", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("p"), "part")
    rows = rows.unionByName(there).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), sides - 1)))
    rows = rows.select("lang", "part", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "source", "zero", "term", "p")

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, _, x, y = key
        term, terms = pd.factorize(rows["term"])
        source, names = pd.factorize(rows["source"])
        zero, side = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        zero[source], side[source] = rows["zero"], rows["own"]
        share = np.repeat(zero[:, None], len(terms), axis=1)
        has = term >= 0
        share[source[has], term[has]] = rows["p"][has]
        out = []
        for i in np.flatnonzero(side == x):
            others = np.flatnonzero((side == y) & ((side != x) | (np.arange(len(names)) != i)))
            value = np.abs(share[others] - share[i]).sum(axis=1)
            out += [(key[0], names[i], names[j], int(s), share.shape[1]) for j, s in zip(others, value, strict=True)]
            if x != y:
                out += [(key[0], names[j], names[i], int(s), share.shape[1]) for j, s in zip(others, value, strict=True)]
        return pd.DataFrame(out, columns=["lang", "source", "item", "value", "seen"])

    met = rows.groupBy("lang", "part", "x", "y").applyInPandas(compare, "lang string, source string, item string, value long, seen long")
    met = met.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    one = groups.select("lang", "source", "zero", "v")
    two = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("other_zero"))
    # Its rows are those of the result: each source with each other one of its language.
    both = one.join(two, "lang").where("source <> item").join(met, ["lang", "source", "item"], "left")
    unseen = (F.col("v") - F.coalesce("seen", F.lit(0))) * F.abs(F.col("zero") - F.col("other_zero"))
    return both.select("lang", "source", "item", (F.coalesce("value", F.lit(0)) + unseen).alias("value"))


def source_divergence(docs: DataFrame, p: Divergence | None = None) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs(lang, source, text)``; nulls count as ''.

    Terms are runs of letters and of characters beyond ASCII, A-Z lower-cased; a language keeps
    those in at least ``least_documents`` of its rows. A group (lang, source) and a language give
    each kept term a share, an integer of ``scale``. Part ``pair``: each other source of the
    language with the sum of the differences of shares, all ranks. Part ``term``: terms that
    the group has more of than its language, by the difference, to rank ``most_terms``. Larger values
    come first, ties by UTF-8.

    Every row is a document: repeated rows count again. Empty tables give no rows, a language with
    one source no pairs; other columns are ignored. Exact integers throughout.
    """
    p = p or Divergence()
    counts = stored(term_counts(docs, p), "terms")
    by_term = counts.where("term <> ''").groupBy("lang", "term")
    kept = by_term.agg(F.sum("count").alias("in_lang"), F.sum("docs").alias("docs"), F.count("*").alias("sources"))
    kept = stored(kept.where(F.col("docs") >= p.least_documents).drop("docs"), "kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("in_lang").alias("n"), F.sum("sources").alias("entries"))
    langs = stored(langs, "languages")
    shared = split_join(kept, langs, "lang", "v")
    shared = shared.select("lang", "term", "sources", _share(F.col("in_lang"), F.col("n"), F.col("v"), p).alias("q"))
    entries = stored(split_join(counts, shared, ["lang", "term"], "sources").select("lang", "source", "term", "count", "q"), "entries")
    sums = entries.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count("*").alias("terms"))
    groups = counts.where("term = ''").select("lang", "source").join(sums, ["lang", "source"], "left")
    groups = groups.fillna(0, ["n", "terms"]).join(langs.select("lang", "v", F.col("entries").alias("of_lang")), "lang", "left").fillna(0, ["v", "of_lang"])
    several = counts.where("term = ''").groupBy("lang").agg(F.count("*").alias("sides"))
    zero = F.when(F.col("v") > 0, _share(F.lit(0), F.col("n"), F.col("v"), p)).otherwise(0)
    groups = stored(groups.join(several, "lang").withColumn("zero", zero), "groups")
    sized = split_join(entries, groups.where("terms > 0"), ["lang", "source"], "terms")
    shares = stored(sized.select("lang", "source", "term", "q", "of_lang", "sides", "zero", _share(F.col("count"), F.col("n"), F.col("v"), p).alias("p")), "shares")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ahead = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    ahead = ahead.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= p.most_terms)
    pairs = _distances(shares, groups, p).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.withColumn("rank", F.row_number().over(best)).unionByName(ahead)
