"""Near-duplicate documents: MinHash signatures, banding, verification, components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlark.llm.bytetext import mix, shingle_set, text_bytes, word_hashes
from tickerlark.llm.components import connected_components
from tickerlark.llm.scratch import among, dropped, flagged, free, stored
from tickerlark.operators.similarity import split_join


@dataclass(frozen=True)
class NearDup:
    """Settings. At the defaults a pair of similarity 0.8 shares no band with probability 1.2e-7."""

    shingle_words: int = 5
    percent: int = 80  # linked if 100 * intersection >= percent * union
    bands: int = 40
    rows: int = 5
    sigmas: float = 5.0  # slack of the signature test before the exact one
    block: int = 512  # documents in a block of a crowded bucket, and
    block_shingles: int = 1_000_000  # shingles in it
    partners: int = 500  # of one document that a task compares it with

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def least_agreement(self) -> int:
        """Agreeing minima below which a pair can't be linked but by an error of ``sigmas``."""
        s = self.percent / 100
        return math.floor(self.hashes * s - self.sigmas * math.sqrt(self.hashes * s * (1 - s)))


def _minima(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of (a*x + b) mod 2**32 for each hash function."""
    x = (values >> np.uint64(32)).astype(np.uint32) ^ values.astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(out, (a[:, None] * x[None, i : i + 2048] + b[:, None]).min(axis=1), out=out)
    return out


def _hash_functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(2024)
    return rng.integers(0, 1 << 32, n, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, np.uint32)


def signatures(docs: DataFrame, p: NearDup) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_key, signature, band_keys) for each row; narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _hash_functions(p.hashes)
        salt = mix(np.arange(1, p.bands + 1, dtype=np.uint64))
        for batch in batches:
            keys, sizes, sets, sigs, bands = [], [], [], [], []
            for text in text_bytes(batch.column(1)):
                raw = b"" if text is None else text.tobytes()
                keys.append(b"0" if text is None else b"1" + hashlib.md5(raw).digest())
                found = shingle_set(word_hashes(np.frombuffer(raw, np.uint8)), p.shingle_words)
                sizes.append(len(found))
                if not len(found):
                    sets.append(None), sigs.append(None), bands.append(None)
                    continue
                low = _minima(found, a, b)
                band = salt.copy()
                for i in range(p.rows):
                    band = mix(band * np.uint64(3) + low[i :: p.rows][: p.bands])
                sets.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                sigs.append(low.astype(np.uint16).tobytes())
                bands.append(band.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n_shingles", "set_key", "signature", "band_keys"],
            )

    schema = "doc_id long, text_key binary, n_shingles long, set_key binary, signature binary, band_keys array<long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def _agreement(a: bytes, b: bytes) -> int:
    return int((np.frombuffer(a, np.uint16) == np.frombuffer(b, np.uint16)).sum())


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(x), len(y)))
    if 100 * small < percent * large:
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _by_centre(pairs: DataFrame, rows: DataFrame, value: str, p: NearDup) -> DataFrame:
    """(v, u, value) sorted by v: first the value of v itself, with null u, then those of its partners.

    A v with many partners is dealt to several tasks, each of which gets its value once.
    """
    load = stored(pairs.groupBy("v").agg(F.count("*").alias("n")), "load")
    part = F.pmod(F.xxhash64("u"), F.ceil(F.col("n") / p.partners)).alias("part")
    dealt = stored(split_join(pairs, load, "v", "n").select("u", "v", part), "dealt")
    one = dealt.join(among(rows, dealt.select(F.col("u").alias("doc_id"))).withColumnRenamed("doc_id", "u"), "u").select("v", "part", "u", value)
    two = dealt.select("v", "part").distinct().join(among(rows, dealt.select(F.col("v").alias("doc_id"))).withColumnRenamed("doc_id", "v"), "v")
    both = one.unionByName(two.select("v", "part", F.lit(None).cast("long").alias("u"), value))
    return both.repartition("v", "part").sortWithinPartitions("v", "part", F.col("u").asc_nulls_first()).select("v", "u", value)


def _alike(pairs: DataFrame, sig: DataFrame, p: NearDup) -> DataFrame:
    """The stored pairs (u, v) whose signatures agree well enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            keep = []
            for u, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if u is None:
                    held = x
                keep.append(u is not None and _agreement(x, held) >= p.least_agreement)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (1, 0)], names=["u", "v"])

    return _by_centre(pairs, sig.select("doc_id", "signature"), "signature", p).mapInArrow(run, "u long, v long")


def _confirmed(pairs: DataFrame, texts: DataFrame, p: NearDup) -> DataFrame:
    """The stored pairs (u, v) that are linked by their full shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            keep = []
            for u, x in zip(batch.column(1).to_pylist(), text_bytes(batch.column(2)), strict=True):
                found = shingle_set(word_hashes(x), p.shingle_words)
                if u is None:
                    held = found
                keep.append(u is not None and _linked(found, held, p.percent))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (1, 0)], names=["u", "v"])

    return _by_centre(pairs, texts.select("doc_id", "text"), "text", p).mapInArrow(run, "u long, v long")


def _texts_of(docs: DataFrame, sig: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the nodes ``ids`` of ``sig``, found by number and digest of the text."""
    wanted = ids.distinct().join(sig.select("doc_id", "given_id", "text_key"), "doc_id")
    keyed = docs.select(F.col("doc_id").cast("long").alias("given_id"), F.col("text").cast("string").alias("text"))
    wanted = stored(wanted, "wanted")
    keyed = among(keyed, wanted.select("given_id")).withColumn("text_key", _text_key())
    return keyed.join(wanted, ["given_id", "text_key"]).groupBy("doc_id").agg(F.first("text").alias("text"))


def _text_key() -> Column:
    return F.coalesce(F.concat(F.lit(b"1"), F.unhex(F.md5("text"))), F.lit(b"0"))


def _buckets(reps: DataFrame) -> DataFrame:
    """(key, doc_id, n_shingles, v): members of the buckets that have several, and the smallest of them.

    Nearly all keys are met once: they move once and end there.
    """
    keyed = reps.select("doc_id", "n_shingles", F.explode("band_keys").alias("key"))
    of_key = Window.partitionBy("key")
    met = keyed.select("*", F.min("doc_id").over(of_key).alias("v"), F.max("doc_id").over(of_key).alias("last"))
    return met.where("v < last").drop("last")


def _stars(buckets: DataFrame) -> DataFrame:
    """Each member of a bucket with the smallest document of the bucket."""
    return buckets.where("doc_id <> v").select(F.col("doc_id").alias("u"), "v").distinct()


def _crowded_blocks(buckets: DataFrame, comps: DataFrame, p: NearDup) -> DataFrame:
    """Members of buckets that the stars left in several components, dealt into bounded blocks.

    (block, side, doc_id, comp): pairs across sides, and inside side ``both``, are still unseen.
    The members of the largest component of a bucket are dealt once; all others visit each of
    these blocks, and each other in pairs of blocks.
    """
    at = buckets.join(comps, "doc_id", "left").withColumn("comp", F.coalesce("comp", "doc_id"))
    sizes = at.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    total = sizes.groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("giant"), F.sum("n").alias("members"), F.count("*").alias("comps"), F.max("n").alias("most"), F.sum("s").alias("s"))
    total = total.where("comps > 1 and members > 2")
    mixed = at.join(total, "key")
    parts = lambda n, s: F.greatest(F.ceil(n / p.block), F.ceil(s / p.block_shingles)).cast("int")
    mixed = mixed.withColumn("g", parts(F.col("most"), F.col("s"))).withColumn("o", parts(F.col("members") - F.col("most"), F.col("s")))
    own = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.when(F.col("comp") == F.col("giant"), F.col("g")).otherwise(F.col("o"))).cast("int")
    mixed = mixed.withColumn("own", own)
    giant = mixed.where("comp = giant").select("key", "own", F.explode(F.sequence(F.lit(0), F.col("o") - 1)).alias("other"), F.lit("giant").alias("side"), "doc_id", "comp")
    visits = mixed.where("comp <> giant").select("key", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("own"), F.col("own").alias("other"), F.lit("rest").alias("side"), "doc_id", "comp")
    among = mixed.where("comp <> giant and comps > 2").select("key", F.explode(F.sequence(F.lit(0), F.col("o") - 1)).alias("x"), "own", "doc_id", "comp")
    among = among.select("key", (-1 - F.least("x", "own")).alias("own"), F.greatest("x", "own").alias("other"), F.lit("both").alias("side"), "doc_id", "comp")
    return giant.unionAll(visits).unionAll(among).withColumn("block", F.xxhash64("key", "own", "other")).select("block", "side", "doc_id", "comp")


def _unseen(rows: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a block, the later rows that it must be compared with."""
    side, comp = rows["side"].to_numpy(), rows["comp"].to_numpy()
    order = np.arange(len(rows))
    for i in order[side != "giant"]:
        if side[i] == "both":
            yield i, order[(order > i) & (side == "both") & (comp != comp[i])]
        else:
            yield i, order[(side == "giant") & (comp != comp[i])]


def _rest_links(buckets: DataFrame, comps: DataFrame, docs: DataFrame, sig: DataFrame, p: NearDup) -> DataFrame:
    """Links inside crowded buckets that no star has seen, a spanning set for each block."""

    def promising(rows: pd.DataFrame) -> pd.DataFrame:
        sigs = np.stack([np.frombuffer(x, np.uint16) for x in rows["signature"]])
        hit = np.zeros(len(rows), bool)
        for i, others in _unseen(rows):
            near = others[(sigs[others] == sigs[i]).sum(axis=1) >= p.least_agreement]
            hit[near] = True
            hit[i] |= len(near) > 0
        return rows.loc[hit, ["block", "side", "doc_id", "comp"]]

    def exact(rows: pd.DataFrame) -> pd.DataFrame:
        sigs = np.stack([np.frombuffer(x, np.uint16) for x in rows["signature"]])
        sets = [shingle_set(word_hashes(np.frombuffer(x.encode(), np.uint8)), p.shingle_words) for x in rows["text"]]
        ids, comp, root, out = rows["doc_id"].to_numpy(), rows["comp"].to_numpy(), {}, []

        def find(x):
            while root.get(x, x) != x:
                x = root[x]
            return x

        for i, others in _unseen(rows):
            for j in others[(sigs[others] == sigs[i]).sum(axis=1) >= p.least_agreement]:
                a, b = find(comp[i]), find(comp[j])
                if a != b and _linked(sets[i], sets[j], p.percent):
                    root[max(a, b)] = min(a, b)
                    out.append((ids[i], ids[j]))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    short = sig.select("doc_id", "signature")
    schema = "block long, side string, doc_id long, comp long"
    blocks = stored(_crowded_blocks(buckets, comps, p), "blocks")
    left = stored(blocks.join(among(short, blocks.select("doc_id")), "doc_id").groupBy("block").applyInPandas(promising, schema), "promising")
    if left.isEmpty():
        return left.selectExpr("doc_id as u", "doc_id as v")
    texts = _texts_of(docs, sig, left.select("doc_id"))
    full = left.join(among(short, left.select("doc_id")), "doc_id").join(texts, "doc_id")
    return full.groupBy("block").applyInPandas(exact, "u long, v long")


def _judged(docs: DataFrame, p: NearDup) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) for each distinct (doc_id, text) and null doc_id."""
    raw = stored(signatures(docs, p).withColumnRenamed("doc_id", "given_id").withColumn("doc_id", F.col("given_id")), "signatures")
    sig = raw.where("given_id is not null")
    repeated = stored(sig.groupBy("given_id").agg(F.count("*").alias("n")).where("n > 1").select("given_id"), "repeated")
    if not repeated.isEmpty():
        # Nodes are numbered anew: one for each (doc_id, text).
        order = F.struct("n_shingles", "set_key", "signature", "band_keys")
        nodes = sig.groupBy("given_id", "text_key").agg(F.min(order).alias("x")).select("given_id", "text_key", "x.*")
        sig = stored(nodes.withColumn("doc_id", F.monotonically_increasing_id()), "signatures")
    some = sig.where("n_shingles > 0")
    first = F.min_by(F.struct(*[c for c in some.columns if c != "set_key"]), "doc_id").alias("x")
    reps = stored(some.groupBy("set_key").agg(first).select("set_key", "x.*"), "representatives")
    classes = reps.select("set_key", F.col("doc_id").alias("rep"))
    buckets = stored(_buckets(reps), "buckets")
    stars = stored(_stars(buckets), "stars")
    alike = stored(_alike(stars, reps, p), "alike")
    dropped(stars)
    ids = alike.select(F.col("u").alias("doc_id")).unionAll(alike.select(F.col("v").alias("doc_id")))
    texts = stored(_texts_of(docs, reps, ids), "texts")
    links = stored(_confirmed(alike, texts, p), "links")
    dropped(texts, alike)
    comps = stored(connected_components(links), "components").select(F.col("id").alias("doc_id"), F.col("component").alias("comp"))
    more = stored(_rest_links(buckets, comps, docs, reps, p), "links")
    if not more.isEmpty():
        comps = stored(connected_components(links.unionAll(more)), "components").select(F.col("id").alias("doc_id"), F.col("component").alias("comp"))
    found = classes.join(comps.select(F.col("doc_id").alias("rep"), "comp"), "rep", "left")
    found = found.select("set_key", F.coalesce("comp", "rep").alias("comp"))
    rows = some.select("doc_id", "given_id", "text_key", "n_shingles", "set_key").join(found, "set_key").drop("set_key")
    rows = rows.unionByName(sig.where("n_shingles = 0").select("doc_id", "given_id", "text_key", "n_shingles", F.col("doc_id").alias("comp")))
    if not repeated.isEmpty():
        rows = stored(rows, "rows")
        first = rows.groupBy("comp").agg(F.min(F.struct("given_id", "text_key")).alias("first"), F.count("*").alias("n"))
        rows = split_join(rows, stored(first, "first"), "comp", "n")
        kept = F.struct("given_id", "text_key") == F.col("first")
        rows = rows.select(F.col("given_id").alias("doc_id"), "text_key", "n_shingles", F.col("first.given_id").alias("component_id"), kept.alias("kept"))
    else:
        rows = rows.select("doc_id", "text_key", "n_shingles", F.col("comp").alias("component_id"), F.expr("doc_id = comp").alias("kept"))
    nameless = raw.where("given_id is null").select("doc_id", "text_key", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    return rows.unionAll(nameless)


def near_duplicates(docs: DataFrame, p: NearDup | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each document of ``docs(doc_id, text)``.

    Equal shingle sets are one class first. One document of each class goes on: in each band
    every member of a bucket is compared with the smallest one (signature, then full sets). Where
    that leaves a bucket in several components, the pairs not yet seen are compared in bounded
    blocks, so no link inside a bucket is lost and no list of all pairs is made.

    Null and word-less texts have no shingles and no links. Of rows that repeat doc_id and text one
    is returned; rows that repeat a doc_id with other texts are judged each by its own text, and of
    a component the one with the smallest doc_id and digest is kept. Rows with null doc_id link with
    nothing and come back with null component and kept true. Other columns are ignored.
    """
    return _judged(docs, p or NearDup()).drop("text_key")


def drop_near_duplicates(docs: DataFrame, p: NearDup | None = None) -> DataFrame:
    """``docs`` without the documents that :func:`near_duplicates` does not keep.

    All columns stay. Rows with null doc_id stay. Rows go by doc_id and text: of those that repeat
    both one stays (the first by a hash of all its columns), and one with a text of its own is
    never lost.
    """
    found = _judged(docs, p or NearDup()).where("doc_id is not null")
    gone = found.where("not kept").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    id_name, key_name = free(docs, "__id"), free(docs, "__key")
    gone = stored(gone.toDF(id_name, key_name), "gone")
    near = free(docs, "__near")
    keyed = flagged(docs.withColumn(id_name, F.col("doc_id").cast("long")), gone.select(id_name), near)
    keyed = keyed.withColumn(key_name, _text_key())
    # Only documents that may be among those gone are moved.
    kept = keyed.where(F.col(near)).join(gone, [id_name, key_name], "left_anti").unionByName(keyed.where(~F.col(near))).drop(near)
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept.select(*docs.columns)
    first = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("__row")
    named = kept.where(F.col(id_name).isNotNull()).groupBy(id_name, key_name).agg(first).select("__row.*")
    return named.unionByName(kept.where(F.col(id_name).isNull()).select(*docs.columns))
