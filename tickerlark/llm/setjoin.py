"""Similarity join of shingle sets: skipping inside index lists, and answers derived from similar sets.

Work is saved by what is known of the relations between sets. In an index list, entries of one
size lie together by position, so the first entry that is too late ends its block of the list.
Sets that are highly similar to a pivot keep only how they differ from it, and how much two of
them share follows from the pivot's size and those differences, without meeting the sets again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerlark.llm.bytetext import shingle_set, text_bytes, word_hashes
from tickerlark.llm.components import connected_components
from tickerlark.llm.scratch import among, dropped, stored
from tickerlark.operators.similarity import split_join


#: Tells an added shingle from a removed one.
ADDED = np.int64(0x5555555555555555)


@dataclass(frozen=True)
class SetJoin:
    """Settings. Only the first two change the result, the others the work."""

    shingle_words: int = 4
    percent: int = 85  # linked if 100 * intersection >= percent * union
    member_percent: int = 60  # similarity to a pivot from which a set is kept as differences
    order_buckets: int = 1 << 18  # shingles are ordered by how often their bucket occurs
    block: int = 512  # sets, and
    block_shingles: int = 1_000_000  # differing shingles in a block of a cluster or list
    list_rows: int = 1_000_000  # of an index list sorted by one task
    remembered: int = 1_000_000  # sets by which a task knows copies
    slice_rows: int = 1000  # sets compared with one other set in one task

    def prefix(self, n: int) -> int:
        """Of so many first shingles two linked sets share one."""
        return n - -(-self.percent * n // 100) + 1

    def need(self, sizes: np.ndarray) -> np.ndarray:
        """Shingles that two sets of these sizes together must share."""
        return -(-self.percent * sizes // (100 + self.percent))


def _named(found: np.ndarray, twins: frozenset) -> tuple[int, bytes]:
    """(number, digest) of a set. The number is a half of the digest, the other half for ``twins``."""
    digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
    half = digest[8:] if digest in twins else digest[:8]
    return int.from_bytes(half, "little", signed=True), digest


def _rows(docs: DataFrame, p: SetJoin, twins: frozenset = frozenset()) -> DataFrame:
    """(doc_id, n, id, set_key) of each row of ``docs(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(word_hashes(x), p.shingle_words) for x in text_bytes(batch.column(1))]
            named = [_named(x, twins) for x in found]
            columns = [pa.array([len(x) for x in found], pa.int64()), pa.array([i for i, _ in named], pa.int64()), pa.array([k for _, k in named], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n", "id", "set_key"])

    return docs.mapInArrow(run, "doc_id long, n long, id long, set_key binary")


def _nodes(docs: DataFrame, p: SetJoin, twins: frozenset) -> DataFrame:
    """(id, n, tokens, s0, s1, sketch): the sets of ``docs(text)``, copies inside a task once.

    ``s0`` and ``s1`` are 128 parities of the set's shingles, ``sketch`` as many as shingles or more: two
    sets differ in at least as many shingles as parities.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sets, ids = [], []
            for text in text_bytes(batch.column(0)):
                found = shingle_set(word_hashes(text), p.shingle_words)
                number = _named(found, twins)[0]
                if len(found) and number not in seen:
                    sets.append(found), ids.append(number)
                    seen.add(number)
            if len(seen) > p.remembered:
                seen.clear()
            bits = [np.packbits(np.bincount((x & np.uint64(127)).astype(np.int64), minlength=128) & 1).view(np.int64) for x in sets]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            columns = [pa.array(ids, pa.int64()), pa.array([len(x) for x in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))]
            columns += [pa.array([b[i] for b in bits], pa.int64()) for i in (0, 1)]
            columns.append(pa.array([_parities(x) for x in sets], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "tokens", "s0", "s1", "sketch"])

    return docs.select("text").mapInArrow(run, "id long, n long, tokens array<long>, s0 long, s1 long, sketch binary")


def _parities(tokens: np.ndarray) -> bytes:
    """Parities of the shingles by their lowest bits: a power of two, 128 at least, not below their number."""
    size = 128
    while size < len(tokens):
        size *= 2
    return np.packbits(np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).tobytes()


def _differing(a: bytes, b: bytes) -> int:
    """Parities in which two sketches differ, the longer one folded to the length of the other."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _plausible(pairs: DataFrame, nodes: DataFrame, p: SetJoin) -> DataFrame:
    """The stored pairs (u, v) whose sketches leave room for a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            room = sizes - 2 * p.need(sizes)
            keep = [_differing(a, b) <= r for a, b, r in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), room.tolist(), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    ids = stored(pairs.select(F.col("u").alias("id")).unionAll(pairs.select("v")).distinct(), "ids")
    own = among(nodes.select("id", "n", "sketch"), ids)
    own = stored(own.groupBy("id").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")), "sketches")
    met = pairs.join(own.toDF("u", "nu", "su"), "u").join(own.toDF("v", "nv", "sv"), "v")
    return met.select("u", "v", "nu", "nv", "su", "sv").mapInArrow(run, "u long, v long")


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The arrays of a list column without nulls, without copies."""
    flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
    return [flat[a - ends[0] : b - ends[0]] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _bucket_counts(nodes: DataFrame, p: SetJoin) -> np.ndarray:
    """How many shingles of all sets fall into each of ``order_buckets`` buckets (bounded by it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(p.order_buckets, np.int64)
        for batch in batches:
            count += np.bincount(batch.column(0).flatten().to_numpy() & (p.order_buckets - 1), minlength=p.order_buckets)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], names=["bucket", "n"])

    parts = nodes.select("tokens").mapInArrow(run, "bucket long, n long")
    sums = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(p.order_buckets, np.int64)
    out[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return out


def _postings(nodes: DataFrame, p: SetJoin) -> DataFrame:
    """(token, id, n, pos) of the first shingles of each set, rare ones first, that other sets have too.

    They move once, by shingle, and those met once end there. A shingle whose bucket is very
    frequent is dealt to several tasks and always goes on.
    """
    sent = nodes.sparkSession.sparkContext.broadcast(_bucket_counts(nodes, p))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, found = _lists(batch.column(1)), []
            for tokens in sets:
                order = np.lexsort((tokens, sent.value[tokens & (p.order_buckets - 1)]))
                found.append(tokens[order[: p.prefix(len(tokens))]])
            sizes = np.array([len(x) for x in found], np.int64)
            pos = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            n = np.repeat(np.array([len(x) for x in sets], np.int64), sizes)
            at = np.repeat(np.arange(len(sets)), sizes)
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            parts = 1 + sent.value[flat & (p.order_buckets - 1)] // p.list_rows
            part = np.where(parts > 1, 1 + (batch.column(0).to_numpy()[at] & 0x7FFFFFFF) % parts, 0)
            yield pa.RecordBatch.from_arrays([pa.array(flat), batch.column(0).take(pa.array(at)), pa.array(n << 32 | pos), pa.array(part)], names=["token", "id", "place", "part"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the last row, and whether the one before has its shingle
        for batch in batches:
            rows = [c.to_numpy() for c in batch.columns]
            if not len(rows[0]):
                continue
            before = False
            if held is not None:
                before, rows = held[-1], [np.concatenate(x) for x in zip(held[:-1], rows, strict=True)]
            copy = (rows[0][1:] == rows[0][:-1]) & (rows[1][1:] == rows[1][:-1])
            rows = [x[np.append(True, ~copy)] for x in rows]
            same = rows[0][1:] == rows[0][:-1]
            keep = np.append(same, False) | np.append(before, same) | (rows[3] > 0)
            held = [*[x[-1:].copy() for x in rows], bool(keep[-1])]
            yield out([x[:-1][keep[:-1]] for x in rows])
        if held is not None and held[-1]:
            yield out(held[:-1])

    def out(rows: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1]), pa.array(rows[2] >> 32), pa.array(rows[2] & 0xFFFFFFFF)], names=["token", "id", "n", "pos"])

    prefixes = nodes.select("id", "tokens").mapInArrow(first, "token long, id long, place long, part long")
    dealt = prefixes.repartition("token", "part").sortWithinPartitions("token", "part", "id")
    return dealt.mapInArrow(shared, "token long, id long, n long, pos long")


def _sets_of(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (id, ..) with the tokens of each id's node, which may repeat; they move once, by id."""
    near = among(nodes.select("id", "tokens"), wanted.select("id"))
    return near.groupBy("id").agg(F.first("tokens").alias("tokens")).join(wanted.hint("merge"), "id")


def _compared(pairs: DataFrame, nodes: DataFrame, least: int, p: SetJoin, differences: bool) -> DataFrame:
    """The stored pairs (u, v) of similarity ``least`` percent, and how u differs from v if asked for.

    A set v with many partners is dealt to several tasks; each gets it once, before its partners.
    """
    load = pairs.groupBy("v").agg(F.count("*").alias("rows"))
    part = F.pmod(F.xxhash64("u"), F.ceil(F.col("rows") / p.slice_rows)).alias("part")
    dealt = stored(split_join(pairs, stored(load, "load"), "v", "rows").select("u", "v", part), "dealt")
    both = dealt.select(F.col("u").alias("id"), "v", "part", "u").unionAll(dealt.select(F.col("v").alias("id"), "v", "part", F.lit(None).cast("long")).distinct())
    rows = _sets_of(nodes, both).select("v", "part", "u", "tokens").repartition("v", "part").sortWithinPartitions("v", "part", F.col("u").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for v, u, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _lists(batch.column(2)), strict=True):
                if u is None:
                    held = tokens.copy()
                    continue
                small, large = sorted((len(tokens), len(held)))
                if 100 * small < least * large:
                    continue
                common = np.intersect1d(tokens, held, assume_unique=True)
                if 100 * len(common) < least * (small + large - len(common)):
                    continue
                out[0].append(u), out[1].append(v)
                if differences:
                    out[2].append(np.setdiff1d(held, common, assume_unique=True)), out[3].append(np.setdiff1d(tokens, common, assume_unique=True))
            columns = [pa.array(x, pa.int64()) for x in out[:2]] + [pa.array(x, pa.list_(pa.int64())) for x in out[2:]] * differences
            yield pa.RecordBatch.from_arrays(columns, names=["u", "v", "removed", "added"][: len(columns)])

    schema = "u long, v long, removed array<long>, added array<long>" if differences else "u long, v long"
    out = stored(rows.select("v", "u", "tokens").mapInArrow(run, schema), "compared")
    dropped(dealt)
    return out


def _clusters(lists: DataFrame, nodes: DataFrame, p: SetJoin) -> DataFrame:
    """(id, cluster, removed, added): sets that are near a pivot, and how they differ from it.

    Candidates for the pivot of a set are the two smallest sets of index lists that share most of
    its prefix, an eighth at least. Which are tried only decides what is derived here and what
    is found by the lists.
    """
    size, prefix = F.col("n"), F.col("n") - F.ceil(F.col("n") * p.percent / 100) + 1
    near = (F.col("centre.n") * 100 >= size * p.member_percent) & (size * 100 >= F.col("centre.n") * p.member_percent)
    stars = lists.where((F.col("id") != F.col("centre.id")) & near).groupBy(F.col("id").alias("u"), F.col("centre.id").alias("v"), prefix.alias("prefix"))
    stars = stored(stars.agg(F.count("*").alias("shared")).where("shared * 8 >= prefix"), "stars")
    most = Window.partitionBy("u").orderBy(F.desc("shared"), "v")
    stars = stored(stars.withColumn("rank", F.row_number().over(most)).where("rank <= 2").select("u", "v"), "stars")
    rel = _compared(stars, nodes, p.member_percent, p, True)
    pivots = rel.groupBy("v").agg(F.count("*").alias("rows")).join(rel.select(F.col("u").alias("v")).distinct(), "v", "left_anti")
    own = split_join(rel, stored(pivots, "pivots"), "v", "rows")
    best = F.min_by(F.struct("v", "removed", "added"), F.struct(F.size("removed") + F.size("added"), "v"))
    return own.groupBy("u").agg(best.alias("b")).select(F.col("u").alias("id"), F.col("b.v").alias("cluster"), "b.removed", "b.added")


def _spread(linked: np.ndarray, x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """The smallest index in the component of each of ``n`` rows; ``linked`` says which of x meet which of y."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, x, np.where(linked, label[y][None, :], n).min(axis=1, initial=n))
        np.minimum.at(label, y, np.where(linked, label[x][:, None], n).min(axis=0, initial=n))
        if (label == before).all():
            return label


def _derived(members: DataFrame, copies: DataFrame, sizes: DataFrame, p: SetJoin) -> DataFrame:
    """(id, links, root): links of sets of the same cluster, from their differences alone.

    With X the pivot, r and a what each of Y and Z lacks and adds, they share
    |X| - |rY| - |rZ| + |rY and rZ| + |aY and aZ| shingles. Clusters are dealt into bounded blocks,
    which meet each other. ``root`` connects the sets that are linked in a block.
    """
    pivots = members.select(F.col("cluster").alias("id")).distinct()
    none = F.array().cast("array<long>")
    rows = members.unionByName(pivots.select("id", F.col("id").alias("cluster"), none.alias("removed"), none.alias("added")))
    rows = stored(rows.join(copies, "id"), "members")
    weight = F.sum(F.size("removed") + F.size("added"))
    load = rows.groupBy("cluster").agg(F.count("*").alias("rows"), F.greatest(F.ceil(F.count("*") / p.block), F.ceil(weight / p.block_shingles)).cast("int").alias("parts"))
    load = stored(load.join(sizes.select(F.col("id").alias("cluster"), F.col("n").alias("size")), "cluster"), "clusters")
    rows = split_join(rows, load, "cluster", "rows").withColumn("own", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("cluster", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "size", "id", "copies", "removed", "added")

    def links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, x, y = key
        side, copies, ids = rows["own"].to_numpy(), rows["copies"].to_numpy(), rows["id"].to_numpy()
        one, two = np.flatnonzero(side == x), np.flatnonzero(side == y)
        lacks, adds = rows["removed"].map(len).to_numpy(), rows["added"].map(len).to_numpy()
        cost = 100 * lacks + p.percent * adds
        row = np.concatenate([np.repeat(np.arange(len(rows)), lacks), np.repeat(np.arange(len(rows)), adds)])
        token = np.concatenate([np.zeros(0, np.int64), *rows["removed"], *(x ^ ADDED for x in rows["added"])])
        _, number, count = np.unique(token, return_inverse=True, return_counts=True)
        several = count > 1
        row, number = row[several[number]], (np.cumsum(several) - 1)[number[several[number]]]
        shared = np.zeros((len(one), len(two)), np.float32)
        for a in range(0, int(several.sum()), 4096):
            has = np.zeros((len(rows), 4096), np.float32)
            now = (number >= a) & (number < a + 4096)
            has[row[now], number[now] - a] = 1
            shared += has[one] @ has[two].T
        room = (100 - p.percent) * rows["size"].iloc[0] - cost[one][:, None] - cost[two][None, :]
        linked = (room + (100 + p.percent) * shared.astype(np.int64) >= 0) & (ids[one][:, None] != ids[two][None, :])
        total = np.zeros(len(rows), np.int64)
        total[one] += linked @ copies[two]
        if x != y:
            total[two] += copies[one] @ linked
        return pd.DataFrame({"id": ids, "links": total, "root": ids[_spread(linked, one, two, len(rows))]})

    return rows.groupBy("cluster", "x", "y").applyInPandas(links, "id long, links long, root long")


def _dealt(lists: DataFrame, members: DataFrame, nodes: DataFrame, p: SetJoin) -> DataFrame:
    """(block, id, cluster, n, pos, s0, s1): index lists with sets of several clusters, in bounded blocks.

    A list's sets of its largest cluster are dealt once; all others visit each of these blocks, and
    each other in pairs of blocks.
    """
    own = lists.select("token", "id", "n", "pos").join(members.select("id", "cluster"), "id", "left").withColumn("cluster", F.coalesce("cluster", "id"))
    own = stored(own, "entries")
    of_cluster = own.groupBy("token", "cluster").agg(F.count("*").alias("rows"))
    load = of_cluster.groupBy("token").agg(F.max_by("cluster", F.struct("rows", "cluster")).alias("giant"), F.sum("rows").alias("rows"), F.max("rows").alias("most"), F.count("*").alias("clusters"))
    load = stored(load.where("clusters > 1"), "mixed")
    rows = split_join(own, load, "token", "rows")
    rows = rows.withColumn("g", F.ceil(F.col("most") / p.block).cast("int")).withColumn("o", F.ceil((F.col("rows") - F.col("most")) / p.block).cast("int"))
    of_giant, small = F.col("cluster") == F.col("giant"), F.col("rows") <= p.block
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id", F.lit(7)), F.when(of_giant, F.col("g")).otherwise(F.col("o"))).cast("int"))
    at = lambda x, y, kind: F.xxhash64("token", F.lit(kind), x, y).alias("block")
    carried = ["id", "cluster", "n", "pos"]
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias("x")
    whole = rows.where(small).select(F.xxhash64("token").alias("block"), *carried)
    large = rows.where(~small)
    giant = large.where(of_giant).select("token", upto("o"), "own", *carried).select(at("own", "x", 0), *carried)
    visits = large.where(~of_giant).select("token", upto("g"), "own", *carried).select(at("x", "own", 0), *carried)
    among = large.where(~of_giant & (F.col("clusters") > 2)).select("token", upto("o"), "own", *carried)
    among = among.select(at(F.least("x", "own"), F.greatest("x", "own"), 1), *carried)
    return whole.unionAll(giant).unionAll(visits).unionAll(among).join(nodes.groupBy("id").agg(F.min("s0").alias("s0"), F.min("s1").alias("s1")), "id")


def _candidates(dealt: DataFrame, p: SetJoin) -> DataFrame:
    """(u, v) of different clusters that can be linked, from index lists in order of size and position."""

    def met(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        block, ids, cluster, n, pos, s0, s1 = rows
        size_ends = np.append(np.flatnonzero((block[1:] != block[:-1]) | (n[1:] != n[:-1])) + 1, len(n))
        size_end = np.repeat(size_ends, np.diff(size_ends, prepend=0))
        i, j, us, vs = np.arange(len(n)), np.arange(1, len(n) + 1), [], []
        while True:
            inside = j < len(n)
            i, j = i[inside], j[inside]
            # The list ends, or its sets have become too large: as do all that follow.
            open_ = (block[j] == block[i]) & (100 * n[i] >= p.percent * n[j])
            i, j = i[open_], j[open_]
            if not len(i):
                return np.concatenate([np.zeros(0, np.int64), *us]), np.concatenate([np.zeros(0, np.int64), *vs])
            need = p.need(n[i] + n[j])
            open_ = pos[i] <= n[i] - need  # else too late for this size, and more so for larger ones
            i, j, need = i[open_], j[open_], need[open_]
            late = pos[j] > n[j] - need  # as is the rest of the block of this size
            differing = np.bitwise_count(s0[i] ^ s0[j]).astype(np.int64) + np.bitwise_count(s1[i] ^ s1[j])
            hit = ~late & (cluster[i] != cluster[j]) & (differing <= n[i] + n[j] - 2 * need)
            us.append(ids[i[hit]]), vs.append(ids[j[hit]])
            j = np.where(late, size_end[j], j + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None  # the last block of the rows so far, which may go on

        def out(rows: list[np.ndarray]) -> pa.RecordBatch:
            u, v = met(rows)
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])

        for batch in batches:
            rows = [c.to_numpy() for c in batch.columns[:5]] + [c.to_numpy().view(np.uint64) for c in batch.columns[5:]]
            rows = rows if kept is None else [np.concatenate(x) for x in zip(kept, rows, strict=True)]
            if not len(rows[0]):
                continue
            at = int(np.searchsorted(rows[0], rows[0][-1]))
            kept = [x[at:].copy() for x in rows]
            if at:
                yield out([x[:at] for x in rows])
        if kept is not None and len(kept[0]):
            yield out(kept)

    ordered = dealt.select("block", "id", "cluster", "n", "pos", "s0", "s1").repartition("block").sortWithinPartitions("block", "n", "pos", "id")
    return ordered.mapInArrow(run, "u long, v long").distinct()


def set_similarity_join(docs: DataFrame, p: SetJoin | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for each row of ``docs(doc_id, text)``.

    Two rows link if 100 * intersection >= ``percent`` * union of their shingle sets. Equal sets are
    one class, whose copies link with each other and are counted, not listed. Sets near a pivot get
    their links from their differences; pairs of different clusters are found in index lists,
    which lose no pair, and confirmed on full sets. ``component_id`` is the smallest doc_id
    reachable by links, ``n_links`` the number of other rows that a row links with.

    Null and word-less texts have no shingles and no links. Rows that repeat a doc_id are judged
    each by its own text. Rows with null doc_id link with nothing and come back with null
    component. Other columns are ignored; an empty table gives no rows.
    """
    p = p or SetJoin()
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows, twins = stored(_rows(given, p), "rows"), frozenset()
    some = rows.where("doc_id is not null and n > 0")
    # Different sets of one number: by chance 70 of them in 5 * 10**10 documents, so they fit a message.
    doubled = some.groupBy("id").agg(F.min("set_key").alias("a"), F.max("set_key").alias("b")).where("a <> b").select("id")
    if not (doubled := stored(doubled, "doubled")).isEmpty():
        twins = frozenset(bytes(r["set_key"]) for r in some.join(doubled, "id").select("set_key").distinct().collect())
        rows = stored(_rows(given, p, twins), "rows")
        some = rows.where("doc_id is not null and n > 0")
    classes = stored(some.groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.min("n").alias("n")), "classes")
    nodes = stored(_nodes(given.where("doc_id is not null"), p, twins), "nodes")
    postings = stored(_postings(nodes, p), "postings")
    several = postings.groupBy("token").agg(F.count("*").alias("rows"), F.min(F.struct("id", "n")).alias("centre")).where("rows > 1")
    lists = stored(split_join(postings, stored(several, "tokens"), "token", "rows"), "lists")
    dropped(postings)
    members = stored(_clusters(lists, nodes, p), "members")
    derived = stored(_derived(members, classes.select("id", "copies"), classes.select("id", "n"), p), "derived")
    candidates = stored(_candidates(_dealt(lists, members, nodes, p), p), "candidates")
    candidates = stored(_plausible(candidates, nodes, p), "plausible")
    links = _compared(candidates, nodes, p.percent, p, False)
    dropped(nodes, lists)
    weight = classes.select("id", "copies")
    both = links.select(F.col("u").alias("id"), F.col("v").alias("other")).unionAll(links.select(F.col("v").alias("id"), F.col("u").alias("other")))
    across = both.join(weight.withColumnRenamed("id", "other"), "other").select("id", F.col("copies").alias("links"))
    n_links = derived.select("id", "links").unionAll(across).groupBy("id").agg(F.sum("links").alias("links"))
    edges = derived.select(F.col("id").alias("u"), F.col("root").alias("v")).unionAll(links)
    comps = stored(connected_components(edges), "components")
    at = classes.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))
    at = stored(at.join(n_links, "id", "left").select("id", "doc_id", "copies", "component", F.coalesce("links", F.lit(0)).alias("links")), "at")
    least = at.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("sets"))
    final = stored(split_join(at, stored(least, "least"), "component", "sets").select("id", "copies", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links")), "final")
    linked = split_join(some.select("doc_id", "n", "id"), final, "id", "copies").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")
    zero = F.lit(0).cast("long").alias("n_links")
    rest = rows.where("doc_id is null or n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), zero)
    return linked.unionByName(rest)
