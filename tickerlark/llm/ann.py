"""Approximate nearest neighbours by cosine: multiprobe p-stable hashing, exact reranking."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerlark.llm.bytetext import mix
from tickerlark.llm.scratch import stored
from tickerlark.llm.topk import whole

ROW = "bucket long, vec_id long, v array<double>"
FOUND = "query_id long, vec_id long, score double"

#: A hash sample takes a share of so many slots; enough for shares of a few in 10**12 rows.
SLOTS = 1 << 50


@dataclass(frozen=True)
class AnnSettings:
    tables: int = 2
    widths: tuple[float, ...] = (1.5, 2.0, 3.0, 4.0)  # of a cell, tried where a unit vector's projection has variance 1
    per_bucket: int = 256  # the number of hashes of a table grows with the logarithm of rows / per_bucket
    target: float = 0.98  # share of the sample's neighbours that the probes must reach, else fewer hashes are taken
    sample: int = 4000  # vectors, in expectation, from which the number of probes is fitted
    sample_queries: int = 200
    most_probes: int = 4096
    exact_rows: int = 4096  # that a task compares with a block of queries where no buckets are used
    block: int = 1024  # rows, or queries, of a bucket that one task multiplies at a time
    seed: int = 5


@dataclass(frozen=True)
class Hashes:
    """floor((a . x + b) / width) for each table and hash; vectors are brought to length 1 first."""

    a: np.ndarray  # tables, hashes, dims
    b: np.ndarray  # tables, hashes
    width: float
    probes: int

    def places(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables, hashes): place along each projection in cells."""
        return (np.einsum("nd,thd->nth", x, self.a) + self.b) / self.width


def unit(v: np.ndarray) -> np.ndarray:
    """Rows brought to length 1, also where squares would leave the range of doubles."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def bucket_keys(cells: np.ndarray, table: int) -> np.ndarray:
    """One number for each row of cells of a table."""
    key = np.full(len(cells), table + 1, np.uint64)
    for column in cells.T:
        key = mix(key * np.uint64(31) + column.astype(np.int64).view(np.uint64))
    return key.view(np.int64)


def probe_cells(place: np.ndarray, most: int) -> np.ndarray:
    """Cells in order of estimated success: the own cell, then sets of steps to neighbours.

    A step costs the squared distance to the wall it crosses; sets of steps come from a heap by
    shifting or extending their last member, cheapest first; a set with both steps of one hash
    is passed over.
    """
    cell = np.floor(place)
    inside = place - cell
    cost = np.concatenate([inside, 1 - inside]) ** 2
    order = np.argsort(cost, kind="stable")
    hashes, n = len(place), len(cost)
    out, heap = [cell], [(cost[order[0]], (0,))]
    while heap and len(out) < most:
        total, steps = heapq.heappop(heap)
        last = steps[-1]
        if last + 1 < n:
            ahead = cost[order[last + 1]]
            heapq.heappush(heap, (total - cost[order[last]] + ahead, (*steps[:-1], last + 1)))
            heapq.heappush(heap, (total + ahead, (*steps, last + 1)))
        moved = [order[i] for i in steps]
        if len({m % hashes for m in moved}) == len(moved):
            near = cell.copy()
            for m in moved:
                near[m % hashes] += -1 if m < hashes else 1
            out.append(near)
    return np.stack(out)


def fit(sample: np.ndarray, rows: int, k: int, s: AnnSettings) -> Hashes | None:
    """Draw the projections; set width, tables, hashes and probes by exact neighbours inside the sample.

    For each width and number of tables: the most hashes of which ``most_probes`` reach the target
    share of the sample's neighbours. Of those the choice whose probes visit the fewest distinct
    rows. Neighbours among all rows are nearer than those in the sample, so they are reached at least as
    often. None if the sample is too small to tell, or nothing reaches the target: then each
    query is compared with all rows.
    """
    rng = np.random.default_rng(s.seed)
    most_hashes = max(2, round(math.log(max(2, rows / s.per_bucket)) / math.log(3)))
    a = rng.normal(size=(s.tables, most_hashes, sample.shape[1]))
    b = rng.uniform(0, 1, (s.tables, most_hashes))
    if len(sample) < 2:
        return None
    x = unit(sample)
    asked, best = min(len(x), s.sample_queries), []
    for q in range(asked):
        near = x @ x[q]
        near[q] = -2
        best.append(np.argsort(-near, kind="stable")[: min(k, len(x) - 1)])
    best, chosen = np.stack(best), None
    for tables in range(s.tables, 0, -1):
        for width in s.widths:
            found = _reaching(x, best, a[:tables], b[:tables] * width, width, s)
            if found is not None and (chosen is None or found[0] < chosen[0]):
                chosen = found
    return chosen and chosen[1]


def _reaching(x: np.ndarray, best: np.ndarray, a: np.ndarray, b: np.ndarray, width: float, s: AnnSettings) -> tuple[float, Hashes] | None:
    """The share of rows that probes visit, and the hashes, for one width; ``best`` are the neighbours of the first rows."""
    tables, asked = len(a), len(best)
    for hashes in range(a.shape[1], 0, -1):
        most = min(3**hashes, s.most_probes)
        h = Hashes(a[:, :hashes], b[:, :hashes], width, most)
        places = h.places(x)
        cells = np.floor(places)
        steps = np.abs(cells[best] - cells[:asked, None]).max(axis=3)
        if (steps <= 1).any(axis=2).mean() < s.target:
            continue  # more than a cell away in each table: no probe gets there
        probed = [[probe_cells(places[q, t], most) for t in range(tables)] for q in range(asked)]
        ranks = np.full(best.shape, most)
        for q, t in np.ndindex(asked, tables):
            order = {c.tobytes(): i for i, c in enumerate(probed[q][t])}
            ranks[q] = np.minimum(ranks[q], [order.get(cells[i, t].tobytes(), most) for i in best[q]])
        last = int(np.sort(ranks, axis=None)[math.ceil(s.target * ranks.size) - 1])
        if last == most:
            continue
        keys = [bucket_keys(cells[:, t], t) for t in range(tables)]
        seen = lambda q: np.logical_or.reduce([np.isin(keys[t], bucket_keys(probed[q][t][: last + 1], t)) for t in range(tables)])  # noqa: B023, E731
        return float(np.mean([seen(q).mean() for q in range(asked)])), Hashes(h.a, h.b, width, last + 1)
    return None


def _cosines(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Row by row in the same order of additions, so that equal vectors score the same."""
    dots = np.stack([(v * row).sum(axis=1) for row in q])
    return dots / (np.sqrt((q * q).sum(axis=1))[:, None] * np.sqrt((v * v).sum(axis=1))[None])


def _in_range(x: np.ndarray) -> np.ndarray:
    """Rows brought into range where squares would leave it; no cosine depends on their length."""
    size = np.abs(x).max(axis=1)
    return x if size.min() > 1e-100 and size.max() < 1e100 else unit(x)


def _rerank(k: int):
    """For one block: each query against the rows of the buckets it visits, the k best in all."""

    def run(key: tuple, q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if q.empty or v.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        v = v.sort_values("vec_id")
        ids, asked, bucket = v["vec_id"].to_numpy(), q["query_id"].to_numpy(), v["bucket"].to_numpy()
        a, b = _in_range(np.stack(q["asked"])), _in_range(np.stack(v["v"]))
        rough = unit(a) @ unit(b).T
        places, scores = [], []
        for i, visited in enumerate(q["buckets"]):
            seen = np.flatnonzero(np.isin(bucket, visited) & (ids != asked[i]))
            seen = seen[np.unique(ids[seen], return_index=True)[1]]  # once, if several tables offer it
            row = rough[i, seen]
            least = np.partition(row, len(row) - k)[len(row) - k] - 1e-9 if len(row) > k else -2.0
            at = seen[row >= least]
            score = _cosines(a[i : i + 1], b[at])[0]
            first = np.lexsort((ids[at], -score))[:k]
            places.append(at[first]), scores.append(score[first])
        asked = np.repeat(asked, [len(p) for p in places])
        return pd.DataFrame({"query_id": asked, "vec_id": ids[np.concatenate(places)], "score": np.concatenate(scores)})

    return run


def _hashed(vectors: DataFrame, h: Hashes, probing: bool) -> DataFrame:
    sent = vectors.sparkSession.sparkContext.broadcast(h)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h = sent.value
        for batch in batches:
            for i in range(0, len(batch), 64 if probing else 4096):
                part = batch.iloc[i : i + (64 if probing else 4096)]
                places = h.places(unit(np.stack(part["v"])))
                for t in range(h.a.shape[0]):
                    if probing:
                        cells = [probe_cells(p, h.probes) for p in places[:, t]]
                        keys = bucket_keys(np.concatenate(cells), t)
                        yield part.iloc[np.repeat(np.arange(len(part)), [len(c) for c in cells])].assign(bucket=keys)[["bucket", "vec_id"]]
                    else:
                        yield part.assign(bucket=bucket_keys(np.floor(places[:, t]), t))[["bucket", "vec_id"]]

    return vectors.select("vec_id", "v").mapInPandas(run, "bucket long, vec_id long")


def _compared(queries: DataFrame, n: int, base: DataFrame, rows: int, k: int, s: AnnSettings) -> DataFrame:
    """``queries(query_id, asked)``, n of them, against all rows of their length, in blocks of rows and queries."""
    parts, tiles = math.ceil(rows / s.exact_rows), math.ceil(n / s.block)
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda c, n: F.pmod(F.xxhash64(c, F.lit(2)), F.lit(n)).cast("int")
    q = queries.select("query_id", "asked", upto(parts).alias("part"), own("query_id", tiles).alias("tile"))
    q = q.select("query_id", "asked", F.size("asked").alias("q_dims"), F.col("part").alias("q_part"), F.col("tile").alias("q_tile"), F.array(F.col("part").cast("long")).alias("buckets"))
    v = base.select("vec_id", "v", own("vec_id", parts).alias("part"), upto(tiles).alias("tile")).withColumn("bucket", F.col("part").cast("long"))
    v = v.withColumn("dims", F.size("v"))
    return q.groupBy("q_dims", "q_part", "q_tile").cogroup(v.groupBy("dims", "part", "tile")).applyInPandas(_rerank(k), FOUND)


def _completed(found: DataFrame, queries: DataFrame, base: DataFrame, rows: int, k: int, s: AnnSettings) -> DataFrame:
    """For queries whose probes met fewer than k rows: all rows."""
    have = found.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n"))
    short = queries.join(have, "query_id", "left").where(F.coalesce("n", F.lit(0)) < min(k, rows - 1))
    short = stored(short.select("query_id", "asked"), "short")
    n = short.count()
    return found.unionAll(_compared(short, n, base, rows, k, s)) if n else found


def _probed(base: DataFrame, every: int, rows: int, h: Hashes, k: int, s: AnnSettings) -> DataFrame:
    """The k best of each query among the rows of the buckets it visits, by block."""
    index = stored(_hashed(base, h, False), "index")
    asked = stored(_hashed(base.where(F.pmod("vec_id", F.lit(every)) == 0), h, True), "probes")
    sizes = index.groupBy("bucket").agg(F.ceil(F.count("*") / s.block).cast("int").alias("parts"))
    wanted = asked.groupBy("bucket").agg(F.ceil(F.count("*") / s.block).cast("int").alias("tiles"))
    blocks = stored(sizes.join(wanted, "bucket"), "blocks")
    groups = max(1, math.ceil(s.tables * rows / (4 * s.block)))
    blocks = blocks.withColumn("group", F.when(F.expr("parts = 1 and tiles = 1"), F.pmod(F.xxhash64("bucket"), F.lit(groups))))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col(n)).cast("int")
    block = F.coalesce("group", F.xxhash64("bucket", "part", "tile")).alias("block")
    v = index.join(blocks, "bucket").select("bucket", "group", own("parts").alias("part"), upto("tiles").alias("tile"), "vec_id")
    v = v.select(block, "bucket", "vec_id").join(base, "vec_id")
    q = asked.join(blocks, "bucket").select("bucket", "group", upto("parts").alias("part"), own("tiles").alias("tile"), "vec_id")
    q = q.select(block, "bucket", F.col("vec_id").alias("query_id")).groupBy("block", "query_id").agg(F.collect_list("bucket").alias("buckets"))
    q = q.join(base.select(F.col("vec_id").alias("query_id"), F.col("v").alias("asked")), "query_id")
    return q.groupBy("block").cogroup(v.groupBy("block")).applyInPandas(_rerank(k), FOUND)


def nearest(vectors: DataFrame, every: int, k: int = 5, s: AnnSettings | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each query of ``vectors(vec_id, embedding)``.

    Queries are the rows whose vec_id is divisible by ``every``; candidates all other rows of the
    same length. Score is the cosine in double precision on the original vectors, ties
    go to the smaller vec_id. Vectors that are null, zero, or hold nulls or non-finite numbers
    take no part, nor do rows without vec_id; of rows that repeat a vec_id the one with the
    smallest vector counts. No rows give no rows; a query gets k rows, or all others if there are
    fewer: one whose probes meet fewer than k is compared with all rows. Vectors of another length
    than the most frequent one are compared with all rows of their length.

    Every row is indexed in each table. A bucket of many rows or queries is cut into blocks by
    hashes, so a vector that is very common is spread over tasks; small buckets share a block.
    Each block is one bounded product, and the k best of each query go on: candidates are never
    listed as pairs.
    """
    s = s or AnnSettings()
    base = vectors.where(F.col("vec_id").isNotNull() & whole("embedding") & F.exists("embedding", lambda x: x != 0))
    base = base.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    base = stored(base.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    lengths = base.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return base.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, rows = lengths[0]
    whole_base, base = base, base.where(F.size("v") == dims)
    share = int(SLOTS * min(1.0, s.sample / rows))
    sample = base.where(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(SLOTS)) < share).orderBy("vec_id").toPandas()
    h = fit(np.stack(sample["v"]) if len(sample) else np.ones((1, dims)), rows, k, s)
    asked = lambda rows: rows.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), F.col("v").alias("asked"))
    queries = asked(base)
    if h is None:
        found = _compared(queries, max(1, queries.count()), base, rows, k, s)
    else:
        found = _completed(stored(_probed(base, every, rows, h, k, s), "found"), queries, base, rows, k, s)
    odd = whole_base.where(F.size("v") != dims)
    if n_odd := asked(odd).count():
        found = found.unionAll(_compared(asked(odd), n_odd, odd, odd.count(), k, s))
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
