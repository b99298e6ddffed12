"""Exact top-k by inner product: tiles of queries against shards, merged in a tree."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LIST = "query_id long, shard long, vec_id long, score long"
LONG = 2**63 - 1


def whole(vector: str):
    """True if neither the vector nor a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | x.isin(float("inf"), float("-inf")))
    return F.col(vector).isNotNull() & ~bad


def _whole_number(x):
    """floor as a double; numbers from 2**53 on are whole already and don't fit floor's long."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer products of rows of whole numbers held as doubles."""
    if q.shape[1] == 0:
        return np.zeros((len(q), len(v)), np.int64)
    if q.shape[1] * np.abs(q).max() * np.abs(v).max() < 2**53:
        return (q @ v.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    out = exact(q) @ exact(v).T
    return np.vectorize(lambda x: min(LONG, max(-LONG, x)), otypes=[np.int64])(out)


def best(found: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
    """Places of each row's k highest scores, ties to the smaller id, without the row's own id.

    ``ids`` rises. k + 1 are selected by partition; all that tie with the last of them are looked at.
    """
    out, n = [], found.shape[1]
    for row, me in zip(found, own, strict=True):
        at = np.flatnonzero(row >= np.partition(row, n - k - 1)[n - k - 1]) if n > k + 1 else np.arange(n)
        at = at[ids[at] != me]
        out.append(at[np.lexsort((ids[at], -row[at]))][:k])
    return out


def top_products(vectors: DataFrame, every: int, k: int = 5, scale: int = 256, shard_rows: int = 4096, tile_rows: int = 512) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors(vec_id, embedding)`` with the highest product.

    Components are floor(scale * x). Queries are the rows whose vec_id is divisible by ``every``;
    each is compared with all other rows of its length. Ties go to the smaller vec_id; a query
    with fewer than k others gets all. Vectors that are null or hold nulls or non-finite numbers
    take no part, nor do rows without vec_id; of rows that repeat a vec_id the one with the
    smallest vector counts. Products beyond a long are cut to its range. No rows give no rows.

    Rows are dealt into shards by a hash, queries into tiles; each (tile, shard) pair is one
    bounded matrix product that returns at most k rows for a query. The lists of eight shards
    at a time are merged until one is left, so no task gets all lists of a large query set.
    """
    base = vectors.where(F.col("vec_id").isNotNull() & whole("embedding"))
    base = base.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: _whole_number(x.cast("double") * scale)).alias("v"))
    base = base.groupBy("vec_id").agg(F.min("v").alias("v"))
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    n, asked = base.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    shards, tiles = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(asked / tile_rows))
    dims = F.size("v").alias("dims")
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard")
    tile = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(tiles)).alias("tile")
    rows = base.select("vec_id", "v", dims, shard, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))).alias("tile"))
    every_shard = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard")
    queries = base.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("asked"), dims, tile, every_shard)
    queries = queries.withColumnsRenamed({k: f"q_{k}" for k in ("tile", "shard", "dims")})

    def product(key: tuple, q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if q.empty or v.empty:
            return pd.DataFrame({"query_id": [], "shard": [], "vec_id": [], "score": []}, dtype="int64")
        v = v.sort_values("vec_id")
        asked, ids = q["query_id"].to_numpy(), v["vec_id"].to_numpy()
        found = scores(np.stack(q["asked"]).astype(float), np.stack(v["v"]).astype(float))
        places = best(found, ids, asked, k)
        row = np.repeat(np.arange(len(q)), [len(p) for p in places])
        at = np.concatenate(places)
        return pd.DataFrame({"query_id": asked[row], "shard": int(key[1]), "vec_id": ids[at], "score": found[row, at]})

    keys = ("tile", "shard", "dims")
    lists = queries.groupBy(*[f"q_{k}" for k in keys]).cogroup(rows.groupBy(*keys)).applyInPandas(product, LIST)
    order = (F.col("score").desc(), F.col("vec_id"))
    while shards > 8:
        shards = math.ceil(shards / 8)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / 8))
        merged = Window.partitionBy("query_id", "shard").orderBy(*order)
        lists = lists.withColumn("rank", F.row_number().over(merged)).where(F.col("rank") <= k).drop("rank")
    last = Window.partitionBy("query_id").orderBy(*order)
    return lists.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
