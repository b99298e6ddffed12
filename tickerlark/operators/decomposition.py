"""Principal components of a sparse matrix whose rows and columns are both too many for one machine.

Subspace iteration on ``A'A`` with A the centred matrix. The matrix stays a long table of entries in
blocks of rows; the right factor is a table with a row of ``width`` numbers per column of A. Only
matrices of ``width`` x ``width`` reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlark.session import discard, materialise


@dataclass(frozen=True)
class Svd:
    """Settings. More columns than ``k`` and more steps bring the values closer."""

    oversample: int = 10
    steps: int = 4  # at most, and
    tolerance: float = 1e-4  # the largest relative change of a singular value at which they end
    block_entries: int = 250_000  # entries multiplied at once
    fan_in: int = 64  # triangles merged at once


def _names(width: int) -> list[str]:
    return [f"z{i}" for i in range(width)]


def _schema(key: str, width: int) -> str:
    return ", ".join([key, *(f"{z} double" for z in _names(width))])


def _blocks(entries: DataFrame, p: Svd) -> DataFrame:
    """(block, rows, columns, sums, row, column, value): the entries in blocks, a row of arrays for each.

    All entries of a row are in one block, by row. ``row`` and ``column`` are places in ``rows`` and
    ``columns``, the names met in the block; ``sums`` are those of its columns.
    """
    n = entries.count()
    block = F.pmod(F.xxhash64("row"), F.lit(max(1, -(-n // p.block_entries))))

    def packed(table: pa.Table) -> pa.Table:
        row, column = (table[c].combine_chunks().dictionary_encode("encode") for c in ("row", "column"))
        value, at, to = table["value"].to_numpy(), row.indices.to_numpy(), column.indices.to_numpy()
        order = np.argsort(at, kind="stable")
        sums = np.bincount(to, value)
        arrays = [row.dictionary, column.dictionary, pa.array(sums), *(pa.array(x[order]) for x in (at, to, value))]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in arrays]
        return pa.Table.from_arrays([table["block"].combine_chunks()[:1], *lists], names=["block", "rows", "columns", "sums", "row", "column", "value"])

    schema = f"block bigint, rows array<{dict(entries.dtypes)['row']}>, columns array<string>, sums array<double>, row array<int>, column array<int>, value array<double>"
    return materialise(entries.withColumn("block", block.cast("bigint")).groupBy("block").applyInArrow(packed, schema))


def _places(blocks: DataFrame) -> DataFrame:
    """(block, row, column, value, n): the numbers of each block, without names; ``n`` counts its columns."""
    return blocks.select("block", "row", "column", "value", F.size("columns").alias("n"))


def _times(block: pd.DataFrame, factor: pd.DataFrame, turn: np.ndarray, shift: np.ndarray, width: int) -> np.ndarray:
    """The rows of a block times the factor."""
    row, column, value = (block[c].iloc[0] for c in ("row", "column", "value"))
    dense = np.zeros((int(block["n"].iloc[0]), turn.shape[1]))
    dense[factor["pos"].to_numpy()] = factor[_names(width)].to_numpy() @ turn
    return np.add.reduceat(value[:, None] * dense[column], np.flatnonzero(np.diff(row, prepend=-1)), axis=0) - shift


def _multiplied(blocks: DataFrame, needed: DataFrame, factor: DataFrame, turn: np.ndarray, shift: np.ndarray) -> DataFrame:
    """(column, sum, z..): A'Y for Y = A * factor * turn - shift, and the column sums of A.

    Rows of no column hold Y'Y (column null, ``at`` its row) and the sums of Y (``at`` = -1).
    """
    width = turn.shape[1]

    def product(block: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(block):
            return pd.DataFrame(columns=["column", "at", "sum", *_names(width)])
        y = _times(block, own, turn, shift, width)
        row, column, value = (block[c].iloc[0] for c in ("row", "column", "value"))
        order = np.argsort(column, kind="stable")
        starts = np.flatnonzero(np.diff(column[order], prepend=-1))
        back = np.add.reduceat(value[order][:, None] * y[row[order]], starts, axis=0)[own["pos"].to_numpy()]
        gram = np.vstack([y.T @ y, y.sum(axis=0)])
        out = pd.DataFrame(np.vstack([back, gram]), columns=_names(width))
        out.insert(0, "column", [*own["column"], *[None] * (width + 1)])
        out.insert(1, "at", [0] * len(own) + [*range(width), -1])
        out.insert(2, "sum", np.append(own["sum"].to_numpy(), np.zeros(width + 1)))
        return out

    met = needed.join(factor.drop("sum"), "column")
    parts = _places(blocks).groupBy("block").cogroup(met.groupBy("block")).applyInPandas(product, _schema("column string, at int, sum double", width))
    return parts.groupBy("column", "at").agg(*[F.sum(c).alias(c) for c in ["sum", *_names(width)]])


def _triangle(factor: DataFrame, n: int, ones: np.ndarray, width: int, p: Svd) -> tuple[np.ndarray, np.ndarray]:
    """The triangle of the factor's QR decomposition, by a tree of QRs, and its product with the column means."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, c = np.zeros((0, width)), np.zeros(width)
        for batch in batches:
            z = np.stack([batch.column(i + 1).to_numpy() for i in range(width)], axis=1)
            mean = batch.column(0).to_numpy() / n
            z = z - mean[:, None] * ones
            r, c = np.linalg.qr(np.vstack([r, z]), "r"), c + mean @ z
        yield triangle(r, c)

    def triangle(r: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.ravel().tolist()]), pa.array([c.tolist()])], names=["r", "c"])

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        r = np.linalg.qr(np.vstack([np.reshape(x, (-1, width)) for x in rows["r"]]), "r")
        return pd.DataFrame({"r": [r.ravel()], "c": [np.sum([*rows["c"]], axis=0)]})

    schema = "r array<double>, c array<double>"
    level = factor.select("sum", *_names(width)).mapInArrow(local, schema)
    level = materialise(level)
    while (left := level.count()) > p.fan_in:
        group = F.pmod(F.xxhash64("r"), F.lit(-(-left // p.fan_in)))
        level = materialise(level.groupBy(group).applyInPandas(merge, schema))
    rows = level.toPandas()
    r = np.linalg.qr(np.vstack([np.reshape(x, (-1, width)) for x in rows["r"]]), "r")
    return r, np.sum([*rows["c"]], axis=0)


def _random_factor(columns: DataFrame, width: int) -> DataFrame:
    """A row of even numbers around 0 for each column, the same in each run."""
    spread = [(F.xxhash64("column", F.lit(i)) / F.lit(2.0**63)).alias(z) for i, z in enumerate(_names(width))]
    return columns.select("column", "sum", *spread)


def principal_components(entries: DataFrame, k: int, rows: int | None = None, p: Svd | None = None) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Scores (row, components array) of the centred matrix, its ``k`` largest singular values, and
    the score of every row without entries.

    ``entries`` is (row, column string, value), each place once; what is missing is zero. ``rows``
    counts rows without entries too (default: rows with entries only). Each component's sign
    makes the sum of cubes of its column weights positive. With fewer columns than ``k`` there
    are as many components as columns. An empty matrix gives no scores.

    A step moves each column's numbers once to each block that has it, and the sums back. Nothing of
    the size of rows or columns squared exists anywhere.
    """
    p = p or Svd()
    blocks = _blocks(entries.select("row", F.col("column").cast("string").alias("column"), F.col("value").cast("double").alias("value")), p)
    named = blocks.select(F.coalesce(F.sum(F.size("rows")), F.lit(0))).first()[0]
    n = rows if rows is not None else named
    zipped = F.arrays_zip(F.col("columns").alias("column"), F.col("sums").alias("sum"))
    needed = materialise(blocks.select("block", F.posexplode(zipped).alias("pos", "x")).select("block", "pos", "x.column", "x.sum"))
    columns = materialise(needed.groupBy("column").agg(F.sum("sum").alias("sum")))
    width = min(k + p.oversample, columns.count())
    if not width:
        return blocks.select(F.explode("rows").alias("row"), F.array().cast("array<double>").alias("components")), np.zeros(0), np.zeros(0)
    factor = materialise(_random_factor(columns, width))
    empty = n - named
    ones, before = np.zeros(width), np.zeros(min(k, width))
    for _ in range(max(1, p.steps)):
        shift, turn = _turned(factor, n, ones, width, p)
        product = materialise(_multiplied(blocks, needed, _centred(factor, n, ones, width), turn, shift))
        ones, value, _ = _ritz(product, shift, empty, width)
        discard(factor)
        factor = materialise(product.filter("column IS NOT NULL").drop("at"))
        now = value[: len(before)]
        if (np.abs(now - before) <= p.tolerance * np.maximum(now, 1e-300)).all():
            break
        before = now
    return _scores(blocks, needed, factor, n, ones, min(k, width), width, p, empty)


def _turned(factor: DataFrame, n: int, ones: np.ndarray, width: int, p: Svd) -> tuple:
    """(shift, turn): factor * turn has orthonormal columns, shift is its product with the means."""
    triangle, means = _triangle(factor, n, ones, width, p)
    # Directions that the matrix doesn't have are left out rather than blown up.
    _, s, v = np.linalg.svd(triangle)
    keep = s > s[0] * 1e-13 if len(s) and s[0] > 0 else np.zeros(len(s), bool)
    turn = v.T @ np.diag(np.where(keep, 1 / np.where(keep, s, 1), 0))
    return means @ turn, turn


def _centred(factor: DataFrame, n: int, ones: np.ndarray, width: int) -> DataFrame:
    own = [(F.col(z) - F.col("sum") / n * float(ones[i])).alias(z) for i, z in enumerate(_names(width))]
    return factor.select("column", *own)


def _ritz(product: DataFrame, shift: np.ndarray, empty: int, width: int) -> tuple:
    """The sums of Y, its singular values and the rotation to them, rows without entries included."""
    small = product.filter("column IS NULL").orderBy("at").select("at", *_names(width)).toPandas().set_index("at")
    # A row without entries is the negative shift.
    gram = small.loc[range(width)].to_numpy() + empty * np.outer(shift, shift)
    ones = small.loc[-1].to_numpy() - empty * shift
    value, vectors = np.linalg.eigh((gram + gram.T) / 2)
    return ones, np.sqrt(np.maximum(value[::-1], 0)), vectors[:, ::-1]


def _scores(blocks: DataFrame, needed: DataFrame, factor: DataFrame, n: int, ones: np.ndarray, k: int, width: int, p: Svd, empty: int) -> tuple:
    shift, turn = _turned(factor, n, ones, width, p)
    own = materialise(_centred(factor, n, ones, width))
    # The last rotation needs Y'Y of this turn.
    product = _multiplied(blocks, needed, own, turn, shift).filter("column IS NULL")
    _, value, vectors = _ritz(materialise(product), shift, empty, width)
    turn, shift = (turn @ vectors)[:, :k], (shift @ vectors)[:k]

    def cubes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k)
        for batch in batches:
            z = np.stack([c.to_numpy() for c in batch.columns], axis=1)
            total += ((z @ turn) ** 3).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(total)], names=["at", "cubes"])

    signs = own.select(*_names(width)).mapInArrow(cubes, "at int, cubes double").groupBy("at").agg(F.sum("cubes").alias("cubes")).collect()
    sign = np.ones(k)
    for row in signs:
        sign[row["at"]] = -1.0 if row["cubes"] < 0 else 1.0
    turn, shift = turn * sign, shift * sign

    def scores(block: pd.DataFrame, factor: pd.DataFrame) -> pd.DataFrame:
        if not len(block):
            return pd.DataFrame(columns=["block", "components"])
        return pd.DataFrame({"block": block["block"], "components": [list(_times(block, factor, turn, shift, width))]})

    met = needed.join(own, "column")
    found = _places(blocks).groupBy("block").cogroup(met.groupBy("block")).applyInPandas(scores, "block bigint, components array<array<double>>")
    zipped = F.arrays_zip(F.col("rows").alias("row"), F.col("components").alias("components"))
    out = blocks.select("block", "rows").join(found, "block").select(F.inline(zipped))
    return out, value[:k], -shift
