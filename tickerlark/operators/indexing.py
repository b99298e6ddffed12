"""A global row index without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerlark.session import materialise

# monotonically_increasing_id puts the partition above bit 33 and the row below it.
_ROW_BITS = 33


def sorted_positions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-partition and sort by ``order``; add ``_part`` and ``_pos`` within it.

    ``order`` should end in a unique column, then even equal leading values are spread.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = spread.withColumn("_mid", F.monotonically_increasing_id())
    return placed.withColumns(
        {
            "_part": F.shiftright("_mid", _ROW_BITS),
            "_pos": F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    ).drop("_mid")


def partition_offsets(counts: DataFrame) -> DataFrame:
    """Rows before each partition, from a (``_part``, ``_n``) table of one row per partition."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def with_row_index(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """Number the rows from 0 in the order given.

    The sorted rows are stored once, so positions and offsets come from the same partitioning.
    Only the offsets, one row per partition, are broadcast.
    """
    placed = materialise(sorted_positions(df, order))
    offsets = partition_offsets(placed.groupBy("_part").agg(F.count("*").alias("_n")))
    return (
        placed.join(F.broadcast(offsets.select("_part", "_offset")), "_part")
        .withColumn(name, F.col("_offset") + F.col("_pos"))
        .drop("_part", "_pos", "_offset")
    )
