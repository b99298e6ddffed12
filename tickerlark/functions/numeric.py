"""Rounding that does not depend on the order in which doubles were added."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sums of doubles differ in the last bits from one partitioning to the next. Values are first
# snapped to ten digits, so a tie at the wanted digit is a tie on every run.
SNAP = 1e10


def snap(c: Column) -> Column:
    """The value without the noise of its last bits, for comparison with a threshold."""
    return F.rint(c * SNAP) / SNAP


def round_half_even(c: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.rint(snap(c) * scale) / scale + F.lit(0.0)


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, for results that are compared by value."""
    return df.select(
        *[
            round_half_even(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema
        ]
    )
