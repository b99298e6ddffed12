"""Intermediate tables of this package, kept in the shared folder and removed when replaced."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlark.session import scratch_path

#: Numbers of 64 bits in the table of :func:`flagged`.
WORDS = 1 << 19
#: Spark's setting of the rows that a Python worker gets at once.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Actions inside hand Python workers batches of at most ``rows`` rows, so that whole texts take little room."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def _place(columns: list[str]) -> tuple[Column, Column]:
    """Number and bit of the values of ``columns`` in the table of :func:`flagged`."""
    value = F.xxhash64(*columns)
    return F.pmod(value, F.lit(WORDS)), F.shiftrightunsigned(value, 58).cast("int")


def _bits(keys: DataFrame, word_name: str, bits_name: str) -> DataFrame:
    """The table of bits, one row for each number, never more than ``WORDS``."""
    word, bit = _place(keys.columns)
    return keys.groupBy(word.alias(word_name)).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias(bits_name))


def _set(bits: Column, bit: Column) -> Column:
    return F.call_function("shiftrightunsigned", bits, bit).bitwiseAND(F.lit(1)) == 1


def flagged(rows: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """``rows`` with the boolean ``name``: false where no row of ``keys`` has their values in its columns.

    A table of bits, never more than ``WORDS`` numbers, is broadcast, so nothing moves; true says
    only that a row may be among ``keys``.
    """
    word_name, bits_name = free(rows, "__word"), free(rows, "__bits")
    word, bit = _place(keys.columns)
    placed = rows.withColumn(word_name, word).join(F.broadcast(_bits(keys, word_name, bits_name)), word_name, "left")
    return placed.withColumn(name, _set(F.coalesce(bits_name, F.lit(0).cast("long")), bit)).drop(word_name, bits_name)


def among(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` without most of those whose values no row of ``keys`` has in its columns.

    The table of :func:`flagged`; each row comes out once or not at all, and only those that may be
    among ``keys`` are made.
    """
    word_name, bits_name = free(rows, "__word"), free(rows, "__bits")
    word, bit = _place(keys.columns)
    return rows.join(F.broadcast(_bits(keys, word_name, bits_name)), (word == F.col(word_name)) & _set(F.col(bits_name), bit), "left_semi")


def dropped(*frames: DataFrame) -> None:
    """Delete the files of tables made by :func:`stored` that no later plan reads.

    The driver then forgets the plans that made them, and Spark's cleaner their shuffle files.
    """
    for df in frames:
        for file in df.inputFiles()[:1]:
            delete(df.sparkSession, file.rsplit("/", 1)[0])
    if frames:
        frames[0].sparkSession._jvm.System.gc()


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
