"""Session settings, scratch space and reliable materialisation."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and scratch tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver and
    executors share one machine, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_scratch.setdefault(
        context.applicationId, tempfile.mkdtemp(prefix="tickerlark-")
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, folder: str) -> None:
    """Remove a scratch folder that no later plan reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*frames: DataFrame) -> None:
    """Remove the tables of :func:`materialise` that no later plan reads."""
    for df in frames:
        for file in df.inputFiles()[:1]:
            delete(df.sparkSession, file.rsplit("/", 1)[0])


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows to a table in the shared folder and read it back.

    The table survives the loss of executors, and its columns are pruned on each later read.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
