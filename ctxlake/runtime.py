"""Shared working folder, and cutting lineage through written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Every executor must reach it, so it is taken from the session, else from the
    context's checkpoint folder. Only a local master (a test run) gets a temporary
    folder; on a cluster executors would write to disks of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        folder = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = folder.get() if folder.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ctxlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared root."""
    return f"{shared_root(spark)}/ctxlake/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write once, read back: lineage ends at files that survive lost executors.

    The reread frame also carries real file sizes, so later joins choose
    broadcast or shuffle from what is on disk.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Even out work ahead of costly per-row parsing when the input is small.

    Bytes decide how many tasks a scan or a coalesced shuffle gets, and parsing
    costs far more than reading. An input too small to give every core a full-size
    task is redistributed, which is cheap because it is small. A big input already
    has enough tasks and is left as it is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    task_bytes = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * task_bytes else df


def staged(df: DataFrame, label: str = "staged") -> DataFrame:
    return written(df, run_folder(df.sparkSession, label))


@contextmanager
def scratch(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """A written copy for the time of a block; its files are removed afterwards.

    For copies that only feed writes inside the block. A frame handed out for later
    use must come from ``staged``.
    """
    spark = df.sparkSession
    path = run_folder(spark, label)
    try:
        yield written(df, path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def write_counted(df: DataFrame, path: str) -> int:
    """Write parquet and return the row count observed by that same job."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return seen.get["n"]
