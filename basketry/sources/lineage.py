"""Cutting lineage in storage that outlives an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# For each open ``temporary`` block the folders that were written since.
_WRITTEN: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that are cut inside the block when it ends.

    Write results inside it: a plan that is only made there has lost its tables later.
    """
    _WRITTEN.append([])
    try:
        yield
    finally:
        for path in _WRITTEN.pop():
            remove(spark, path)


def note(path: str) -> str:
    """Remember a folder for the innermost ``temporary`` block."""
    if _WRITTEN:
        _WRITTEN[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    A local session without the setting gets a temporary folder. A cluster
    session without it is an error: a folder on one machine is lost with it.
    """
    context = spark.sparkContext
    shared = context.getConf().get(CHECKPOINT_SETTING) or spark.conf.get(
        CHECKPOINT_SETTING, None
    )
    current = context.getCheckpointDir()
    if current:
        return current
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="checkpoint-")
    context.setCheckpointDir(shared)
    return shared


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and go on from there.

    Parquet rather than a plain checkpoint: later steps read only the columns
    and rows they need, and joins see the real size.
    """
    path = note(f"{ensure_checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}.parquet")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
