"""Tables that a job writes to the cluster's shared folder to cut its lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from basketry.sources.lineage import ensure_checkpoint_dir, note, remove

#: Spark's setting that lets a query delete its shuffle files when it ends, rather than when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _without_leftovers(spark: SparkSession) -> Iterator[None]:
    """Queries that begin inside delete their shuffle files when they end."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def cut(df: DataFrame, path: str | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Unlike a plain checkpoint, later steps read only the columns they need. The
    files are as safe as the folder, so a lost executor costs no recomputation. As
    the table is read from there, the shuffle files that made it go at once.
    """
    path = path or note(f"{ensure_checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}")
    with _without_leftovers(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Cut tables of one operator in one folder.

    ``drop`` deletes a table that is no longer read. The folder goes at the end of a
    ``sources.lineage.temporary`` block around the operator and the writing of its
    result; without one it stays until the checkpoint folder is cleaned.
    """

    def __init__(self, spark) -> None:
        self.spark = spark
        self.root = note(f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}")
        self.number = 0

    def cut(self, df: DataFrame, compression: str | None = None) -> DataFrame:
        self.number += 1
        return cut(df, f"{self.root}/{self.number}", compression)

    def drop(self, df: DataFrame) -> None:
        """Delete the files of one cut table that is no longer read."""
        own = f"/{self.root.rsplit('/', 1)[-1]}/"  # the rest of a path is written in several ways: file:/ or file:///
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if own in folder:
                remove(self.spark, folder)
