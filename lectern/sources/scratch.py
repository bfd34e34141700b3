"""Where written tables and checkpoints go, and how they are removed."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_handed_out: dict[str, list[str]] = {}

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names, or the context's checkpoint folder.

    A local master that names neither writes below its warehouse. A cluster must name one,
    since a folder on one machine is lost with that machine.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the root that no one has used; ``release`` removes what is written there."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(frame: DataFrame, label: str) -> DataFrame:
    """The same rows, read back from a table in scratch space: computed once, whoever reads them."""
    path = scratch_path(frame.sparkSession, label)
    with drop_shuffles(frame.sparkSession):
        frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def drop_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each job that begins inside as it ends: for jobs that write a table, which is read instead."""
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def release(spark: SparkSession) -> None:
    """Delete every folder that this application has written to scratch space.

    Call it when no result that reads them is needed any more.
    """
    for name in _handed_out.pop(spark.sparkContext.applicationId, []):
        _delete(spark, name)


def drop(spark: SparkSession, path: str) -> None:
    """Delete one of these folders, which nothing reads any more."""
    _handed_out[spark.sparkContext.applicationId].remove(path)
    _delete(spark, path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
