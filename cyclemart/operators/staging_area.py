"""Cutting lineage through tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scopes: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, one machine may use a temporary
    folder; on a cluster that would be a different folder on each machine, so it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="cyclemart-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_location(spark: SparkSession, label: str) -> str:
    root = _scopes[-1] if _scopes else f"{shared_folder(spark)}/cyclemart"
    return f"{root}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, location: str) -> None:
    """Remove a folder, through Spark's own file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """Tables materialised inside are dropped at the end; nothing lazy may outlive the block."""
    root = f"{shared_folder(spark)}/cyclemart/scope-{uuid.uuid4().hex}"
    _scopes.append(root)
    try:
        yield root
    finally:
        _scopes.remove(root)
        delete(spark, root)


def materialise(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and read it back: lost executors re-read files instead of
    recomputing the chain, and later joins plan on its true size. Rows are put in a folder for each value of ``by``."""
    path = new_location(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
