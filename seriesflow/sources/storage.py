"""Folder for tables that cut lineage. It must be visible to all executors."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CONF, _WAREHOUSE = "spark.checkpoint.dir", "spark.sql.warehouse.dir"
_made: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints, else the session's warehouse.

    On a cluster the warehouse will not do if it is on the driver's own disk:
    then the setting is missing and that is an error.
    """
    folder = spark.conf.get(_CONF, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    folder = qualified(spark, spark.conf.get(_WAREHOUSE))
    one_machine = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
    if folder.startswith("file:") and not one_machine:
        raise RuntimeError(f"set {_CONF} to a folder shared by the cluster")
    return f"{folder.rstrip('/')}/seriesflow"


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, as Hadoop resolves it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _made[-1:]:
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are deleted at the end, when their results are written."""
    _made.append([])
    try:
        yield
    finally:
        for path in _made.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def store(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(stored: DataFrame) -> None:
    """Delete the files of a table that ``store`` gave and nothing reads any more."""
    for path in {name.rsplit("/", 1)[0] for name in stored.inputFiles()}:
        folder = stored.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(stored.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)
