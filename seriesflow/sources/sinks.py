"""Writers for feature tables and reports."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from seriesflow.config import KEY, SPLIT, T

_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_PARALLEL = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


FILE_BYTES = 512 << 20


def write_features(
    df: DataFrame, path: str, max_rows_per_file: int = 50_000_000, file_bytes: int = FILE_BYTES
) -> None:
    """Feature table as parquet, one folder per split, in time order per file.

    Rows are dealt out by split, and adaptive execution cuts each split into files of about
    ``file_bytes``, along the tasks that made the rows, so that the rows of a short series
    stay together. The number of files follows from the size of the table, not from that of
    the tasks. An earlier table at the path stays until the new one is complete.
    """
    spark = df.sparkSession
    with _settings(spark, {_ADVISORY: str(file_bytes), _PARALLEL: "false"}):
        dealt = df.hint("rebalance", SPLIT).sortWithinPartitions(SPLIT, KEY, T)
        replace(spark, path, lambda new: (
            dealt.write.option("maxRecordsPerFile", max_rows_per_file).partitionBy(SPLIT).parquet(new)))


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write a folder beside ``path`` and put it there when it is complete.

    A job that fails before leaves what was there, and no half-written folder in its place.
    """
    new, old = (f"{path.rstrip('/')}.{name}-{uuid.uuid4().hex}" for name in ("new", "old"))
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        write(new)
        if files.exists(at(path)):
            _rename(files, at(path), at(old))
        _rename(files, at(new), at(path))
        files.delete(at(old), True)
    finally:
        files.delete(at(new), True)


def _rename(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"cannot rename {source} to {target}")


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_report_csv(df: DataFrame, path: str) -> None:
    """Report as CSV with a header, columns in the order of the DataFrame."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_summary_json(df: DataFrame, path: str) -> None:
    """Summary rows as JSON lines, one object per series."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
