import datetime
import math
import tempfile

import pytest
from pyspark.sql import SparkSession

from seriesflow.config import Layout


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("seriesflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="seriesflow-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def month(i: int) -> datetime.date:
    return datetime.date(1949 + i // 12, i % 12 + 1, 1)


@pytest.fixture(scope="session")
def make_series(spark):
    """Monthly series from lists of values, one list per key."""

    def make(**values):
        rows = [(k, month(i), v) for k, vs in values.items() for i, v in enumerate(vs)]
        return spark.createDataFrame(rows, "series_id string, t date, y double")

    return make


LAYOUTS = [Layout("plain"), Layout("auto"), Layout("auto", block_rows=30)]


def rows_of(df, *keys):
    """Rows as dicts in a fixed order."""
    return in_order([r.asDict() for r in df.collect()], keys)


def in_order(rows, keys):
    return sorted(rows, key=lambda row: tuple(str(row[k]).rjust(20) for k in keys))


def same(a, b, tolerance=1e-9):
    """Equal rows, doubles up to relative rounding."""
    if len(a) != len(b):
        return False
    return all(r.keys() == s.keys() and all(_close(r[k], s[k], tolerance) for k in r)
               for r, s in zip(a, b))


def _close(x, y, tolerance):
    if isinstance(x, list) and isinstance(y, list):
        return len(x) == len(y) and all(_close(p, q, tolerance) for p, q in zip(x, y))
    if isinstance(x, float) and isinstance(y, float):
        return (math.isnan(x) and math.isnan(y)) or math.isclose(
            x, y, rel_tol=tolerance, abs_tol=tolerance
        )
    return x == y
