"""Chronological positions and the 70/15/15 split of the raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from seriesflow.config import (
    AUTO, IDX, KEY, N, SPLIT, TEST, TRAIN, VALIDATION, WINDOW, Layout,
)
from seriesflow.functions.columns import split_label, train_end, validation_end
from seriesflow.plans.layout import index_series


def chrono_index(df: DataFrame, layout: Layout = AUTO) -> DataFrame:
    """0-based position ``idx`` and length ``n`` of each row's series."""
    return index_series(df, layout).df


def split_raw(df: DataFrame, layout: Layout = AUTO) -> DataFrame:
    """Split label of every raw row."""
    return chrono_index(df, layout).withColumn(SPLIT, split_label(F.col(IDX)))


def test_slice(df: DataFrame, layout: Layout = AUTO) -> DataFrame:
    """The rows on which forecasts are scored."""
    return split_raw(df, layout).filter(F.col(SPLIT) == TEST)


def split_counts(labelled: DataFrame) -> DataFrame:
    """Rows per split, one row per series."""
    return labelled.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(SPLIT) == s).alias(f"{s}_rows") for s in (TRAIN, VALIDATION, TEST)],
    )


def window_counts(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """Number of full input windows whose target lies in each split.

    They follow from the length of the series, so its rows need no order.
    """
    n = F.col(N)
    # First and last-plus-one target position of each split.
    ends = [F.lit(0), train_end(), validation_end(), n]
    sizes = [
        F.greatest(end - F.greatest(start, F.lit(window)), F.lit(0)).cast("bigint")
        for start, end in zip(ends, ends[1:])
    ]
    names = [f"{s}_windows" for s in (TRAIN, VALIDATION, TEST)]
    lengths = df.groupBy(KEY).agg(F.count(F.lit(1)).alias(N))
    return lengths.select(KEY, *[c.alias(name) for name, c in zip(names, sizes)])
