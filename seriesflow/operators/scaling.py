"""Standard scaling of each series, fitted on its training rows only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from seriesflow.config import AUTO, IDX, KEY, STD_EPSILON, Y, Layout
from seriesflow.functions.columns import train_end
from seriesflow.plans.layout import SeriesFrame, WindowColumns, index_series


def _fit_columns() -> dict[str, Column]:
    y = F.when(F.col(IDX) < train_end(), F.col(Y))
    return {"scale_mean": F.avg(y), "scale_std": F.stddev_pop(y)}


def _widened(df: DataFrame) -> DataFrame:
    # Keeps the division defined for a constant series.
    return df.withColumn("scale_std", F.col("scale_std") + F.lit(STD_EPSILON))


def index_with_scale(
    df: DataFrame, layout: Layout, windows: WindowColumns | None = None, back: int = 0
) -> SeriesFrame:
    """Indexed rows with mean and spread of the training rows of their series."""
    return index_series(df, layout, windows, back=back, aggs=_fit_columns()).map(_widened)


def scaled(value: Column) -> Column:
    return (value - F.col("scale_mean")) / F.col("scale_std")


def unscaled(value: Column) -> Column:
    return value * F.col("scale_std") + F.col("scale_mean")


def scaler_fit(df: DataFrame, layout: Layout = AUTO) -> DataFrame:
    """One row per series: mean and spread of its training rows."""
    fit = [c.alias(name) for name, c in _fit_columns().items()]
    return _widened(index_series(df, layout).df.groupBy(KEY).agg(*fit))


def scaler_transform(df: DataFrame, layout: Layout = AUTO) -> DataFrame:
    """Every row with its scaled value ``z`` and the fit it was scaled by."""
    return index_with_scale(df, layout).df.withColumn("z", scaled(F.col(Y)))


def scaler_inverse(df: DataFrame, value: str = "z", out: str = "y_back") -> DataFrame:
    """Undo the scaling of a column of rows that carry their fit."""
    return df.withColumn(out, unscaled(F.col(value)))
