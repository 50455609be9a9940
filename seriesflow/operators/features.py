"""Lag, rolling-mean and next-period features with their own split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from seriesflow.config import AUTO, KEY, LAGS, ROLLS, SPLIT, T, Y, Layout
from seriesflow.functions.columns import split_label
from seriesflow.plans.layout import SeriesFrame, WindowColumns, index_series, order_columns

Steps = Sequence[int]


def feature_names(lags: Steps = LAGS, rolls: Steps = ROLLS) -> list[str]:
    return [*[f"lag_{k}" for k in lags], *[f"rolling_mean_{k}" for k in rolls]]


FEATURES = feature_names()
TARGETS = ["target_next", "target_t"]


def _lags(lags: Steps) -> WindowColumns:
    return lambda w: {f"lag_{k}": F.lag(Y, k).over(w) for k in lags}


def _rolling(rolls: Steps) -> WindowColumns:
    # The current row is left out; the first rows average what there is.
    return lambda w: {f"rolling_mean_{k}": F.avg(Y).over(w.rowsBetween(-k, -1)) for k in rolls}


def _lead(w: WindowSpec) -> dict[str, Column]:
    return {"target_next": F.lead(Y, 1).over(w), "target_t": F.lead(T, 1).over(w)}


def feature_windows(lags: Steps, rolls: Steps) -> WindowColumns:
    # ``lag_1`` lies two periods before the target: the row's own value is between.
    return lambda w: _lags(lags)(w) | _rolling(rolls)(w) | _lead(w)


def lag_features(df: DataFrame, layout: Layout = AUTO, lags: Steps = LAGS) -> DataFrame:
    """Values some rows back; 1, 3 and 12 by default."""
    return index_series(df, layout, _lags(lags), back=max(lags)).df


def rolling_means(df: DataFrame, layout: Layout = AUTO, rolls: Steps = ROLLS) -> DataFrame:
    """Means of some rows before the current one; 3 and 12 by default."""
    return index_series(df, layout, _rolling(rolls), back=max(rolls)).df


def lead_target(df: DataFrame, layout: Layout = AUTO) -> DataFrame:
    """Value and time of the next row."""
    return index_series(df, layout, _lead, ahead=1).df


def _complete_frame(df: DataFrame, layout: Layout, lags: Steps, rolls: Steps) -> SeriesFrame:
    complete = F.col(f"lag_{max(lags)}").isNotNull() & F.col("target_next").isNotNull()
    frame = index_series(df, layout, feature_windows(lags, rolls), back=max(*lags, *rolls), ahead=1)
    return frame.map(lambda rows: rows.filter(complete))


def complete_rows(
    df: DataFrame, layout: Layout = AUTO, lags: Steps = LAGS, rolls: Steps = ROLLS
) -> DataFrame:
    """Feature rows that have both the longest lag and a target."""
    return _complete_frame(df, layout, lags, rolls).df


def feature_table(
    df: DataFrame, layout: Layout = AUTO, lags: Steps = LAGS, rolls: Steps = ROLLS
) -> DataFrame:
    """Complete feature rows, split 70/15/15 by their position among themselves."""
    numbered = _complete_frame(df, layout, lags, rolls).renumber("_position", "_total")
    return numbered.df.select(
        KEY, *order_columns(df), *feature_names(lags, rolls), *TARGETS,
        split_label(F.col("_position"), F.col("_total")).alias(SPLIT),
    )
