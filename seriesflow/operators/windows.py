"""Input windows of past values with level and difference targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from seriesflow.config import AUTO, IDX, KEY, SPLIT, T, WINDOW, Y, Layout
from seriesflow.functions.columns import split_label
from seriesflow.operators.scaling import index_with_scale, scaled, unscaled
from seriesflow.plans.layout import index_series


def _past(length: int):
    # One lag column per slot keeps a missing value in its slot; collect_list
    # would close the gap.
    def columns(w: WindowSpec) -> dict[str, Column]:
        return {f"_past_{k}": F.lag(Y, k).over(w) for k in range(1, length + 1)}

    return columns


def _slots(length: int) -> list[Column]:
    """Past values from the oldest to the latest."""
    return [F.col(f"_past_{k}") for k in range(length, 0, -1)]


def window_arrays(df: DataFrame, layout: Layout = AUTO, length: int = WINDOW) -> DataFrame:
    """The ``length`` values before each row, for rows that have that many."""
    frame = index_series(df, layout, _past(length), back=length).map(
        lambda rows: rows.filter(F.col(IDX) >= length)
    )
    return frame.df.select(KEY, T, IDX, Y, F.array(*_slots(length)).alias("x"))


def supervised_rows(df: DataFrame, layout: Layout = AUTO, length: int = WINDOW) -> DataFrame:
    """Scaled input window ``x``, level and difference targets per row.

    A row belongs to the split of its target, so the windows of validation
    and test rows reach back into the rows before their split.
    """
    frame = index_with_scale(df, layout, _past(length), back=length).map(
        lambda rows: rows.filter(F.col(IDX) >= length)
    )
    last = scaled(F.col("_past_1"))
    return frame.df.select(
        KEY, T, IDX, Y, "scale_mean", "scale_std",
        split_label(F.col(IDX)).alias(SPLIT),
        F.array(*[scaled(c) for c in _slots(length)]).alias("x"),
        last.alias("last_level"),
        scaled(F.col(Y)).alias("level_target"),
        (scaled(F.col(Y)) - last).alias("delta_target"),
    )


def level_delta_targets(df: DataFrame, layout: Layout = AUTO, length: int = WINDOW) -> DataFrame:
    """Targets of ``supervised_rows`` without carrying the windows along."""
    frame = index_with_scale(df, layout, _past(1), back=1).map(
        lambda rows: rows.filter(F.col(IDX) >= length)
    )
    last = scaled(F.col("_past_1"))
    return frame.df.select(
        KEY, T, IDX,
        split_label(F.col(IDX)).alias(SPLIT),
        last.alias("last_level"),
        scaled(F.col(Y)).alias("level_target"),
        (scaled(F.col(Y)) - last).alias("delta_target"),
    )


def reconstruct_levels(rows: DataFrame, prediction: str, differenced: bool) -> DataFrame:
    """Turn a scaled prediction into a forecast in the unit of the series."""
    level = F.col(prediction)
    if differenced:
        level = F.col("last_level") + level
    return rows.withColumn("forecast", unscaled(level))
