"""Rule-based one-step-ahead forecasts.

Each forecast uses the actual values before its row, never an earlier
forecast, so all of them are window columns over the same ordering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from seriesflow.config import (
    AUTO, BASELINE, BASELINE_MODELS, IDX, KEY, SEASON, SPLIT, T, TEST, Y, Layout, baseline_models,
)
from seriesflow.functions import columns as C
from seriesflow.plans.layout import SeriesFrame, WindowColumns, index_series

NAIVE, MOVING_AVERAGE, SEASONAL, TREND = BASELINE_MODELS


def _columns(season: int) -> dict[str, str]:
    return dict(zip(baseline_models(season), ("naive", "moving_average", "seasonal", "trend")))


def _windows(season: int) -> WindowColumns:
    def columns(w: WindowSpec) -> dict[str, Column]:
        return {
            "naive": F.lag(Y, 1).over(w),
            "moving_average": F.avg(Y).over(w.rowsBetween(-season, -1)),
            "_season": F.lag(Y, season).over(w),
        }

    return columns


def _trend_fit() -> dict[str, Column]:
    y = F.when(F.col(IDX) < C.train_end(), F.col(Y))
    return {"_slope": F.regr_slope(y, F.col(IDX)), "_intercept": F.regr_intercept(y, F.col(IDX))}


def _forecast_columns(
    df: DataFrame, layout: Layout, models: Sequence[str], season: int
) -> SeriesFrame:
    wanted = [_columns(season)[m] for m in models]
    fit = _trend_fit() if TREND in models else None
    frame = index_series(df, layout, _windows(season), back=season, aggs=fit)

    def forecasts(rows: DataFrame) -> DataFrame:
        # The season falls back by position: a NULL one season ago stays NULL.
        seasonal = F.when(F.col(IDX) >= season, F.col("_season")).otherwise(F.col("naive"))
        rows = rows.withColumn("seasonal", seasonal)
        if TREND in models:
            rows = rows.withColumn("trend", F.col("_slope") * F.col(IDX) + F.col("_intercept"))
        split = C.split_label(F.col(IDX)).alias(SPLIT)
        return rows.select(KEY, T, IDX, Y, split, *wanted)

    return frame.map(forecasts)


def with_baselines(
    df: DataFrame, layout: Layout = AUTO, models: Sequence[str] | None = None,
    season: int = SEASON,
) -> DataFrame:
    """Every row with its split and one forecast column per model."""
    return _forecast_columns(df, layout, models or baseline_models(season), season).df


def _is_test() -> Column:
    return F.col(SPLIT) == TEST


def baseline_frame(
    df: DataFrame, layout: Layout = AUTO, models: Sequence[str] | None = None,
    season: int = SEASON,
) -> SeriesFrame:
    """Forecast tables of the short and of the long series, kept apart.

    The review of short series needs no further shuffle, so it is best given
    these and not their union. ``season`` is a number of rows; the moving average
    and the seasonal model are named after it.
    """
    names = baseline_models(season)
    models = models or names
    long = F.explode(F.array(*[
        F.struct(
            F.lit(m).alias("model"),
            F.lit(names.index(m)).alias("model_order"),
            F.col(_columns(season)[m]).alias("forecast"),
        )
        for m in models
    ])).alias("_f")
    fixed = [KEY, T, IDX, F.lit(BASELINE).alias("condition"), F.col(Y).alias("actual")]
    return _forecast_columns(df, layout, models, season).map(
        lambda rows: rows.filter(_is_test())
        .select(*fixed, long)
        .select(KEY, T, IDX, "condition", "_f.model", "_f.model_order", "actual", "_f.forecast")
    )


def baseline_forecasts(
    df: DataFrame, layout: Layout = AUTO, models: Sequence[str] | None = None,
    season: int = SEASON,
) -> DataFrame:
    """Forecasts of the test rows, one row per row and model."""
    return baseline_frame(df, layout, models, season).df


def baseline_suite(df: DataFrame, layout: Layout = AUTO, season: int = SEASON) -> DataFrame:
    """Test metrics of all baselines per series.

    The models are scored side by side in one aggregate and turned into rows
    afterwards, so test rows are not multiplied by the number of models.
    """
    metrics = [
        F.struct(
            C.mae(F.col(Y), F.col(c)).alias("mae"),
            C.rmse(F.col(Y), F.col(c)).alias("rmse"),
            C.mape(F.col(Y), F.col(c)).alias("mape"),
        ).alias(c)
        for c in _columns(season).values()
    ]
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(m).alias("model"), F.lit(i).alias("model_order"),
            F.col(f"{c}.mae").alias("mae"), F.col(f"{c}.rmse").alias("rmse"),
            F.col(f"{c}.mape").alias("mape"),
        )
        for i, (m, c) in enumerate(_columns(season).items())
    ]))
    return (
        with_baselines(df, layout, season=season)
        .filter(_is_test())
        .groupBy(KEY)
        .agg(*metrics)
        .select(KEY, F.lit(BASELINE).alias("condition"), rows.alias("_m"))
        .select(KEY, "condition", "_m.*")
    )
