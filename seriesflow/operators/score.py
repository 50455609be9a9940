"""Scoring of forecast tables.

A forecast table has the columns ``series_id, t, idx, condition, model,
model_order, actual, forecast``; ``model_order`` decides ties.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from seriesflow.config import IDX, KEY, T, Y
from seriesflow.functions import columns as C
from seriesflow.plans.layout import join_series

MODEL = ["condition", "model", "model_order"]
COLUMNS = [KEY, T, IDX, *MODEL, "actual", "forecast"]


def all_forecasts(*tables: DataFrame) -> DataFrame:
    """One forecast table out of several unrelated ones."""
    return reduce(DataFrame.unionByName, [t.select(*COLUMNS) for t in tables])


def join_forecasts(actuals: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Bring forecasts made elsewhere together with the actuals.

    Both sides have one row per series and position, so the join key is
    spread evenly even when one series holds most rows.
    """
    made = forecasts.select(KEY, IDX, *MODEL, "forecast")
    seen = actuals.select(KEY, T, IDX, F.col(Y).alias("actual"))
    return join_series(seen, made, IDX).select(*COLUMNS)


def score(forecasts: DataFrame) -> DataFrame:
    """MAE, RMSE and MAPE per series and model."""
    actual, forecast = F.col("actual"), F.col("forecast")
    return forecasts.groupBy(KEY, *MODEL).agg(
        C.mae(actual, forecast).alias("mae"),
        C.rmse(actual, forecast).alias("rmse"),
        C.mape(actual, forecast).alias("mape"),
    )


def report_metrics(mae: Column, rmse: Column, mape: Column) -> dict[str, Column]:
    """Metrics in report precision."""
    return {
        "test_mae": C.report_round(mae, 3),
        "test_rmse": C.report_round(rmse, 3),
        "test_mape_percent": C.report_round(mape, 2),
    }


def result_records(scores: DataFrame, validation: DataFrame | None = None) -> DataFrame:
    """Scores in report precision.

    ``validation`` has ``condition, model, best_val_mse`` for fitted models;
    rule-based ones have none.
    """
    if validation is None:
        scores = scores.withColumn("best_val_mse", F.lit(None).cast("double"))
    else:
        # One row per fitted model: Spark broadcasts what it finds to be small.
        scores = scores.join(validation, ["condition", "model"], "left")
    return scores.select(
        KEY, *MODEL,
        C.report_round(F.col("best_val_mse"), 6).alias("best_val_mse"),
        *[c.alias(k) for k, c in report_metrics(*map(F.col, ("mae", "rmse", "mape"))).items()],
    )


def leaderboard(forecasts: DataFrame, validation: DataFrame | None = None) -> DataFrame:
    """Report-precision metrics of every model on every series."""
    return result_records(score(forecasts), validation)
