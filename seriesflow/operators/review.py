"""Ranking of models and review of the periods with high forecast error.

The review takes a forecast table, or the frame an operator made it in: then
the short series are reviewed where they are and only long ones are joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from seriesflow.config import AUTO, IDX, KEY, PLAIN, REVIEW_STDS, SEED, T, WINDOW, Layout
from seriesflow.functions import columns as C
from seriesflow.operators.score import MODEL, report_metrics
from seriesflow.plans.layout import (
    BLOCK, SeriesFrame, block_of, join_series, spread_over_blocks,
)

Forecasts = DataFrame | SeriesFrame


def _by_rmse() -> WindowSpec:
    # A full order: models that tie in both are told apart by name, under every layout.
    return Window.partitionBy(KEY).orderBy(
        F.col("test_rmse").asc_nulls_last(), "model_order", "condition", "model")


def rank_models(board: DataFrame, top: int | None = None) -> DataFrame:
    """Rank by rounded RMSE; equal RMSE keeps the order of the models."""
    # A series has one row per model here, however many observations it has.
    ranked = board.withColumn("rank", F.row_number().over(_by_rmse()).cast("bigint"))
    return ranked if top is None else ranked.filter(F.col("rank") <= top)


def best_model(board: DataFrame) -> DataFrame:
    """The model with the lowest RMSE of each series."""
    return rank_models(board, top=1).drop("rank")


def _at_rank(rank: int, column: str) -> Column:
    return F.max(F.when(F.col("rank") == rank, F.col(column)))


def _pair_columns() -> list[Column]:
    return [
        _at_rank(1, "model").alias("best_model"),
        _at_rank(1, "condition").alias("best_condition"),
        _at_rank(1, "test_mae").alias("best_mae"),
        _at_rank(1, "test_rmse").alias("best_rmse"),
        _at_rank(1, "test_mape_percent").alias("best_mape_percent"),
        _at_rank(2, "model").alias("next_best_model"),
        _at_rank(2, "condition").alias("next_best_condition"),
        _at_rank(2, "test_rmse").alias("next_best_rmse"),
    ]


def _with_gain(pairs: DataFrame) -> DataFrame:
    best, runner_up = F.col("best_rmse"), F.col("next_best_rmse")
    gain = runner_up - best
    return pairs.withColumns({
        "rmse_improvement_vs_next_best": C.report_round(gain, 3),
        "rmse_improvement_percent_vs_next_best": C.report_round(
            F.when(runner_up != 0, gain / runner_up * 100), 2
        ),
    })


def best_vs_next(board: DataFrame) -> DataFrame:
    """Best and second-best model and the RMSE gained between them.

    With a single model the columns of the second one are NULL.
    """
    return _with_gain(rank_models(board, top=2).groupBy(KEY).agg(*_pair_columns()))


def _abs_error() -> Column:
    return F.abs(F.col("actual") - F.col("forecast"))


def _error_aggregates() -> dict[str, Column]:
    actual, forecast = F.col("actual"), F.col("forecast")
    return {
        "_mean": F.avg(_abs_error()),
        "_square": F.avg((actual - forecast) * (actual - forecast)),
        "_share": F.avg(C.error_share(actual, forecast)),
        "_spread": F.stddev_pop(_abs_error()),
    }


def _with_metrics(df: DataFrame, stds: float) -> DataFrame:
    """Report metrics and review threshold in place of the aggregates."""
    mean, square, share, spread = (F.col(c) for c in _error_aggregates())
    metrics = report_metrics(mean, F.sqrt(square), share * 100)
    return df.withColumns(metrics | {"error_threshold": mean + F.lit(stds) * spread}).drop(
        *_error_aggregates()
    )


def ranked_errors(
    forecasts: Forecasts, layout: Layout = AUTO, stds: float = REVIEW_STDS
) -> DataFrame:
    """Forecast rows with error, flag, and metrics, threshold and rank of their model."""
    if isinstance(forecasts, SeriesFrame):
        blocks = Layout("blocks", block_rows=forecasts.block_rows)
        parts = [(forecasts.short, PLAIN), (forecasts.long, blocks)]
        ranked = [ranked_errors(df, how, stds) for df, how in parts if df is not None]
        return reduce(DataFrame.unionByName, ranked)
    if layout.mode == "plain":
        rows = _ranked_in_place(forecasts, stds)
    else:
        rows = _ranked_by_block(forecasts, stds, layout.block_rows)
    # Both sides are rounded so that float noise cannot flip an equal error.
    flag = F.round(_abs_error(), 6) >= F.round("error_threshold", 6)
    return rows.withColumns({"absolute_error": _abs_error(), "high_error_flag": flag})


def _ranked_in_place(forecasts: DataFrame, stds: float) -> DataFrame:
    # Forecasts stay distributed by series: no join, no further shuffle.
    group = Window.partitionBy(KEY, *MODEL)
    aggregates = [c.over(group).alias(name) for name, c in _error_aggregates().items()]
    rows = _with_metrics(forecasts.select("*", *aggregates), stds)
    return rows.withColumn("rank", F.dense_rank().over(_by_rmse()).cast("bigint"))


def _ranked_by_block(forecasts: DataFrame, stds: float, block_rows: int) -> DataFrame:
    stats = forecasts.groupBy(KEY, *MODEL).agg(
        *[c.alias(name) for name, c in _error_aggregates().items()],
        F.min(IDX).alias("_first"), F.max(IDX).alias("_last"),
    )
    stats = rank_models(_with_metrics(stats, stds))
    # Keyed by block as well, the rows of a long series go to many tasks.
    stats = spread_over_blocks(stats, "_last", block_rows, "_first")
    rows = forecasts.withColumn(BLOCK, block_of(block_rows))
    return join_series(rows, stats, *MODEL, BLOCK).drop(BLOCK)


def _review(rows: DataFrame) -> DataFrame:
    return rows.select(
        KEY, T, IDX, *MODEL,
        C.report_round(F.col("actual"), 3).alias("actual"),
        C.report_round(F.col("forecast"), 3).alias("forecast"),
        C.report_round(F.col("absolute_error"), 3).alias("absolute_error"),
        C.report_round(F.col("error_threshold"), 3).alias("error_threshold"),
        "high_error_flag",
    )


def high_error_review(
    forecasts: Forecasts, layout: Layout = AUTO, stds: float = REVIEW_STDS
) -> DataFrame:
    """Forecasts of the best model of each series, flagged where the error is high."""
    return review_of(ranked_errors(forecasts, layout, stds))


def review_of(ranked: DataFrame) -> DataFrame:
    """The review, from rows of ``ranked_errors``."""
    return _review(ranked.filter(F.col("rank") == 1))


def high_error_review_by_model(
    forecasts: Forecasts, layout: Layout = AUTO, stds: float = REVIEW_STDS
) -> DataFrame:
    """The same review for every model."""
    return _review(ranked_errors(forecasts, layout, stds))


def forecast_comparison(forecasts: Forecasts, layout: Layout = AUTO) -> DataFrame:
    """Actual, forecast and error of the best model of each series."""
    review = high_error_review(forecasts, layout)
    return review.drop("error_threshold", "high_error_flag")


def run_summary(
    forecasts: Forecasts, dataset: str, layout: Layout = AUTO, window: int = WINDOW
) -> DataFrame:
    """One row per series: settings, best models, gain and flagged periods.

    The last row of a series is always a test row, so its length is known from
    the forecasts and the series are not read again.
    """
    return summary_of(ranked_errors(forecasts, layout), dataset, window)


def summary_of(ranked: DataFrame, dataset: str, window: int = WINDOW) -> DataFrame:
    """The run summary, from rows of ``ranked_errors``."""
    best = F.col("rank") == 1
    compared = ranked.groupBy(KEY).agg(
        F.max("rank").alias("models_compared"),  # ranks have no ties
        (F.max(IDX) + 1).alias("total_observations"),
        F.array_sort(F.collect_set("condition")).alias("conditions_compared"),
        *_pair_columns(),
        F.count_if(best & F.col("high_error_flag")).alias("high_error_periods_flagged"),
        C.report_round(_at_rank(1, "error_threshold"), 3).alias("review_threshold"),
    )
    return _with_gain(compared).withColumns({
        "dataset": F.lit(dataset),
        "forecast_horizon": F.lit("1-step ahead"),
        "window_length": F.lit(window).cast("bigint"),
        "seed": F.lit(SEED).cast("bigint"),
    })
