"""The registered queries: one or more per operator, over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from seriesflow.catalog import tables as tb
from seriesflow.catalog.tables import MONTHLY, ONE_HOT_SERIES, ONE_LONG_SERIES
from seriesflow.config import AUTO, BASELINE_MODELS, SPLIT, TEST
from seriesflow.functions import columns as C
from seriesflow.operators import (
    baselines, features, learned, periods, prepare, review, scaling, score, splits, windows,
)
from seriesflow.plans.layout import SeriesFrame
from seriesflow.sources import series as sources, sinks
from seriesflow.sources.storage import new_path, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORDERS, LINEITEM = "monthly_orders", "monthly_lineitem"


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _day(name: str = "t") -> Column:
    return F.col(name).cast("string").alias(name)


def _r(name: str, places: int = 4) -> Column:
    return C.report_round(F.col(name), places).alias(name)


def _joined(name: str, places: int) -> Column:
    """Array of doubles as one text, equal in every engine."""
    digits = F.transform(name, lambda v: v.cast(f"decimal(38,{places})").cast("string"))
    return F.array_join(digits, ",").alias(name)


# --- sources ---------------------------------------------------------------

@_query
def load_series(spark, folder):
    return tb.monthly_orders(spark, folder).select("series_id", _day(), "y")


@_query
def load_series_lineitem(spark, folder):
    return tb.monthly_lineitem(spark, folder).select("series_id", _day(), "y")


@_query
def scan_series_csv(spark, folder):
    """Write the monthly series as CSV texts, scan and type them again."""
    path = new_path(spark, "series-csv")
    monthly = tb.monthly_orders(spark, folder).select(
        F.col("series_id").alias("priority"), C.month_text(F.col("t")).alias("month"),
        F.col("y").alias("amount"),
    )
    sinks.write_report_csv(monthly, path)
    schema = T.StructType([
        T.StructField(c, T.StringType()) for c in ("priority", "month", "amount")
    ])
    raw = sources.read_series_csv(spark, path, schema)
    typed = prepare.prepare_series(raw, F.col("priority"), F.col("month"), F.col("amount"))
    return typed.select("series_id", _day(), "y")


@_query
def scan_series_csv_folder(spark, folder):
    """A folder whose files have their columns in three orders, one of them with a column more."""
    path = new_path(spark, "series-csv")
    monthly = tb.monthly_orders(spark, folder).select(
        F.col("series_id").alias("priority"), C.month_text(F.col("t")).alias("month"), F.col("y").alias("amount"))
    orders = (("priority", "month", "amount"), ("amount", "priority", "month"), ("month", "note", "amount", "priority"))
    part = F.pmod(F.xxhash64("priority", "month"), F.lit(len(orders)))
    for i, columns in enumerate(orders):
        rows = monthly.filter(part == i).withColumn("note", F.lit("x, y"))
        sinks.write_report_csv(rows.select(*columns), f"{path}/part={i}")
    raw = sources.read_texts(spark, f"{path}/*", ("priority", "month", "amount"))
    typed = prepare.prepare_series(raw, F.col("priority"), F.col("month"), F.col("amount"))
    return typed.select("series_id", _day(), "y")


@_query
def unreadable_rows(spark, folder):
    """Orders whose month or amount text cannot be read, with the texts."""
    raw = tb.raw_orders(spark, folder)
    return prepare.unreadable_rows(raw, F.col("month"), F.col("amount"))


@_query
def scan_series_csv_reordered(spark, folder):
    """The same with the columns of the file in another order and one more among them."""
    path = new_path(spark, "series-csv")
    sinks.write_report_csv(tb.monthly_orders(spark, folder).select(
        F.col("y").alias("amount"), F.lit("x").alias("other"),
        C.month_text(F.col("t")).alias("month"), F.col("series_id").alias("priority"),
    ), path)
    schema = T.StructType([
        T.StructField("priority", T.StringType()), T.StructField("month", T.StringType()),
        T.StructField("amount", T.DoubleType()),
    ])
    raw = sources.read_series_csv(spark, path, schema, strict=True)
    return raw.select(
        F.col("priority").alias("series_id"),
        C.month_date(F.col("month")).cast("string").alias("t"), F.col("amount").alias("y"))


# --- typing and quality ----------------------------------------------------

@_query
def parse_month(spark, folder):
    raw = tb.raw_orders(spark, folder)
    return raw.select(
        "order_key", C.month_date(F.col("month")).cast("string").alias("month_date")
    )


@_query
def cast_measure(spark, folder):
    value = C.measure(F.col("amount"))
    return tb.raw_orders(spark, folder).select(
        "order_key",
        F.isnan(value).alias("is_nan"),
        F.when(~F.isnan(value), value).alias("amount"),
    )


@_query
def prepare_series(spark, folder):
    typed = tb.dirty_orders(spark, folder)
    return typed.select(
        "series_id", F.col("tiebreak").alias("order_key"), _day(),
        F.when(~F.isnan("y"), F.col("y")).alias("y"),
    )


@_query
def duplicate_groups(spark, folder):
    return prepare.duplicate_groups(tb.dirty_orders(spark, folder))


@_query
def duplicate_rows(spark, folder):
    return prepare.duplicate_rows(tb.dirty_orders(spark, folder))


@_query
def prep_report(spark, folder):
    return prepare.prep_report(tb.dirty_orders(spark, folder), AUTO)


@_query
def prep_report_orders(spark, folder):
    return prepare.prep_report(tb.monthly_orders(spark, folder), MONTHLY)


@_query
def prep_report_skewed(spark, folder):
    return prepare.prep_report(tb.skewed_events(spark, folder), ONE_HOT_SERIES)


def _quality(df: DataFrame, dataset: str) -> DataFrame:
    return prepare.with_months(prepare.data_quality_report(df, dataset))


@_query
def data_quality_report(spark, folder):
    return _quality(tb.monthly_orders(spark, folder), ORDERS)


@_query
def data_quality_report_users(spark, folder):
    return _quality(tb.user_events(spark, folder), "user_events")


@_query
def data_quality_report_dirty(spark, folder):
    return _quality(tb.dirty_orders(spark, folder), "dirty_orders")


def _in_steps(series: DataFrame, cuts: list[str], layout=AUTO) -> tuple[DataFrame, DataFrame]:
    """Features and state after the rows have come in three steps, cut at two times."""
    edges, state, made = [None, *cuts, None], None, []
    for first, last in zip(edges, edges[1:]):
        arrived = series
        if first:
            arrived = arrived.filter(F.col("t") >= F.lit(first).cast(series.schema["t"].dataType))
        if last:
            arrived = arrived.filter(F.col("t") < F.lit(last).cast(series.schema["t"].dataType))
        step = periods.advance(arrived, state, layout)
        made.append(step.features)
        state = store(step.state, "state")
    return periods.with_splits(reduce(DataFrame.unionByName, made), state), state


@_query
def feature_table_in_steps(spark, folder):
    """The feature table of monthly orders that arrive in three steps."""
    rows, _ = _in_steps(tb.monthly_orders(spark, folder), ["1995-03-01", "1997-06-01"], MONTHLY)
    return _features(rows, _day(), _day("target_t"))


@_query
def feature_table_skewed_in_steps(spark, folder):
    """Three steps of events, a third of them of one user."""
    rows, _ = _in_steps(tb.skewed_events(spark, folder), ["2024-01-12", "2024-01-24 06:00:00"], ONE_HOT_SERIES)
    return _features(rows, F.col("tiebreak").alias("event_id"))


@_query
def data_quality_report_in_steps(spark, folder):
    _, state = _in_steps(tb.user_events(spark, folder), ["2024-01-12", "2024-01-24 06:00:00"])
    return prepare.with_months(periods.quality_report(state, "user_events"))


# --- positions and splits --------------------------------------------------

@_query
def chrono_index(spark, folder):
    indexed = splits.chrono_index(tb.monthly_orders(spark, folder), MONTHLY)
    return indexed.select("series_id", _day(), "y", "idx", "n")


@_query
def chrono_index_long(spark, folder):
    indexed = splits.chrono_index(tb.all_events(spark, folder), ONE_LONG_SERIES)
    return indexed.select("series_id", F.col("tiebreak").alias("event_id"), "y", "idx", "n")


@_query
def split_raw(spark, folder):
    labelled = splits.split_raw(tb.monthly_orders(spark, folder), MONTHLY)
    return labelled.select("series_id", _day(), "idx", SPLIT)


@_query
def split_raw_users(spark, folder):
    labelled = splits.split_raw(tb.user_events(spark, folder))
    return labelled.select("series_id", F.col("tiebreak").alias("event_id"), "idx", SPLIT)


@_query
def split_counts(spark, folder):
    return splits.split_counts(splits.split_raw(tb.monthly_orders(spark, folder), MONTHLY))


@_query
def split_counts_users(spark, folder):
    return splits.split_counts(splits.split_raw(tb.user_events(spark, folder)))


@_query
def test_slice(spark, folder):
    rows = splits.test_slice(tb.monthly_orders(spark, folder), MONTHLY)
    return rows.select("series_id", _day(), "idx", "y")


@_query
def window_counts_users(spark, folder):
    return splits.window_counts(tb.user_events(spark, folder))


@_query
def window_counts(spark, folder):
    return splits.window_counts(tb.monthly_orders(spark, folder))


# --- features --------------------------------------------------------------

_LAGS = [f"lag_{k}" for k in (1, 3, 12)]
_ROLLS = ["rolling_mean_3", "rolling_mean_12"]


@_query
def lag_features(spark, folder):
    rows = features.lag_features(tb.monthly_orders(spark, folder), MONTHLY)
    return rows.select("series_id", _day(), "y", *_LAGS)


@_query
def lag_features_users(spark, folder):
    rows = features.lag_features(tb.user_events(spark, folder))
    return rows.select("series_id", F.col("tiebreak").alias("event_id"), "y", *_LAGS)


@_query
def rolling_means(spark, folder):
    rows = features.rolling_means(tb.monthly_orders(spark, folder), MONTHLY)
    return rows.select("series_id", _day(), *[_r(c) for c in _ROLLS])


@_query
def lead_target(spark, folder):
    rows = features.lead_target(tb.monthly_orders(spark, folder), MONTHLY)
    return rows.select("series_id", _day(), "target_next", _day("target_t"))


@_query
def complete_rows(spark, folder):
    rows = features.complete_rows(tb.monthly_orders(spark, folder), MONTHLY)
    return rows.select("series_id", _day(), "idx", "lag_12", "target_next")


def _features(df: DataFrame, *labels: Column) -> DataFrame:
    return df.select(
        "series_id", *labels, "y", *_LAGS, *[_r(c) for c in _ROLLS], "target_next", SPLIT
    )


@_query
def split_features(spark, folder):
    rows = features.feature_table(tb.monthly_orders(spark, folder), MONTHLY)
    return rows.select("series_id", _day(), SPLIT)


@_query
def feature_table(spark, folder):
    rows = features.feature_table(tb.monthly_orders(spark, folder), MONTHLY)
    return _features(rows, _day(), _day("target_t"))


@_query
def feature_table_lineitem(spark, folder):
    rows = features.feature_table(tb.monthly_lineitem(spark, folder), MONTHLY)
    return _features(rows, _day(), _day("target_t"))


@_query
def feature_table_users(spark, folder):
    rows = features.feature_table(tb.user_events(spark, folder))
    return _features(rows, F.col("tiebreak").alias("event_id"))


@_query
def feature_table_skewed(spark, folder):
    """Features where one series holds a third of the rows."""
    rows = features.feature_table(tb.skewed_events(spark, folder), ONE_HOT_SERIES)
    return _features(rows, F.col("tiebreak").alias("event_id"))


@_query
def feature_table_long(spark, folder):
    """Features of one long series, worked on in blocks."""
    rows = features.feature_table(tb.all_events(spark, folder), ONE_LONG_SERIES)
    return _features(rows, F.col("tiebreak").alias("event_id"))


@_query
def sink_features(spark, folder):
    """Write the feature table by split and read it back."""
    path = new_path(spark, "features")
    sinks.write_features(features.feature_table(tb.monthly_orders(spark, folder), MONTHLY), path)
    return _features(spark.read.parquet(path), _day(), _day("target_t"))


# --- scaling, windows, targets ---------------------------------------------

@_query
def scaler_fit(spark, folder):
    fit = scaling.scaler_fit(tb.monthly_orders(spark, folder), MONTHLY)
    return fit.select("series_id", _r("scale_mean"), _r("scale_std"))


@_query
def scaler_fit_skewed(spark, folder):
    fit = scaling.scaler_fit(tb.skewed_events(spark, folder), ONE_HOT_SERIES)
    return fit.select("series_id", _r("scale_mean"), _r("scale_std"))


@_query
def scaler_transform(spark, folder):
    rows = scaling.scaler_transform(tb.monthly_orders(spark, folder), MONTHLY)
    return rows.select("series_id", _day(), _r("z"))


@_query
def scaler_transform_long(spark, folder):
    rows = scaling.scaler_transform(tb.all_events(spark, folder), ONE_LONG_SERIES)
    return rows.select("series_id", F.col("tiebreak").alias("event_id"), _r("z"))


@_query
def scaler_roundtrip(spark, folder):
    rows = scaling.scaler_transform(tb.monthly_orders(spark, folder), MONTHLY)
    return scaling.scaler_inverse(rows).select("series_id", _day(), _r("y_back", 2))


@_query
def window_arrays(spark, folder):
    rows = windows.window_arrays(tb.monthly_orders(spark, folder), MONTHLY)
    return rows.select("series_id", _day(), "idx", _joined("x", 2))


@_query
def window_arrays_long(spark, folder):
    rows = windows.window_arrays(tb.all_events(spark, folder), ONE_LONG_SERIES)
    return rows.select("series_id", "idx", _joined("x", 2))


@_query
def level_delta_targets(spark, folder):
    rows = windows.level_delta_targets(tb.monthly_orders(spark, folder), MONTHLY)
    return rows.select(
        "series_id", _day(), "idx", SPLIT, _r("last_level"), _r("level_target"),
        _r("delta_target"),
    )


@_query
def supervised_rows(spark, folder):
    rows = windows.supervised_rows(tb.monthly_orders(spark, folder), MONTHLY)
    return rows.select(
        "series_id", _day(), "idx", SPLIT, _joined("x", 5), _r("last_level"),
        _r("level_target"), _r("delta_target"),
    )


@_query
def level_delta_targets_skewed(spark, folder):
    rows = windows.level_delta_targets(tb.skewed_events(spark, folder), ONE_HOT_SERIES)
    return rows.select(
        "series_id", "idx", SPLIT, _r("last_level"), _r("level_target"), _r("delta_target")
    )


@_query
def supervised_rows_users(spark, folder):
    rows = windows.supervised_rows(tb.user_events(spark, folder))
    return rows.select("series_id", "idx", SPLIT, _joined("x", 5), _r("level_target"))


def _season_change(rows: DataFrame) -> DataFrame:
    """Stand-in prediction: the change seen one season earlier."""
    change = F.element_at("x", 13) - F.element_at("x", 12)
    return rows.withColumn("prediction", change)


@_query
def reconstruct_levels(spark, folder):
    rows = windows.supervised_rows(tb.monthly_orders(spark, folder), MONTHLY)
    rows = _season_change(rows).filter(F.col(SPLIT) == TEST)
    out = windows.reconstruct_levels(rows, "prediction", differenced=True)
    return out.select("series_id", _day(), "idx", _r("y", 2), _r("forecast", 2))


# --- forecasts and metrics -------------------------------------------------

def _forecast(spark, folder, model: str) -> DataFrame:
    rows = baselines.baseline_forecasts(tb.monthly_orders(spark, folder), MONTHLY, [model])
    return rows.select("series_id", _day(), "idx", "actual", _r("forecast"))


@_query
def forecast_naive(spark, folder):
    return _forecast(spark, folder, baselines.NAIVE)


@_query
def forecast_moving_avg(spark, folder):
    return _forecast(spark, folder, baselines.MOVING_AVERAGE)


@_query
def forecast_seasonal_naive(spark, folder):
    return _forecast(spark, folder, baselines.SEASONAL)


@_query
def forecast_linear_trend(spark, folder):
    return _forecast(spark, folder, baselines.TREND)


def _suite(df: DataFrame) -> DataFrame:
    return df.select("series_id", "model", _r("mae"), _r("rmse"), _r("mape"))


@_query
def baseline_suite(spark, folder):
    return _suite(baselines.baseline_suite(tb.monthly_orders(spark, folder), MONTHLY))


@_query
def baseline_suite_users(spark, folder):
    return _suite(baselines.baseline_suite(tb.user_events(spark, folder)))


@_query
def baseline_suite_season7(spark, folder):
    return _suite(baselines.baseline_suite(tb.user_events(spark, folder), season=7))


@_query
def baseline_suite_lineitem(spark, folder):
    return _suite(baselines.baseline_suite(tb.monthly_lineitem(spark, folder), MONTHLY))


@_query
def baseline_suite_skewed(spark, folder):
    return _suite(baselines.baseline_suite(tb.skewed_events(spark, folder), ONE_HOT_SERIES))


@_query
def baseline_suite_long(spark, folder):
    return _suite(baselines.baseline_suite(tb.all_events(spark, folder), ONE_LONG_SERIES))


def _orders_forecasts(spark, folder) -> DataFrame:
    return baselines.baseline_forecasts(tb.monthly_orders(spark, folder), MONTHLY)


def _user_forecasts(spark, folder) -> DataFrame:
    return baselines.baseline_forecasts(tb.user_events(spark, folder))


@_query
def metric_mae(spark, folder):
    scores = score.score(_orders_forecasts(spark, folder))
    return scores.select("series_id", "model", _r("mae"))


@_query
def metric_rmse(spark, folder):
    scores = score.score(_orders_forecasts(spark, folder))
    return scores.select("series_id", "model", _r("rmse"))


@_query
def metric_mape(spark, folder):
    """Over user events, some of which are zero."""
    scores = score.score(_user_forecasts(spark, folder))
    return scores.select("series_id", "model", _r("mape"))


def _external(spark, folder) -> DataFrame:
    """Forecasts made outside the baseline suite, without the actuals."""
    rows = windows.supervised_rows(tb.monthly_orders(spark, folder), MONTHLY)
    rows = _season_change(rows).filter(F.col(SPLIT) == TEST)
    made = windows.reconstruct_levels(rows, "prediction", differenced=True)
    return made.select(
        "series_id", "idx", F.lit("External").alias("condition"),
        F.lit("SeasonChange").alias("model"),
        F.lit(len(BASELINE_MODELS)).alias("model_order"), "forecast",
    )


def _joined_forecasts(spark, folder) -> DataFrame:
    actuals = splits.test_slice(tb.monthly_orders(spark, folder), MONTHLY)
    return score.join_forecasts(actuals, _external(spark, folder))


@_query
def join_forecasts(spark, folder):
    return _joined_forecasts(spark, folder).select(
        "series_id", _day(), "idx", "condition", "model", "actual", _r("forecast", 2)
    )


@_query
def all_forecasts(spark, folder):
    rows = score.all_forecasts(
        _orders_forecasts(spark, folder), _joined_forecasts(spark, folder)
    )
    return rows.select(
        "series_id", _day(), "idx", "condition", "model", "actual", _r("forecast", 2)
    )


# --- ranking and review ----------------------------------------------------

_RECORD = [
    "series_id", "condition", "model", "best_val_mse", "test_mae", "test_rmse",
    "test_mape_percent",
]


@_query
def result_records(spark, folder):
    scores = baselines.baseline_suite(tb.monthly_orders(spark, folder), MONTHLY)
    return score.result_records(scores).select(*_RECORD)


@_query
def leaderboard(spark, folder):
    rows = score.all_forecasts(
        _orders_forecasts(spark, folder), _joined_forecasts(spark, folder)
    )
    return score.leaderboard(rows).select(*_RECORD)


@_query
def leaderboard_users(spark, folder):
    return score.leaderboard(_user_forecasts(spark, folder)).select(*_RECORD)


@_query
def rank_models(spark, folder):
    ranked = review.rank_models(score.leaderboard(_orders_forecasts(spark, folder)))
    return ranked.select("series_id", "rank", "model", "test_rmse")


@_query
def best_model(spark, folder):
    best = review.best_model(score.leaderboard(_orders_forecasts(spark, folder)))
    return best.select("series_id", "model", "test_mae", "test_rmse", "test_mape_percent")


@_query
def best_vs_next(spark, folder):
    return review.best_vs_next(score.leaderboard(_orders_forecasts(spark, folder)))


@_query
def forecast_comparison(spark, folder):
    rows = review.forecast_comparison(_orders_forecasts(spark, folder), MONTHLY)
    return rows.select(
        "series_id", C.month_text(F.col("t")).alias("month"), "actual", "forecast",
        "absolute_error", "model", "condition",
    )


_REVIEW = ["actual", "forecast", "absolute_error", "error_threshold", "high_error_flag"]


@_query
def high_error_review(spark, folder):
    rows = review.high_error_review(_orders_forecasts(spark, folder), MONTHLY)
    return rows.select("series_id", C.month_text(F.col("t")).alias("month"), "model", *_REVIEW)


@_query
def high_error_review_by_model(spark, folder):
    rows = review.high_error_review_by_model(_orders_forecasts(spark, folder), MONTHLY)
    return rows.select("series_id", C.month_text(F.col("t")).alias("month"), "model", *_REVIEW)


@_query
def high_error_review_users(spark, folder):
    rows = review.high_error_review(baselines.baseline_frame(tb.user_events(spark, folder)))
    return rows.select("series_id", "idx", "model", *_REVIEW)


def _skewed_forecasts(spark, folder) -> SeriesFrame:
    return baselines.baseline_frame(tb.skewed_events(spark, folder), ONE_HOT_SERIES)


@_query
def high_error_review_skewed(spark, folder):
    rows = review.high_error_review(_skewed_forecasts(spark, folder))
    return rows.select("series_id", "idx", "model", *_REVIEW)


def _tied(forecasts: SeriesFrame) -> SeriesFrame:
    """Three models with the forecasts of the naive one and equal order."""
    names = F.explode(F.array(*[F.lit(f"Naive-{c}") for c in "CAB"]))
    return forecasts.map(lambda rows: rows.filter(F.col("model") == "Naive").withColumn("model", names))


@_query
def high_error_review_ties(spark, folder):
    """The first by name of three models that tie, for series of users and a hot one in blocks."""
    users = baselines.baseline_frame(tb.user_events(spark, folder))
    parts = [("users", _tied(users)), ("skewed", _tied(_skewed_forecasts(spark, folder)))]
    rows = [review.high_error_review(f).withColumn("source", F.lit(name)) for name, f in parts]
    return rows[0].unionByName(rows[1]).select("source", "series_id", "idx", "model", *_REVIEW)


def _summary(spark, folder) -> DataFrame:
    rows = review.run_summary(_orders_forecasts(spark, folder), ORDERS, MONTHLY)
    return rows.withColumn("conditions_compared", F.array_join("conditions_compared", ","))


@_query
def run_summary(spark, folder):
    return _summary(spark, folder)


@_query
def run_summary_skewed(spark, folder):
    rows = review.run_summary(_skewed_forecasts(spark, folder), "skewed_events")
    return rows.withColumn("conditions_compared", F.array_join("conditions_compared", ","))


# --- report sinks ----------------------------------------------------------

def _csv_round_trip(spark, df: DataFrame, name: str) -> DataFrame:
    path = new_path(spark, name)
    sinks.write_report_csv(df, path)
    return sources.read_series_csv(spark, path, df.schema, strict=True, allow_empty=True)


@_query
def sink_reports(spark, folder):
    """Metrics report written as CSV and read back."""
    scores = baselines.baseline_suite(tb.monthly_orders(spark, folder), MONTHLY)
    return _csv_round_trip(spark, score.result_records(scores).select(*_RECORD), "metrics")


@_query
def sink_forecast_report(spark, folder):
    return _csv_round_trip(spark, forecast_comparison(spark, folder), "forecasts")


@_query
def sink_review_report(spark, folder):
    return _csv_round_trip(spark, high_error_review(spark, folder), "review")


@_query
def sink_quality_report(spark, folder):
    return _csv_round_trip(spark, data_quality_report(spark, folder), "quality")


@_query
def sink_summary_json(spark, folder):
    """Run summary written as JSON lines and read back."""
    summary, path = _summary(spark, folder), new_path(spark, "summary")
    sinks.write_summary_json(summary, path)
    return spark.read.schema(summary.schema).json(path)


# --- learned forecasters ---------------------------------------------------

# A window of one value and no penalty: least squares, which SQL has as well.
_ONE_VALUE = learned.LearnedSettings(length=1, models=(learned.LINEAR,), ridge=(0.0,))


def _one_value(spark, folder):
    return learned.learned_forecasts(tb.user_events(spark, folder), AUTO, _ONE_VALUE)


@_query
def learned_forecast_one_value(spark, folder):
    forecasts, _ = _one_value(spark, folder)
    return forecasts.select("series_id", "idx", "condition", "model", "actual", _r("forecast", 3))


@_query
def model_selection_one_value(spark, folder):
    _, selection = _one_value(spark, folder)
    return selection.select("condition", "model", _r("best_val_mse", 6), "setting")


@_query
def leaderboard_one_value(spark, folder):
    forecasts, selection = _one_value(spark, folder)
    return score.leaderboard(forecasts, selection).select(*_RECORD)


@_query
def boosted_validation(spark, folder):
    """Kept validation error of the boosted trees against that of their own forecasts."""
    settings = learned.LearnedSettings(length=6, models=(learned.BOOSTED,), depth=2, first_rounds=10, max_rounds=10)
    rows = learned.learning_rows(tb.monthly_orders(spark, folder), MONTHLY, settings.length)
    fitted = {f.condition: f for f in learned.fit_models(rows, settings)}
    found = []
    for condition, label in ((learned.LEVEL, "level_target"), (learned.DELTA, "delta_target")):
        model = fitted[condition].model.copy().setPredictionCol("_p")
        scored = model.transform(rows.filter((F.col(SPLIT) == "validation") & F.col("usable")))
        gap = F.abs(F.avg(F.pow(F.col(label) - F.col("_p"), 2)) - F.lit(fitted[condition].best_val_mse))
        found.append(scored.agg(
            F.lit(condition).alias("condition"), F.count(F.lit(1)).alias("validation_rows"),
            F.round(gap, 6).alias("difference")))
    return found[0].unionByName(found[1])


def _training(spark, folder):
    return learned.learning_rows(tb.monthly_orders(spark, folder), MONTHLY)


@_query
def learning_moments(spark, folder):
    """Sums of products of the 24 window values, both targets and one, which decide the linear fits."""
    return learned.moment_rows(_training(spark, folder)).select("a", "b", _r("value"))


@_query
def learning_moments_users(spark, folder):
    return learned.moment_rows(learned.learning_rows(tb.user_events(spark, folder))).select("a", "b", _r("value"))


@_query
def linear_optimality(spark, folder):
    """The fits of every penalty meet the conditions of their optimum."""
    gaps = learned.optimality_gaps(_training(spark, folder))
    return gaps.select("condition", "ridge", "feature", "train_rows", F.round(F.abs("slope"), 6).alias("slope"))


@_query
def linear_optimality_users(spark, folder):
    gaps = learned.optimality_gaps(learned.learning_rows(tb.user_events(spark, folder)))
    return gaps.select("condition", "ridge", "feature", "train_rows", F.round(F.abs("slope"), 6).alias("slope"))


@_query
def boosted_validation_full(spark, folder):
    """``boosted_validation`` with the default settings, where the patience ends the rounds."""
    rows = _training(spark, folder)
    fitted = {f.condition: f for f in learned.fit_models(rows, learned.LearnedSettings(models=(learned.BOOSTED,)))}
    scored, conditions = rows.filter((F.col(SPLIT) == "validation") & F.col("usable")), []
    for i, (condition, label) in enumerate(((learned.LEVEL, "level_target"), (learned.DELTA, "delta_target"))):
        fit = fitted[condition]
        scored = fit.model.copy().setPredictionCol(f"_p{i}").transform(scored)
        gap = F.abs(F.avg(F.pow(F.col(label) - F.col(f"_p{i}"), 2)) - F.lit(fit.best_val_mse))
        conditions.append(F.struct(
            F.lit(condition).alias("condition"), F.count(F.lit(1)).alias("validation_rows"),
            F.round(gap, 6).alias("difference"),
            F.lit(not fit.setting.endswith("at the limit")).alias("ended_by_patience")))
    return scored.agg(F.array(*conditions).alias("_c")).select(F.explode("_c").alias("_c")).select("_c.*")


# Predictions of windows of 24 values and boosted trees have no SQL counterpart.

def _learned(spark, folder):
    return learned.learned_forecasts(tb.monthly_orders(spark, folder), MONTHLY)


@_query
def learned_forecast(spark, folder):
    forecasts, _ = _learned(spark, folder)
    return forecasts.select(
        "series_id", _day(), "idx", "condition", "model", "actual", "forecast"
    )


@_query
def model_selection(spark, folder):
    _, selection = _learned(spark, folder)
    return selection


@_query
def leaderboard_learned(spark, folder):
    forecasts, selection = _learned(spark, folder)
    rows = score.all_forecasts(_orders_forecasts(spark, folder), forecasts)
    return score.leaderboard(rows, selection).select(*_RECORD)


@_query
def learned_forecast_users(spark, folder):
    """One linear model over the windows of all users."""
    settings = learned.LearnedSettings(models=(learned.LINEAR,))
    forecasts, _ = learned.learned_forecasts(tb.user_events(spark, folder), AUTO, settings)
    return forecasts.select("series_id", "idx", "condition", "model", "actual", "forecast")
