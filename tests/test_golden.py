"""Published results of one well-known series."""

import pytest
from pyspark.sql import functions as F

from seriesflow.config import PLAIN
from seriesflow.functions import columns as C
from seriesflow.operators import (
    baselines, features, prepare, review, scaling, score, splits, windows,
)
from tests import fixed_values as fixed
from tests.conftest import LAYOUTS, month, rows_of


@pytest.fixture(scope="module")
def air(make_series):
    return make_series(air=[float(v) for v in fixed.PASSENGERS]).cache()


@pytest.fixture(scope="module")
def published(spark):
    """The published network forecasts as a forecast table."""
    rows = [
        ("air", month(122 + i), 122 + i, "RNN - differencing", "BiLSTM", 9,
         float(fixed.PASSENGERS[122 + i]), f)
        for i, f in enumerate(fixed.PUBLISHED_FORECASTS)
    ]
    return spark.createDataFrame(
        rows,
        "series_id string, t date, idx bigint, condition string, model string, "
        "model_order int, actual double, forecast double",
    )


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
def test_baseline_metrics(air, layout):
    records = score.result_records(baselines.baseline_suite(air, layout)).collect()
    found = {r.model: (r.test_mae, r.test_rmse, r.test_mape_percent) for r in records}
    assert found == fixed.BASELINE_METRICS
    assert all(r.best_val_mse is None for r in records)


def test_wide_and_long_scoring_agree(air):
    wide = score.result_records(baselines.baseline_suite(air, PLAIN))
    long = score.leaderboard(baselines.baseline_forecasts(air, PLAIN))
    assert rows_of(wide, "model") == rows_of(long, "model")


def test_quality_report(air):
    row = prepare.data_quality_report(air, "air").first()
    assert (row.total_observations, str(row.start_period), str(row.end_period)) == (
        144, "1949-01-01", "1960-12-01")
    assert (row.missing_values, row.duplicate_months) == (0, 0)
    assert (row.train_points, row.validation_points, row.test_points) == (100, 22, 22)
    assert (row.train_windows, row.validation_windows, row.test_windows) == (76, 22, 22)


def test_window_counts(air):
    row = splits.window_counts(air).first()
    assert (row.train_windows, row.validation_windows, row.test_windows) == (76, 22, 22)


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
def test_feature_table(air, layout):
    table = features.feature_table(air, layout)
    counts = splits.split_counts(table).first()
    assert (counts.total_rows, counts.train_rows, counts.validation_rows, counts.test_rows) == (
        131, 91, 20, 20)
    rows = rows_of(table, "t")
    first, last = rows[0], rows[-1]
    assert str(first["t"]) == "1950-01-01" and str(first["target_t"]) == "1950-02-01"
    assert (first["y"], first["lag_1"], first["lag_3"], first["lag_12"]) == (115, 118, 119, 112)
    assert first["rolling_mean_3"] == pytest.approx(113.666667, abs=1e-6)
    assert first["rolling_mean_12"] == pytest.approx(126.666667, abs=1e-6)
    assert first["target_next"] == 126
    assert str(last["t"]) == "1960-11-01" and str(last["target_t"]) == "1960-12-01"
    assert (last["y"], last["lag_1"], last["lag_3"], last["lag_12"]) == (390, 461, 606, 362)
    assert last["rolling_mean_3"] == 525 and last["target_next"] == 432
    assert last["rolling_mean_12"] == pytest.approx(471.583333, abs=1e-6)
    ends = {s: [str(r["t"]) for r in rows if r["split"] == s]
            for s in ("train", "validation", "test")}
    assert (ends["train"][-1], ends["validation"][-1]) == ("1957-07-01", "1959-03-01")
    assert (ends["test"][0], ends["test"][-1]) == ("1959-04-01", "1960-11-01")


def test_scaler(air):
    fit = scaling.scaler_fit(air, PLAIN).first()
    assert fit.scale_mean == pytest.approx(218.36)
    assert fit.scale_std == pytest.approx(73.84842856470927, abs=1e-12)


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
def test_first_window(air, layout):
    row = windows.supervised_rows(air, layout).filter("idx = 24").first()
    assert len(row.x) == 24
    assert row.x[0] == pytest.approx(-1.4402473020)
    assert row.x[23] == row.last_level == pytest.approx(-1.0610923147)
    assert row.level_target == pytest.approx(-0.9933860669)
    assert row.delta_target == pytest.approx(0.0677062478)


def test_linear_trend(air):
    rows = rows_of(baselines.baseline_forecasts(air, PLAIN, [baselines.TREND]), "idx")
    for row in rows:
        line = 2.3344734473447346 * row["idx"] + 102.80356435643566
        assert row["forecast"] == pytest.approx(line, rel=1e-12)


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
def test_review_of_published_forecasts(published, layout):
    rows = rows_of(review.high_error_review(published, layout), "t")
    assert {r["error_threshold"] for r in rows} == {fixed.PUBLISHED_THRESHOLD}
    flagged = [str(r["t"])[:7] for r in rows if r["high_error_flag"]]
    assert flagged == fixed.PUBLISHED_FLAGS
    board = score.leaderboard(published).first()
    assert (board.test_mae, board.test_rmse, board.test_mape_percent) == fixed.PUBLISHED_METRICS


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
def test_review_of_each_baseline(air, layout):
    forecasts = baselines.baseline_forecasts(air, layout)
    rows = rows_of(review.high_error_review_by_model(forecasts, layout), "model", "t")
    thresholds = {r["model"]: r["error_threshold"] for r in rows}
    assert thresholds == {
        "Naive": 87.079, "MovingAvg-12": 134.228, "SeasonalNaive-12": 70.614,
        "LinearTrend": 150.053,
    }
    summer = ["1959-07", "1959-08", "1960-07", "1960-08"]
    flags = {m: [str(r["t"])[:7] for r in rows if r["model"] == m and r["high_error_flag"]]
             for m in thresholds}
    assert flags == {
        "Naive": ["1959-09", "1960-09"], "MovingAvg-12": summer,
        "SeasonalNaive-12": ["1960-07"], "LinearTrend": summer,
    }


def test_baseline_ranking(air):
    board = score.leaderboard(baselines.baseline_forecasts(air, PLAIN))
    row = review.best_vs_next(board).first()
    assert (row.best_model, row.best_rmse) == ("SeasonalNaive-12", 51.783)
    assert (row.next_best_model, row.next_best_rmse) == ("Naive", 53.725)
    assert row.rmse_improvement_vs_next_best == 1.942
    assert row.rmse_improvement_percent_vs_next_best == 3.61


def test_published_ranking(spark):
    board = spark.createDataFrame(
        [("air", *r) for r in fixed.PUBLISHED_BOARD],
        "series_id string, condition string, model string, model_order int, test_mae double, "
        "test_rmse double, test_mape_percent double",
    )
    row = review.best_vs_next(board).first()
    assert (row.best_model, row.best_condition) == ("BiLSTM", "RNN - differencing")
    assert (row.best_mae, row.best_rmse, row.best_mape_percent) == fixed.PUBLISHED_METRICS
    assert (row.next_best_model, row.next_best_rmse) == ("GRU", 41.037)
    assert row.rmse_improvement_vs_next_best == 6.106
    assert row.rmse_improvement_percent_vs_next_best == 14.88


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
def test_run_summary(air, published, layout):
    forecasts = score.all_forecasts(baselines.baseline_forecasts(air, layout), published)
    row = review.run_summary(forecasts, "air", layout).first()
    assert (row.dataset, row.total_observations, row.models_compared) == ("air", 144, 5)
    assert row.conditions_compared == ["Baseline", "RNN - differencing"]
    assert (row.best_model, row.best_rmse) == ("BiLSTM", 34.931)
    assert (row.next_best_model, row.next_best_rmse) == ("SeasonalNaive-12", 51.783)
    assert (row.high_error_periods_flagged, row.review_threshold) == (2, 58.973)
    assert (row.forecast_horizon, row.window_length, row.seed) == ("1-step ahead", 24, 42)


def test_month_texts_are_parsed(spark):
    raw = spark.createDataFrame([("1949-01",), ("1949-13",), ("bad",), (None,)], "m string")
    days = [r.d for r in raw.select(C.month_date(F.col("m")).alias("d")).collect()]
    assert [None if d is None else str(d) for d in days] == ["1949-01-01", None, None, None]
