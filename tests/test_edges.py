"""Short, empty, constant and broken series."""

import math

import pytest
from pyspark.sql import functions as F

from seriesflow.config import PLAIN, Layout
from seriesflow.functions import columns as C
from seriesflow.operators import (
    baselines, features, learned, prepare, review, scaling, score, splits, windows,
)
from tests.conftest import month, rows_of

LENGTHS = (1, 2, 12, 13, 24, 25, 90, 170)


@pytest.fixture(scope="module")
def by_length(make_series):
    return make_series(**{f"n{n}": [100.0 + 2 * i for i in range(n)] for n in LENGTHS}).cache()


def test_split_sizes_use_double_arithmetic(by_length):
    counts = splits.split_counts(splits.split_raw(by_length, PLAIN))
    rows = {r.series_id: r for r in counts.collect()}
    for n in LENGTHS:
        row = rows[f"n{n}"]
        train, validation = int(0.70 * n), int(0.85 * n)
        assert row.total_rows == n
        assert (row.train_rows, row.validation_rows, row.test_rows) == (
            train, validation - train, n - validation)
    # In exact arithmetic 0.70 * 90 is 63; in double it is just below.
    assert rows["n90"].train_rows == 62 and rows["n170"].train_rows == 118


def test_windows_need_24_earlier_values(by_length):
    counts = {r.series_id: r["count"] for r in
              windows.window_arrays(by_length, PLAIN).groupBy("series_id").count().collect()}
    assert counts == {f"n{n}": n - 24 for n in LENGTHS if n > 24}
    labelled = windows.supervised_rows(by_length, PLAIN)
    by_split = {r.series_id: r for r in splits.split_counts(labelled).collect()}
    for row in splits.window_counts(by_length).collect():
        if row.series_id in by_split:
            seen = by_split[row.series_id]
            assert (row.train_windows, row.validation_windows, row.test_windows) == (
                seen.train_rows, seen.validation_rows, seen.test_rows)
        else:
            assert row.train_windows + row.validation_windows + row.test_windows == 0
    report = {r.series_id: r for r in prepare.data_quality_report(by_length, "d").collect()}
    assert report["n24"].train_windows == 0 and report["n90"].train_windows == 38


def test_head_of_series(by_length):
    rows = rows_of(features.rolling_means(by_length.filter("series_id = 'n13'"), PLAIN), "t")
    assert rows[0]["rolling_mean_3"] is None
    assert rows[1]["rolling_mean_3"] == 100.0
    assert rows[2]["rolling_mean_12"] == 101.0


def test_rising_line_is_forecast_exactly(by_length):
    rows = {(r.series_id, r.model): r for r in baselines.baseline_suite(by_length, PLAIN).collect()}
    for n in (24, 90, 170):
        assert rows[f"n{n}", "Naive"].mae == pytest.approx(2.0)
        assert rows[f"n{n}", "SeasonalNaive-12"].mae == pytest.approx(24.0)
        assert rows[f"n{n}", "LinearTrend"].mae == pytest.approx(0.0, abs=1e-9)
    # The only row of a series is its test row and has nothing before it.
    assert rows["n1", "Naive"].mae is None


def test_season_falls_back_by_position(make_series):
    values = [None] + [float(i) for i in range(1, 14)]
    rows = rows_of(
        baselines.with_baselines(make_series(a=values), PLAIN).select("idx", "seasonal"), "idx")
    assert rows[1]["seasonal"] is None          # previous value is missing
    assert rows[5]["seasonal"] == 4.0           # too early for a season: previous value
    assert rows[12]["seasonal"] is None         # the value one season ago is missing
    assert rows[13]["seasonal"] == 1.0


def test_periodic_series_with_zeros(make_series):
    df = make_series(a=[float(i % 12) for i in range(80)])
    rows = {r.model: r for r in baselines.baseline_suite(df, PLAIN).collect()}
    assert rows["SeasonalNaive-12"].mae == 0 and rows["SeasonalNaive-12"].mape == 0
    assert math.isfinite(rows["Naive"].mape)


def test_all_zero_actuals_have_no_percentage(make_series):
    board = score.leaderboard(baselines.baseline_forecasts(make_series(a=[0.0] * 40), PLAIN))
    assert all(r.test_mape_percent is None and r.test_mae == 0 for r in board.collect())
    # All models tie, so the first in their order is best.
    assert review.best_model(board).first().model == "Naive"
    pair = review.best_vs_next(board).first()
    assert pair.rmse_improvement_vs_next_best == 0
    assert pair.rmse_improvement_percent_vs_next_best is None


def test_constant_series_scales_to_zero(make_series):
    rows = scaling.scaler_transform(make_series(a=[5.0] * 30), PLAIN).collect()
    assert {r.z for r in rows} == {0.0}


def test_equal_errors_are_all_flagged(spark):
    rows = [("a", month(i), i, "c", "m", 0, 10.1 + i, 10.0 + i) for i in range(8)]
    forecasts = spark.createDataFrame(
        rows, "series_id string, t date, idx bigint, condition string, model string, "
        "model_order int, actual double, forecast double")
    for layout in (PLAIN, Layout("blocks", block_rows=3)):
        assert all(r.high_error_flag for r in review.high_error_review(forecasts, layout).collect())
    pair = review.best_vs_next(score.leaderboard(forecasts)).first()
    assert pair.best_model == "m" and pair.next_best_model is None
    assert pair.rmse_improvement_vs_next_best is None


def test_nan_series_ranks_last_and_does_not_fail(make_series):
    df = make_series(a=[float(i) if i != 70 else float("nan") for i in range(80)])
    board = score.leaderboard(baselines.baseline_forecasts(df, PLAIN))
    rows = {r.model: r for r in board.collect()}
    assert math.isnan(rows["Naive"].test_rmse)
    assert math.isfinite(rows["SeasonalNaive-12"].test_mape_percent)


def test_missing_values_keep_their_window_slot(make_series):
    df = make_series(a=[None if i == 3 else float(i) for i in range(30)])
    row = windows.window_arrays(df, PLAIN).filter("idx = 25").first()
    assert row.x == [float(i) if i != 3 else None for i in range(1, 25)]


def test_empty_input(make_series, spark):
    empty = make_series(a=[1.0]).filter("y < 0")
    for layout in (PLAIN, Layout(), Layout("blocks", block_rows=50)):
        assert features.feature_table(empty, layout).count() == 0
        assert baselines.baseline_suite(empty, layout).count() == 0
    assert prepare.prep_report(empty).count() == 0


def test_no_training_windows_gives_no_learned_forecasts(make_series):
    forecasts, selection = learned.learned_forecasts(make_series(a=[1.0, 2.0, 4.0]), PLAIN)
    assert forecasts.count() == 0 and selection.count() == 0
    assert forecasts.columns == score.COLUMNS


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [
        ("a", "2020-01", "1.5", 1), ("a", "2020-01", "2.5", 2), ("a", "2020-01", "n/a", 3),
        ("a", "2020-13", "4", 4), ("a", "bad", None, 5), ("a", "2020-02", "NaN", 6),
        ("b", "2020-01", "7", 7),
    ]
    raw = spark.createDataFrame(rows, "k string, m string, v string, id int")
    return prepare.prepare_series(raw, F.col("k"), F.col("m"), F.col("v"), F.col("id"))


def test_unreadable_texts_become_null(dirty):
    rows = rows_of(dirty, "tiebreak")
    assert [None if r["t"] is None else str(r["t"]) for r in rows] == [
        "2020-01-01", "2020-01-01", "2020-01-01", None, None, "2020-02-01", "2020-01-01"]
    assert [r["y"] for r in rows[:5]] == [1.5, 2.5, None, 4.0, None]
    assert math.isnan(rows[5]["y"])


def test_quality_counts(dirty):
    rows = {r.series_id: r for r in prepare.prep_report(dirty).collect()}
    a = rows["a"]
    assert (a.raw_rows, a.missing_months, a.missing_values, a.nan_values) == (6, 2, 2, 1)
    # January and the missing month occur more than once.
    assert (a.duplicate_groups, a.duplicate_rows) == (2, 3)
    assert (a.feature_rows, a.train_rows, a.test_rows) == (0, 0, 0)
    for layout in (PLAIN, Layout("blocks", block_rows=12)):
        again = prepare.prep_report(dirty, layout)
        assert rows_of(again, "series_id") == [rows[k].asDict() for k in ("a", "b")]
    assert rows["b"].raw_rows == 1 and rows["b"].duplicate_groups == 0
    assert {r.series_id: r.duplicate_groups for r in prepare.duplicate_groups(dirty).collect()} == {
        "a": 2, "b": 0}
    assert {r.series_id: r.duplicate_rows for r in prepare.duplicate_rows(dirty).collect()} == {
        "a": 3, "b": 0}
    report = {r.series_id: r for r in prepare.data_quality_report(dirty, "d").collect()}
    assert (report["a"].missing_values, report["a"].duplicate_months) == (3, 3)


def test_ties_are_rounded_up_despite_float_noise(spark):
    values = [(0.1 + 0.2 - 0.2875 + 0.3, ), (0.0125,), (2.5e-7,), (float("nan"),), (None,)]
    df = spark.createDataFrame(values, "v double")
    rounded = [r.v for r in df.select(C.report_round(F.col("v"), 3).alias("v")).collect()]
    assert rounded[0] == 0.313 and rounded[1] == 0.013 and rounded[2] == 0.0
    assert math.isnan(rounded[3]) and rounded[4] is None


def test_rank_ties_keep_model_order(spark):
    board = spark.createDataFrame(
        [("a", "c", "late", 2, 1.0), ("a", "c", "early", 1, 1.0), ("a", "c", "worse", 0, 1.001)],
        "series_id string, condition string, model string, model_order int, test_rmse double")
    ranked = rows_of(review.rank_models(board), "rank")
    assert [r["model"] for r in ranked] == ["early", "late", "worse"]
