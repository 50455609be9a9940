"""Rules that hold for any series."""

import random

import pytest
from pyspark.sql import functions as F

from seriesflow.config import PLAIN
from seriesflow.operators import baselines, features, scaling, score, splits, windows
from tests.conftest import in_order, rows_of, same

CUT = 60


@pytest.fixture(scope="module")
def values():
    source = random.Random(7)
    return {k: [round(source.uniform(1, 100), 2) for _ in range(n)]
            for k, n in (("a", 80), ("b", 57), ("c", 31))}


@pytest.fixture(scope="module")
def series(make_series, values):
    return make_series(**values).cache()


@pytest.fixture(scope="module")
def changed_later(make_series, values):
    """The same series with other values from position CUT on."""
    return make_series(a=values["a"][:CUT] + [v * 3 + 1 for v in values["a"][CUT:]]).cache()


def _only_a(df):
    return df.filter("series_id = 'a'")


def test_past_does_not_see_the_future(series, changed_later):
    """Values from CUT on, beyond the training rows, leave what is before alone."""
    for operator in (features.lag_features, features.rolling_means, scaling.scaler_transform,
                     baselines.with_baselines, windows.window_arrays):
        before = _only_a(operator(series, PLAIN)).drop("target_next")
        after = operator(changed_later, PLAIN).drop("target_next")
        index = splits.chrono_index(changed_later, PLAIN).filter(f"idx < {CUT}").select("t")
        assert rows_of(before.join(index, "t"), "t") == rows_of(after.join(index, "t"), "t")


def test_training_fits_do_not_see_later_rows(series, changed_later):
    fit = _only_a(scaling.scaler_fit(series, PLAIN))
    later_fit = scaling.scaler_fit(changed_later, PLAIN)
    assert rows_of(fit, "series_id") == rows_of(later_fit, "series_id")
    trend = [baselines.TREND]
    a = rows_of(_only_a(baselines.baseline_forecasts(series, PLAIN, trend)).drop("actual"), "idx")
    b = rows_of(baselines.baseline_forecasts(changed_later, PLAIN, trend).drop("actual"), "idx")
    assert a == b


def test_forecasts_use_actual_history(series, values):
    """Each naive test forecast is the actual value before it, not an earlier forecast."""
    rows = rows_of(_only_a(baselines.baseline_forecasts(series, PLAIN, [baselines.NAIVE])), "idx")
    assert [r["forecast"] for r in rows] == values["a"][67:79]


def test_many_series_equal_single_series(series, make_series, values):
    for operator in (features.feature_table, baselines.baseline_suite, windows.supervised_rows):
        together = operator(series, PLAIN)
        keys = [c for c in ("series_id", "t", "model") if c in together.columns]
        alone = [row for k, v in values.items()
                 for row in rows_of(operator(make_series(**{k: v}), PLAIN), *keys)]
        assert same(rows_of(together, *keys), in_order(alone, keys))


def test_scaling_is_undone(series):
    rows = scaling.scaler_inverse(scaling.scaler_transform(series, PLAIN)).collect()
    assert all(r.y_back == pytest.approx(r.y) for r in rows)


def test_targets_rebuild_the_level(series):
    rows = windows.supervised_rows(series, PLAIN)
    level = windows.reconstruct_levels(rows, "level_target", differenced=False)
    delta = windows.reconstruct_levels(rows, "delta_target", differenced=True)
    for out in (level, delta):
        assert all(r.forecast == pytest.approx(r.y) for r in out.collect())


def test_targets_agree_with_supervised_rows(series):
    wanted = windows.level_delta_targets(series, PLAIN)
    full = windows.supervised_rows(series, PLAIN).select(wanted.columns)
    assert rows_of(wanted, "series_id", "t") == rows_of(full, "series_id", "t")


def test_splits_partition_the_series(series, values):
    for row in splits.split_counts(splits.split_raw(series, PLAIN)).collect():
        assert row.train_rows + row.validation_rows + row.test_rows == len(values[row.series_id])
    tested = splits.test_slice(series, PLAIN).groupBy("series_id").agg(
        F.min("idx").alias("first"), F.max("idx").alias("last")).collect()
    assert all(r.last == len(values[r.series_id]) - 1 for r in tested)


def test_join_with_actuals_rebuilds_the_forecast_table(series):
    forecasts = baselines.baseline_forecasts(series, PLAIN)
    actuals = splits.test_slice(series, PLAIN)
    joined = score.join_forecasts(actuals, forecasts.drop("actual", "t"))
    assert rows_of(joined, "series_id", "model", "idx") == rows_of(
        forecasts, "series_id", "model", "idx")


def test_shuffled_rows_give_the_same(series):
    shuffled = series.orderBy(F.rand(3))
    keys = ("series_id", "t")
    assert rows_of(features.feature_table(shuffled, PLAIN), *keys) == rows_of(
        features.feature_table(series, PLAIN), *keys)
