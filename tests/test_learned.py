"""Learned forecasters against least squares and the simple baselines."""

import math

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from seriesflow.config import PLAIN, Layout
from seriesflow.operators import baselines, learned, score, windows
from tests import fixed_values as fixed
from tests.conftest import rows_of, same

QUICK = learned.LearnedSettings(max_rounds=12, patience=4)
LINEAR_ONLY = learned.LearnedSettings(models=(learned.LINEAR,), ridge=(0.0,))


@pytest.fixture(scope="module")
def air(make_series):
    return make_series(air=[float(v) for v in fixed.PASSENGERS]).cache()


@pytest.fixture(scope="module")
def fitted(air):
    rows = learned.learning_rows(air, PLAIN)
    return rows, learned.fit_models(rows, QUICK)


def test_best_round_waits_for_patience():
    assert learned.best_round([3, 2, 2.5, 2.4, 1], patience=3, min_gain=0) == 4
    assert learned.best_round([3, 2, 2.5, 2.4, 1], patience=2, min_gain=0) == 1
    assert learned.best_round([3, 2.9999, 2.9998], patience=9, min_gain=0.01) == 0
    assert learned.best_round([], patience=3, min_gain=0) == 0


def test_linear_model_is_least_squares(air):
    """Without a penalty the fit is that of a normal least-squares solver."""
    forecasts, _ = learned.learned_forecasts(air, PLAIN, LINEAR_ONLY)
    rows = rows_of(windows.supervised_rows(air, PLAIN), "idx")
    train = [r for r in rows if r["split"] == "train"]
    test = [r for r in rows if r["split"] == "test"]
    x = lambda part: np.array([r["x"] + [1.0] for r in part])
    y = np.array([r["level_target"] for r in train])
    weights, *_ = np.linalg.lstsq(x(train), y, rcond=None)
    expected = x(test) @ weights * test[0]["scale_std"] + test[0]["scale_mean"]
    for condition in (learned.LEVEL, learned.DELTA):
        found = rows_of(forecasts.filter(F.col("condition") == condition), "idx")
        assert [r["forecast"] for r in found] == pytest.approx(list(expected), rel=1e-6)
        assert [r["actual"] for r in found] == [float(v) for v in fixed.PASSENGERS[122:]]


def test_all_models_enter_the_leaderboard(air, fitted):
    rows, fits = fitted
    selection = learned.selection_report(air, fits)
    forecasts = score.all_forecasts(
        baselines.baseline_forecasts(air, PLAIN), learned.forecasts_of(rows, fits))
    board = {(r.condition, r.model): r for r in score.leaderboard(forecasts, selection).collect()}
    assert len(board) == 8
    assert all(math.isfinite(r.test_rmse) for r in board.values())
    for condition in (learned.LEVEL, learned.DELTA):
        for model in (learned.LINEAR, learned.BOOSTED):
            assert board[condition, model].best_val_mse > 0
        assert board[condition, learned.LINEAR].test_rmse < board["Baseline", "Naive"].test_rmse
    assert board["Baseline", "Naive"].best_val_mse is None


def test_refit_equals_the_kept_rounds(fitted):
    """The shorter boosted model has the validation error its round had in the long one."""
    rows, fits = fitted
    validation = rows.filter("split = 'validation'")
    for f in fits:
        if f.name == learned.BOOSTED:
            assert f.setting.split(",")[0] == f"rounds={f.model.getNumTrees}"
            label = {learned.LEVEL: "level_target", learned.DELTA: "delta_target"}[f.condition]
            error = f.model.transform(validation).agg(
                F.avg(F.pow(F.col(label) - F.col("prediction"), 2))).first()[0]
            assert error == pytest.approx(f.best_val_mse, rel=1e-9)


def test_fit_is_repeatable(air, fitted):
    rows, fits = fitted
    again = learned.fit_models(rows, QUICK)
    assert [(f.condition, f.name, f.setting) for f in again] == [
        (f.condition, f.name, f.setting) for f in fits]
    assert [f.best_val_mse for f in again] == pytest.approx([f.best_val_mse for f in fits])


def test_gaps_get_no_forecast_but_keep_their_row(make_series):
    values = [float(i * i % 29) for i in range(120)]
    values[100] = None
    forecasts, _ = learned.learned_forecasts(make_series(a=values), PLAIN, LINEAR_ONLY)
    rows = rows_of(forecasts.filter(F.col("condition") == learned.LEVEL), "idx")
    assert [r["idx"] for r in rows] == list(range(102, 120))
    assert all(r["forecast"] is None for r in rows)


def test_blocks_give_the_same_linear_forecasts(make_series):
    values = [float((i * 37) % 101) + i for i in range(200)]
    df = make_series(a=values, b=values[:70])
    keys = ("series_id", "condition", "idx")
    plain, _ = learned.learned_forecasts(df, PLAIN, LINEAR_ONLY)
    blocks, _ = learned.learned_forecasts(df, Layout("auto", block_rows=80), LINEAR_ONLY)
    assert same(rows_of(plain, *keys), rows_of(blocks, *keys), 1e-7)


def trees_of(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.trees]


def test_going_on_gives_the_trees_of_one_long_fit(make_series, spark):
    """Also above the rows from which Spark samples the candidate splits."""
    values = {f"s{k}": [float((i * i * (k + 3)) % 101 + i % 7) for i in range(170)] for k in range(110)}
    rows = learned.learning_rows(make_series(**values), PLAIN)
    train, _ = learned._fitting_data(rows)
    train = train.repartition(3, "features").cache()
    assert train.count() > 10_000
    boosting = lambda n: GBTRegressor(labelCol="delta_target", maxDepth=3, maxIter=n, seed=42)
    long = boosting(6).fit(train)
    grown = learned.more_rounds(boosting(3).fit(train), train, boosting(3), 1)
    grown = learned.more_rounds(grown, train, boosting(3), 2)
    assert trees_of(grown) == trees_of(long) and grown.treeWeights == long.treeWeights
    train.unpersist()


def test_each_round_is_fitted_once(fitted, monkeypatch):
    rows, _ = fitted
    made = []
    for kind, rounds in ((GBTRegressor, lambda e: e.getMaxIter()), (DecisionTreeRegressor, lambda e: 1)):
        monkeypatch.setattr(kind, "fit", lambda self, df, f=kind.fit, n=rounds: made.append(
            (self.getSeed(), n(self))) or f(self, df))
    bulk = learned.LearnedSettings(models=(learned.BOOSTED,), first_rounds=9, max_rounds=9, patience=4)
    steps = learned.LearnedSettings(models=(learned.BOOSTED,), first_rounds=2, max_rounds=9, patience=4, refit_rows=0)
    a = learned.fit_models(rows, bulk)
    made.clear()
    b = learned.fit_models(rows, steps)
    assert [(f.setting, f.best_val_mse) for f in a] == [(f.setting, pytest.approx(f.best_val_mse)) for f in b]
    for f, g in zip(a, b):
        assert trees_of(f.model)[:4] == trees_of(g.model)[:4] and f.model.getNumTrees == g.model.getNumTrees
    needed = [min(9, int(f.setting.split("=")[1].split(",")[0]) + 4) for f in b]
    assert sum(n for _, n in made) == sum(needed) and sum(n == 2 for _, n in made) == 2


@pytest.mark.parametrize("ridge", [0.0, 0.01, 0.1, 5.0])
def test_weights_from_sums_are_those_of_the_estimator(fitted, ridge):
    rows, _ = fitted
    train, _ = learned._fitting_data(rows)
    sums = learned.moments(train)
    for i, label in enumerate(("level_target", "delta_target")):
        model = LinearRegression(labelCol=label, regParam=ridge, solver="normal").fit(train)
        weights, intercept = learned.ridge_weights(sums, i, ridge)
        assert list(weights) == pytest.approx(list(model.coefficients), abs=1e-9)
        assert intercept == pytest.approx(model.intercept, abs=1e-9)


def test_one_pass_over_the_packs_serves_all_penalties(fitted, spark):
    rows, _ = fitted
    train, _ = learned._fitting_data(rows)
    spark.sparkContext.setJobGroup("sums", "")
    learned.linear_candidates(train, learned.LearnedSettings(ridge=(0.0, 0.1, 1.0, 10.0)))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("sums")
    spark.sparkContext.setJobGroup("after", "")
    assert len(jobs) <= 2  # the number of columns is read from the first row


def test_constant_features_and_labels_weigh_nothing():
    rows = [[1.0, 3.0, i % 5, 2.0, i % 3] for i in range(30)]  # features 1, 3, x; labels 2, z
    sums = np.array([r + [1.0] for r in rows])
    sums = sums.T @ sums
    assert learned.ridge_weights(sums, 0, 0.0) == (pytest.approx([0, 0, 0]), pytest.approx(2.0))
    weights, intercept = learned.ridge_weights(sums, 1, 0.0)
    assert list(weights[:2]) == [0, 0] and weights[2] == pytest.approx(0, abs=1e-9) and intercept == pytest.approx(1.0)
