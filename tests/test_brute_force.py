"""Random series with gaps against pandas, all series in one run per layout."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from seriesflow.config import PLAIN, Layout
from seriesflow.operators import baselines, features, review, score, windows

SERIES = 60
BOTH = [PLAIN, Layout("auto", block_rows=25)]


@pytest.fixture(scope="module")
def values():
    source = random.Random(11)

    def value():
        if source.random() < 0.08:
            return None
        return 0.0 if source.random() < 0.05 else round(source.uniform(-50, 50), 2)

    return {f"k{i:02d}": [value() for _ in range(source.randint(1, 90))] for i in range(SERIES)}


@pytest.fixture(scope="module")
def series(make_series, values):
    return make_series(**values).cache()


def _pandas(values):
    return {k: pd.Series(v, dtype="float64") for k, v in values.items()}


def _equal(found, expected):
    if found is None or expected is None or math.isnan(expected):
        return found is None and (expected is None or math.isnan(expected))
    return math.isclose(found, expected, rel_tol=1e-9, abs_tol=1e-9)


def _before(s, k):
    return s.shift(1).rolling(k, min_periods=1).mean()


@pytest.mark.parametrize("layout", BOTH, ids=str)
def test_feature_table(series, values, layout):
    found = {(r.series_id, r.t): r for r in features.feature_table(series, layout).collect()}
    times = {k: sorted(r.t for r in rows) for k, rows in _by_key(series).items()}
    expected = 0
    for key, s in _pandas(values).items():
        table = pd.DataFrame({
            "y": s, "lag_1": s.shift(1), "lag_3": s.shift(3), "lag_12": s.shift(12),
            "rolling_mean_3": _before(s, 3), "rolling_mean_12": _before(s, 12),
            "target_next": s.shift(-1),
        })
        kept = table[table.lag_12.notna() & table.target_next.notna()]
        ends = int(0.70 * len(kept)), int(0.85 * len(kept))
        for place, (i, row) in enumerate(kept.iterrows()):
            got = found[key, times[key][i]]
            assert all(_equal(got[c], row[c]) for c in kept.columns)
            assert got.target_t == times[key][i + 1]
            assert got.split == ("train", "validation", "test")[sum(place >= e for e in ends)]
        expected += len(kept)
    assert len(found) == expected > 500


def _by_key(df):
    rows = {}
    for r in df.collect():
        rows.setdefault(r.series_id, []).append(r)
    return rows


def _expected_forecasts(s):
    n = len(s)
    place = np.arange(n)
    fit = s[: int(0.70 * n)].dropna()
    trend = np.full(n, np.nan)
    if len(fit) > 1:
        slope, start = np.polyfit(fit.index, fit, 1)
        trend = slope * place + start
    return {
        "Naive": s.shift(1),
        "MovingAvg-12": _before(s, 12),
        "SeasonalNaive-12": s.shift(12).where(place >= 12, s.shift(1)),
        "LinearTrend": pd.Series(trend),
    }


@pytest.mark.parametrize("layout", BOTH, ids=str)
def test_forecasts_and_metrics(series, values, layout):
    forecasts = baselines.baseline_forecasts(series, layout).cache()
    found = {(r.series_id, r.model, r.idx): r for r in forecasts.collect()}
    wide = {(r.series_id, r.model): r for r in baselines.baseline_suite(series, layout).collect()}
    long = {(r.series_id, r.model): r for r in score.score(forecasts).collect()}
    rows = 0
    for key, s in _pandas(values).items():
        first = int(0.85 * len(s))
        for model, forecast in _expected_forecasts(s).items():
            for i in range(first, len(s)):
                got = found[key, model, i]
                assert _equal(got.actual, s[i]) and _equal(got.forecast, forecast[i])
                rows += 1
            error = (s - forecast)[first:]
            shares = (error / s.where(s.abs() >= 1e-8)).abs()[first:]
            expected = error.abs().mean(), math.sqrt((error**2).mean()), shares.mean() * 100
            for scores in (wide, long):
                got = scores[key, model]
                assert all(map(_equal, (got.mae, got.rmse, got.mape), expected))
    assert len(found) == rows


@pytest.mark.parametrize("layout", BOTH, ids=str)
def test_review(series, values, layout):
    forecasts = baselines.baseline_forecasts(series, layout)
    rows = review.high_error_review_by_model(forecasts, layout).collect()
    flags = {(r.series_id, r.model, r.idx): r.high_error_flag for r in rows}
    best = {r.series_id: r.model for r in review.high_error_review(forecasts, layout).collect()}
    for key, s in _pandas(values).items():
        first, rmse = int(0.85 * len(s)), {}
        for model, forecast in _expected_forecasts(s).items():
            error = (s - forecast).abs()[first:]
            threshold = error.mean() + 1.5 * error.std(ddof=0)
            for i, e in error.items():
                wanted = None if math.isnan(e) else round(e, 6) >= round(threshold, 6)
                assert flags[key, model, i] == wanted
            rmse[model] = round(math.sqrt((error**2).mean()), 3)
        known = {m: v for m, v in rmse.items() if not math.isnan(v)}
        if known:
            assert rmse[best[key]] == min(known.values())


@pytest.mark.parametrize("layout", BOTH, ids=str)
def test_windows(series, values, layout):
    rows = windows.supervised_rows(series, layout).collect()
    assert len(rows) == sum(max(len(v) - 24, 0) for v in values.values())
    tables = _pandas(values)
    for r in rows:
        s = tables[r.series_id]
        fit = s[: int(0.70 * len(s))]
        z = (s - fit.mean()) / (fit.std(ddof=0) + 1e-8)
        assert all(map(_equal, r.x, z[r.idx - 24:r.idx]))
        assert _equal(r.level_target, z[r.idx]) and _equal(r.last_level, z[r.idx - 1])
        assert _equal(r.delta_target, z[r.idx] - z[r.idx - 1])
