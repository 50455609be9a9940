"""SQL that gives the same rows as the registered queries.

Written from the definition of each operator, without the layout and join
choices of the Spark side: plain windows, plain joins.
"""

from __future__ import annotations

ORDERS = """
series AS (
  SELECT o_orderpriority AS series_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS t,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM orders GROUP BY 1, 2)"""

LINEITEM = """
series AS (
  SELECT l_returnflag || l_linestatus AS series_id,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS t,
         CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM lineitem GROUP BY 1, 2)"""

USERS = """
series AS (
  SELECT user_id AS series_id, ts AS t, value AS y, event_id AS tiebreak FROM events)"""

LONG = """
series AS (
  SELECT 'all' AS series_id, ts AS t, value AS y, event_id AS tiebreak FROM events)"""

SKEWED = """
series AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS series_id,
         ts AS t, value AS y, event_id AS tiebreak
  FROM events)"""

RAW = """
raw AS (
  SELECT o_orderpriority AS priority, o_orderkey AS order_key,
    CASE WHEN o_orderkey % 97 = 0 THEN 'bad'
         WHEN o_orderkey % 101 = 0
           THEN substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 4) || '-13'
         ELSE substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 7) END AS month,
    CASE WHEN o_orderkey % 89 = 0 THEN 'n/a'
         WHEN o_orderkey % 83 = 0 THEN NULL
         WHEN o_orderkey % 79 = 0 THEN 'NaN'
         ELSE CAST(o_totalprice AS VARCHAR) END AS amount
  FROM orders)"""

DIRTY = RAW + """,
series AS (
  SELECT priority AS series_id, TRY_CAST(month || '-01' AS DATE) AS t,
         TRY_CAST(amount AS DOUBLE) AS y, order_key AS tiebreak
  FROM raw)"""


def _indexed(order: str = "t") -> str:
    return f""",
indexed AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY {order}) - 1 AS idx,
         COUNT(*) OVER (PARTITION BY series_id) AS n
  FROM series),
bounds AS (
  SELECT *, CAST(floor(CAST(0.70 AS DOUBLE) * n) AS BIGINT) AS train_end,
         CAST(floor(CAST(0.85 AS DOUBLE) * n) AS BIGINT) AS validation_end
  FROM indexed),
labelled AS (
  SELECT *, CASE WHEN idx < train_end THEN 'train'
                 WHEN idx < validation_end THEN 'validation' ELSE 'test' END AS split
  FROM bounds)"""


def _r(expression: str, places: int = 4) -> str:
    rounded = "CAST(round(CAST({} AS DECIMAL(38,{})), {}) AS DOUBLE)"
    return (
        f"CASE WHEN abs({expression}) < 1000 THEN {rounded.format(expression, 10, places)} "
        f"ELSE {rounded.format(expression, 7, places)} END"
    )


def _texts(name: str, places: int) -> str:
    return (
        f"array_to_string([CAST(CAST(v AS DECIMAL(38,{places})) AS VARCHAR) for v in {name}], "
        f"',') AS {name}"
    )


def _features(order: str = "t") -> str:
    w = f"PARTITION BY series_id ORDER BY {order}"
    before = "ROWS BETWEEN {} PRECEDING AND 1 PRECEDING"
    return f""",
featured AS (
  SELECT *, lag(y, 1) OVER ({w}) AS lag_1, lag(y, 3) OVER ({w}) AS lag_3,
         lag(y, 12) OVER ({w}) AS lag_12,
         avg(y) OVER ({w} {before.format(3)}) AS rolling_mean_3,
         avg(y) OVER ({w} {before.format(12)}) AS rolling_mean_12,
         lead(y, 1) OVER ({w}) AS target_next, lead(t, 1) OVER ({w}) AS target_t
  FROM labelled),
complete AS (
  SELECT * EXCLUDE (split) FROM featured
  WHERE lag_12 IS NOT NULL AND target_next IS NOT NULL),
positions AS (
  SELECT *, ROW_NUMBER() OVER ({w}) - 1 AS pos, COUNT(*) OVER (PARTITION BY series_id) AS m
  FROM complete),
features AS (
  SELECT *, CASE WHEN pos < floor(CAST(0.70 AS DOUBLE) * m) THEN 'train'
                 WHEN pos < floor(CAST(0.85 AS DOUBLE) * m) THEN 'validation'
                 ELSE 'test' END AS split
  FROM positions)"""


SCALED = """,
fit AS (
  SELECT series_id, avg(y) AS scale_mean, stddev_pop(y) + 1e-8 AS scale_std
  FROM labelled WHERE split = 'train' GROUP BY 1),
scaled AS (
  SELECT l.*, scale_mean, scale_std, (y - scale_mean) / scale_std AS z
  FROM labelled l JOIN fit USING (series_id))"""


def _windowed(value: str, source: str, order: str = "t") -> str:
    w = f"PARTITION BY series_id ORDER BY {order}"
    return f""",
windowed AS (
  SELECT * FROM (
    SELECT *, list({value}) OVER ({w} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS x
    FROM {source})
  WHERE idx >= 24)"""


def _forecasts(order: str = "t", season: int = 12) -> str:
    w = f"PARTITION BY series_id ORDER BY {order}"
    return f""",
wide AS (
  SELECT *, lag(y, 1) OVER ({w}) AS naive,
         avg(y) OVER ({w} ROWS BETWEEN {season} PRECEDING AND 1 PRECEDING) AS moving,
         CASE WHEN idx >= {season} THEN lag(y, {season}) OVER ({w}) ELSE lag(y, 1) OVER ({w}) END
           AS seasonal
  FROM labelled),
trend AS (
  SELECT series_id, regr_slope(y, idx) AS a, regr_intercept(y, idx) AS b
  FROM labelled WHERE split = 'train' GROUP BY 1),
tested AS (
  SELECT wide.*, a * idx + b AS trend FROM wide LEFT JOIN trend USING (series_id)
  WHERE split = 'test'),
forecasts AS (
  SELECT series_id, t, idx, 'Baseline' AS condition, model, model_order, y AS actual, forecast
  FROM (
    SELECT *, 'Naive' AS model, 0 AS model_order, naive AS forecast FROM tested UNION ALL
    SELECT *, 'MovingAvg-{season}', 1, moving FROM tested UNION ALL
    SELECT *, 'SeasonalNaive-{season}', 2, seasonal FROM tested UNION ALL
    SELECT *, 'LinearTrend', 3, trend FROM tested))"""


def _scores(source: str = "forecasts") -> str:
    return f""",
scores AS (
  SELECT series_id, condition, model, model_order,
         avg(abs(actual - forecast)) AS mae,
         sqrt(avg((actual - forecast) * (actual - forecast))) AS rmse,
         avg(CASE WHEN abs(actual) >= 1e-8
                  THEN abs((actual - forecast) / actual) END) * 100 AS mape
  FROM {source} GROUP BY ALL),
records AS (
  SELECT series_id, condition, model, model_order, CAST(NULL AS DOUBLE) AS best_val_mse,
         {_r("mae", 3)} AS test_mae, {_r("rmse", 3)} AS test_rmse,
         {_r("mape", 2)} AS test_mape_percent
  FROM scores),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY series_id ORDER BY test_rmse, model_order, condition, model) AS rank
  FROM records)"""


REVIEW = f""",
errors AS (
  SELECT f.*, rank, abs(actual - forecast) AS absolute_error,
         avg(abs(actual - forecast)) OVER m
           + 1.5 * stddev_pop(abs(actual - forecast)) OVER m AS error_threshold
  FROM forecasts f JOIN ranked USING (series_id, condition, model)
  WINDOW m AS (PARTITION BY f.series_id, f.condition, f.model)),
reviewed AS (
  SELECT *, round(absolute_error, 6) >= round(error_threshold, 6) AS high_error_flag
  FROM errors),
review AS (
  SELECT series_id, substr(CAST(CAST(t AS DATE) AS VARCHAR), 1, 7) AS month, idx, condition, model,
         rank, {_r("actual", 3)} AS actual, {_r("forecast", 3)} AS forecast,
         {_r("absolute_error", 3)} AS absolute_error,
         {_r("error_threshold", 3)} AS error_threshold, high_error_flag
  FROM reviewed)"""


def _tied(source: str, series: str) -> str:
    """Review of three models with the naive forecasts, the first by name."""
    tied = """,
tied AS (
  SELECT * EXCLUDE (model, letter), 'Naive-' || letter AS model
  FROM (SELECT * FROM forecasts WHERE model = 'Naive'), (VALUES ('C'), ('A'), ('B')) v(letter))"""
    parts = series + _indexed("t, tiebreak") + _forecasts("t, tiebreak")
    parts += tied + _scores("tied")
    parts += REVIEW.replace("FROM forecasts f", "FROM tied f")
    row = "series_id, idx, model, actual, forecast, absolute_error, error_threshold, high_error_flag"
    return f"SELECT '{source}' AS source, * FROM (WITH {parts.strip()}\nSELECT {row} FROM review WHERE rank = 1)"


# Least squares over scaled windows of one value, all series together.
ONE_VALUE = """,
fit AS (
  SELECT series_id, avg(y) AS scale_mean, stddev_pop(y) + 1e-8 AS scale_std
  FROM labelled WHERE split = 'train' GROUP BY 1),
scaled AS (
  SELECT l.*, scale_mean, scale_std,
         coalesce(scale_std - 1e-8 > 1e-8 * greatest(1.0, abs(scale_mean)), FALSE) AS spread,
         (y - scale_mean) / scale_std AS z,
         (lag(y) OVER (PARTITION BY l.series_id ORDER BY idx) - scale_mean) / scale_std AS x
  FROM labelled l LEFT JOIN fit ON l.series_id = fit.series_id),
windowed AS (SELECT *, spread AND x IS NOT NULL AND z IS NOT NULL AS usable FROM scaled WHERE idx >= 1),
line AS (
  SELECT 'Learned - no differencing' AS condition, regr_slope(z, x) AS a, regr_intercept(z, x) AS b,
         0.0 AS last
  FROM windowed WHERE usable AND split = 'train' UNION ALL
  SELECT 'Learned - differencing', regr_slope(z - x, x), regr_intercept(z - x, x), 1.0
  FROM windowed WHERE usable AND split = 'train'),
selection AS (
  SELECT condition, 'LinearRegression' AS model,
         avg((z - last * x - a * x - b) * (z - last * x - a * x - b)) AS best_val_mse
  FROM windowed, line WHERE usable AND split = 'validation' GROUP BY 1),
learned AS (
  SELECT series_id, idx, condition, 'LinearRegression' AS model, 100 AS model_order, y AS actual,
         CASE WHEN spread THEN (last * x + a * x + b) * scale_std + scale_mean END AS forecast
  FROM windowed, line WHERE split = 'test')"""

EXTERNAL = SCALED + _windowed("z", "scaled") + """,
external AS (
  SELECT series_id, t, idx, 'External' AS condition, 'SeasonChange' AS model, 4 AS model_order,
         y AS actual, (x[24] + x[13] - x[12]) * scale_std + scale_mean AS forecast
  FROM windowed WHERE split = 'test')"""

PERIODS = """,
periods AS (
  SELECT series_id, t, COUNT(*) AS c, COUNT(*) FILTER (WHERE y IS NULL) AS missing,
         COUNT(*) FILTER (WHERE isnan(y)) AS nans
  FROM series GROUP BY 1, 2)"""


def _sql(parts: str, select: str) -> str:
    return f"WITH {parts.strip()}\n{select}"


DAY = "CAST(t AS VARCHAR) AS t"
LAGS = "lag_1, lag_3, lag_12"
ROLLS = f"{_r('rolling_mean_3')} AS rolling_mean_3, {_r('rolling_mean_12')} AS rolling_mean_12"
FEATURE_ROW = f"y, {LAGS}, {ROLLS}, target_next, split"
FEATURE_DAYS = f"series_id, {DAY}, CAST(target_t AS VARCHAR) AS target_t, {FEATURE_ROW}"
METRICS = f"{_r('mae')} AS mae, {_r('rmse')} AS rmse, {_r('mape')} AS mape"
RECORD = "series_id, condition, model, best_val_mse, test_mae, test_rmse, test_mape_percent"
REVIEW_ROW = "actual, forecast, absolute_error, error_threshold, high_error_flag"
COMPARISON = "series_id, month, actual, forecast, absolute_error, model, condition"
TEXTS = "CAST(t AS VARCHAR) AS t, idx"

ORDERS_INDEXED = ORDERS + _indexed()
ORDERS_FORECASTS = ORDERS_INDEXED + _forecasts()
ORDERS_RANKED = ORDERS_FORECASTS + _scores()
ORDERS_REVIEW = ORDERS_RANKED + REVIEW
EVENT_ORDER = "t, tiebreak"
USERS_INDEXED = USERS + _indexed(EVENT_ORDER)
USERS_RANKED = USERS_INDEXED + _forecasts(EVENT_ORDER) + _scores()
LONG_INDEXED = LONG + _indexed(EVENT_ORDER)
SKEWED_INDEXED = SKEWED + _indexed(EVENT_ORDER)
SKEWED_RANKED = SKEWED_INDEXED + _forecasts(EVENT_ORDER) + _scores()
DIRTY_ORDER = "t NULLS FIRST, tiebreak"
DIRTY_INDEXED = DIRTY + _indexed(DIRTY_ORDER)

_SPLIT_COUNTS = """SELECT series_id, COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE split = 'train') AS train_rows,
  COUNT(*) FILTER (WHERE split = 'validation') AS validation_rows,
  COUNT(*) FILTER (WHERE split = 'test') AS test_rows
FROM labelled GROUP BY 1"""

_WINDOW_COUNTS = """SELECT series_id,
  COUNT(*) FILTER (WHERE idx >= 24 AND split = 'train') AS train_windows,
  COUNT(*) FILTER (WHERE idx >= 24 AND split = 'validation') AS validation_windows,
  COUNT(*) FILTER (WHERE idx >= 24 AND split = 'test') AS test_windows
FROM labelled GROUP BY 1"""

_PREP_REPORT = """SELECT series_id, raw_rows, missing_months, missing_values, nan_values,
  duplicate_groups, duplicate_rows, COALESCE(feature_rows, 0) AS feature_rows,
  COALESCE(train_rows, 0) AS train_rows, COALESCE(validation_rows, 0) AS validation_rows,
  COALESCE(test_rows, 0) AS test_rows
FROM (
  SELECT series_id, CAST(SUM(c) AS BIGINT) AS raw_rows,
         CAST(COALESCE(SUM(c) FILTER (WHERE t IS NULL), 0) AS BIGINT) AS missing_months,
         CAST(SUM(missing) AS BIGINT) AS missing_values, CAST(SUM(nans) AS BIGINT) AS nan_values,
         COUNT(*) FILTER (WHERE c > 1) AS duplicate_groups,
         CAST(SUM(c - 1) AS BIGINT) AS duplicate_rows
  FROM periods GROUP BY 1)
LEFT JOIN (
  SELECT series_id, COUNT(*) AS feature_rows, COUNT(*) FILTER (WHERE split = 'train') AS train_rows,
         COUNT(*) FILTER (WHERE split = 'validation') AS validation_rows,
         COUNT(*) FILTER (WHERE split = 'test') AS test_rows
  FROM features GROUP BY 1) USING (series_id)"""


def _quality(dataset: str) -> str:
    return f"""SELECT series_id, '{dataset}' AS dataset, n AS total_observations,
  start_month, end_month, missing_values, duplicate_months,
  train_end AS train_points, validation_end - train_end AS validation_points,
  n - validation_end AS test_points, CAST(24 AS BIGINT) AS window_length,
  greatest(train_end - 24, 0) AS train_windows,
  validation_end - train_end AS validation_windows, n - validation_end AS test_windows
FROM (
  SELECT *, CAST(floor(CAST(0.70 AS DOUBLE) * n) AS BIGINT) AS train_end,
         CAST(floor(CAST(0.85 AS DOUBLE) * n) AS BIGINT) AS validation_end
  FROM (
    SELECT series_id, COUNT(*) AS n, substr(CAST(MIN(t) AS VARCHAR), 1, 7) AS start_month,
           substr(CAST(MAX(t) AS VARCHAR), 1, 7) AS end_month,
           COUNT(*) FILTER (WHERE y IS NULL OR isnan(y)) AS missing_values,
           COUNT(*) - COUNT(DISTINCT COALESCE(CAST(t AS VARCHAR), 'none')) AS duplicate_months
    FROM series GROUP BY 1))"""


_BEST_VS_NEXT = f"""
best AS (
  SELECT b.series_id, b.model AS best_model, b.condition AS best_condition,
    b.test_mae AS best_mae, b.test_rmse AS best_rmse, b.test_mape_percent AS best_mape_percent,
    s.model AS next_best_model, s.condition AS next_best_condition,
    s.test_rmse AS next_best_rmse,
    {_r("s.test_rmse - b.test_rmse", 3)} AS rmse_improvement_vs_next_best,
    {_r("(s.test_rmse - b.test_rmse) / s.test_rmse * 100", 2)}
      AS rmse_improvement_percent_vs_next_best
  FROM ranked b LEFT JOIN ranked s ON s.series_id = b.series_id AND s.rank = 2
  WHERE b.rank = 1)"""

def _summary(dataset: str) -> str:
    return f"""SELECT best.*, total_observations, models_compared,
  'Baseline' AS conditions_compared, high_error_periods_flagged, review_threshold,
  '{dataset}' AS dataset, '1-step ahead' AS forecast_horizon,
  CAST(24 AS BIGINT) AS window_length, CAST(42 AS BIGINT) AS seed
FROM best
JOIN (SELECT series_id, COUNT(*) AS total_observations FROM series GROUP BY 1) USING (series_id)
JOIN (SELECT series_id, COUNT(*) AS models_compared FROM records GROUP BY 1) USING (series_id)
JOIN (SELECT series_id, COUNT(*) FILTER (WHERE high_error_flag) AS high_error_periods_flagged,
             MAX(error_threshold) AS review_threshold
      FROM review WHERE rank = 1 GROUP BY 1) USING (series_id)"""


def _forecast(column: str) -> str:
    return _sql(
        ORDERS_FORECASTS,
        f"SELECT series_id, {TEXTS}, y AS actual, {_r(column)} AS forecast FROM tested",
    )


_FORECAST_ROW = (
    f"series_id, {TEXTS}, condition, model, actual, {_r('forecast', 2)} AS forecast"
)
_SUMMARY = _sql(ORDERS_REVIEW + "," + _BEST_VS_NEXT, _summary("monthly_orders"))
_BOTH = """,
every AS (SELECT * FROM forecasts UNION ALL SELECT * FROM external)"""
_LOADED = _sql(ORDERS, f"SELECT series_id, {DAY}, y FROM series")
_RECORDS = _sql(ORDERS_RANKED, f"SELECT {RECORD} FROM records")
_COMPARED = _sql(ORDERS_REVIEW, f"SELECT {COMPARISON} FROM review WHERE rank = 1")
_REVIEWED = f"SELECT series_id, month, model, {REVIEW_ROW} FROM review"
_FEATURES = _sql(ORDERS_INDEXED + _features(), f"SELECT {FEATURE_DAYS} FROM features")
_SUITE = f"SELECT series_id, model, {METRICS} FROM scores"
_TARGETS = (
    f"{_r('x[24]')} AS last_level, {_r('z')} AS level_target, {_r('z - x[24]')} AS delta_target"
)
ORDERS_WINDOWED = ORDERS_INDEXED + SCALED + _windowed("z", "scaled")
USERS_WINDOWED = USERS_INDEXED + SCALED + _windowed("z", "scaled", EVENT_ORDER)
# Training rows of series whose training values differ; windows and targets have no gaps here.
_LEARNABLE = """,
learnable AS (
  SELECT list_concat(x, [z, z - x[24], 1.0]) AS v FROM windowed
  WHERE split = 'train' AND scale_std - 1e-8 > 1e-8 * greatest(1, abs(scale_mean)))"""
_MOMENTS = f"""
SELECT CAST(a.i AS INTEGER) AS a, CAST(b.i AS INTEGER) AS b, {_r('SUM(v[a.i + 1] * v[b.i + 1])')} AS value
FROM learnable, range(27) a(i), range(27) b(i) GROUP BY 1, 2"""
_OPTIMALITY = """
SELECT condition, CAST(ridge AS DOUBLE) AS ridge, CAST(f.i AS INTEGER) AS feature,
       (SELECT COUNT(*) FROM learnable) AS train_rows, CAST(0 AS DOUBLE) AS slope
FROM (VALUES ('Learned - no differencing'), ('Learned - differencing')) c(condition),
     (VALUES (0.0), (0.01), (0.1)) r(ridge), range(25) f(i)"""

ORACLE: dict[str, str] = {
    "load_series": _LOADED,
    "load_series_lineitem": _sql(LINEITEM, f"SELECT series_id, {DAY}, y FROM series"),
    "scan_series_csv": _LOADED,
    "scan_series_csv_folder": _LOADED,
    "unreadable_rows": _sql(
        RAW, "SELECT *, CASE WHEN TRY_CAST(month || '-01' AS DATE) IS NOT NULL THEN 'value' "
        "WHEN amount IS NULL OR TRY_CAST(amount AS DOUBLE) IS NOT NULL THEN 'month' "
        "ELSE 'month and value' END AS unreadable FROM raw "
        "WHERE TRY_CAST(month || '-01' AS DATE) IS NULL "
        "OR amount IS NOT NULL AND TRY_CAST(amount AS DOUBLE) IS NULL"),
    "parse_month": _sql(
        RAW, "SELECT order_key, CAST(TRY_CAST(month || '-01' AS DATE) AS VARCHAR) AS month_date "
        "FROM raw"),
    "cast_measure": _sql(
        RAW, "SELECT order_key, COALESCE(isnan(TRY_CAST(amount AS DOUBLE)), FALSE) AS is_nan, "
        "CASE WHEN NOT isnan(TRY_CAST(amount AS DOUBLE)) THEN TRY_CAST(amount AS DOUBLE) END "
        "AS amount FROM raw"),
    "prepare_series": _sql(
        DIRTY, f"SELECT series_id, tiebreak AS order_key, {DAY}, "
        "CASE WHEN NOT isnan(y) THEN y END AS y FROM series"),
    "duplicate_groups": _sql(
        DIRTY + PERIODS, "SELECT series_id, COUNT(*) FILTER (WHERE c > 1) AS duplicate_groups "
        "FROM periods GROUP BY 1"),
    "duplicate_rows": _sql(
        DIRTY + PERIODS, "SELECT series_id, CAST(SUM(c - 1) AS BIGINT) AS duplicate_rows "
        "FROM periods GROUP BY 1"),
    "prep_report": _sql(DIRTY_INDEXED + _features(DIRTY_ORDER) + PERIODS, _PREP_REPORT),
    "prep_report_orders": _sql(ORDERS_INDEXED + _features() + PERIODS, _PREP_REPORT),
    "prep_report_skewed": _sql(
        SKEWED_INDEXED + _features(EVENT_ORDER) + PERIODS, _PREP_REPORT),
    "data_quality_report_users": _sql(USERS, _quality("user_events")),
    "data_quality_report": _sql(ORDERS, _quality("monthly_orders")),
    "data_quality_report_dirty": _sql(DIRTY, _quality("dirty_orders")),
    "chrono_index": _sql(ORDERS_INDEXED, f"SELECT series_id, {DAY}, y, idx, n FROM indexed"),
    "chrono_index_long": _sql(
        LONG_INDEXED, "SELECT series_id, tiebreak AS event_id, y, idx, n FROM indexed"),
    "split_raw": _sql(ORDERS_INDEXED, f"SELECT series_id, {TEXTS}, split FROM labelled"),
    "split_raw_users": _sql(
        USERS_INDEXED, "SELECT series_id, tiebreak AS event_id, idx, split FROM labelled"),
    "split_counts": _sql(ORDERS_INDEXED, _SPLIT_COUNTS),
    "split_counts_users": _sql(USERS_INDEXED, _SPLIT_COUNTS),
    "test_slice": _sql(
        ORDERS_INDEXED, f"SELECT series_id, {TEXTS}, y FROM labelled WHERE split = 'test'"),
    "window_counts": _sql(ORDERS_INDEXED, _WINDOW_COUNTS),
    "window_counts_users": _sql(USERS_INDEXED, _WINDOW_COUNTS),
    "lag_features": _sql(
        ORDERS_INDEXED + _features(), f"SELECT series_id, {DAY}, y, {LAGS} FROM featured"),
    "lag_features_users": _sql(
        USERS_INDEXED + _features(EVENT_ORDER),
        f"SELECT series_id, tiebreak AS event_id, y, {LAGS} FROM featured"),
    "rolling_means": _sql(
        ORDERS_INDEXED + _features(), f"SELECT series_id, {DAY}, {ROLLS} FROM featured"),
    "lead_target": _sql(
        ORDERS_INDEXED + _features(),
        f"SELECT series_id, {DAY}, target_next, CAST(target_t AS VARCHAR) AS target_t "
        "FROM featured"),
    "complete_rows": _sql(
        ORDERS_INDEXED + _features(),
        f"SELECT series_id, {TEXTS}, lag_12, target_next FROM complete"),
    "split_features": _sql(
        ORDERS_INDEXED + _features(), f"SELECT series_id, {DAY}, split FROM features"),
    "feature_table": _FEATURES,
    "feature_table_lineitem": _sql(
        LINEITEM + _indexed() + _features(), f"SELECT {FEATURE_DAYS} FROM features"),
    "feature_table_users": _sql(
        USERS_INDEXED + _features(EVENT_ORDER),
        f"SELECT series_id, tiebreak AS event_id, {FEATURE_ROW} FROM features"),
    "feature_table_skewed": _sql(
        SKEWED_INDEXED + _features(EVENT_ORDER),
        f"SELECT series_id, tiebreak AS event_id, {FEATURE_ROW} FROM features"),
    "feature_table_long": _sql(
        LONG_INDEXED + _features(EVENT_ORDER),
        f"SELECT series_id, tiebreak AS event_id, {FEATURE_ROW} FROM features"),
    "sink_features": _FEATURES,
    "scaler_fit": _sql(
        ORDERS_INDEXED + SCALED,
        f"SELECT series_id, {_r('scale_mean')} AS scale_mean, {_r('scale_std')} AS scale_std "
        "FROM fit"),
    "scaler_fit_skewed": _sql(
        SKEWED_INDEXED + SCALED,
        f"SELECT series_id, {_r('scale_mean')} AS scale_mean, {_r('scale_std')} AS scale_std "
        "FROM fit"),
    "scaler_transform": _sql(
        ORDERS_INDEXED + SCALED, f"SELECT series_id, {DAY}, {_r('z')} AS z FROM scaled"),
    "scaler_transform_long": _sql(
        LONG_INDEXED + SCALED,
        f"SELECT series_id, tiebreak AS event_id, {_r('z')} AS z FROM scaled"),
    "scaler_roundtrip": _sql(
        ORDERS_INDEXED + SCALED,
        f"SELECT series_id, {DAY}, {_r('z * scale_std + scale_mean', 2)} AS y_back FROM scaled"),
    "window_arrays": _sql(
        ORDERS_INDEXED + _windowed("y", "labelled"),
        f"SELECT series_id, {TEXTS}, {_texts('x', 2)} FROM windowed"),
    "window_arrays_long": _sql(
        LONG_INDEXED + _windowed("y", "labelled", EVENT_ORDER),
        f"SELECT series_id, idx, {_texts('x', 2)} FROM windowed"),
    "level_delta_targets": _sql(
        ORDERS_WINDOWED, f"SELECT series_id, {TEXTS}, split, {_TARGETS} FROM windowed"),
    "level_delta_targets_skewed": _sql(
        SKEWED_INDEXED + SCALED + _windowed("z", "scaled", EVENT_ORDER),
        f"SELECT series_id, idx, split, {_TARGETS} FROM windowed"),
    "supervised_rows_users": _sql(
        USERS_INDEXED + SCALED + _windowed("z", "scaled", EVENT_ORDER),
        f"SELECT series_id, idx, split, {_texts('x', 5)}, {_r('z')} AS level_target "
        "FROM windowed"),
    "supervised_rows": _sql(
        ORDERS_WINDOWED,
        f"SELECT series_id, {TEXTS}, split, {_texts('x', 5)}, {_TARGETS} FROM windowed"),
    "reconstruct_levels": _sql(
        ORDERS_INDEXED + EXTERNAL,
        f"SELECT series_id, {TEXTS}, {_r('actual', 2)} AS y, {_r('forecast', 2)} AS forecast "
        "FROM external"),
    "forecast_naive": _forecast("naive"),
    "forecast_moving_avg": _forecast("moving"),
    "forecast_seasonal_naive": _forecast("seasonal"),
    "forecast_linear_trend": _forecast("trend"),
    "baseline_suite": _sql(ORDERS_RANKED, _SUITE),
    "baseline_suite_users": _sql(USERS_RANKED, _SUITE),
    "baseline_suite_lineitem": _sql(LINEITEM + _indexed() + _forecasts() + _scores(), _SUITE),
    "baseline_suite_skewed": _sql(SKEWED_RANKED, _SUITE),
    "baseline_suite_long": _sql(LONG_INDEXED + _forecasts(EVENT_ORDER) + _scores(), _SUITE),
    "metric_mae": _sql(ORDERS_RANKED, f"SELECT series_id, model, {_r('mae')} AS mae FROM scores"),
    "metric_rmse": _sql(
        ORDERS_RANKED, f"SELECT series_id, model, {_r('rmse')} AS rmse FROM scores"),
    "metric_mape": _sql(
        USERS_RANKED, f"SELECT series_id, model, {_r('mape')} AS mape FROM scores"),
    "join_forecasts": _sql(ORDERS_INDEXED + EXTERNAL, f"SELECT {_FORECAST_ROW} FROM external"),
    "all_forecasts": _sql(
        ORDERS_FORECASTS + EXTERNAL + _BOTH, f"SELECT {_FORECAST_ROW} FROM every"),
    "result_records": _RECORDS,
    "leaderboard": _sql(
        ORDERS_FORECASTS + EXTERNAL + _BOTH + _scores("every"), f"SELECT {RECORD} FROM records"),
    "leaderboard_users": _sql(USERS_RANKED, f"SELECT {RECORD} FROM records"),
    "rank_models": _sql(ORDERS_RANKED, "SELECT series_id, rank, model, test_rmse FROM ranked"),
    "best_model": _sql(
        ORDERS_RANKED,
        "SELECT series_id, model, test_mae, test_rmse, test_mape_percent FROM ranked "
        "WHERE rank = 1"),
    "best_vs_next": _sql(ORDERS_RANKED + "," + _BEST_VS_NEXT, "SELECT * FROM best"),
    "forecast_comparison": _COMPARED,
    "high_error_review": _sql(ORDERS_REVIEW, f"{_REVIEWED} WHERE rank = 1"),
    "high_error_review_by_model": _sql(ORDERS_REVIEW, _REVIEWED),
    "high_error_review_users": _sql(
        USERS_RANKED + REVIEW,
        f"SELECT series_id, idx, model, {REVIEW_ROW} FROM review WHERE rank = 1"),
    "high_error_review_skewed": _sql(
        SKEWED_RANKED + REVIEW,
        f"SELECT series_id, idx, model, {REVIEW_ROW} FROM review WHERE rank = 1"),
    "run_summary_skewed": _sql(
        SKEWED_RANKED + REVIEW + "," + _BEST_VS_NEXT, _summary("skewed_events")),
    "run_summary": _SUMMARY,
    "scan_series_csv_reordered": _LOADED,
    "baseline_suite_season7": _sql(
        USERS_INDEXED + _forecasts(EVENT_ORDER, 7) + _scores(), _SUITE),
    "high_error_review_ties": _tied("users", USERS) + "\nUNION ALL\n" + _tied("skewed", SKEWED),
    "learned_forecast_one_value": _sql(
        USERS_INDEXED + ONE_VALUE,
        f"SELECT series_id, idx, condition, model, actual, {_r('forecast', 3)} AS forecast "
        "FROM learned"),
    "model_selection_one_value": _sql(
        USERS_INDEXED + ONE_VALUE,
        f"SELECT condition, model, {_r('best_val_mse', 6)} AS best_val_mse, "
        "'regParam=0.0' AS setting FROM selection"),
    "leaderboard_one_value": _sql(
        USERS_INDEXED + ONE_VALUE + _scores("learned"),
        "SELECT series_id, condition, model, "
        f"{_r('s.best_val_mse', 6)} AS best_val_mse, test_mae, test_rmse, test_mape_percent "
        "FROM records r JOIN selection s USING (condition, model)"),
    "boosted_validation": _sql(
        ORDERS_INDEXED,
        "SELECT condition, COUNT(*) AS validation_rows, CAST(0 AS DOUBLE) AS difference "
        "FROM labelled, (VALUES ('Learned - no differencing'), ('Learned - differencing')) "
        "v(condition) WHERE split = 'validation' AND idx >= 6 GROUP BY 1"),
    "learning_moments": _sql(ORDERS_WINDOWED + _LEARNABLE, _MOMENTS),
    "learning_moments_users": _sql(USERS_WINDOWED + _LEARNABLE, _MOMENTS),
    "linear_optimality": _sql(ORDERS_WINDOWED + _LEARNABLE, _OPTIMALITY),
    "linear_optimality_users": _sql(USERS_WINDOWED + _LEARNABLE, _OPTIMALITY),
    "boosted_validation_full": _sql(
        ORDERS_INDEXED,
        "SELECT condition, COUNT(*) AS validation_rows, CAST(0 AS DOUBLE) AS difference, TRUE AS ended_by_patience "
        "FROM labelled, (VALUES ('Learned - no differencing'), ('Learned - differencing')) "
        "v(condition) WHERE split = 'validation' AND idx >= 24 GROUP BY 1"),
    "feature_table_in_steps": _FEATURES,
    "feature_table_skewed_in_steps": _sql(
        SKEWED_INDEXED + _features(EVENT_ORDER),
        f"SELECT series_id, tiebreak AS event_id, {FEATURE_ROW} FROM features"),
    "data_quality_report_in_steps": _sql(USERS, _quality("user_events")),
    "sink_reports": _RECORDS,
    "sink_forecast_report": _COMPARED,
    "sink_review_report": _sql(ORDERS_REVIEW, f"{_REVIEWED} WHERE rank = 1"),
    "sink_quality_report": _sql(ORDERS, _quality("monthly_orders")),
    "sink_summary_json": _SUMMARY,
}
