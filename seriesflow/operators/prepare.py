"""Typing of raw rows and data-quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from seriesflow.config import AUTO, IDX, KEY, LAGS, T, TIE, WINDOW, Y, Layout
from seriesflow.functions import columns as C
from seriesflow.plans.layout import index_series


def prepare_series(
    raw: DataFrame, key: Column, month: Column, value: Column, tiebreak: Column | None = None
) -> DataFrame:
    """Type month and value texts; what cannot be read becomes NULL."""
    columns = [key.alias(KEY), C.month_date(month).alias(T), C.measure(value).alias(Y)]
    if tiebreak is not None:
        columns.append(tiebreak.alias(TIE))
    return raw.select(*columns)


def unreadable_rows(raw: DataFrame, month: Column, value: Column) -> DataFrame:
    """The rows whose month or value text is there but cannot be read, with all their columns."""
    bad = [(month.isNotNull() & C.month_date(month).isNull(), "month"),
           (value.isNotNull() & C.measure(value).isNull(), "value")]
    reasons = F.array_compact(F.array(*[F.when(is_bad, F.lit(name)) for is_bad, name in bad]))
    return raw.withColumn("unreadable", F.array_join(reasons, " and ")).filter("unreadable != ''")


def _per_period(df: DataFrame) -> DataFrame:
    """Rows, missing and NaN values per series and period.

    The missing period counts as a period of its own.
    """
    return df.groupBy(KEY, T).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col(Y).isNull()).alias("_missing"),
        F.count_if(F.isnan(Y)).alias("_nan"),
    )


def duplicate_groups(df: DataFrame) -> DataFrame:
    """Number of periods that occur more than once, per series."""
    return _per_period(df).groupBy(KEY).agg(
        F.count_if(F.col("_rows") > 1).alias("duplicate_groups")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows beyond the first of each period, per series."""
    return _per_period(df).groupBy(KEY).agg(F.sum(F.col("_rows") - 1).alias("duplicate_rows"))


def _report_windows(w: WindowSpec) -> dict[str, Column]:
    return {
        "_lag": F.lag(Y, max(LAGS)).over(w),
        "_next": F.lead(Y, 1).over(w),
        "_before": F.lag(T, 1).over(w),
        "_before_that": F.lag(T, 2).over(w),
    }


def prep_report(df: DataFrame, layout: Layout = AUTO) -> DataFrame:
    """Quality counts, size of the feature table and its splits, per series.

    Rows of one period are neighbours in the order the features need anyway,
    so duplicates are counted there, without grouping by period as well. The
    split sizes follow from the number of feature rows.
    """
    rows = index_series(df, layout, _report_windows, back=max(LAGS), ahead=1).df
    # The position tells a missing period before from there being no row before.
    repeated = (F.col(IDX) >= 1) & F.col(T).eqNullSafe(F.col("_before"))
    second = repeated & ~((F.col(IDX) >= 2) & F.col(T).eqNullSafe(F.col("_before_that")))
    counts = rows.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(F.col(T).isNull()).alias("missing_months"),
        F.count_if(F.col(Y).isNull()).alias("missing_values"),
        F.count_if(F.isnan(Y)).alias("nan_values"),
        F.count_if(second).alias("duplicate_groups"),
        F.count_if(repeated).alias("duplicate_rows"),
        F.count_if(F.col("_lag").isNotNull() & F.col("_next").isNotNull()).alias("feature_rows"),
    )
    n = F.col("feature_rows")
    train, validation = C.train_end(n), C.validation_end(n)
    return counts.withColumns({
        "train_rows": train, "validation_rows": validation - train, "test_rows": n - validation,
    })


def data_quality_report(df: DataFrame, dataset: str, window: int = WINDOW) -> DataFrame:
    """Length, range, missing values, duplicates, split and window sizes."""
    counts = _per_period(df).groupBy(KEY).agg(
        F.sum("_rows").alias("total_observations"),
        F.min(T).alias("start_period"),
        F.max(T).alias("end_period"),
        F.sum(F.col("_missing") + F.col("_nan")).alias("missing_values"),
        F.sum(F.col("_rows") - 1).alias("duplicate_months"),
    )
    return quality_columns(counts, dataset, window)


def quality_columns(counts: DataFrame, dataset: str, window: int = WINDOW) -> DataFrame:
    """The quality report from the counts of each series."""
    n = F.col("total_observations")
    train, validation = C.train_end(n), C.validation_end(n)
    return counts.select(
        KEY,
        F.lit(dataset).alias("dataset"),
        "total_observations", "start_period", "end_period",
        "missing_values", "duplicate_months",
        train.alias("train_points"),
        (validation - train).alias("validation_points"),
        (n - validation).alias("test_points"),
        F.lit(window).cast("bigint").alias("window_length"),
        F.greatest(train - window, F.lit(0)).cast("bigint").alias("train_windows"),
        (validation - train).alias("validation_windows"),
        (n - validation).alias("test_windows"),
    )


def with_months(report: DataFrame) -> DataFrame:
    """The quality report of monthly series, with its range as ``yyyy-MM`` texts."""
    return report.withColumns({
        "start_period": C.month_text(F.col("start_period")),
        "end_period": C.month_text(F.col("end_period")),
    }).withColumnsRenamed({"start_period": "start_month", "end_period": "end_month"})
