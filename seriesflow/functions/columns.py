"""Column expressions shared by the operators. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from seriesflow.config import (
    N, TEST, TRAIN, TRAIN_SHARE, VALIDATION, VALIDATION_SHARE,
    ZERO_ACTUAL,
)


def month_date(text: Column) -> Column:
    """First day of a ``yyyy-MM`` month; NULL when the text is no month."""
    day = F.concat(text, F.lit("-01")).try_cast("date")
    return F.when(text.rlike(r"^\d{4}-\d{2}$"), day)


def measure(text: Column) -> Column:
    """Double value of a text; NULL when it is no number."""
    return text.try_cast("double")


def train_end(n: Column | str = N) -> Column:
    # The product is taken in double: as a decimal it differs at n = 90, 170, ...
    return F.floor(F.lit(TRAIN_SHARE) * _col(n))


def validation_end(n: Column | str = N) -> Column:
    return F.floor(F.lit(VALIDATION_SHARE) * _col(n))


def split_label(position: Column, n: Column | str = N) -> Column:
    """Split of a 0-based chronological position in a series of ``n`` rows."""
    return (
        F.when(position < train_end(n), F.lit(TRAIN))
        .when(position < validation_end(n), F.lit(VALIDATION))
        .otherwise(F.lit(TEST))
    )


def mae(actual: Column, forecast: Column) -> Column:
    return F.avg(F.abs(actual - forecast))


def rmse(actual: Column, forecast: Column) -> Column:
    error = actual - forecast
    return F.sqrt(F.avg(error * error))


def error_share(actual: Column, forecast: Column) -> Column:
    """Error as a share of the actual; NULL where that is zero or NaN."""
    share = F.when(F.abs(actual) >= ZERO_ACTUAL, F.abs((actual - forecast) / actual))
    return F.nanvl(share, F.lit(None).cast("double"))


def mape(actual: Column, forecast: Column) -> Column:
    return F.avg(error_share(actual, forecast)) * 100


def report_round(value: Column, places: int) -> Column:
    """Half-up rounding of decimal digits.

    Going through a decimal with ten places first (seven from 1,000 on, where
    doubles are coarser) removes the float noise that would otherwise decide an
    exact tie such as 0.0125. Values that are no such decimal, among them
    infinite ones, stay as they are.
    """
    def rounded(exact: int) -> Column:
        return F.round(value.try_cast(f"decimal(38,{exact})"), places).cast("double")

    kept = F.when(F.isnan(value), value).when(F.abs(value) < 1000, rounded(10))
    return F.coalesce(kept.otherwise(rounded(7)), value)


def month_text(day: Column) -> Column:
    return F.substring(day.cast("date").cast("string"), 1, 7)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
