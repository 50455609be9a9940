"""The two batch jobs: prepare features, and forecast with all reports.

    spark-submit run_job.py prepare \\
        --input demand.csv --time Month --value Units --output out
    spark-submit run_job.py forecast \\
        --input demand.parquet --key product --time day --value units --output out
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from seriesflow.config import (
    AUTO, LAGS, PLAIN, ROLLS, SEASON, TRAIN_SHARE, VALIDATION_SHARE, WINDOW, Layout,
)
from seriesflow.functions.columns import month_date, month_text
from seriesflow.operators import baselines, features, learned, prepare, review, score
from seriesflow.plans.layout import keep_index
from seriesflow.sources import sinks
from seriesflow.sources.series import load_series, read_series_csv, read_texts
from seriesflow.sources.storage import scratch, store


def _names(*columns: str | None) -> list[str]:
    return list(dict.fromkeys(c for c in columns if c))


def read_input(
    spark: SparkSession, path: str, time: str, value: str, key: str | None, tiebreak: str | None,
    is_csv: bool, strict: bool = False,
) -> DataFrame:
    """Series from a CSV file with ``yyyy-MM`` months, or from a typed parquet table.

    ``strict`` fails on a bad or empty value of a CSV file, which is NULL otherwise.
    """
    name = F.col(key) if key else F.lit("all")
    order = F.col(tiebreak) if tiebreak else None
    if is_csv and strict:
        schema = StructType([
            StructField(c, DoubleType() if c == value else StringType())
            for c in _names(key, time, value, tiebreak)
        ])
        table = read_series_csv(spark, path, schema, strict=True)
        bad = F.raise_error(F.concat(F.lit("not a month: "), F.col(time)))
        table = table.withColumn(time, F.when(month_date(F.col(time)).isNull(), bad).otherwise(F.col(time)))
        return prepare.prepare_series(table, name, F.col(time), F.col(value).cast("string"), order)
    if is_csv:
        table = read_texts(spark, path, _names(key, time, value, tiebreak))
        return prepare.prepare_series(table, name, F.col(time), F.col(value), order)
    table = spark.read.parquet(path)
    return load_series(table, name, F.col(time), F.col(value).cast("double"), order)


def prepare_job(
    series: DataFrame, output: str, layout: Layout = AUTO, source: str = "",
    lags: Sequence[int] = LAGS, rolls: Sequence[int] = ROLLS,
) -> None:
    """Write the feature table and the preparation report."""
    series, layout = keep_index(series, layout)
    lags, rolls = tuple(lags), tuple(rolls)
    sinks.write_features(features.feature_table(series, layout, lags, rolls), f"{output}/features")
    report = prepare.prep_report(series, layout).withColumns({
        "input": F.lit(source),
        "output": F.lit(f"{output}/features"),
        "split_rule": F.lit(f"chronological: train below {TRAIN_SHARE:.0%}, validation below "
                            f"{VALIDATION_SHARE:.0%}, test the rest"),
        "feature_columns": F.array(*[F.lit(c) for c in features.feature_names(lags, rolls)]),
        "target_column": F.lit(features.TARGETS[0]),
    })
    sinks.write_summary_json(report, f"{output}/preparation_report")


def forecast_job(
    series: DataFrame, dataset: str, output: str, layout: Layout = AUTO, with_learned: bool = True,
    season: int = SEASON, window: int = WINDOW, monthly: bool = True,
) -> None:
    """Forecast every series, score and rank the models, and write all reports.

    Periods are written as ``yyyy-MM`` for monthly series and in full for others.
    """
    spark = series.sparkSession
    period = month_text(F.col("t")) if monthly else F.col("t").cast("string")
    name = "month" if monthly else "period"
    series, layout = keep_index(series, layout)
    tables, selection = [baselines.baseline_forecasts(series, layout, season=season)], None
    if with_learned:
        settings = learned.LearnedSettings(length=window)
        forecasts, selection = learned.learned_forecasts(series, layout, settings)
        tables.append(forecasts)
        sinks.write_report_csv(selection, f"{output}/model_selection")
        sinks.write_report_csv(
            learned.series_without_spread(series, layout), f"{output}/series_not_learned")
    # All reports start from the forecasts, so these are made once and kept.
    made = score.all_forecasts(*tables)
    made.write.mode("overwrite").parquet(f"{output}/forecasts")
    made = spark.read.schema(made.schema).parquet(f"{output}/forecasts")

    sinks.write_report_csv(
        score.leaderboard(made, selection).drop("model_order"), f"{output}/metrics_summary")
    # The review is found once; both tables and the summary are drawn from it.
    ranked = store(review.ranked_errors(made, layout), "ranked")
    reviewed = review.review_of(ranked).withColumn(name, period)
    sinks.write_report_csv(
        reviewed.select(
            "series_id", name, "idx", "actual", "forecast", "absolute_error", "model",
            "condition",
        ),
        f"{output}/forecast_comparison",
    )
    sinks.write_report_csv(
        reviewed.select(
            "series_id", name, "idx", "actual", "forecast", "absolute_error",
            "error_threshold", "high_error_flag",
        ),
        f"{output}/high_error_review",
    )
    quality = prepare.data_quality_report(series, dataset, window)
    quality = prepare.with_months(quality) if monthly else quality
    sinks.write_report_csv(quality, f"{output}/data_quality_report")
    sinks.write_summary_json(review.summary_of(ranked, dataset, window), f"{output}/run_summary")


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=["prepare", "forecast"])
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--time", required=True)
    parser.add_argument("--value", required=True)
    parser.add_argument("--key", help="series key; without it the input is one series")
    parser.add_argument("--tiebreak", help="order of rows with equal time")
    parser.add_argument("--dataset", help="name in the reports; default is the input path")
    parser.add_argument("--baselines-only", action="store_true")
    parser.add_argument("--format", choices=["csv", "parquet"], help="default is by the file suffix")
    parser.add_argument("--strict", action="store_true", help="fail on bad or empty CSV values")
    parser.add_argument("--season", type=int, default=SEASON, help="rows of a season")
    parser.add_argument("--window", type=int, default=WINDOW, help="rows of a learned model's window")
    parser.add_argument("--lags", type=int, nargs="+", default=LAGS, help="rows back of the lag features")
    parser.add_argument("--rolls", type=int, nargs="+", default=ROLLS, help="rows of the rolling means")
    parser.add_argument(
        "--bounded", action="store_true", help="every series fits one task: skip the count")
    args = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(f"seriesflow-{args.job}").getOrCreate()
    is_csv = args.format == "csv" or not args.format and args.input.rstrip("/").endswith(".csv")
    series = read_input(
        spark, args.input, args.time, args.value, args.key, args.tiebreak, is_csv, args.strict)
    layout = PLAIN if args.bounded else AUTO
    with scratch(spark):
        if args.job == "prepare":
            prepare_job(series, args.output, layout, args.input, args.lags, args.rolls)
            if is_csv and not args.strict:  # what became NULL, as it was read
                texts = read_texts(spark, args.input, _names(args.key, args.time, args.value, args.tiebreak))
                sinks.write_report_csv(
                    prepare.unreadable_rows(texts, F.col(args.time), F.col(args.value)),
                    f"{args.output}/unreadable_rows")
        else:
            forecast_job(
                series, args.dataset or args.input, args.output, layout,
                not args.baselines_only, args.season, args.window, is_csv)
