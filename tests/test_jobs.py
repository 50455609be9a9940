"""The two jobs from a CSV file to the written reports."""

import pytest

from seriesflow import jobs
from tests import fixed_values as fixed
from tests.conftest import month, rows_of


@pytest.fixture(scope="module")
def csv_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("input") / "demand.csv"
    lines = [f"{month(i):%Y-%m},{v}" for i, v in enumerate(fixed.PASSENGERS)]
    path.write_text("\n".join(["Month,Units", *lines]) + "\n")
    return str(path)


def _csv(spark, path):
    return spark.read.option("header", True).csv(path)


def test_prepare_job(spark, csv_path, tmp_path):
    jobs.main(["prepare", "--input", csv_path, "--time", "Month", "--value", "Units",
               "--output", str(tmp_path)])
    assert spark.read.parquet(f"{tmp_path}/features").count() == 131
    report = spark.read.json(f"{tmp_path}/preparation_report").first()
    assert (report.raw_rows, report.missing_months, report.missing_values) == (144, 0, 0)
    assert (report.feature_rows, report.train_rows, report.validation_rows, report.test_rows) == (
        131, 91, 20, 20)


def test_forecast_job_with_baselines(spark, csv_path, tmp_path):
    jobs.main(["forecast", "--input", csv_path, "--time", "Month", "--value", "Units",
               "--output", str(tmp_path), "--dataset", "air", "--baselines-only"])
    metrics = {r.model: (float(r.test_mae), float(r.test_rmse), float(r.test_mape_percent))
               for r in _csv(spark, f"{tmp_path}/metrics_summary").collect()}
    assert metrics == fixed.BASELINE_METRICS
    compared = _csv(spark, f"{tmp_path}/forecast_comparison")
    assert compared.count() == 22
    assert {r.model for r in compared.collect()} == {"SeasonalNaive-12"}
    flagged = _csv(spark, f"{tmp_path}/high_error_review").filter("high_error_flag = 'true'")
    assert [r["month"] for r in rows_of(flagged, "month")] == ["1960-07"]
    quality = _csv(spark, f"{tmp_path}/data_quality_report").first()
    assert (quality.start_month, quality.end_month) == ("1949-01", "1960-12")
    assert quality.dataset == "air" and quality.total_observations == "144"
    summary = spark.read.json(f"{tmp_path}/run_summary").first()
    assert (summary.best_model, summary.next_best_model) == ("SeasonalNaive-12", "Naive")
    assert summary.high_error_periods_flagged == 1


def test_forecast_job_with_learned_models(spark, make_series, tmp_path):
    series = make_series(
        air=[float(v) for v in fixed.PASSENGERS],
        doubled=[2.0 * v for v in fixed.PASSENGERS[:100]],
    )
    jobs.forecast_job(series, "two", str(tmp_path))
    rows = _csv(spark, f"{tmp_path}/metrics_summary").collect()
    assert len(rows) == 2 * 8
    summary = {r.series_id: r for r in spark.read.json(f"{tmp_path}/run_summary").collect()}
    assert summary["air"].models_compared == 8
    assert summary["air"].best_model == "LinearRegression"
    assert summary["doubled"].total_observations == 100


def test_parquet_input_with_key(spark, make_series, tmp_path):
    table = make_series(a=[float(i % 7) for i in range(60)], b=[float(i) for i in range(70)])
    table.withColumnsRenamed({"series_id": "shop", "t": "day", "y": "units"}).write.parquet(
        f"{tmp_path}/in")
    jobs.main(["prepare", "--input", f"{tmp_path}/in", "--key", "shop", "--time", "day",
               "--value", "units", "--output", f"{tmp_path}/out", "--bounded"])
    report = rows_of(spark.read.json(f"{tmp_path}/out/preparation_report"), "series_id")
    assert [(r["series_id"], r["feature_rows"]) for r in report] == [("a", 47), ("b", 57)]
