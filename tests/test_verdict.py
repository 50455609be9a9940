"""Ties, unusable series, strict input, rounding: cases that once went wrong."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from seriesflow import jobs
from seriesflow.catalog import tables as tb
from seriesflow.config import AUTO, PLAIN, Layout
from seriesflow.functions import columns as C
from seriesflow.operators import baselines, learned, review
from seriesflow.sources import series as sources, storage
from tests.conftest import rows_of, same

BLOCKS = Layout("blocks", block_rows=30)


def _tied(made, orders):
    names = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.lit(o).alias("o")) for m, o in orders]))
    naive = made.filter("model = 'Naive'").withColumn("_n", names)
    return naive.withColumn("model", F.col("_n.m")).withColumn("model_order", F.col("_n.o")).drop("_n")


@pytest.mark.parametrize("orders", [[("b", 1), ("a", 2)], [("b", 1), ("a", 1), ("c", 1)]])
def test_ties_give_the_same_rows_under_every_layout(make_series, orders):
    series = make_series(one=[float(i * 7 % 13) for i in range(80)], two=[float(i % 5) for i in range(61)])
    made = _tied(baselines.baseline_forecasts(series, PLAIN), orders)
    found = [rows_of(review.high_error_review(made, how), "series_id", "idx") for how in (PLAIN, AUTO, BLOCKS)]
    assert same(found[0], found[1]) and same(found[0], found[2])
    first = min(orders, key=lambda m: (m[1], m[0]))[0]
    assert {r["model"] for r in found[0]} == {first} and len(found[0]) == 12 + 10
    for how in (PLAIN, AUTO, BLOCKS):
        rows = review.run_summary(made, "d", how).collect()
        assert {(r.series_id, r.total_observations, r.models_compared) for r in rows} == {
            ("one", 80, len(orders)), ("two", 61, len(orders))}


def test_run_summary_reads_the_table_once(spark, tmp_path):
    spark.range(60).select(F.lit("a").alias("series_id"), F.col("id").alias("t"),
                           (F.col("id") * 7 % 13).cast("double").alias("y")).write.parquet(str(tmp_path / "s"))
    series = spark.read.parquet(str(tmp_path / "s"))
    plan = review.run_summary(baselines.baseline_forecasts(series, PLAIN), "d", PLAIN)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange") <= 2


GOOD = {k: [math.sin(i / (3 + n)) + i / 40 for i in range(120)] for n, k in enumerate("abcde")}


def _forecasts(make_series, **more):
    settings = learned.LearnedSettings(length=6, models=(learned.LINEAR,))
    made, selection = learned.learned_forecasts(make_series(**GOOD, **more), AUTO, settings)
    return rows_of(made, "series_id", "idx", "condition"), rows_of(selection, "condition")


@pytest.mark.parametrize("bad", [
    [1.0] * 90 + [float(i) for i in range(30)],
    [float(i % 7) for i in range(95)] + [math.inf] + [float(i % 7) for i in range(24)],
    [math.inf] + [float(i % 7) for i in range(119)],
    [5e15 + (i % 2) * 1e-9 for i in range(120)],
])
def test_a_bad_series_leaves_the_others_alone(make_series, bad):
    alone, chosen = _forecasts(make_series)
    together, still = _forecasts(make_series, bad=bad)
    infinite_only_late = math.isinf(bad[95]) if len(bad) > 95 else False
    own = [r for r in together if r["series_id"] == "bad"]
    assert len(own) == 2 * 18
    if infinite_only_late:  # its own training rows are good: they take part
        assert all(r["forecast"] is not None for r in own[-4:])
        return
    assert all(r["forecast"] is None for r in own)
    assert same([r for r in together if r["series_id"] != "bad"], alone) and same(still, chosen)


def test_series_without_spread_are_listed(make_series):
    found = learned.series_without_spread(make_series(flat=[3.0] * 50, fine=[float(i) for i in range(50)]), PLAIN)
    assert [r.series_id for r in found.collect()] == ["flat"]


@pytest.mark.parametrize("pack", [4096, 30])
def test_packs_give_the_supervised_rows(make_series, monkeypatch, pack):
    from seriesflow.operators.windows import supervised_rows

    monkeypatch.setattr(learned, "PACK", pack)
    series = make_series(**{k: v[:n] for (k, v), n in zip(GOOD.items(), (120, 61, 25, 24, 3))}, gap=[1.0, None] * 30)
    for layout in (PLAIN, BLOCKS):
        found = rows_of(learned.unpacked(learned.packed(series, layout, 24), 24), "series_id", "idx")
        assert same(found, rows_of(supervised_rows(series, PLAIN, 24), "series_id", "idx"))


def test_first_trees_are_those_of_a_shorter_fit(make_series):
    from pyspark.ml.regression import GBTRegressor

    rows = learned.learning_rows(make_series(**GOOD), PLAIN, 6)
    train, validation = learned._fitting_data(rows)
    long, short = (GBTRegressor(labelCol="level_target", maxDepth=2, maxIter=n, seed=42).fit(train) for n in (8, 3))
    cut = learned.first_trees(long, 3)
    assert cut.getNumTrees == 3 and learned.first_trees(short, 9) is short
    a, b = ([r.prediction for r in m.transform(validation).orderBy("series_id", "idx").collect()]
            if "series_id" in validation.columns else
            sorted(r.prediction for r in m.transform(validation).collect()) for m in (cut, short))
    assert a == pytest.approx(b, abs=1e-12)


def test_other_lags_and_rolls(make_series):
    from seriesflow.operators import features

    values = [float(i * i % 17) for i in range(30)]
    for layout in (PLAIN, Layout("blocks", block_rows=10)):
        rows = rows_of(features.feature_table(make_series(a=values), layout, (2, 5), (4,)), "t")
        assert len(rows) == 30 - 5 - 1
        for i, r in enumerate(rows, 5):
            assert (r["y"], r["lag_2"], r["lag_5"], r["target_next"]) == (
                values[i], values[i - 2], values[i - 5], values[i + 1])
            assert r["rolling_mean_4"] == pytest.approx(sum(values[i - 4:i]) / 4)


SCHEMA = StructType([StructField("Month", StringType()), StructField("Units", DoubleType())])


def _file(tmp_path, text):
    path = tmp_path / "in.csv"
    path.write_text(text)
    return str(path)


def test_csv_columns_go_by_name(spark, tmp_path):
    path = _file(tmp_path, "Units,Other,Month\n1.5,x,1949-01\n2,y,1949-02\n")
    for strict in (True, False):
        rows = sources.read_series_csv(spark, path, SCHEMA, strict=strict).collect()
        assert [(r.Month, r.Units) for r in rows] == [("1949-01", 1.5), ("1949-02", 2.0)]
    with pytest.raises(ValueError, match="no column Units"):
        sources.read_series_csv(spark, _file(tmp_path, "Month,Unit\n1949-01,1\n"), SCHEMA)


@pytest.mark.parametrize("line", ["1949-01,", ",1.0", "1949-01,abc"])
def test_strict_reading_fails_on_bad_and_empty_values(spark, tmp_path, line):
    path = _file(tmp_path, f"Month,Units\n1949-02,1\n{line}\n")
    with pytest.raises(Exception, match="empty value|MALFORMED|Malformed"):
        sources.read_series_csv(spark, path, SCHEMA, strict=True).collect()


def test_strict_jobs(spark, tmp_path):
    good = "Month,Units\n" + "".join(f"{1949 + i // 12}-{i % 12 + 1:02},{i % 9}\n" for i in range(60))
    path = tmp_path / "folder"
    path.mkdir()
    (path / "part").write_text(good)
    options = ["--input", str(path), "--time", "Month", "--value", "Units", "--format", "csv", "--strict"]
    jobs.main(["forecast", *options, "--output", str(tmp_path / "out"), "--baselines-only", "--season", "6"])
    models = {r.model for r in spark.read.option("header", True).csv(f"{tmp_path}/out/metrics_summary").collect()}
    assert models == {"Naive", "MovingAvg-6", "SeasonalNaive-6", "LinearTrend"}
    (path / "part").write_text(good + "1960,4\n")
    with pytest.raises(Exception, match="not a month"):
        jobs.main(["prepare", *options, "--output", str(tmp_path / "other")])


def test_other_than_monthly_periods_are_written_in_full(spark, tmp_path):
    days = spark.range(60).select(F.lit("a").alias("series_id"),
                                  F.expr("date_add(date'2024-01-01', cast(id as int))").alias("t"),
                                  (F.col("id") * 7 % 13).cast("double").alias("y"))
    jobs.forecast_job(days, "d", str(tmp_path), PLAIN, with_learned=False, monthly=False)
    rows = spark.read.option("header", True).csv(f"{tmp_path}/forecast_comparison").collect()
    assert len({r.period for r in rows}) == 9 and all(len(r.period) == 10 for r in rows)
    quality = spark.read.option("header", True).csv(f"{tmp_path}/data_quality_report").first()
    assert quality.start_period == "2024-01-01"


def test_report_round(spark):
    values = [1e33, math.inf, -math.inf, 1.2344999996, 0.0125, 231495.1175, -2.5, None, math.nan]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        C.report_round(F.col("v"), 3).alias("r")).collect()
    found = [r.r for r in rows]
    assert found[:7] == [1e33, math.inf, -math.inf, 1.234, 0.013, 231495.118, -2.5]
    assert found[7] is None and math.isnan(found[8])


def test_month_date(spark):
    texts = ["2020-01", "2020", "2020-1", "+2020-01", "2020-13", " 2020-01", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "m string").select(
        C.month_date(F.col("m")).cast("string").alias("d")).collect()
    assert [r.d for r in rows] == ["2020-01-01"] + [None] * 7


def test_scratch_tables_are_deleted(spark):
    with storage.scratch(spark):
        kept = storage.store(spark.range(5).toDF("x"), "short-lived")
        path = kept.inputFiles()[0]
        assert kept.count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_folder_without_settings(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default if key == "spark.checkpoint.dir" else spark.conf.get(key)

    class Session:
        conf, _jvm, _jsc = Conf(), spark._jvm, spark._jsc

        class sparkContext:
            master = "local[8]"
            getCheckpointDir = staticmethod(lambda: None)

    assert storage.shared_folder(Session).endswith("/seriesflow")
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session)


def test_hot_series_of_the_catalog_is_cut(spark):
    rows = [(i, i % 20, i, float(i % 11)) for i in range(6000)]
    events = spark.createDataFrame(rows, "event_id bigint, user_id bigint, ts bigint, value double")
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    series = sources.load_series(hot, F.col("user_id"), F.col("ts"), F.col("value"), F.col("event_id"))
    frame = baselines.baseline_frame(series, tb.ONE_HOT_SERIES)
    assert frame.long is not None and frame.short is not None
    plain = baselines.baseline_frame(series, PLAIN)
    a, b = (rows_of(review.high_error_review(f), "series_id", "idx") for f in (frame, plain))
    assert same(a, b)
