"""Readers, writers and the shared folder."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F, types as T

from seriesflow.config import PLAIN
from seriesflow.operators import baselines, features, prepare, review, score
from seriesflow.sources import series as sources, sinks, storage
from tests.conftest import rows_of

SCHEMA = T.StructType([
    T.StructField("Month", T.StringType()), T.StructField("Passengers", T.DoubleType()),
])


@pytest.fixture
def csv_file(tmp_path):
    def write(text):
        path = tmp_path / "series.csv"
        path.write_text(text)
        return str(path)

    return write


def test_csv_scan_and_typing(spark, csv_file):
    path = csv_file("Month,Passengers\n1949-01,112\n1949-02,118\n")
    raw = sources.read_series_csv(spark, path, SCHEMA, strict=True)
    typed = prepare.prepare_series(
        raw, F.lit("air"), F.col("Month"), F.col("Passengers").cast("string"))
    assert [(r.series_id, str(r.t), r.y) for r in typed.orderBy("t").collect()] == [
        ("air", "1949-01-01", 112.0), ("air", "1949-02-01", 118.0)]


def test_bad_csv_row_is_kept_or_fails(spark, csv_file):
    path = csv_file("Month,Passengers\n1949-01,112\n1949-02,many\n")
    rows = sources.read_series_csv(spark, path, SCHEMA).cache().orderBy("Month").collect()
    assert [(r.Passengers, r[sources.CORRUPT]) for r in rows] == [
        (112.0, None), (None, "1949-02,many")]
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        sources.read_series_csv(spark, path, SCHEMA, strict=True).collect()


def test_monthly_sum(spark):
    df = spark.createDataFrame(
        [("a", "2020-01-03", 0.1), ("a", "2020-01-30", 0.2), ("a", "2020-02-01", 5.0)],
        "k string, d string, v double")
    rows = rows_of(sources.load_monthly(df, F.col("k"), F.col("d").cast("date"), F.col("v")), "t")
    assert [(str(r["t"]), r["y"]) for r in rows] == [("2020-01-01", 0.3), ("2020-02-01", 5.0)]


def test_feature_sink_is_partitioned_by_split(spark, make_series, tmp_path):
    table = features.feature_table(make_series(a=[float(i) for i in range(60)]), PLAIN)
    path = str(tmp_path / "features")
    sinks.write_features(table, path)
    back = spark.read.parquet(path)
    assert rows_of(back.select(table.columns), "t") == rows_of(table, "t")
    plan = back.filter("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_reports_survive_the_round_trip(spark, make_series, tmp_path):
    df = make_series(a=[float(i * i % 17) for i in range(60)])
    forecasts = baselines.baseline_forecasts(df, PLAIN)
    records = score.leaderboard(forecasts)
    sinks.write_report_csv(records, str(tmp_path / "csv"))
    back = sources.read_series_csv(spark, str(tmp_path / "csv"), records.schema, strict=True, allow_empty=True)
    assert rows_of(back, "model") == rows_of(records, "model")
    summary = review.run_summary(forecasts, "d", PLAIN)
    sinks.write_summary_json(summary, str(tmp_path / "json"))
    assert rows_of(spark.read.schema(summary.schema).json(str(tmp_path / "json")), "series_id") == (
        rows_of(summary, "series_id"))


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert storage.shared_folder(spark) == named.rstrip("/")
    assert storage.new_path(spark, "x") != storage.new_path(spark, "x")


def _session(master):
    folder = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: folder[0] if folder else None,
        setCheckpointDir=folder.append)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))


def test_cluster_without_shared_folder_is_refused(monkeypatch):
    monkeypatch.setattr(storage, "qualified", lambda session, folder: "file:/warehouse")
    for master in ("spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            storage.shared_folder(_session(master))
    for master in ("local", "local[2]", "local[*]"):
        assert storage.shared_folder(_session(master)) == "file:/warehouse/seriesflow"
    monkeypatch.setattr(storage, "qualified", lambda session, folder: "hdfs://host/warehouse/")
    assert storage.shared_folder(_session("spark://host:7077")) == "hdfs://host/warehouse/seriesflow"


UNITS = T.StructType([T.StructField("Month", T.StringType()), T.StructField("Units", T.DoubleType())])


def _folder(tmp_path, **files):
    folder = tmp_path / "in put%"
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_files_of_a_folder_are_read_by_their_own_headers(spark, tmp_path):
    path = _folder(tmp_path, a="Month,Units\n2020-01,1\n2020-02,2\n", b="Units,Month\n3,2020-03\n",
                   c='Note,Units,"Month"\n"x, y",4,2020-04\n', d="Units,Month\n5,2020-05\n", e="", f="\nMonth,Units\n")
    expected = [(f"2020-0{i}", float(i)) for i in range(1, 6)]
    for strict in (True, False):
        rows = sources.read_series_csv(spark, path, UNITS, strict=strict).collect()
        assert sorted((r.Month, r.Units) for r in rows) == expected
    texts = sources.read_texts(spark, path, ["Units"]).collect()
    assert sorted(r.Units for r in texts) == list("12345")
    assert [len(files) for _, files in sources.by_header(spark, path, ["Month"])] == [2, 1, 2]


@pytest.mark.parametrize("text, message", [("Month,Unit\n1,2\n", "no column Units in .*b.csv"),
                                           ("Units,Month,Units\n1,2,3\n", "more than one column Units in .*b.csv")])
def test_a_file_without_a_column_is_named(spark, tmp_path, text, message):
    path = _folder(tmp_path, a="Month,Units\n2020-01,1\n", b=text)
    with pytest.raises(ValueError, match=message):
        sources.read_series_csv(spark, path, UNITS)


def test_a_folder_without_lines_has_no_rows(spark, tmp_path):
    path = _folder(tmp_path, a="", b="\n\n")
    assert sources.read_series_csv(spark, path, UNITS, strict=True).count() == 0
    assert sources.read_texts(spark, path, ["Month"]).columns == ["Month"]


def test_headers_are_found_without_reading_on(spark, tmp_path):
    long = "Month,Units\n" + "2020-01,1\n" * 200_000
    path = _folder(tmp_path, a=long, b=long)
    headers = sources.csv_headers(spark, path)
    assert headers.rdd.getNumPartitions() == 2  # one task a file
    assert [r.header for r in headers.collect()] == ["Month,Units"] * 2


def _features(spark, n, tasks):
    return spark.range(n).select(
        F.concat(F.lit("s"), F.col("id") % 50).alias("series_id"), F.col("id").alias("t"),
        F.element_at(F.array(*map(F.lit, ("train", "validation", "test"))), (F.col("id") % 3 + 1).cast("int")).alias("split"),
        F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(tasks)


def test_number_of_feature_files_follows_the_size(spark, tmp_path):
    df = _features(spark, 60_000, 200)
    sinks.write_features(df, f"{tmp_path}/small")
    files = [p for p in (tmp_path / "small").rglob("*.parquet")]
    assert 3 <= len(files) <= 6
    sinks.write_features(df, f"{tmp_path}/cut", file_bytes=1 << 20)
    cut = [p for p in (tmp_path / "cut").rglob("*.parquet")]
    assert len(files) < len(cut) <= 40
    for path in ("small", "cut"):
        back = spark.read.parquet(f"{tmp_path}/{path}")
        assert back.count() == 60_000 and back.select("t").distinct().count() == 60_000
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") != str(1 << 20)


def test_a_failed_write_leaves_the_earlier_table(spark, tmp_path):
    df = _features(spark, 300, 4)
    sinks.write_features(df, f"{tmp_path}/t")
    broken = df.withColumn("x", F.when(F.col("t") == 299, F.raise_error(F.lit("broken"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="broken"):
        sinks.write_features(broken, f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 300
    sinks.write_features(df.limit(20), f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 20
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
