"""Long series in blocks give what the plain window gives."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from seriesflow.config import PLAIN, Layout
from seriesflow.operators import (
    baselines, features, learned, prepare, review, scaling, score, splits, windows,
)
from seriesflow.plans.layout import index_series, keep_index, measure_lengths, resolve
from seriesflow.sources import storage
from tests.conftest import rows_of, same

SMALL_BLOCKS = [Layout("blocks", block_rows=24), Layout("auto", block_rows=100)]


@pytest.fixture(scope="module")
def skewed(spark):
    """Many short series and one that holds a third of all rows; some values missing."""
    short = spark.range(1200).select(
        F.concat(F.lit("s"), (F.col("id") % 30).cast("string")).alias("series_id"),
        F.col("id").alias("i"),
    )
    long = spark.range(600).select(F.lit("hot").alias("series_id"), F.col("id").alias("i"))
    rows = short.unionByName(long)
    # Times repeat, so the order within a series rests on the tiebreak.
    return rows.select(
        "series_id",
        F.timestamp_seconds((F.col("i") / 7).cast("bigint") * 3600).alias("t"),
        F.when(F.col("i") % 41 != 0, ((F.col("i") * 7919) % 1013).cast("double")).alias("y"),
        F.col("i").alias("tiebreak"),
    ).cache()


@pytest.fixture(scope="module")
def kept(skewed):
    return keep_index(skewed, Layout("auto", block_rows=100))


OPERATORS = {
    "chrono_index": splits.chrono_index,
    "split_raw": splits.split_raw,
    "lag_features": features.lag_features,
    "rolling_means": features.rolling_means,
    "lead_target": features.lead_target,
    "feature_table": features.feature_table,
    "scaler_transform": scaling.scaler_transform,
    "scaler_fit": scaling.scaler_fit,
    "window_arrays": windows.window_arrays,
    "supervised_rows": windows.supervised_rows,
    "level_delta_targets": windows.level_delta_targets,
    "baseline_forecasts": baselines.baseline_forecasts,
    "baseline_suite": baselines.baseline_suite,
}


def _keys(df):
    return [c for c in ("series_id", "t", "tiebreak", "idx", "model") if c in df.columns] + [
        c for c in ("y", "lag_1", "lag_3", "lag_12") if c in df.columns and "idx" not in df.columns]


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("layout", SMALL_BLOCKS, ids=str)
def test_blocks_equal_plain(skewed, name, layout):
    plain = OPERATORS[name](skewed, PLAIN)
    blocks = OPERATORS[name](skewed, layout)
    assert set(plain.columns) == set(blocks.columns)
    blocks = blocks.select(plain.columns)
    assert same(rows_of(plain, *_keys(plain)), rows_of(blocks, *_keys(plain)))


@pytest.mark.parametrize("name", [*OPERATORS, "prep_report"])
def test_kept_index_gives_the_same(kept, skewed, name):
    operator = OPERATORS.get(name, prepare.prep_report)
    rows, layout = kept
    plain, again = operator(skewed, PLAIN), operator(rows, layout)
    assert set(plain.columns) == set(again.columns)
    assert same(
        rows_of(plain, *_keys(plain)), rows_of(again.select(plain.columns), *_keys(plain)))


def test_index_is_kept_only_for_long_series(skewed, kept):
    rows, layout = kept
    assert layout.indexed and layout.mode == "auto" and rows.count() == 1800
    assert keep_index(rows, layout) == (rows, layout)
    assert keep_index(skewed, Layout()) == (skewed, PLAIN)
    plan = features.lag_features(rows, layout)._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan


def test_blocks_bound_the_rows_of_a_task_group(skewed):
    layout = Layout("auto", block_rows=50)
    frame = index_series(skewed, layout, lambda w: {"p": F.lag("y", 24).over(w)}, back=24)
    sizes = frame.long.groupBy("series_id", "_block").count().collect()
    assert {r["count"] for r in sizes} == {50} and len(sizes) == 12
    assert frame.short.groupBy("series_id").count().agg(F.max("count")).first()[0] <= 50


@pytest.mark.parametrize("layout", SMALL_BLOCKS, ids=str)
def test_review_in_blocks_equals_plain(skewed, layout):
    forecasts = baselines.baseline_forecasts(skewed, PLAIN).cache()
    for operator in (review.high_error_review, review.high_error_review_by_model):
        plain = rows_of(operator(forecasts, PLAIN), "series_id", "model", "idx")
        blocks = rows_of(operator(forecasts, layout), "series_id", "model", "idx")
        assert len(plain) > 0 and plain == blocks
        frame = baselines.baseline_frame(skewed, layout)
        assert plain == rows_of(operator(frame), "series_id", "model", "idx")
    forecasts.unpersist()


def test_prep_report_in_blocks_equals_grouping(skewed):
    """Duplicates found between neighbours are those found by grouping."""
    groups = {r.series_id: r.duplicate_groups for r in prepare.duplicate_groups(skewed).collect()}
    surplus = {r.series_id: r.duplicate_rows for r in prepare.duplicate_rows(skewed).collect()}
    for layout in [PLAIN, *SMALL_BLOCKS]:
        rows = prepare.prep_report(skewed, layout).collect()
        assert {r.series_id: r.duplicate_groups for r in rows} == groups
        assert {r.series_id: r.duplicate_rows for r in rows} == surplus


def test_copies_of_one_row_are_spread(spark):
    """A third of the rows are the same row, without anything to tell them apart."""
    rows = spark.range(900).select(
        F.lit("a").alias("series_id"),
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 450).otherwise(F.col("id"))).alias("t"),
        F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id").cast("double")).alias("y"),
    )
    layout = Layout("blocks", block_rows=50)
    plain = features.rolling_means(rows, PLAIN)
    assert same(rows_of(plain, "idx"), rows_of(features.rolling_means(rows, layout), "idx"))
    folder = storage.shared_folder(spark).removeprefix("file:")
    latest = max(glob.glob(f"{folder}/positions-*"), key=os.path.getmtime)
    pieces = spark.read.parquet(latest).groupBy(F.shiftright("_pos", 33)).count().collect()
    assert len(pieces) > 12 and max(r["count"] for r in pieces) < 150


def test_rows_without_a_key_are_a_series(skewed):
    unnamed = skewed.withColumn(
        "series_id", F.when(F.col("series_id") != "hot", F.col("series_id")))
    forecasts = baselines.baseline_forecasts(unnamed, PLAIN)
    hot = rows_of(baselines.baseline_forecasts(
        skewed.filter("series_id = 'hot'"), PLAIN).drop("series_id"), "model", "idx")
    for layout in SMALL_BLOCKS:
        blocks = baselines.baseline_forecasts(unnamed, layout)
        assert blocks.count() == forecasts.count()
    alone = skewed.filter("series_id = 'hot'").withColumn("series_id", F.lit(None).cast("string"))
    blocks = baselines.baseline_forecasts(alone, SMALL_BLOCKS[0]).drop("series_id")
    assert same(rows_of(blocks, "model", "idx"), hot)


def test_lengths_are_measured(skewed):
    lengths = measure_lengths(skewed, Layout("auto", block_rows=100))
    assert (lengths.has_short, lengths.long_series, lengths.long_rows) == (True, 1, 600)
    assert resolve(skewed, Layout("auto", block_rows=1000)) == PLAIN
    assert resolve(skewed, Layout("auto", block_rows=100)).mode == "auto"


def test_joins_without_broadcast_give_the_same(skewed, monkeypatch):
    layout = Layout("auto", block_rows=50)
    keys = ("series_id", "t", "y", "lag_1", "lag_3")
    expected = rows_of(features.feature_table(skewed, layout), *keys)
    scaled = rows_of(scaling.scaler_transform(skewed, layout), "series_id", "idx")
    monkeypatch.setattr("seriesflow.plans.layout.BROADCAST_ROWS", -1)
    assert expected == rows_of(features.feature_table(skewed, layout), *keys)
    assert same(scaled, rows_of(scaling.scaler_transform(skewed, layout), "series_id", "idx"))


def test_blocks_grow_to_the_reach_of_the_windows(skewed):
    small = features.rolling_means(skewed, Layout("blocks", block_rows=5))
    plain = features.rolling_means(skewed, PLAIN)
    assert same(rows_of(small, "series_id", "idx"), rows_of(plain, "series_id", "idx"))


def test_no_window_over_all_rows_of_a_long_series(skewed):
    """Rows are partitioned by series and block; only counts by series alone."""
    frame = index_series(
        skewed, Layout("blocks", block_rows=50), lambda w: {"p": F.lag("y", 1).over(w)}, back=1)
    plan = re.sub(r"#\d+L?", "", frame.df._jdf.queryExecution().executedPlan().toString())
    assert "SinglePartition" not in plan
    lag = [line for line in plan.splitlines() if "Window [lag(y" in line]
    assert lag and all("windowspecdefinition(series_id, _block" in line for line in lag)


def test_one_shuffle_for_the_plain_suite(skewed):
    plan = baselines.baseline_suite(skewed, PLAIN)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_review_of_bounded_series_adds_no_shuffle(skewed):
    plan = _plan(review.high_error_review(baselines.baseline_forecasts(skewed, PLAIN), PLAIN))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_best_model_keeps_only_the_first_of_a_group(skewed):
    board = score.leaderboard(baselines.baseline_forecasts(skewed, PLAIN))
    assert "WindowGroupLimit" in _plan(review.best_model(board))


def test_scan_reads_only_the_columns_used(spark, skewed, tmp_path):
    path = str(tmp_path / "wide")
    skewed.withColumn("unused", F.lit("x")).write.parquet(path)
    plan = _plan(splits.split_raw(spark.read.parquet(path).drop("unused"), PLAIN).select("idx"))
    assert "ReadSchema: struct<series_id:string,t:timestamp,y:double,tiebreak:bigint>" in plan
    counts = _plan(splits.window_counts(spark.read.parquet(path)))
    assert "ReadSchema: struct<series_id:string>" in counts


def test_key_filter_reaches_the_scan(spark, skewed, tmp_path):
    path = str(tmp_path / "series")
    skewed.write.parquet(path)
    rows = features.lag_features(spark.read.parquet(path), PLAIN).filter("series_id = 's1'")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(series_id,s1)" in plan


def test_result_does_not_depend_on_partitions(skewed):
    one = features.feature_table(skewed.coalesce(1), PLAIN)
    many = features.feature_table(skewed.repartition(13), PLAIN)
    keys = ("series_id", "t", "y", "lag_1", "lag_3")
    assert rows_of(one, *keys) == rows_of(many, *keys)


@pytest.mark.parametrize("reach", [1000, 5000])
def test_windows_longer_than_a_block(spark, reach):
    """Blocks of 1,000 rows, windows of as many and of five times that: the plain result."""
    df = spark.range(13_000).select(
        F.when(F.col("id") < 600, F.lit("short")).otherwise(F.lit("long")).alias("series_id"),
        F.col("id").alias("t"), ((F.col("id") * 37) % 101).cast("double").alias("y"))
    blocks = Layout("auto", block_rows=1000)
    for make in (lambda layout: features.feature_table(df, layout, (1, reach), (3, reach)),
                 lambda layout: baselines.baseline_forecasts(df, layout, season=reach)):
        plain, cut = make(PLAIN), make(blocks)
        assert plain.count() == cut.count() > 0
        values = [c for c, kind in plain.dtypes if kind == "double"]
        keys = [c for c in plain.columns if c not in values]
        rounded = [df.select(*keys, *[F.round(c, 6).alias(c) for c in values]) for df in (plain, cut)]
        assert rounded[0].exceptAll(rounded[1]).count() == 0


def test_learned_windows_longer_than_a_pack(spark, monkeypatch):
    monkeypatch.setattr(learned, "PACK", 16)
    df = spark.range(300).select(F.lit("a").alias("series_id"), F.col("id").alias("t"),
                                 ((F.col("id") * 37) % 101).cast("double").alias("y"))
    rows = learned.unpacked(learned.packed(df, PLAIN, 40), 40).orderBy("idx").collect()
    plain = windows.supervised_rows(df, PLAIN, 40).orderBy("idx").collect()
    assert [(r.idx, r.split, r.x, r.delta_target) for r in rows] == [
        (r.idx, r.split, pytest.approx(r.x), pytest.approx(r.delta_target)) for r in plain]


def test_rows_left_in_one_piece_are_not_numbered_again(spark):
    values = ((F.col("id") * 37) % 101).cast("double")
    df = spark.range(500).select(F.lit("a").alias("series_id"), F.col("id").alias("t"), values.alias("y"))
    gaps = df.withColumn("y", F.when(F.col("t") % 7 != 3, F.col("y")))
    windows_of = {}
    for name, rows in (("whole", df), ("gaps", gaps)):
        table = features.feature_table(rows, Layout("auto", block_rows=90))
        plan = table._jdf.queryExecution().sparkPlan().toString()
        windows_of[name] = len(re.findall(r"^\W*Window\b", plan, re.M))
        assert same(rows_of(table, "t"), rows_of(features.feature_table(rows, PLAIN), "t"))
    assert windows_of["whole"] == windows_of["gaps"] - 1
