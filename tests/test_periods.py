"""Features and counts that grow with the periods against those of one run."""

import pytest
from pyspark.sql import functions as F

from seriesflow.config import PLAIN, Layout
from seriesflow.operators import features, periods, prepare
from seriesflow.sources.storage import store
from tests import fixed_values as fixed
from tests.conftest import month, rows_of, same

BLOCKS = Layout("auto", block_rows=30)


def in_steps(df, cuts, layout, **steps):
    edges, state, made = [0, *cuts, 1000], None, []
    for a, b in zip(edges, edges[1:]):
        arrived = df.filter((F.col("t") >= F.lit(month(a))) & (F.col("t") < F.lit(month(b))))
        step = periods.advance(arrived, state, layout, **steps)
        made.append(store(step.features, "features"))
        state = store(step.state, "state")
        assert step.late is None or step.late.count() == 0
    table = made[0]
    for more in made[1:]:
        table = table.unionByName(more)
    return table, state


@pytest.mark.parametrize("layout", [PLAIN, BLOCKS])
@pytest.mark.parametrize("cuts", [[130], [5, 12, 13, 14, 60], [143]])
def test_steps_give_the_features_of_one_run(make_series, layout, cuts):
    late = [float(i) for i in range(40)]
    df = make_series(air=[float(v) for v in fixed.PASSENGERS], gaps=[None if i % 17 == 5 else float(i * i % 23) for i in range(144)])
    df = df.unionByName(make_series(new=late).withColumn("t", F.add_months("t", 90))).unionByName(make_series(ended=late))
    table, state = in_steps(df, cuts, layout)
    keys = ("series_id", "t")
    assert same(rows_of(periods.with_splits(table, state), *keys), rows_of(features.feature_table(df, PLAIN), *keys))
    assert rows_of(periods.quality_report(state, "d"), "series_id") == rows_of(prepare.data_quality_report(df, "d"), "series_id")
    assert {r["series_id"]: len(r["tail"]) for r in rows_of(state, "series_id")} == {
        "air": 13, "gaps": 13, "new": 13, "ended": 13}


def test_other_lags_and_rolls(make_series):
    df = make_series(a=[float(i * 7 % 31) for i in range(60)])
    steps = {"lags": (2,), "rolls": (5, 20)}
    table, state = in_steps(df, [30, 31], PLAIN, **steps)
    assert same(rows_of(periods.with_splits(table, state), "t"), rows_of(features.feature_table(df, PLAIN, **steps), "t"))


def test_late_rows_are_handed_back(spark, make_series):
    first = periods.advance(make_series(a=[1.0, 2.0, 3.0], b=[1.0]), None, PLAIN)
    state = store(first.state, "state")
    rows = [("a", month(2), 9.0), ("a", month(3), 4.0), ("a", None, 5.0), ("b", month(1), 6.0), ("c", None, 7.0),
            (None, month(0), 8.0)]
    arrived = spark.createDataFrame(rows, "series_id string, t date, y double")
    step = periods.advance(arrived, state, PLAIN)
    assert {(r.series_id, r.y) for r in step.late.collect()} == {("a", 9.0), ("a", 5.0)}
    assert {r.series_id: (r["rows"], r.last_t) for r in step.state.collect()} == {
        "a": (4, month(3)), "b": (2, month(1)), "c": (1, None), None: (1, month(0))}


def test_a_step_reads_new_rows_and_tails_only(spark, make_series, tmp_path):
    df = make_series(a=[float(i) for i in range(144)])
    state = store(periods.advance(df.filter(F.col("t") < F.lit(month(130))), None, PLAIN).state, "state")
    df.filter(F.col("t") >= F.lit(month(130))).write.parquet(f"{tmp_path}/new")
    step = periods.advance(spark.read.parquet(f"{tmp_path}/new"), state, PLAIN)
    read = set(step.features.inputFiles())
    assert read == set(state.inputFiles()) | {p for p in read if "/new/" in p}
    assert step.features.count() == 14 and state.first()["rows"] == 130


def test_steps_without_rows(spark, make_series):
    df = make_series(a=[float(i) for i in range(20)])
    none = df.filter("false")
    assert periods.advance(none, None, PLAIN).state.count() == 0
    state = store(periods.advance(df, None, PLAIN).state, "state")
    step = periods.advance(none, state, PLAIN)
    assert step.features.count() == 0 and rows_of(step.state) == rows_of(state)
