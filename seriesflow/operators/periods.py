"""Features and quality counts of the next periods, without reading the past again.

After each step a state is kept: for every series its counts and its last rows, as many as
the windows look back. The next step reads the rows that have arrived and this state. The
features of all steps together are those of one run over all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from seriesflow.config import AUTO, IDX, KEY, LAGS, N, ROLLS, SPLIT, T, WINDOW, Y, Layout
from seriesflow.functions.columns import split_label
from seriesflow.operators import prepare
from seriesflow.operators.features import TARGETS, Steps, feature_names, feature_windows
from seriesflow.plans.layout import broadcast_up_to, index_series, join_series, order_columns

# Counts of a state: of rows, feature rows, missing and NaN values, repeated periods.
_COUNTS = ("rows", "complete", "missing", "nan", "repeated")


@dataclass(frozen=True)
class Step:
    """``features`` are the feature rows that have become complete, with their ``position``
    among those of their series. ``state`` is what the next step needs. ``late`` are arrived
    rows that do not lie after the known ones of their series, or have no time: they take no
    part, and call for a run over all rows. None if nothing was known before."""

    features: DataFrame
    state: DataFrame
    late: DataFrame | None


def advance(
    arrived: DataFrame, state: DataFrame | None = None, layout: Layout = AUTO,
    lags: Steps = LAGS, rolls: Steps = ROLLS,
) -> Step:
    """Take in rows that have arrived; without a state they are all there is.

    Series may be new, or have no new rows. Lags and rolls must be those of the steps before.
    """
    reach = max(*lags, *rolls)
    order = order_columns(arrived)
    rows, late = arrived.select(KEY, *order, F.lit(True).alias("_new")), None
    if state is not None:
        late, rows = _by_lateness(rows, state)
        known = state.withColumn("_old", F.struct(*_COUNTS, F.size("tail").alias("kept"), "first_t"))
        tails = known.select(KEY, F.explode("tail").alias("_r"), "_old").select(
            KEY, *[F.col(f"_r.{c}").alias(c) for c in order], F.lit(False).alias("_new"), "_old")
        rows = tails.unionByName(rows, allowMissingColumns=True)
        past = F.max("_old")
    else:
        past = F.max(_nothing(arrived.schema[T].dataType.simpleString()))

    def windows(w: WindowSpec) -> dict[str, Column]:
        return feature_windows(lags, rolls)(w) | {"_before": F.lag(T, 1).over(w), "_next_new": F.lead("_new", 1).over(w)}

    frame = index_series(rows, layout, windows, back=reach, ahead=1, aggs={"_past": past})
    # the row before the first new one gets its target now
    complete = F.col(f"lag_{max(lags)}").isNotNull() & F.col("target_next").isNotNull() & F.col("_next_new")
    done = frame.map(lambda df: df.filter(complete)).renumber("_position", "_total").df
    features = done.select(
        KEY, *order, *feature_names(lags, rolls), *TARGETS,
        (F.col("_position") + _past("complete")).alias("position"))
    return Step(features, _state(frame.df, order, complete, reach + 1), late)


def _nothing(time: str) -> Column:
    fields = [*[f"{c}:bigint" for c in _COUNTS], "kept:int", f"first_t:{time}"]
    return F.lit(None).cast(f"struct<{','.join(fields)}>")


def _past(name: str) -> Column:
    return F.coalesce(F.col(f"_past.{name}"), F.lit(0).cast("bigint"))


def _by_lateness(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    last = broadcast_up_to(state.select(KEY, "last_t"), state.count())
    marked = join_series(rows, last, how="left")
    is_late = F.col("last_t").isNotNull() & F.coalesce(F.col(T) <= F.col("last_t"), F.lit(True))
    return (marked.filter(is_late).drop("last_t", "_new"), marked.filter(~is_late).drop("last_t"))


def _state(rows: DataFrame, order: list[str], complete: Column, kept: int) -> DataFrame:
    """Counts of the series and their last rows, from the rows of a step."""
    new = F.col("_new")
    repeated = new & (F.col(IDX) >= 1) & F.col(T).eqNullSafe(F.col("_before"))
    last_rows = F.when(F.col(IDX) >= F.col(N) - kept, F.struct(IDX, *order))
    found = rows.groupBy(KEY).agg(
        F.max("_past").alias("_past"),
        F.count_if(new).alias("rows"), F.count_if(complete).alias("complete"),
        F.count_if(new & F.col(Y).isNull()).alias("missing"), F.count_if(new & F.isnan(Y)).alias("nan"),
        F.count_if(repeated).alias("repeated"),
        F.min(T).alias("_first"), F.max(T).alias("last_t"),
        F.sort_array(F.collect_list(last_rows)).alias("_tail"),
    )
    return found.select(
        KEY, *[(F.col(c) + _past(c)).alias(c) for c in _COUNTS],
        F.least("_first", "_past.first_t").alias("first_t"), "last_t",
        F.transform("_tail", lambda r: F.struct(*[r[c].alias(c) for c in order])).alias("tail"))


def with_splits(features: DataFrame, state: DataFrame) -> DataFrame:
    """The feature rows of all steps so far with the split that they have now.

    The 70/15/15 split moves as a series grows, so it is no part of what a step writes.
    """
    totals = state.select(KEY, F.col("complete").alias("_total"))
    joined = join_series(features, broadcast_up_to(totals, state.count()))
    return joined.withColumn(SPLIT, split_label(F.col("position"), F.col("_total"))).drop("_total", "position")


def quality_report(state: DataFrame, dataset: str, window: int = WINDOW) -> DataFrame:
    """``prepare.data_quality_report`` of all rows taken in so far."""
    counts = state.select(
        KEY, F.col("rows").alias("total_observations"), F.col("first_t").alias("start_period"),
        F.col("last_t").alias("end_period"), (F.col("missing") + F.col("nan")).alias("missing_values"),
        F.col("repeated").alias("duplicate_months"))
    return prepare.quality_columns(counts, dataset, window)
