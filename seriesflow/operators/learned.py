"""Learned one-step forecasters: one model fitted over the windows of all series.

The windows are scaled per series, so a single distributed regression learns
from all of them. Each model is fitted twice: on the next level and on the
next difference, from which the level is then rebuilt.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressionModel, GBTRegressor, LinearRegressionModel,
)
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, functions as F

from seriesflow.config import (
    AUTO, IDX, KEY, MIN_GAIN, N, PATIENCE, SEED, SPLIT, STD_EPSILON, T, TEST, TRAIN,
    VALIDATION, WINDOW, Y, Layout,
)
from seriesflow.functions.columns import split_label
from seriesflow.operators.scaling import index_with_scale, scaled, scaler_fit, unscaled
from seriesflow.sources.storage import store

LEVEL, DELTA = "Learned - no differencing", "Learned - differencing"
_LABELS = {LEVEL: "level_target", DELTA: "delta_target"}
LINEAR, BOOSTED = "LinearRegression", "GBT"
PACK = 4096  # rows of a series read together
FIRST_ORDER = 100  # of learned models in ties: after baselines and external models


@dataclass(frozen=True)
class LearnedSettings:
    """``length`` is the window. Boosting stops after ``patience`` rounds without gain on
    the validation rows, at the latest after ``max_rounds``; the selection report says
    where that limit was reached. The ``first_rounds`` are fitted in bulk, those that the
    patience asks for beyond them one after another; only up to ``refit_rows`` training
    rows, where a round costs the start of its jobs and not its passes, by a longer fit
    from the start. The trees are the same."""

    length: int = WINDOW
    models: tuple[str, ...] = (LINEAR, BOOSTED)
    ridge: tuple[float, ...] = (0.0, 0.01, 0.1)
    first_rounds: int = 40
    refit_rows: int = 100_000
    max_rounds: int = 300
    depth: int = 3
    patience: int = PATIENCE
    min_gain: float = MIN_GAIN


@dataclass(frozen=True)
class Fitted:
    condition: str
    name: str
    order: int
    model: Model
    best_val_mse: float | None
    setting: str


def best_round(curve: Sequence[float], patience: int, min_gain: float) -> int:
    """Index of the round kept when training stops after ``patience`` bad ones."""
    best, kept = float("inf"), 0
    for i, loss in enumerate(curve):
        if loss < best - min_gain:
            best, kept = loss, i
        elif i - kept >= patience:
            break
    return kept


def packed(df: DataFrame, layout: Layout = AUTO, length: int = WINDOW) -> DataFrame:
    """Packs of up to PACK consecutive rows of a series, with the ``length`` rows before;
    packs are longer where the windows are.

    The windows of a pack's rows lie inside it. So the table that the fits read
    holds each row about once (twice at most), and not once for every window it is
    part of; and a long series has many packs.
    """
    size = max(PACK, length)
    own = F.expr(f"{IDX} div {size}")
    homes = F.when(F.col(IDX) % size >= size - length, F.array(own, own + 1)).otherwise(F.array(own))
    return (
        index_with_scale(df, layout).df
        .withColumn("_pack", F.explode(homes))
        .groupBy(KEY, "_pack")
        .agg(
            F.sort_array(F.collect_list(F.struct(IDX, T, Y))).alias("_rows"),
            *[F.max(c).alias(c) for c in (N, "scale_mean", "scale_std")],
        )
    )


def unpacked(packs: DataFrame, length: int = WINDOW) -> DataFrame:
    """The supervised rows of the packs; see ``windows.supervised_rows``."""
    rows = F.col("_rows")
    start = F.greatest(F.col("_pack") * max(PACK, length), F.lit(length)) - rows[0][IDX]
    places = F.when(start < F.size(rows), F.sequence(start.cast("int"), F.size(rows) - 1))

    def supervised(j: Column) -> Column:
        row = rows[j]
        x = F.transform(F.slice(rows, j - length + 1, length), lambda r: scaled(r[Y]))
        level, last = scaled(row[Y]), scaled(rows[j - 1][Y])
        return F.struct(
            row[T].alias(T), row[IDX].alias(IDX), row[Y].alias(Y), x.alias("x"),
            last.alias("last_level"), level.alias("level_target"),
            (level - last).alias("delta_target"),
        )

    # The rows are built inside an array, so that a pack is not copied to each of them.
    made = packs.select(KEY, N, "scale_mean", "scale_std",
                        F.explode(F.transform(places, supervised)).alias("_r"))
    return made.select(
        KEY, f"_r.{T}", f"_r.{IDX}", f"_r.{Y}", "scale_mean", "scale_std",
        split_label(F.col(f"_r.{IDX}")).alias(SPLIT),
        "_r.x", "_r.last_level", "_r.level_target", "_r.delta_target",
    )


def learning_rows(df: DataFrame, layout: Layout = AUTO, length: int = WINDOW) -> DataFrame:
    """Supervised rows with a feature vector.

    Rows whose window or target has a gap or an infinite value stay in, marked
    as not ``usable``; they are kept out of the fits and get no forecast. So do
    all rows of a series without spread in its training rows: scaled by next to
    nothing, its later values would outweigh those of every other series.
    """
    rows = unpacked(store(packed(df, layout, length), "packs"), length)
    rows = rows.withColumn("has_spread", _has_spread())
    window_ok = F.col("has_spread") & F.forall("x", _finite)
    rows = rows.withColumn("window_ok", F.coalesce(window_ok, F.lit(False)))
    target_ok = F.coalesce(_finite(F.col("level_target")), F.lit(False))
    rows = rows.withColumn("usable", F.col("window_ok") & target_ok)
    blank = F.array_repeat(F.lit(0.0), length)
    vector = array_to_vector(F.when(F.col("window_ok"), F.col("x")).otherwise(blank))
    return rows.withColumn("features", vector)


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def _has_spread() -> Column:
    """Whether the training rows differ by more than float noise."""
    std, mean = F.col("scale_std") - STD_EPSILON, F.col("scale_mean")
    return F.coalesce(_finite(std) & (std > STD_EPSILON * F.greatest(F.lit(1.0), F.abs(mean))), F.lit(False))


def series_without_spread(df: DataFrame, layout: Layout = AUTO) -> DataFrame:
    """The series that get no learned forecast because their training rows are all alike."""
    return scaler_fit(df, layout).filter(~_has_spread()).select(KEY, "scale_mean")


def _fitting_data(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows; each pass reads the packs anew."""
    usable = rows.filter("usable").select("features", *_LABELS.values(), SPLIT)
    return usable.filter(F.col(SPLIT) == TRAIN), usable.filter(F.col(SPLIT) == VALIDATION)


def _side_by_side(fit: Callable, choices: Sequence, train: DataFrame) -> list:
    """Fit once per choice, at the same time: each fit is a chain of Spark jobs."""
    with ThreadPool(len(choices)) as pool:
        return pool.map(inheritable_thread_target(train.sparkSession)(fit), choices)


def moments(rows: DataFrame, features: str = "features") -> np.ndarray:
    """Sums of all products of two of: the features, the labels, one. A single pass.

    The matrix has a row and a column for each of them, whatever the number of rows.
    """
    both = F.concat(vector_to_array(features), F.array(*[F.col(c) for c in _LABELS.values()], F.lit(1.0)))
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector(both).alias("v")), "v")
    return RowMatrix(vectors).computeGramianMatrix().toArray()


def ridge_weights(sums: np.ndarray, label: int, ridge: float) -> tuple[np.ndarray, float]:
    """Weights and intercept of the ridge regression on one label of ``moments``.

    They are those of ``LinearRegression`` with ``regParam=ridge``: the penalty is on the
    weights of features scaled to a standard deviation of one. Constant features weigh
    nothing; of many solutions it is the one with the smallest scaled weights.
    """
    k = len(sums) - len(_LABELS) - 1
    means = sums[:, -1] / sums[-1, -1]
    spread = sums / sums[-1, -1] - np.outer(means, means)
    std = np.sqrt(np.maximum(np.diag(spread), 0.0))
    y, noise = k + label, 1e-7 * (1.0 + np.abs(means))
    weights = np.zeros(k)
    used = np.flatnonzero(std[:k] > noise[:k])
    if len(used) and std[y] > noise[y]:
        alike = spread[np.ix_(used, used)] / np.outer(std[used], std[used])
        values, axes = np.linalg.eigh(alike)
        damped = values + ridge / std[y]
        kept = damped > 1e-12 * damped.max()
        target = axes[:, kept].T @ (spread[used, y] / (std[used] * std[y]))
        weights[used] = axes[:, kept] @ (target / damped[kept]) * std[y] / std[used]
    return weights, float(means[y] - weights @ means[:k])


def linear_model(weights: Sequence[float], intercept: float) -> LinearRegressionModel:
    gateway = SparkContext._gateway
    values = gateway.new_array(gateway.jvm.double, len(weights))
    for i, w in enumerate(weights):
        values[i] = float(w)
    java = gateway.jvm.org.apache.spark.ml.regression.LinearRegressionModel(
        f"LinearRegression_{uuid.uuid4().hex[:12]}", gateway.jvm.org.apache.spark.ml.linalg.Vectors.dense(values),
        float(intercept))
    return LinearRegressionModel(java)


def linear_candidates(train: DataFrame, settings: LearnedSettings) -> dict[tuple[str, float], Model]:
    """The model of every condition and penalty, all solved from the same sums."""
    sums = moments(train)
    return {(condition, ridge): linear_model(*ridge_weights(sums, i, ridge))
            for i, condition in enumerate(_LABELS) for ridge in settings.ridge}


def moment_rows(rows: DataFrame) -> DataFrame:
    """``moments`` of the training rows as a table (a, b, value): features, labels, one."""
    sums = moments(_fitting_data(rows)[0])
    return rows.sparkSession.createDataFrame(
        [(a, b, float(v)) for a, line in enumerate(sums) for b, v in enumerate(line)],
        "a int, b int, value double")


def optimality_gaps(rows: DataFrame, settings: LearnedSettings = LearnedSettings()) -> DataFrame:
    """How far the linear models are from the optimum of what they minimise.

    One row per condition, penalty and feature (the last one stands for the intercept): the
    training rows, and the slope of half the mean squared error plus penalty, zero at the
    optimum. Found from the residuals of the rows, not from the sums that gave the weights.
    """
    train, _ = _fitting_data(rows)
    candidates = linear_candidates(train, settings)
    scored = train.withColumn("_x", vector_to_array("features"))
    for i, model in enumerate(candidates.values()):
        scored = model.setPredictionCol(f"_p{i}").transform(scored)
    deviations = [F.stddev_pop(F.col("_x")[j]).alias(f"_s{j}") for j in range(settings.length)]
    deviations += [F.stddev_pop(c).alias(f"_s_{c}") for c in _LABELS.values()]
    slopes = []
    for i, (condition, _) in enumerate(candidates):
        left = F.col(f"_p{i}") - F.col(_LABELS[condition])
        slopes += [F.avg(left * F.col("_x")[j]).alias(f"_g{i}_{j}") for j in range(settings.length)]
        slopes.append(F.avg(left).alias(f"_g{i}_{settings.length}"))
    found = scored.agg(F.count(F.lit(1)).alias("_n"), *deviations, *slopes)
    gaps = []
    for i, ((condition, ridge), model) in enumerate(candidates.items()):
        for j in range(settings.length + 1):
            slope = F.col(f"_g{i}_{j}")
            if j < settings.length:
                slope += ridge / F.col(f"_s_{_LABELS[condition]}") * F.pow(f"_s{j}", 2) * float(model.coefficients[j])
            gaps.append(F.struct(F.lit(condition).alias("condition"), F.lit(ridge).alias("ridge"),
                                 F.lit(j).alias("feature"), F.col("_n").alias("train_rows"), slope.alias("slope")))
    return found.select(F.explode(F.array(*gaps)).alias("_g")).select("_g.*")


def _fit_linear(train, validation, settings: LearnedSettings) -> dict[str, tuple]:
    """Ridge regression; the penalty is the one with the lowest validation error."""
    candidates = linear_candidates(train, settings)
    # All candidates are scored in one pass over the validation rows.
    scored = validation
    for i, model in enumerate(candidates.values()):
        scored = model.setPredictionCol(f"_p{i}").transform(scored)
    errors = scored.agg(*[
        F.avg(F.pow(F.col(_LABELS[c]) - F.col(m.getPredictionCol()), 2)).alias(m.getPredictionCol())
        for (c, _), m in candidates.items()
    ]).first()
    chosen = {}
    for condition in _LABELS:
        mine = {r: m for (c, r), m in candidates.items() if c == condition}
        loss = {r: errors[m.getPredictionCol()] for r, m in mine.items()}
        ridge = min(loss, key=lambda r: float("inf") if loss[r] is None else loss[r])
        chosen[condition] = (mine[ridge], loss[ridge], f"regParam={ridge}")
    return chosen


def boosted_model(like: GBTRegressionModel, trees: Sequence, weights: Sequence[float]) -> GBTRegressionModel:
    """A boosted model of the given trees (of Spark's JVM side), else as ``like``."""
    gateway, java = SparkContext._gateway, like._java_obj
    kind = gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    its_trees, its_weights = gateway.new_array(kind, len(trees)), gateway.new_array(gateway.jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        its_trees[i], its_weights[i] = tree, float(weight)
    made = gateway.jvm.org.apache.spark.ml.regression.GBTRegressionModel(like.uid, its_trees, its_weights)
    return GBTRegressionModel(java.copyValues(made, java.extractParamMap()))


def first_trees(model: GBTRegressionModel, count: int) -> GBTRegressionModel:
    """The boosted model after ``count`` rounds: later trees do not change earlier ones."""
    if count >= model.getNumTrees:
        return model
    return boosted_model(model, list(model._java_obj.trees())[:count], model.treeWeights[:count])


def more_rounds(
    model: GBTRegressionModel, train: DataFrame, boosting: GBTRegressor, rounds: int
) -> GBTRegressionModel:
    """The model after further rounds of ``boosting``; those that it has are not fitted again.

    A round is a tree on twice what the model leaves of the label, the slope of the squared
    error, so the trees are those of one longer fit (where two
    splits gain the same but for rounding, either may be taken).
    """
    trees, weights = list(model._java_obj.trees()), list(model.treeWeights)
    added = []  # a fitted tree's Java side lives as long as its Python side
    for _ in range(rounds):
        left = 2 * (F.col(boosting.getLabelCol()) - F.col("_f"))
        rows = model.copy().setPredictionCol("_f").transform(train).withColumn("_left", left)
        tree = DecisionTreeRegressor(
            labelCol="_left", maxDepth=boosting.getMaxDepth(), seed=boosting.getSeed(),
        ).fit(rows.select("features", "_left"))
        added.append(tree)
        trees.append(tree._java_obj)
        weights.append(boosting.getStepSize())
        model = boosted_model(model, trees, weights)
    return model


def _fit_boosted(train, validation, settings: LearnedSettings) -> dict[str, tuple]:
    """Boosted trees with as many rounds as patience on the validation curve keeps."""
    has_validation = not validation.isEmpty()

    def few_rows() -> bool:
        return settings.refit_rows > 0 and train.limit(settings.refit_rows + 1).count() <= settings.refit_rows

    def fit(label: str) -> tuple:
        rounds = min(settings.first_rounds, settings.max_rounds)
        boosting = GBTRegressor(labelCol=label, maxDepth=settings.depth, maxIter=rounds, seed=SEED)
        model = boosting.fit(train)
        if not has_validation:
            return model, None, f"rounds={rounds}"
        while True:
            curve = model.evaluateEachIteration(validation, "squared")
            kept = best_round(curve, settings.patience, settings.min_gain)
            at_limit = kept + settings.patience >= len(curve)
            if not at_limit or len(curve) >= settings.max_rounds:
                break
            if few_rows():
                rounds = min(2 * len(curve), settings.max_rounds)
                model = boosting.setMaxIter(rounds).fit(train)
                continue
            # the curve can stop at the earliest after these
            missing = kept + settings.patience + 1 - len(curve)
            model = more_rounds(model, train, boosting, min(missing, settings.max_rounds - len(curve)))
        return first_trees(model, kept + 1), curve[kept], f"rounds={kept + 1}" + ", at the limit" * at_limit

    return dict(zip(_LABELS, _side_by_side(fit, list(_LABELS.values()), train)))


_FITS = {LINEAR: _fit_linear, BOOSTED: _fit_boosted}


def fit_models(rows: DataFrame, settings: LearnedSettings = LearnedSettings()) -> list[Fitted]:
    """Fit every model under both conditions; none if there is no training window."""
    train, validation = _fitting_data(rows)
    if train.isEmpty():
        return []
    fits = {name: _FITS[name](train, validation, settings) for name in settings.models}
    pairs = [(c, name) for c in _LABELS for name in settings.models]
    return [
        Fitted(c, name, FIRST_ORDER + i, *fits[name][c])
        for i, (c, name) in enumerate(pairs)
    ]


def selection_report(df: DataFrame, fitted: Sequence[Fitted]) -> DataFrame:
    """Validation error and chosen setting per condition and model: a few rows."""
    return df.sparkSession.createDataFrame(
        [(f.condition, f.name, f.best_val_mse, f.setting) for f in fitted],
        "condition string, model string, best_val_mse double, setting string",
    )


def forecasts_of(rows: DataFrame, fitted: Sequence[Fitted]) -> DataFrame:
    """Test forecasts of all fitted models as a forecast table."""
    scored = rows.filter(F.col(SPLIT) == TEST)
    outputs = []
    for i, f in enumerate(fitted):
        scored = f.model.copy().setPredictionCol(f"_p{i}").transform(scored)
        level = F.col(f"_p{i}")
        if f.condition == DELTA:
            level = F.col("last_level") + level
        outputs.append(F.struct(
            F.lit(f.condition).alias("condition"),
            F.lit(f.name).alias("model"),
            F.lit(f.order).alias("model_order"),
            F.when(F.col("window_ok"), unscaled(level)).alias("forecast"),
        ))
    nothing = "array<struct<condition:string,model:string,model_order:int,forecast:double>>"
    long = F.array(*outputs) if outputs else F.array().cast(nothing)
    return (
        scored.select(KEY, T, IDX, F.col(Y).alias("actual"), F.explode(long).alias("_f"))
        .select(KEY, T, IDX, "_f.condition", "_f.model", "_f.model_order", "actual", "_f.forecast")
    )


def learned_forecasts(
    df: DataFrame, layout: Layout = AUTO, settings: LearnedSettings = LearnedSettings()
) -> tuple[DataFrame, DataFrame]:
    """Test forecasts of the learned models and their selection report."""
    rows = learning_rows(df, layout, settings.length)
    fitted = fit_models(rows, settings)
    return forecasts_of(rows, fitted), selection_report(df, fitted)
