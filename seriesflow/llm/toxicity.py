"""Toxicity scores: boosted trees over dense text features, calibrated by isotonic regression.

The lexicon (words and word beginnings) is learned, with the trees, from a bounded sample of
labelled rows; a part of the sample is kept aside for the calibration. Scores are found for
whole texts and depend on the text alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, functions as F, types as T

from seriesflow.llm.common import add_columns, share, small_batches
from seriesflow.sources.storage import store

WORD = re.compile(r"\w+")
# Second-person forms of the four languages of the test tables.
SECOND_PERSON = frozenset(
    "you your yours yourself ur u du dich dir dein deine deinen deiner ihr euch euer "
    "tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros tus su sus".split())
# Digits and marks that stand for letters in disguised words.
PLAIN = str.maketrans("013457@$!|", "oieastasil")
MIXED = re.compile(r"\b\w*[^\W\d_](?:[@$!|*#]+|[0134579]+)[^\W\d_]\w*")
RUN = re.compile(r"([^\W\d_])\1{3,}")
SPELT = re.compile(r"\b(?:[^\W\d_][ .\-_*]){3,}[^\W\d_]\b")
NEAR = 5
STEMS = (4, 5)
NAMES = ("words", "word_density", "word_hits", "weight_density", "weight_max", "different_words",
         "stem_density", "stem_hits", "different_stems", "near_second_person", "second_person",
         "capitals", "capital_words", "exclamations", "questions", "marks", "mixed_words",
         "disguised_hits", "letter_runs", "spelt_out")


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled rows used for the fit, ``lexicon`` its entries."""

    sample: int = 24_000
    lexicon: int = 1_500
    least_rows: int = 4
    least_odds: float = 1.5
    trees: int = 20
    depth: int = 3
    calibration_share: float = 0.25
    threshold: float = 0.3
    seed: int = 11


def entries(text: str) -> set[str]:
    """Lexicon entries of a text: its words, and their beginnings marked by a star."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    """Values of ``NAMES``; an empty text has zeros."""
    low = text.lower()
    words = WORD.findall(low)
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    hits = [(i, lexicon[w]) for i, w in enumerate(words) if w in lexicon]
    stems = [w for w in words if w[:5] + "*" in lexicon or w[:4] + "*" in lexicon]
    persons = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    marked = {words[i] for i, _ in hits}
    at = np.array(persons)
    near = 0
    if len(at):
        for i, _ in hits:
            k = np.searchsorted(at, i - NEAR)
            near += k < len(at) and at[k] <= i + NEAR
    letters = sum(map(str.isalpha, text)) if not text.isascii() else len(_ASCII_LETTERS.sub("", text))
    upper = len(_UPPER.findall(text))
    mixed = MIXED.findall(low)
    disguised = sum(m.translate(PLAIN).strip("*#") in lexicon for m in mixed)
    weights = [w for _, w in hits]
    return [math.log1p(n), len(hits) / n, math.log1p(len(hits)), sum(weights) / n,
            max(weights, default=0.0), float(len(marked)), len(stems) / n, math.log1p(len(stems)),
            float(len(set(stems))), near / max(1, len(hits)), len(persons) / n,
            upper / max(1, letters), len(_CAPITAL_WORDS.findall(text)) / n,
            text.count("!") / n, text.count("?") / n, len(_MARKS.findall(text)) / n,
            len(mixed) / n, float(disguised), len(RUN.findall(low)) / n, len(SPELT.findall(low)) / n]


_ASCII_LETTERS = re.compile("[^A-Za-z]+")
_UPPER = re.compile("[A-ZÀ-ÖØ-Þ]")
_CAPITAL_WORDS = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b")
_MARKS = re.compile(r"[^\w\s]")


def learn_lexicon(rows: DataFrame, settings: Settings, text: str = "text") -> dict[str, float]:
    """Log odds of the entries that toxic rows have more often, the strongest ones.

    ``rows`` has columns ``text`` and ``toxic``. Rows with an entry are counted in the
    tasks, added up by Spark, and only the chosen entries reach the driver.
    """
    totals = rows.agg(F.sum("toxic"), F.count("*")).first()
    toxic, clean = int(totals[0] or 0), int(totals[1]) - int(totals[0] or 0)
    if not toxic or not clean:
        return {}

    small_batches(rows)

    def run(batches):
        counts = [Counter(), Counter()]
        for batch in batches:
            for text, mark in zip(batch.column(0), batch.column(1).to_pylist()):
                counts[mark].update(entries(text.as_py() or ""))
        words = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([counts[1][w] for w in words], pa.int64()),
             pa.array([counts[0][w] for w in words], pa.int64())], names=["entry", "t", "c"])

    counted = rows.select(text, F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        run, "entry string, t bigint, c bigint")
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0) / ((F.col("c") + 0.5) / (clean + 1.0)))
    chosen = (counted.groupBy("entry").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
              .where(F.col("t") >= settings.least_rows)
              .select("entry", "t", odds.alias("odds")).where(F.col("odds") >= settings.least_odds)
              .orderBy((F.col("odds") * F.sqrt("t")).desc(), "entry").limit(settings.lexicon))
    return {r.entry: r.odds for r in chosen.collect()}


class ToxicityModel:
    """Lexicon, trees and calibration; ``constant`` replaces them if only one class was seen."""

    def __init__(self, lexicon: dict[str, float], trees: GBTClassificationModel | None,
                 calibration: IsotonicRegressionModel | None, constant: float = 0.0):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant


def feature_rows(docs: DataFrame, lexicon: dict[str, float], keep: list[str], text: str = "text") -> DataFrame:
    """Column ``features_`` for every text; null texts count as empty."""
    shared = share(docs, lexicon)

    def make():
        own = shared()
        return lambda texts: ([features((t or b"").decode(), own) for t in texts],)

    return add_columns(docs, make, [("features_", T.ArrayType(T.DoubleType()))], keep, text)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), text: str = "text") -> ToxicityModel:
    """Model from the labelled rows among docs (columns ``doc_id`` and ``toxic`` of labels).

    At most ``settings.sample`` rows are used, those of the labels with the smallest hash of
    doc_id. Rows without an id, label or text are left out, and so are labels that are
    neither 0 nor 1; of a repeated label the highest counts, of rows that repeat an id the
    one whose text has the smallest hash.
    """
    marked = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").try_cast("double").isin(0.0, 1.0))
              .groupBy("doc_id").agg(F.max(F.col("toxic").try_cast("double")).cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample))
    part = F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(1000)) < 1000 * settings.calibration_share
    source = docs.select("doc_id", F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull())
    labelled = source.join(F.broadcast(marked), "doc_id")  # bounded by settings.sample
    one_each = labelled.groupBy("doc_id").agg(
        F.min(F.struct(F.xxhash64("text"), "text", "toxic")).alias("first_")).select("doc_id", "first_.*")
    rows = store(one_each.select("text", "toxic", part.alias("aside")), "toxicity-sample")
    fitting = rows.where(~F.col("aside"))
    lexicon = learn_lexicon(fitting, settings)
    seen = rows.groupBy("aside").agg(F.min("toxic").alias("low"), F.max("toxic").alias("high"),
                                     F.avg("toxic").alias("mean")).collect()
    both = {r.aside for r in seen if r.low != r.high}
    if False not in both:
        return ToxicityModel(lexicon, None, None, max((r.mean for r in seen), default=0.0))
    known = store(feature_rows(rows, lexicon, ["toxic", "aside"]).select(
        array_to_vector("features_").alias("features_"), F.col("toxic").cast("double").alias("label_"), "aside"),
        "toxicity-features").coalesce(6)
    trees = GBTClassifier(featuresCol="features_", labelCol="label_", maxIter=settings.trees,
                          maxDepth=settings.depth, stepSize=0.2, seed=settings.seed).fit(known.where(~F.col("aside")))
    calibration = None
    if True in both:
        held = trees.transform(known.where("aside")).select("label_", vector_to_array("probability")[1].alias("raw_"))
        calibration = IsotonicRegression(featuresCol="raw_", labelCol="label_", predictionCol="score").fit(held)
    return ToxicityModel(lexicon, trees, calibration)


def score(docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None, text: str = "text",
          threshold: float = Settings.threshold) -> DataFrame:
    """``score`` (0 to 1) and ``predicted`` (1 from the threshold on) beside columns ``keep``.

    One row per input row in no given order, repeated rows and null ids included; null and
    empty texts get the score of a text without features. An input column named like a new
    one is replaced.
    """
    keep = [c for c in (["doc_id"] if keep is None else keep) if c not in ("score", "predicted")]
    if model.trees is None:
        chosen = F.lit(float(model.constant))
        return docs.select(*keep, chosen.alias("score"), (chosen >= threshold).cast("int").alias("predicted"))
    kept = {c: f"kept{i}_" for i, c in enumerate(keep)}  # clear of the names that the models add
    source = docs.select(*[F.col(c).alias(k) for c, k in kept.items()], F.col(text).alias("text_"))
    rows = feature_rows(source, model.lexicon, list(kept.values()), "text_")
    found = model.trees.transform(rows.withColumn("features_", array_to_vector("features_")))
    found = found.withColumn("raw_", vector_to_array("probability")[1])
    found = model.calibration.transform(found) if model.calibration else found.withColumn("score", F.col("raw_"))
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score"))
    return found.select(*[F.col(k).alias(c) for c, k in kept.items()], clipped.alias("score"),
                        (clipped >= threshold).cast("int").alias("predicted"))
