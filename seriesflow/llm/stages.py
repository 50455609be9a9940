"""Stages of the text pipeline. All but the last return the columns of their input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from seriesflow.llm import pieces, repeats, simhash, templates, toxicity

SHINGLE_WORDS, SIMHASH_BITS = 3, 2
WINDOW_WORDS = 20
_OWN = ("score", "predicted", "fingerprint", "component_id", "component_fp", "n_words", "n_removed",
        "kept_text", "fp_", "root_", "lowest_", "place_", "id_key_", "tie_key_", "first_")


def _clear(docs: DataFrame) -> tuple[DataFrame, list]:
    """docs with the names that the operators add kept free, and the columns to go back."""
    free = {c: f"{c}__{i}" if c in _OWN else c for i, c in enumerate(docs.columns)}
    return docs.withColumnsRenamed(free), [F.col(new).alias(old) for old, new in free.items()]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model learned from ``labels`` does not predict to be toxic."""
    docs, back = _clear(docs)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, docs.columns).where("predicted = 0").select(*back)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that with the smallest doc_id."""
    docs, back = _clear(docs)
    # Texts stay out of the components: the documents are told by id and a hash of the text.
    docs = docs.withColumns({"id_key_": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                             "tie_key_": F.xxhash64("text")})
    rows = simhash.near_components(docs, SHINGLE_WORDS, SIMHASH_BITS, ["doc_id", "id_key_", "tie_key_"])
    first = (rows.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("component_fp").agg(F.min(F.struct("tie_key_", "id_key_")).alias("first_"))
             .select("first_.*"))
    kept = docs.join(first, ["id_key_", "tie_key_"], "left_semi")
    # of rows that repeat id and text one stays
    order = Window.partitionBy("id_key_", "tie_key_").orderBy("tie_key_")
    return kept.withColumn("place_", F.row_number().over(order)).where("place_ = 1").select(*back)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; texts that lose words are the words left, joined by one space."""
    docs, back = _clear(docs)
    rows = repeats.remove_repeats(docs, WINDOW_WORDS, docs.columns)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    rows = rows.withColumn("text", text)
    if "n_chars" in rows.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("bigint"))
                               .otherwise(F.col("n_chars")))
    return rows.select(*back)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of ``benchmark`` is found."""
    return templates.without_contaminations(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of pieces and digests of ids and decoded text of every document."""
    return pieces.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), digests=True)
