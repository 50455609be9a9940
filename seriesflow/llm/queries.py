"""One registered query for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesflow.llm import (
    fill_middle, interpolation, languages, page_text, perplexity, pieces, repeats, simhash, spelling, templates, token_counts, toxicity,
    warc,
)
from seriesflow.llm.common import crc_mod
from seriesflow.sources.storage import new_path

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return perplexity.quality(_table(spark, folder, "documents"), stored=True)


@_query
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, folder, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").withColumn("held_out", crc_mod(F.col("doc_id"), 3) == 1)
    model = languages.fit(docs.where(~F.col("held_out")))
    return languages.predict(docs, model, ["doc_id", "held_out"])


@_query
def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode_texts(_table(spark, folder, "documents"),
                               public_tokenizers.path("piece_bpe_32k.model"), digests=True)


@_query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").withColumn("held_out", crc_mod(F.col("doc_id"), 4) == 2)
    model = toxicity.fit(docs.where(~F.col("held_out")), _learnable(_table(spark, folder, "labels")))
    return toxicity.score(docs, model, ["doc_id", "held_out"])


def _learnable(labels: DataFrame) -> DataFrame:
    return labels.where(crc_mod(F.col("doc_id"), 4) != 2)


@_query
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_components(_table(spark, folder, "documents"))


@_query
def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, folder, "documents"), digest=True)


# Words, windows of 20 words, and the words that some window found earlier covers.
ORACLE["op9_substring_dedup"] = r"""
WITH cut AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                               lambda w: w <> '') AS words
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM cut WHERE len(words) >= 20)
), ranked AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS r FROM windows
), gone AS (
    SELECT doc_id, list(DISTINCT p) AS gone
    FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM ranked WHERE r > 1) GROUP BY doc_id
), words AS (
    SELECT cut.doc_id, words, coalesce(gone, []) AS gone FROM cut LEFT JOIN gone USING (doc_id)
), kept AS (
    SELECT w.doc_id, array_to_string(list(w.words[w.p] ORDER BY w.p), ' ') AS text
    FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM words) w
    LEFT JOIN (SELECT doc_id, unnest(gone) AS p, true AS gone FROM words) g
        ON w.doc_id = g.doc_id AND w.p = g.p
    WHERE g.gone IS NULL GROUP BY w.doc_id
)
SELECT words.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


@_query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return templates.contaminations(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query
def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = new_path(spark, "warc")
    warc.write_archives(_table(spark, folder, "pages"), archive)
    return warc.read_archives(spark, archive).drop("url")


ORACLE["op2_warc"] = """
WITH bodies AS (
    SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS size FROM pages
), kept AS (
    SELECT body, max(page_id) AS kept FROM bodies WHERE size >= 1000 GROUP BY body
)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < kept THEN kept END AS refers_to
FROM bodies LEFT JOIN kept USING (body)
"""


@_query
def op4_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    return interpolation.score(_table(spark, folder, "documents"))


@_query
def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_middle.transform(_table(spark, folder, "documents"), ["doc_id"])
    back = fill_middle.restore(made, made.columns)
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


ORACLE["op13_fill_middle"] = """
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), cut AS (
    SELECT doc_id, t, n, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1,
           CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2,
           CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                     OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
                WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM hashed
), parts AS (
    SELECT *, substring(t, 1, least(c1, c2)) AS p,
           substring(t, least(c1, c2) + 1, greatest(c1, c2) - least(c1, c2)) AS m,
           substring(t, greatest(c1, c2) + 1) AS s
    FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(c1, c2) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN greatest(c1, c2) - least(c1, c2) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""


@_query
def op12_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return page_text.extract(_table(spark, folder, "pages"), ["page_id", "url"])


@_query
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(_table(spark, folder, "documents"))
