"""Helpers: slices, kept columns, hashes."""

import zlib

import numpy as np
from pyspark.sql import functions as F, types as T

from seriesflow.llm import common


def test_ranges_cover_all_and_stay_small():
    rng = np.random.default_rng(1)
    for _ in range(50):
        lengths = rng.integers(0, 400, rng.integers(0, 60))
        found = list(common.ranges(lengths, 1000))
        assert [i for a, b in found for i in range(a, b)] == list(range(len(lengths)))
        assert all(b - a == 1 or (lengths[a:b] + 64).sum() <= 1000 for a, b in found)


def test_mixing_is_one_to_one():
    values = np.unique(np.random.default_rng(2).integers(0, 2**63, 10_000).astype(np.uint64))
    assert len(np.unique(common.mix(values))) == len(values)


def test_crc_of_ids(spark):
    rows = spark.createDataFrame([(i,) for i in [0, -5, 123456789012, None]], "i bigint").select(
        "i", common.crc_mod(F.col("i"), 10).alias("m")).collect()
    assert [r.m for r in rows] == [zlib.crc32(b"" if r.i is None else str(r.i).encode()) % 10 for r in rows]


def test_kept_columns_stay_with_their_rows(spark):
    rows = [(i, "é" * (i % 7) if i % 5 else None, [i], float(i)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n array<bigint>, size double").repartition(4)

    def make():
        return lambda texts: ([len(t or b"") for t in texts],)

    found = common.add_columns(docs, make, [("size", T.LongType())], docs.columns, limit=200)
    assert found.columns == ["doc_id", "text", "n", "size"]
    for r in found.collect():
        assert (r.text, r.n) == (rows[r.doc_id][1], [r.doc_id]) and r.size == len((r.text or "").encode())


def test_own_batch_size_is_kept(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "1m")
        common.small_batches(spark.range(1))
        assert spark.conf.get(name) in ("1m", "1048576b", "1048576")
        spark.conf.unset(name)
        common.small_batches(spark.range(1))
        assert int(spark.conf.get(name).rstrip("b")) == common.BATCH_BYTES
    finally:
        spark.conf.set(name, before)
