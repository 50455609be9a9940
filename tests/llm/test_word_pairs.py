"""How the counts of word pairs travel: without the texts, and to the portions that asked."""

import os
import random
import tempfile

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from seriesflow.llm import perplexity, queries, word_pairs
from seriesflow.llm.common import different
from seriesflow.sources import storage


def size(folder):
    return sum(os.path.getsize(os.path.join(at, name)) for at, _, names in os.walk(folder) for name in names)


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def test_quality_stores_no_copy_of_the_texts(spark):
    rng = random.Random(4)
    folder = tempfile.mkdtemp(prefix="seriesflow-tests-")
    rows = [(i, f"{rng.getrandbits(400_000):x} and so on", "en") for i in range(60)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    shared = local(storage.shared_folder(spark))
    before = size(shared)
    assert queries.QUERIES["op1_quality_rules"](spark, folder).count() == 60
    assert size(shared) - before < size(folder) / 4


def test_portions_do_not_depend_on_batches_and_columns(spark, monkeypatch):
    rng = random.Random(6)
    words = "stone river cloud garden window quiet summer old new".split()
    folder = tempfile.mkdtemp(prefix="seriesflow-tests-")
    rows = [(i, None if i % 17 == 0 else " ".join(rng.choices(words, k=rng.randint(0, 90))), rng.choice(["en", "de", None]),
             "x" * rng.randint(0, 3000)) for i in range(300)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, other string").repartition(3).write.parquet(f"{folder}/d")
    docs = spark.read.parquet(f"{folder}/d")

    def found(**how):
        return {r.doc_id: r for r in perplexity.quality(docs, **how).collect()}

    wanted = found()
    monkeypatch.setattr(word_pairs, "PORTION", 3000)
    monkeypatch.setattr(word_pairs, "_SLICE", 700)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "5000b")
    try:
        many = found(stored=True, keep=docs.columns)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    assert len(many) == len(rows)
    for i, r in many.items():
        assert r.word_perplexity == pytest.approx(wanted[i].word_perplexity, rel=1e-9)
        assert r.word_perplexity_high == pytest.approx(wanted[i].word_perplexity_high, rel=1e-9, nan_ok=True)
        assert (r.kept, r.n_words, r.n_repeat_words, r.other) == (
            wanted[i].kept, wanted[i].n_words, wanted[i].n_repeat_words, rows[i][3])


def test_settings_are_put_back(spark):
    names = "spark.sql.files.minPartitionNum", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = [spark.conf.get(n, None) for n in names]
    with word_pairs.same_portions(spark):
        assert [spark.conf.get(n) for n in names] == [str(spark.sparkContext.defaultParallelism), "true"]
    assert [spark.conf.get(n, None) for n in names] == before


def changing(spark):
    """Texts that are others at each reading."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([" ".join(os.urandom(2).hex() for _ in range(20)) for _ in range(len(batch))])],
                names=["doc_id", "text"])
    return spark.range(40).mapInArrow(run, "doc_id bigint, text string").withColumn("lang", F.lit("en"))


def test_texts_that_change_between_readings(spark):
    assert perplexity.quality(changing(spark)).count() == 40  # a copy is read
    with pytest.raises(PythonException, match="must be stored first"):
        perplexity.quality(changing(spark), stored=True)


def test_deleted_table_is_gone(spark):
    table = storage.store(spark.range(10).repartition(2), "gone")
    folder = os.path.dirname(local(table.inputFiles()[0]))
    assert os.path.isdir(folder)
    storage.delete(table)
    assert not os.path.exists(folder) and os.path.isdir(os.path.dirname(folder))


@pytest.mark.parametrize("low", [0, 3, 8])
def test_packing(low):
    rng = np.random.default_rng(1)
    arrays = [(np.zeros(0, np.uint64), "<u8"), (rng.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2), "<u8"),
              (np.zeros(500, np.int64), "<u4"), (rng.integers(0, 2, 2999).astype(bool), "<u1"), (np.zeros(2500, np.int64), "<u4"),
              (rng.integers(0, 70_000, 2048), "<u4"), (np.array([1 << 40], np.int64), "<u8"), (np.arange(300), "<u4")]
    for some in ([], arrays[:1], arrays, arrays[::-1]):
        found = word_pairs._unpack(word_pairs._pack([(a, k, low) for a, k in some]), [k for _, k in some])
        assert [f.tolist() for f in found] == [a.astype(k).tolist() for a, k in some]


@pytest.mark.parametrize("n,high", [(0, 1), (1, 1), (400, 7), (400, 100_000), (400, 400)])
def test_different(n, high):
    keys = np.random.default_rng(n + high).integers(0, high, n)
    wanted, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
    for limit in (None, high):
        at, found, many = different(keys, limit)
        assert (keys[at].tolist(), found.tolist(), many.tolist()) == (wanted.tolist(), place.tolist(), counts.tolist())
