"""Interpolated model, archives and pipeline."""

import base64
import hashlib
import io
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from seriesflow.llm import interpolation, queries, simhash, stages, templates, toxicity, warc
from tests.llm.conftest import PASSAGE, edge_rows
from tests.llm.test_copies import brute_components, brute_repeats, with_ties


def tokens(text):
    return [w for w in (text or "").encode().lower().split()] + [b"\n"]


def fold(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10


def brute_scores(rows):
    """Base and model scores from plain dictionaries."""
    def gather(some):
        words, pairs, begins = Counter(), Counter(), 0
        for _, t in some:
            before, begins = None, begins + 1
            for w in tokens(t):
                words[w] += 1
                pairs[before, w] += 1
                before = w
        return words, pairs, begins

    def parts(text, words, pairs, begins):
        n, before = sum(words.values()), None
        for w in tokens(text):
            context = begins if before is None else words[before]
            bucket = min(int(math.log2(context)) + 1, interpolation.BUCKETS - 1) if context else 0
            yield w, bucket, pairs[before, w] / max(context, 1), words[w] / max(n, 1)
            before = w

    train = [r for r in rows if fold(r[0]) != 0]
    full = gather(train)
    rest = gather([r for r in train if fold(r[0]) != 1])
    seen = Counter()
    for i, t in rows:
        if fold(i) == 1:
            for _, b, p2, p1 in parts(t, *rest):
                step = [round(4 * math.log2(p)) if p else interpolation._UNSEEN for p in (p2, p1)]
                seen[b, *step] += 1
    v, n = len(full[0]), sum(full[0].values())
    weights = interpolation.learn_weights([(*k, c) for k, c in seen.items()], v)
    out = []
    for i, t in rows:
        found = list(parts(t, *full))
        model = sum(math.log10(weights[b] @ [p2, p1, 1 / (v + 1)]) for _, b, p2, p1 in found)
        base = sum(math.log10((full[0][w] + .1) / (n + .1 * (v + 1))) for w, *_ in found)
        out.append((i, fold(i) == 0, len(found), sum(full[0][w] > 0 for w, *_ in found), n, base, model))
    return out


def check_scores(found, rows):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted((tuple(r[c] for c in names) for r in found), key=lambda r: (str(r[:5]), r[5]))
    for a, b in zip(got, sorted(brute_scores(rows), key=lambda r: (str(r[:5]), r[5])), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("chunk", [8 << 20, 4000])
def test_scores_equal_brute_force(documents, monkeypatch, chunk):
    monkeypatch.setattr(interpolation, "CHUNK", chunk)
    some = documents.limit(120).repartition(3)
    rows = [(r.doc_id, r.text) for r in documents.limit(120).collect()]
    check_scores(interpolation.score(some).collect(), rows)


def test_scores_on_edges(edges, none):
    rows = interpolation.score(edges, edges.columns).collect()
    assert {r.n_words for r in rows} == {"w"}
    check_scores(rows, [r[:2] for r in edge_rows()])
    assert interpolation.score(none).count() == 0
    held = edges.withColumn("doc_id", F.lit(next(i for i in range(1000) if fold(i) == 0)).cast("bigint"))
    assert all(r.train_tokens == 0 and r.base_score == 0 and r.score == 0
               for r in interpolation.score(held).collect())


def test_weights_prefer_what_predicts():
    good = interpolation.learn_weights([(3, -4, -40, 900), (3, interpolation._UNSEEN, -20, 100)], 10**6)
    assert good[3, 0] > 0.8 and np.allclose(good.sum(axis=1), 1) and (good[:, 2] > 0).all()


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):  # every word has two followers
        w, text = int(rng.integers(50)), []
        for _ in range(40):
            text.append(f"w{w}")
            w = (3 * w + int(rng.integers(2))) % 50
        rows.append((i, " ".join(text)))
    row = interpolation.score(spark.createDataFrame(rows, "doc_id bigint, text string")).where("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert row[0] > 0.35 * row[1]


PAGES = [(1, "http://a.example/", "x" * 1500), (2, None, "x" * 1500), (3, "http://b.example/\r\nX: y z", "short"),
         (4, "u", "short"), (5, "u", None), (6, "u", ""), (None, "u", "x" * 1500), (None, None, None),
         (2, None, "x" * 1500), (9, "u", "é" * 700), (-5, "u", "é" * 700), (10, "u", "line\r\n\r\nWARC/1.1\r\n" * 90)]


def pages_frame(spark, rows=PAGES):
    rows = [(*r, "clash", "bytes") for r in rows]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string, payload string")


def expected(rows=PAGES):
    best = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 1000:
            best[html] = max(best.get(html, i), i)
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        to = best.get(html)
        again = i is not None and to is not None and i < to
        out.append((str(i), len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response",
                    str(to if again else None)))
    return sorted(out)


def read_rows(spark, folder):
    return sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to))
                  for r in warc.read_archives(spark, folder).collect())


@pytest.mark.parametrize("settings", [warc.Archive(), warc.Archive(shard_bytes=3000, file_bytes=300)])
def test_archives_round_trip(spark, tmp_path, settings):
    folders = [str(tmp_path / "a"), (tmp_path / "b").as_uri()]
    manifests = []
    for k, folder in enumerate(folders):
        frame = pages_frame(spark, PAGES if k else PAGES[::-1]).repartition(3)
        manifest = warc.write_archives(frame, folder, settings)
        manifests.append(sorted(tuple(r) for r in manifest.collect()))
        assert read_rows(spark, folder) == expected()
    assert manifests[0] == manifests[1]  # same names, sizes and digests whatever the order of rows
    for name, _, _, _, size, sha1 in manifests[0]:
        raw = (tmp_path / "a" / name).read_bytes()
        assert len(raw) == size and hashlib.sha1(raw).hexdigest() == sha1
        ids = []
        for headers, block in warc.records_of(io.BytesIO(raw)):
            digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
            assert headers["WARC-Block-Digest"] == f"sha1:{digest}"
            ids += [int(headers["X-Page-Id"])] if "X-Page-Id" in headers else []
        assert ids == sorted(ids)
    if settings.file_bytes < 1000:
        assert len(manifests[0]) > 3
    assert not list((tmp_path / "a" / "_temporary").iterdir())


def test_files_outside_the_manifest_do_not_count(spark, tmp_path):
    warc.write_archives(pages_frame(spark), str(tmp_path / "a"))
    (tmp_path / "a" / "pages-999999-00000.warc.gz").write_bytes(b"left behind")
    assert read_rows(spark, str(tmp_path / "a")) == expected()


def test_damage_is_noticed(spark, tmp_path):
    folder = tmp_path / "a"
    name = warc.write_archives(pages_frame(spark), str(folder)).first().file
    raw = (folder / name).read_bytes()
    members = []
    while raw:
        unpacker = zlib.decompressobj(31)
        members.append(unpacker.decompress(raw))
        raw = unpacker.unused_data
    members = [m.replace(b"short", b"shirt") for m in members]
    (folder / name).write_bytes(b"".join(
        (lambda p: p.compress(m) + p.flush())(zlib.compressobj(6, zlib.DEFLATED, 31)) for m in members))
    with pytest.raises(Exception, match="damaged"):
        warc.read_archives(spark, str(folder)).collect()


def test_shards_divide_crowded_ranges_and_ids(spark):
    rng = np.random.default_rng(2)
    mark = lambda: int(rng.integers(0, 16 ** warc.DIGITS))
    rows = [(i, mark(), 100) for i in range(1000)] + [(10**12 + i, mark(), 100) for i in range(1000)]
    rows += [(-7, mark(), 50_000)]  # one row
    rows += [(5, mark(), 1000) for _ in range(400)] + [(warc.NO_ID, mark(), 1000) for _ in range(300)]  # hot ids
    rows += [(2**63 - 1, mark(), 100), (-(2**63) + 1, 4, 100)]
    df = spark.createDataFrame(rows, "page_id bigint, mark bigint, bytes bigint").repartition(5)
    starts = warc.boundaries(df, 10_000)
    pairs = list(zip(*(x.tolist() for x in starts)))
    assert pairs == sorted(set(pairs))
    ids, marks, sizes = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    where = warc.last_not_after(*starts, ids, marks)
    assert where.tolist() == [sum(p <= r[:2] for p in pairs) for r in rows]
    volume = np.bincount(where, sizes)
    assert (np.sort(volume)[:-1] <= 10_000).all() and volume.max() == 50_000 and len(volume) < 250
    assert len(set(where[ids == 5])) >= 40 and len(set(where[ids == warc.NO_ID])) >= 30
    assert len(warc.boundaries(spark.createDataFrame([], df.schema), 10)[0]) == 0


def test_one_job_a_level(spark):
    df = spark.range(100_000).selectExpr("id * id as page_id", "id as mark", "10L as bytes").cache()
    df.count()
    spark.sparkContext.setJobGroup("levels", "")
    warc.boundaries(df, 200)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("levels"))
    spark.sparkContext.setJobGroup("after", "")
    df.unpersist()
    assert jobs <= 20  # two for each level, and the totals


def test_hot_and_missing_ids_are_spread_and_read_back(spark, tmp_path):
    rows = [(7, f"http://a/{i}", f"text {i} " * 40) for i in range(200)]
    rows += [(None, None, f"other {i} " * 40) for i in range(100)] + [(i, "http://b", "small") for i in range(10, 40)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    manifest = warc.write_archives(pages, str(tmp_path / "a"), warc.Archive(shard_bytes=20_000, revisit_bytes=100)).collect()
    assert len({r.shard for r in manifest}) > 15 and not list((tmp_path / "a" / "_temporary").iterdir())
    back = warc.read_archives(spark, str(tmp_path / "a")).collect()
    assert sorted((r.page_id or -1, r.payload_digest) for r in back) == sorted(
        (i or -1, hashlib.sha1(h.encode()).hexdigest()) for i, _, h in rows)
    assert {r.record_type for r in back} == {"response"}


def test_other_files_than_those_of_the_manifest_fail(spark, tmp_path):
    import re as r

    folder = tmp_path / "a"
    warc.write_archives(pages_frame(spark), str(folder))
    for part in (folder / "_manifest").glob("*.json"):
        part.write_text(r.sub('"sha1":"..', '"sha1":"00', part.read_text()))
        (folder / "_manifest" / f".{part.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="not the file of the manifest"):
        warc.read_archives(spark, str(folder)).collect()


def test_no_pages(spark, tmp_path):
    warc.write_archives(pages_frame(spark).limit(0), str(tmp_path / "a"))
    assert read_rows(spark, str(tmp_path / "a")) == []


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, sf, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    found, wanted = queries.QUERIES[name](spark, sf), connection.sql(queries.ORACLE[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    order = sorted(found.columns)
    at = [wanted.columns.index(c) for c in order]
    rows = sorted((tuple(r[c] for c in order) for r in found.collect()), key=repr)
    assert rows and rows == sorted((tuple(r[i] for i in at) for r in wanted.fetchall()), key=repr)


def test_every_operator_is_registered():
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_pipeline_stages_one_by_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    stage = dict(corpus_pipeline.STAGES)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    bad = {r.doc_id for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    kept = stage[names[0]](spark, docs, sf)
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - bad

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    once = stage[names[1]](spark, docs, sf)
    assert once.columns == columns
    assert sorted(str(r.doc_id) for r in once.collect()) == sorted({c for _, _, c in brute_components(rows)})

    wanted = brute_repeats(with_ties(spark, rows))
    for r in stage[names[2]](spark, docs, sf).join(docs.select("doc_id", F.col("text").alias("old")), "doc_id").collect():
        n, left = wanted[r.doc_id, r.old]
        assert r.text == (b" ".join(left).decode() if len(left) < n else r.old) and r.n_chars == len(r.text)

    hits = {r.doc_id for r in templates.contaminations(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    clean = stage[names[3]](spark, docs, sf)
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - hits

    last = stage[names[4]](spark, docs, sf)
    assert {r.doc_id: r.n_tokens for r in last.collect()} == {
        r.doc_id: r.n_tokens for r in queries.QUERIES["op10_sentencepiece"](spark, sf).collect()}


def test_pipeline_runs_whole(spark, sf):
    found = corpus_pipeline.run(spark, sf)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    n = found.count()
    assert 0 < n < spark.read.parquet(f"{sf}/documents.parquet").count()


def test_stages_on_edges(spark, edges, none, sf, tmp_path):
    folder = str(tmp_path)
    labels = [(1, 0, 0), (2, 1, 1), (6, 1, 0), (7, 0, 1), (9, 0, 0), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, PASSAGE), (None, None)], "item_id bigint, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    for docs in (edges, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, docs, folder)
            assert found.columns == edges.columns, name
            assert all(r.score == "s" and r.predicted == "x" for r in found.collect())
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()
    once = stages.drop_near_copies(spark, edges, folder).collect()
    prints = {simhash.fingerprint((r[1] or "").encode()) for r in edge_rows()}
    assert len(once) <= len(prints) and {simhash.fingerprint((r.text or "").encode()) for r in once} <= prints
