"""Removal of passages that occur earlier, by super-k-mers.

A window is ``size`` consecutive words. Its minimiser is the smallest hash of the
``MINI``-word sequences in it. Consecutive windows with one minimiser travel as one packed
string (a super-k-mer) to the minimiser's bucket, where the windows are sorted and equal
ones counted. Equal windows share their minimiser, so each bucket decides for itself.

Hot minimisers: super-k-mers that are equal within a slice of the input are sent once, the
later ones being repeats in any case; minimisers that a sample shows in a large share of the
documents are replaced by the hash of the whole window, so that their windows spread over
all buckets. The sample decides only where windows travel, never the result.
"""

from __future__ import annotations

import hashlib
import struct
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from seriesflow.llm.common import mix, numbered, ranges, share, small_batches, starts_of

MINI = 3
LONGEST = 2048  # windows of one super-k-mer
SLICE = 4 << 20  # bytes of text whose super-k-mers are packed together
SAMPLE_DOCS = 10_000
HOT_SHARE = 0.005  # of the sampled documents
LAST_ID = 2**63 - 1  # stands for a null doc_id, after all others
_SPANS = "id bigint, tie bigint, start int, n int"


def _identified(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """id and tie: rows equal in both are one document. Null ids come last."""
    return docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST_ID)).alias("id"),
                       F.coalesce(F.xxhash64(F.col(text).cast("string")), F.lit(0)).alias("tie"),
                       F.col(text).cast("string").cast("binary").alias("text"))


def super_kmers(lengths: np.ndarray, word_hash: np.ndarray, size: int, hot: np.ndarray):
    """First word, number of windows and minimiser of each super-k-mer of the texts.

    Texts lie end to end with ``lengths`` words each. Windows whose minimiser is hot are
    cut off one by one and have the hash of the window as minimiser.
    """
    none = np.zeros(0, np.int64)
    if len(word_hash) < size:
        return none, none, np.zeros(0, np.uint64)
    mini = min(MINI, size)
    gram = mix(word_hash)
    for i in range(1, mini):
        gram = gram[:-1]
        gram = mix(gram + word_hash[i:len(gram) + i])
    # smallest of the size - mini + 1 sequences of a window, by doubling
    width, low = 1, gram
    want = size - mini + 1
    while width * 2 <= want:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < want:
        low = np.minimum(low[:len(low) - (want - width)], low[want - width:])
    n = len(word_hash) - size + 1
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.flatnonzero(text_of[:n] == text_of[size - 1:])
    if not len(inside):
        return none, none, np.zeros(0, np.uint64)
    value = low[inside]
    begin = np.ones(len(inside), bool)
    begin[1:] = (value[1:] != value[:-1]) | (inside[1:] != inside[:-1] + 1)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, value), len(hot) - 1)
        is_hot = hot[at] == value
        begin |= is_hot
    first = np.flatnonzero(begin)
    sizes = np.diff(np.append(first, len(inside)))
    long = sizes > LONGEST
    if long.any():
        extra = np.concatenate([np.arange(f, f + s, LONGEST) for f, s in zip(first[long], sizes[long])])
        first = np.unique(np.concatenate([first, extra]))
        sizes = np.diff(np.append(first, len(inside)))
    minimiser = value[first]
    if len(hot) and is_hot[first].any():
        which = np.flatnonzero(is_hot[first])
        whole = np.zeros(len(which), np.uint64)
        for i in range(size):
            whole = mix(whole + word_hash[inside[first[which]] + i])
        minimiser[which] = whole
    return inside[first], sizes, minimiser


def _slices_of(batches):
    """Documents of about SLICE bytes: ids, ties and lists of words, sorted by document."""
    for batch in batches:
        texts = batch.column(2)
        if not len(texts):
            continue
        sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4))
        ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for a, b in ranges(sizes, SLICE):
            order = np.lexsort((ties[a:b], ids[a:b]))
            words = [(t or b"").split() for t in texts.slice(a, b - a).to_pylist()]
            yield ids[a:b][order], ties[a:b][order], [words[i] for i in order]


def _kmers_of(words: list[list[bytes]], size: int, hot: np.ndarray):
    lengths = np.array([len(w) for w in words], np.int64)
    flat = [w for text in words for w in text]
    numbers, hashes = numbered(flat)
    first, sizes, minimiser = super_kmers(lengths, hashes[numbers], size, hot)
    text_of = np.repeat(np.arange(len(lengths)), lengths)[first] if len(first) else first
    return flat, text_of, first - starts_of(lengths)[text_of] if len(first) else first, first, sizes, minimiser


def pack(ids, ties, starts, sizes, contents: list[bytes]) -> bytes:
    head = struct.pack("<q", len(contents)) + b"".join(
        np.asarray(x, kind).tobytes() for x, kind in ((ids, "<i8"), (ties, "<i8"), (starts, "<i4"), (sizes, "<i4")))
    return zstandard.ZstdCompressor(level=5).compress(head + b"\n".join(contents))


def unpack(payload: bytes):
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n = struct.unpack_from("<q", raw)[0]
    at, arrays = 8, []
    for kind, width in (("<i8", 8), ("<i8", 8), ("<i4", 4), ("<i4", 4)):
        arrays.append(np.frombuffer(raw, kind, n, at))
        at += n * width
    return (*arrays, raw[at:].split(b"\n") if n else [])


def find_repeats(ids, ties, starts, sizes, contents: list[bytes], size: int):
    """Spans (id, tie, first window, windows) of windows of super-k-mers that start earlier.

    Windows are put in the order of documents and places, then sorted by a hash of their
    words, equal hashes in that order; a window is a repeat of the first of its hash after
    all words are compared. Windows that share a hash only are sorted out by their words.
    """
    order = np.lexsort((starts, ties, ids))
    ids, ties, starts, sizes = ids[order], ties[order], starts[order].astype(np.int64), sizes[order].astype(np.int64)
    lengths = sizes + size - 1
    numbers, hashes = numbered(b" ".join([contents[i] for i in order]).split(b" "))
    value = hashes[numbers]
    # polynomial hash of a window, by doubling
    base = np.uint64(0x9E3779B97F4A7C15)
    width, window = 1, mix(value)
    parts = []
    left = size
    while True:
        if left & width:
            parts.append((width, window))
        if width * 2 > size:
            break
        window = window[:-width] * _power(base, width) + window[width:]
        width *= 2
    total, at = None, 0
    for w, part in reversed(parts):
        total = part if total is None else total[:len(part) - at] * _power(base, w) + part[at:at + len(total)]
        at += w
    run = np.repeat(np.arange(len(sizes)), sizes)
    offset = np.arange(len(run)) - np.repeat(starts_of(sizes), sizes)
    place = starts_of(lengths)[run] + offset  # of the window's first word
    key = total[place]
    by = np.argsort(key, kind="stable")
    ordered = key[by]
    head = np.ones(len(by), bool)
    head[1:] = ordered[1:] != ordered[:-1]
    leader = by[np.maximum.accumulate(np.where(head, np.arange(len(by)), 0))]
    pair = np.flatnonzero(~head)
    mine, first = by[pair], leader[pair]
    same = np.ones(len(mine), bool)
    for i in range(size):
        same &= numbers[place[mine] + i] == numbers[place[first] + i]
    if not same.all():
        for group in np.unique(first[~same]).tolist():
            seen: dict[tuple, int] = {}
            for k in [group, *sorted(mine[first == group].tolist())]:
                words = tuple(numbers[place[k]:place[k] + size].tolist())
                at = seen.setdefault(words, k)
                if at != k:
                    first[mine == k], same[mine == k] = at, True
    mine, first = mine[same], first[same]
    position = starts[run] + offset
    itself = (ids[run[mine]] == ids[run[first]]) & (ties[run[mine]] == ties[run[first]]) \
        & (position[mine] == position[first])
    mine = np.sort(mine[~itself])
    return _spans(ids[run[mine]], ties[run[mine]], position[mine])


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 2**64))


def _spans(ids, ties, position):
    """Runs of consecutive windows of one document."""
    return _joined(ids, ties, position, np.ones(len(position), np.int64))


def _joined(ids, ties, starts, sizes):
    """Spans in order, those that follow each other without a gap made one."""
    if not len(ids):
        return ids, ties, starts, sizes
    begin = np.ones(len(ids), bool)
    begin[1:] = (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1]) | (starts[1:] != starts[:-1] + sizes[:-1])
    first = np.flatnonzero(begin)
    return ids[first], ties[first], starts[first], np.add.reduceat(sizes, first)


def _span_batch(ids, ties, starts, sizes):
    return [pa.array(np.asarray(ids, np.int64)), pa.array(np.asarray(ties, np.int64)),
            pa.array(np.asarray(starts, np.int32)), pa.array(np.asarray(sizes, np.int32))]


def repeat_spans(docs: DataFrame, size: int = 20, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (id, tie, start, n): n windows from word ``start`` on occur earlier."""
    small_batches(docs)
    spark = docs.sparkSession
    source = _identified(docs, text, doc_id)
    hot = hot_minimisers(source, size)
    buckets = 6 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = share(docs, hot)

    def cut(batches):
        own = shared()
        for ids, ties, words in _slices_of(batches):
            flat, text_of, start, first, sizes, minimiser = _kmers_of(words, size, own)
            if not len(first):
                continue
            joined = b" ".join(flat)
            ends = np.cumsum([len(w) + 1 for w in flat]) - 1
            begins = np.append(0, ends[:-1] + 1)
            contents = [joined[a:b] for a, b in zip(begins[first].tolist(), ends[first + sizes + size - 2].tolist())]
            earliest: dict[bytes, int] = {}
            kept = np.fromiter(map(earliest.setdefault, contents, count()), np.int64, len(contents))
            again = np.flatnonzero(kept != np.arange(len(kept)))
            other = kept[again]
            again = again[(ids[text_of[again]] != ids[text_of[other]]) | (ties[text_of[again]] != ties[text_of[other]])
                          | (start[again] != start[other])]
            if len(again):  # decided: dealt out by document
                spans = _joined(ids[text_of[again]], ties[text_of[again]], start[again], sizes[again])
                yield pa.RecordBatch.from_arrays(
                    [pa.array((mix(spans[0].view(np.uint64)) % np.uint64(buckets)).astype(np.int32)),
                     pa.nulls(len(spans[0]), pa.binary()), *_span_batch(*spans)],
                    names=["bucket", "payload", "id", "tie", "start", "n"])
            sent = np.flatnonzero(kept == np.arange(len(kept)))
            bucket = (minimiser[sent] % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            sent, bucket = sent[by], bucket[by]
            groups = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            payloads = []
            for a, b in zip(groups, np.append(groups[1:], len(sent))):
                some = sent[a:b]
                payloads.append(pack(ids[text_of[some]], ties[text_of[some]], start[some], sizes[some],
                                     [contents[i] for i in some.tolist()]))
            empty = pa.nulls(len(groups), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[groups].astype(np.int32)), pa.array(payloads, pa.binary()), empty, empty,
                 empty.cast(pa.int32()), empty.cast(pa.int32())],
                names=["bucket", "payload", "id", "tie", "start", "n"])

    def decide(batches):
        names = ["id", "tie", "start", "n"]
        bucket, held = None, []
        for batch in batches:
            known = batch.column(1).is_null()
            spans = batch.filter(known)
            if len(spans):
                yield pa.RecordBatch.from_arrays([spans.column(i) for i in range(2, 6)], names=names)
            rest = batch.filter(pa.compute.invert(known))
            for b, payload in zip(rest.column(0).to_pylist(), rest.column(1).to_pylist()):
                if b != bucket and held:
                    yield pa.RecordBatch.from_arrays(_span_batch(*_decided(held, size)), names=names)
                    held = []
                bucket = b
                held.append(payload)
        if held:
            yield pa.RecordBatch.from_arrays(_span_batch(*_decided(held, size)), names=names)

    packed = source.mapInArrow(cut, f"bucket int, payload binary, {_SPANS}")
    dealt = packed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "bucket")
    return dealt.sortWithinPartitions("bucket").mapInArrow(decide, _SPANS)


def _decided(payloads: list[bytes], size: int):
    parts = [unpack(p) for p in payloads]
    arrays = [np.concatenate([p[i] for p in parts]) for i in range(4)]
    return find_repeats(*arrays, [c for p in parts for c in p[4]], size)


def hot_minimisers(source: DataFrame, size: int) -> np.ndarray:
    """Sorted minimisers that HOT_SHARE of the documents of a sample contain (at most
    some hundred per document of that share, so a bounded array)."""
    total = source.count()
    sample = source if total <= SAMPLE_DOCS // 10 else source.sample(min(1.0, SAMPLE_DOCS / total), 5)
    none = np.zeros(0, np.uint64)

    def run(batches):
        for _, _, words in _slices_of(batches):
            _, text_of, _, first, sizes, minimiser = _kmers_of(words, size, none)
            pairs = np.unique(np.stack([minimiser, text_of.astype(np.uint64)]), axis=1)
            value, docs = np.unique(pairs[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(docs.astype(np.int64))],
                                             names=["m", "docs"])

    least = max(20, HOT_SHARE * min(total, SAMPLE_DOCS))
    found = sample.mapInArrow(run, "m bigint, docs bigint").groupBy("m").agg(F.sum("docs").alias("docs"))
    values = [r.m for r in found.where(F.col("docs") >= least).select("m").collect()]
    return np.sort(np.array(values, np.int64).view(np.uint64))


def remove_repeats(docs: DataFrame, size: int = 20, keep: list[str] | None = None, text: str = "text",
                   doc_id: str = "doc_id", digest: bool = False) -> DataFrame:
    """Every row without the words that lie in a window occurring earlier.

    Beside columns ``keep``: ``n_words``, ``n_removed`` and ``kept_text`` (the words left,
    joined by one space), or with ``digest`` its SHA-256 as ``kept_sha256``. Earlier means a
    smaller doc_id, or the same document and an earlier word; a null doc_id comes after all
    others, rows of one doc_id with different texts are ordered by a hash of the text, and
    rows equal in doc_id and text are one document: each is returned, alike. Windows are
    judged on the input. Null texts have no words. An input column named like a new one is
    replaced.
    """
    new = "kept_sha256" if digest else "kept_text"
    keep = [c for c in ([doc_id] if keep is None else keep) if c not in ("n_words", "n_removed", new)]
    spans = repeat_spans(docs, size, text, doc_id)
    spans = spans.groupBy("id", "tie").agg(
        F.collect_list("start").alias("starts_"), F.collect_list("n").alias("sizes_"))
    # the text travels once, also where it is kept
    own_text = [text] if docs.schema[text].dataType == T.StringType() else []
    named = docs.select(
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST_ID)).alias("id_"),
        F.coalesce(F.xxhash64(F.col(text).cast("string")), F.lit(0)).alias("tie_"),
        F.col(text).cast("string").alias("text_"),
        *[F.col(c).alias(f"kept{i}_") for i, c in enumerate(keep) if c not in own_text])
    joined = named.join(spans.withColumnsRenamed({"id": "id_", "tie": "tie_"}), ["id_", "tie_"], "left")
    types = [docs.schema[c].dataType for c in keep]
    schema = T.StructType([T.StructField(c, t) for c, t in zip(keep, types)] + [
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField(new, T.StringType())])
    places = ["text_" if c in own_text else f"kept{i}_" for i, c in enumerate(keep)]
    columns = ["text_", "starts_", "sizes_", *dict.fromkeys(c for c in places if c != "text_")]

    def parts_of(batches):
        for batch in batches:
            texts = batch.column(0)
            if len(texts):
                sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4))
                for a, b in ranges(sizes, SLICE):
                    yield batch.slice(a, b - a)

    def run(batches):
        for batch in parts_of(batches):
            n_words, n_removed, left = [], [], []
            for raw, starts, sizes in zip(batch.column(0), batch.column(1), batch.column(2)):
                words = (raw.as_py() or "").encode().split()
                n_words.append(len(words))
                if starts.is_valid and len(starts):
                    edge = np.zeros(len(words) + 1, np.int64)
                    first, n = starts.values.to_numpy(), sizes.values.to_numpy()
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + n + size - 1, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    n_removed.append(int(gone.sum()))
                    words = [words[i] for i in np.flatnonzero(~gone).tolist()]
                else:
                    n_removed.append(0)
                joined_words = b" ".join(words)
                left.append(hashlib.sha256(joined_words).hexdigest() if digest else joined_words.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(columns.index(c)) for c in places]
                + [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(left, pa.string())],
                names=[*keep, "n_words", "n_removed", new])

    return joined.select(*columns).mapInArrow(run, schema)
