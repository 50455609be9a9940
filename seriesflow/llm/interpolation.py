"""A word bigram model by deleted interpolation.

The probability of a token is a mixture of three estimates: its relative frequency after the
word before it, its relative frequency, and a uniform share. The weights depend on how often
the word before it was seen (a bucket for each power of two) and are learned by
expectation-maximisation on held-out counts: one tenth of the training texts is scored with
the counts of the others.

Counts travel in packed form. Texts are gathered into chunks, written once to the shared
folder. A chunk asks for each of its different words and word pairs once: their 64-bit hashes
go, sorted and compressed, to the buckets of the hash space, with the chunk's own training
counts. A bucket adds these up over all chunks and answers each chunk in its own order. A
frequent word costs one entry per chunk, so no bucket is hot, and nothing that grows with
the collection is broadcast or held on the driver.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from seriesflow.llm.common import crc_mod, mix, numbered, ranges, share, small_batches, starts_of
from seriesflow.sources.storage import store

CHUNK = 4 << 20  # bytes of text
FOLDS, HELD_OUT, DELETED = 10, 0, 1  # remainders of the id's crc32: never learned from, weights
_BEGIN, _END = np.uint64(0x243F6A8885A308D3), b"\n"  # no word holds a line end
BUCKETS = 40  # context frequencies: unseen, 1, 2-3, 4-7, ...
_STEPS = 4  # of a power of two, in which estimates are told apart for the weights
_UNSEEN = -10_000
ROUNDS = 60
ADDED = 0.1


@dataclass(frozen=True)
class Totals:
    """Training tokens, those of the deleted fold, and different training tokens."""

    tokens: int
    deleted: int
    words: int


def _planes(values: np.ndarray, kind: str) -> bytes:
    """Bytes of the values, first bytes first, so that small numbers compress."""
    width = np.dtype(kind).itemsize
    return values.astype(kind).view(np.uint8).reshape(-1, width).T.tobytes()


def _unplanes(raw: bytes, n: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width).reshape(width, n).T).view(kind).ravel()


def _pack(arrays: list[tuple[np.ndarray, str]]) -> bytes:
    head = struct.pack(f"<{len(arrays)}q", *[len(a) for a, _ in arrays])
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(_planes(a, k) for a, k in arrays))


def _unpack(payload: bytes, kinds: list[str]) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    sizes, at, out = struct.unpack_from(f"<{len(kinds)}q", raw), 8 * len(kinds), []
    for n, kind in zip(sizes, kinds):
        width = np.dtype(kind).itemsize
        out.append(_unplanes(raw[at:at + n * width], n, kind))
        at += n * width
    return out


def _steps(keys: np.ndarray) -> np.ndarray:
    """Differences of sorted keys."""
    return np.diff(keys, prepend=np.zeros(1, np.uint64))


def chunks(docs: DataFrame, keep: list[str], text: str, doc_id: str) -> DataFrame:
    """Rows (chunk, deleted, payload): texts of about CHUNK bytes with columns ``keep``, as an
    Arrow stream; texts of the deleted fold have chunks of their own."""
    fold = crc_mod(F.col(doc_id), FOLDS).cast("int")
    small_batches(docs)
    source = docs.select(F.coalesce(F.col(text).cast("string").cast("binary"), F.lit("").cast("binary")).alias("text_"),
                         fold.alias("fold_"), *[F.col(c).alias(f"kept{i}_") for i, c in enumerate(keep)])

    def gather(batches):
        number = TaskContext.get().partitionId() << 32
        waiting = {False: [0, []], True: [0, []]}

        def row(deleted):
            nonlocal number
            parts = waiting[deleted][1]
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for part in parts:
                    out.write_batch(part)
            waiting[deleted] = [0, []]
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([deleted]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                names=["chunk", "deleted", "payload"])

        for batch in batches:
            column = batch.column(0)
            if not len(column):
                continue
            sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4))
            for a, b in ranges(sizes, CHUNK // 4):
                piece = batch.slice(a, b - a)
                is_deleted = np.asarray(piece.column(1)) == DELETED
                for deleted in (False, True):
                    some = piece.take(pa.array(np.flatnonzero(is_deleted == deleted)))
                    if len(some):
                        waiting[deleted][0] += some.column(0).nbytes
                        waiting[deleted][1].append(some)
                        if waiting[deleted][0] >= CHUNK:
                            yield row(deleted)
        for deleted in (False, True):
            if waiting[deleted][1]:
                yield row(deleted)

    return source.mapInArrow(gather, "chunk bigint, deleted boolean, payload binary")


class Chunk:
    """Tokens of a chunk: their words and word pairs as places in sorted different hashes."""

    def __init__(self, payload: bytes):
        with pa.ipc.open_stream(payload) as reader:
            rows = reader.read_all()
        self.fold = np.asarray(rows.column(1))
        self.kept = [c.combine_chunks() for c in rows.columns[2:]]
        flat, lengths = [], []
        for text in rows.column(0):
            before = len(flat)
            flat += text.as_py().lower().split()
            flat.append(_END)
            lengths.append(len(flat) - before)
        del rows
        self.lengths = np.array(lengths, np.int64)
        self.starts = starts_of(self.lengths)
        numbers, hashes = numbered(flat)
        del flat
        value = hashes[numbers]
        del numbers, hashes
        before = np.empty_like(value)
        before[1:] = value[:-1]
        before[self.starts] = _BEGIN
        self.first = np.zeros(len(value), bool)
        self.first[self.starts] = True
        self.words, self.word = np.unique(value, return_inverse=True)
        self.pairs, self.pair = np.unique(mix(mix(before) + value), return_inverse=True)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each word and each pair occurs in the chunk's training texts."""
        train = np.repeat(self.fold != HELD_OUT, self.lengths)
        return (np.bincount(self.word[train], minlength=len(self.words)),
                np.bincount(self.pair[train], minlength=len(self.pairs)))


def _requests(chunk_rows: DataFrame, bits: int) -> DataFrame:
    """Rows (bucket, chunk, deleted, payload): a chunk's hashes in each bucket and its counts."""

    def ask(batches):
        for batch in batches:
            for number, deleted, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                chunk = Chunk(payload)
                word_counts, pair_counts = chunk.counts()
                edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
                word_at = np.concatenate([[0], np.searchsorted(chunk.words, edges), [len(chunk.words)]])
                pair_at = np.concatenate([[0], np.searchsorted(chunk.pairs, edges), [len(chunk.pairs)]])
                buckets, payloads = [], []
                for b in range(1 << bits):
                    w, p = slice(word_at[b], word_at[b + 1]), slice(pair_at[b], pair_at[b + 1])
                    if w.start < w.stop or p.start < p.stop:
                        buckets.append(b)
                        payloads.append(_pack([(_steps(chunk.words[w]), "<u8"), (word_counts[w], "<u4"),
                                               (_steps(chunk.pairs[p]), "<u8"), (pair_counts[p], "<u4")]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets, pa.int32()), pa.array([number] * len(buckets), pa.int64()),
                     pa.array([deleted] * len(buckets)), pa.array(payloads, pa.binary())],
                    names=["bucket", "chunk", "deleted", "payload"])

    return chunk_rows.mapInArrow(ask, "bucket int, chunk bigint, deleted boolean, payload binary")


_ANSWER = "chunk bigint, bucket int, payload binary, tokens bigint, deleted bigint, words bigint"


def _answer(batches):
    """Add up the counts of each bucket and answer every chunk; one row more has totals."""
    bucket, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if row[0] != bucket and held:
                yield _answered(bucket, held)
                held = []
            bucket = row[0]
            held.append(row[1:])
    if held:
        yield _answered(bucket, held)


def _answered(bucket, held):
    kinds = ["<u8", "<u4", "<u8", "<u4"]
    parts = [_unpack(payload, kinds) for _, _, payload in held]
    answers = []
    for at in (0, 2):
        keys = np.concatenate([np.cumsum(p[at], dtype=np.uint64) for p in parts])
        counts = np.concatenate([p[at + 1] for p in parts]).astype(np.float64)
        deleted = np.repeat([d for _, d, _ in held], [len(p[at]) for p in parts])
        different, place = np.unique(keys, return_inverse=True)
        total = np.bincount(place, counts, len(different)).astype(np.int64)
        aside = np.bincount(place, counts * deleted, len(different)).astype(np.int64)
        if at == 0:
            sums = int(total.sum()), int(aside.sum()), int((total > 0).sum())
        ends = np.cumsum([len(p[at]) for p in parts])[:-1]
        answers.append((np.split(total[place], ends), np.split(aside[place], ends)))
    (words, words_aside), (pairs, pairs_aside) = answers
    payloads = [_pack([(words[i], "<u8"), (words_aside[i], "<u8"), (pairs[i], "<u8"), (pairs_aside[i], "<u8")])
                for i in range(len(held))]
    n = len(held)
    return pa.RecordBatch.from_arrays(
        [pa.array([c for c, _, _ in held] + [-1], pa.int64()), pa.array([bucket] * (n + 1), pa.int32()),
         pa.array(payloads + [None], pa.binary()), *[pa.array([None] * n + [s], pa.int64()) for s in sums]],
        names=["chunk", "bucket", "payload", "tokens", "deleted", "words"])


def _answers_of(answers) -> list[np.ndarray]:
    """Counts of a chunk's words and pairs, all and deleted, from its answers by bucket."""
    parts = [_unpack(a["payload"], ["<u8"] * 4) for a in sorted(answers, key=lambda a: a["bucket"])]
    return [np.concatenate([p[i] for p in parts]).astype(np.int64) for i in range(4)]


def _estimates(chunk: Chunk, word: np.ndarray, pair: np.ndarray, begins: int, tokens: int):
    """Context bucket, pair estimate and word estimate of each token."""
    own = word[chunk.word]
    before = np.empty(len(own), np.int64)
    before[1:] = own[:-1]
    before[chunk.first] = begins
    bucket = np.where(before > 0, np.minimum(np.log2(np.maximum(before, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)
    return bucket, pair[chunk.pair] / np.maximum(before, 1), own / max(tokens, 1)


def learn_weights(histogram: list[tuple[int, int, int, int]], words: int) -> np.ndarray:
    """Weights (bucket x pair, word, uniform) from counts of quantised held-out estimates.

    Expectation-maximisation in each bucket. A bucket without held-out tokens takes the
    weights of the nearest lower one; bucket 0, contexts never seen, has no pair estimate.
    """
    weights = np.full((BUCKETS, 3), np.nan)
    uniform = 1.0 / (words + 1)
    rows = np.array(histogram, np.int64).reshape(-1, 4)
    for b in range(BUCKETS):
        some = rows[rows[:, 0] == b]
        if not len(some):
            continue
        p = np.stack([np.where(some[:, i] == _UNSEEN, 0.0, np.exp2(np.maximum(some[:, i], -2000) / _STEPS))
                      for i in (1, 2)] + [np.full(len(some), uniform)], axis=1)
        n = some[:, 3].astype(np.float64)
        w = np.array([0.0, 0.6, 0.4]) if b == 0 else np.array([0.4, 0.4, 0.2])
        for _ in range(ROUNDS):
            joint = p * w
            w = (joint / joint.sum(axis=1, keepdims=True) * n[:, None]).sum(axis=0) / n.sum()
        w = np.maximum(w, [0.0 if b == 0 else 1e-6, 1e-6, 1e-6])
        weights[b] = w / w.sum()
    last = np.array([0.0, 0.6, 0.4])
    for b in range(BUCKETS):
        if np.isnan(weights[b, 0]):
            weights[b] = last if b == 0 or last[0] else [0.2, 0.5, 0.3]
        last = weights[b]
    return weights


def score(docs: DataFrame, keep: list[str] | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Scores of every text under models learned from all of them but the held-out fold.

    Beside columns ``keep``: held_out (crc32 of doc_id as text modulo 10 is 0), n_tokens
    (words and one end), n_known (tokens seen in training), train_tokens, base_score (log10
    under added-0.1 word frequencies) and score (log10 under the interpolated model). One row
    per input row in no given order, repeated rows included; a null doc_id counts as empty
    text in the crc; null texts are empty and have the end alone. With nothing to learn from
    all scores are those of the uniform share. An input column named like a new one is
    replaced.
    """
    new = [("held_out", T.BooleanType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()),
           ("train_tokens", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType())]
    names = [n for n, _ in new]
    keep = [c for c in ([doc_id] if keep is None else keep) if c not in names]
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(4, (2 * partitions - 1).bit_length())
    table = store(chunks(docs, keep, text, doc_id), "chunks")
    dealt = _requests(table, bits).repartition(partitions, "bucket").sortWithinPartitions("bucket")
    answers = store(dealt.mapInArrow(_answer, _ANSWER), "answers")
    sums = answers.where("chunk = -1").agg(F.sum("tokens"), F.sum("deleted"), F.sum("words")).first()
    totals = Totals(*(int(s or 0) for s in sums))
    begins = docs.select(crc_mod(F.col(doc_id), FOLDS).alias("f")).agg(
        F.count_if(F.col("f") != HELD_OUT), F.count_if(F.col("f") == DELETED)).first()
    by_chunk = answers.where("chunk >= 0").groupBy("chunk").agg(
        F.collect_list(F.struct("bucket", "payload")).alias("answers"))
    joined = table.join(by_chunk, "chunk").select("payload", "answers", "deleted")

    def held_out_counts(batches):
        for batch in batches:
            seen: dict[tuple, int] = {}
            for payload, answer in zip(batch.column(0), batch.column(1)):
                chunk = Chunk(payload.as_py())
                word, word_aside, pair, pair_aside = _answers_of(answer.as_py())
                bucket, p2, p1 = _estimates(chunk, word - word_aside, pair - pair_aside,
                                            begins[0] - begins[1], totals.tokens - totals.deleted)
                places = [np.where(p > 0, np.round(_STEPS * np.log2(np.maximum(p, 1e-300))), _UNSEEN).astype(np.int64)
                          for p in (p2, p1)]
                rows, n = np.unique(np.stack([bucket, *places], axis=1), axis=0, return_counts=True)
                for row, k in zip(map(tuple, rows.tolist()), n.tolist()):
                    seen[row] = seen.get(row, 0) + k
            columns = list(zip(*[(*row, n) for row, n in seen.items()])) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=list("bpwn"))

    histogram = (joined.where("deleted").mapInArrow(held_out_counts, "b bigint, p bigint, w bigint, n bigint")
                 .groupBy("b", "p", "w").agg(F.sum("n").alias("n")).collect())  # bounded by the steps
    weights = learn_weights([tuple(r) for r in histogram], totals.words)
    shared = share(docs, weights if totals.tokens else np.tile([0.0, 0.0, 1.0], (BUCKETS, 1)))
    types = [docs.schema[c].dataType for c in keep]
    schema = T.StructType([T.StructField(c, t) for c, t in zip(keep, types)] + [T.StructField(n, t) for n, t in new])
    base_total = np.log10(totals.tokens + ADDED * (totals.words + 1))

    def scored(batches):
        weights = shared()
        for batch in batches:
            for payload, answer in zip(batch.column(0), batch.column(1)):
                chunk = Chunk(payload.as_py())
                word, _, pair, _ = _answers_of(answer.as_py())
                bucket, p2, p1 = _estimates(chunk, word, pair, begins[0], totals.tokens)
                w = weights[bucket]
                own = np.log10(w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (totals.words + 1))
                count = word[chunk.word]
                base = np.log10(count + ADDED) - base_total
                yield pa.RecordBatch.from_arrays(
                    chunk.kept
                    + [pa.array(chunk.fold == HELD_OUT), pa.array(chunk.lengths),
                       pa.array(np.add.reduceat((count > 0).astype(np.int64), chunk.starts)),
                       pa.array(np.full(len(chunk.lengths), totals.tokens, np.int64)),
                       pa.array(np.add.reduceat(base, chunk.starts)),
                       pa.array(np.add.reduceat(own, chunk.starts))],
                    names=[*keep, *names])

    return joined.mapInArrow(scored, schema)
