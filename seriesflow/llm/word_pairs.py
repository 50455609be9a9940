"""Modified Kneser-Ney probabilities of words after words, by language.

A text is scored with the counts of all texts of its language but itself, else the word pairs
of a text would vouch for it. The lowest order counts the different words before a word and
hands on to the character model, which knows unknown words.

Counts travel as in ``interpolation``: portions of the texts ask buckets of the hash space,
first for the counts of their word pairs, then for the statistics of their words. One portion
of those that hold a pair is its owner and counts it among the pairs of its two words. Nothing
that grows with the collection is broadcast; of each language seven numbers are.

The texts do not travel. They are read again for each step, in the same portions, and each
task reads the answers to its portions from the shared folder.
"""

from __future__ import annotations

import copy
import struct
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesflow.llm.common import different, mix, ranges, starts_of
from seriesflow.llm.interpolation import _planes, _steps, _unplanes
from seriesflow.llm.warc import file_system
from seriesflow.sources.storage import delete, new_path, qualified, store

_BEGIN, _END = np.uint64(0x243F6A8885A308D3), "\n"  # no word holds a line end
PAIR = 1  # columns of a pair: count
WORD = 5  # of a word: count as the word before, different words before it, pairs seen once, twice, more often
PORTION = 12 << 20  # bytes of text that ask together
_SLICE = 2 << 20  # bytes of text scored together
_STATS_TASK = -1
_ANSWER = "task int, chunk bigint, bucket int, payload binary, lang bigint, n1 bigint, n2 bigint, n3 bigint, n4 bigint, more bigint, total bigint"
_STATISTICS = ("n1", "n2", "n3", "n4", "more", "total")


_FRAME = 2048  # values from which on a byte plane is compressed by itself


def _pack(arrays: list[tuple[np.ndarray, str, int]]) -> bytes:
    """The arrays by byte planes: so many low planes as they are, as those of hashes are random,
    the others compressed, without the high ones that are zero."""
    squeeze, head, body, joint = zstandard.ZstdCompressor(level=1), [], [], []
    for array, kind, low in arrays:
        n, raw = len(array), _planes(array, kind)
        high = (int(array.max()).bit_length() + 7) // 8 if n else 0
        low = min(low, high)
        head.append(struct.pack("<IBB", n, low, high))
        body.append(raw[:low * n])
        if n < _FRAME:
            joint.append(raw[low * n:high * n])
            continue
        for at in range(low * n, high * n, n):
            frame = squeeze.compress(raw[at:at + n])
            body += [struct.pack("<I", len(frame)), frame]
    return b"".join([*head, *body, squeeze.compress(b"".join(joint))])


def _unpack(payload: bytes, kinds: list[str]) -> list[np.ndarray]:
    expand, at, found = zstandard.ZstdDecompressor(), 6 * len(kinds), []
    for i, kind in enumerate(kinds):
        n, low, high = struct.unpack_from("<IBB", payload, 6 * i)
        raw = [payload[at:at + low * n]]
        at += low * n
        for _ in range(high - low if n >= _FRAME else 0):
            size, = struct.unpack_from("<I", payload, at)
            raw.append(expand.decompress(payload[at + 4:at + 4 + size]))
            at += 4 + size
        found.append((n, low, high, raw))
    joint, start, out = expand.decompress(payload[at:]), 0, []
    for kind, (n, low, high, raw) in zip(kinds, found):
        if n < _FRAME:
            raw.append(joint[start:start + (high - low) * n])
            start += (high - low) * n
        out.append(_unplanes(b"".join([*raw, bytes((np.dtype(kind).itemsize - high) * n)]), n, kind))
    return out


def portions(batches) -> Iterator[tuple[int, pa.Table]]:
    """Rows of a task in portions of about PORTION bytes of text (the first column), numbered
    in the order of reading. They do not depend on how the rows are cut into batches."""
    number, waiting, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        column = batch.column(0)
        if not len(column):
            continue
        sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4))
        ends, start, before = np.cumsum(sizes.astype(np.int64) + 64), 0, 0
        while start < len(ends):
            end = min(int(np.searchsorted(ends, before + PORTION - size)) + 1, len(ends))
            waiting.append(batch.slice(start, end - start))
            size += int(ends[end - 1]) - before
            start, before = end, int(ends[end - 1])
            if size >= PORTION:
                yield number, pa.Table.from_batches(waiting)
                number, waiting, size = number + 1, [], 0
    if waiting:
        yield number, pa.Table.from_batches(waiting)


class Chunk:
    """Words and word pairs of a portion's texts (columns text, language and those to keep) as
    places in sorted different hashes."""

    def __init__(self, rows: pa.Table):
        self.texts = rows.column(0).to_pylist()
        langs = rows.column(1).to_pylist()
        self.kept = [c.combine_chunks() for c in rows.columns[2:]]
        parts, lengths = [], []
        for a, b in ranges([len(t) for t in self.texts], 1 << 20):
            flat = []
            for text in self.texts[a:b]:
                before = len(flat)
                flat += text.decode().lower().split()
                flat.append(_END)
                lengths.append(len(flat) - before)
            parts.append(pa.array(flat, pa.string()))
        del flat
        coded = pa.concat_arrays(parts).dictionary_encode()
        del parts
        self.lengths = np.array(lengths, np.int64)
        self.starts = starts_of(self.lengths)
        self.doc = np.repeat(np.arange(len(lengths), dtype=np.int32), self.lengths)
        self.forms = coded.dictionary.to_pylist()
        self.form = coded.indices.to_numpy()
        del coded
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.forms), np.uint64, len(self.forms))
        of_lang = {name: xxhash.xxh64_intdigest(name) for name in set(langs)}
        self.lang_hashes, self.lang = np.unique(np.array([of_lang[name] for name in langs], np.uint64),
                                                return_inverse=True)
        # different words of a language, then the beginnings of its texts
        n = len(self.lang_hashes)
        at, of, _ = different(self.form * np.int64(n) + self.lang[self.doc], len(self.forms) * n)
        form, lang = self.form[at], self.lang[self.doc[at]]
        self.words, place = np.unique(np.concatenate([
            mix(hashes[form] + self.lang_hashes[lang]), mix(mix(self.lang_hashes) + _BEGIN)]), return_inverse=True)
        self.word_lang = np.empty(len(self.words), np.int64)
        self.word_lang[place] = np.concatenate([lang, np.arange(n)])
        place = place.astype(np.int32)
        self.word = place[of]
        self.before = np.empty_like(self.word)
        self.before[1:] = self.word[:-1]
        self.before[self.starts] = place[len(at):][self.lang]
        del of
        keys = mix(self.words)[self.before]
        keys += self.words[self.word]
        keys = mix(keys)
        self.pair_at, self.pair, _ = different(keys)
        self.pairs = keys[self.pair_at]

    def slices(self) -> Iterator[Chunk]:
        """The chunk in ranges of texts; words and pairs are places as in the whole."""
        for a, b in ranges([len(t) for t in self.texts], _SLICE):
            part = copy.copy(self)
            begin, end = self.starts[a], self.starts[b - 1] + self.lengths[b - 1]
            for name in ("form", "word", "before", "pair"):
                setattr(part, name, getattr(self, name)[begin:end].astype(np.int64))
            part.doc = self.doc[begin:end].astype(np.int64) - a
            part.texts, part.lang, part.lengths = self.texts[a:b], self.lang[a:b], self.lengths[a:b]
            part.starts, part.kept = self.starts[a:b] - begin, [c.slice(a, b - a) for c in self.kept]
            yield part

    def pair_columns(self) -> list[np.ndarray]:
        return [np.bincount(self.pair, minlength=len(self.pairs))]

    def word_columns(self, total: np.ndarray, owned: np.ndarray) -> list[np.ndarray]:
        """What this chunk adds to the statistics of its words, by the pairs it owns."""
        n, size = np.minimum(total, 3), len(self.words)
        word, before = self.word[self.pair_at], self.before[self.pair_at]
        return [np.bincount(self.before, minlength=size), np.bincount(word[owned], minlength=size),
                *[np.bincount(before[owned & (n == k)], minlength=size) for k in (1, 2, 3)]]


def _requests(number: int, keys: np.ndarray, lang: np.ndarray, langs: np.ndarray, columns, bits: int):
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    at = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
    buckets = [b for b in range(1 << bits) if at[b] < at[b + 1]]
    payloads, random = [], (64 - len(keys).bit_length()) // 8  # bytes of the differences of keys
    for b in buckets:
        s = slice(at[b], at[b + 1])
        payloads.append(_pack([(langs, "<u8", 8), (_steps(keys[s]), "<u8", random), (lang[s], "<u4", 0),
                               *[(c[s], "<u4", 0) for c in columns]]))
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int32()), pa.array([number] * len(buckets), pa.int64()), pa.array(payloads, pa.binary())],
        names=["bucket", "chunk", "payload"])


def _answering(width: int, counted: int):
    """Sums of the ``width`` columns of each key, and for each language how many keys have
    1, 2, 3, 4, 3 or more in column ``counted``, and its sum."""

    def answered(bucket, held):
        parts = [_unpack(payload, ["<u8", "<u8", "<u4"] + ["<u4"] * width) for _, payload in held]
        keys = np.concatenate([np.cumsum(p[1], dtype=np.uint64) for p in parts])
        langs = np.concatenate([p[0][p[2]] for p in parts])
        first, place, _ = different(keys)
        owner = np.zeros(len(keys), bool)
        owner[first] = True
        sums = [np.bincount(place, np.concatenate([p[3 + i] for p in parts]), len(first)).astype(np.int64)
                for i in range(width)]
        names, of = np.unique(langs[first], return_inverse=True)
        n = sums[counted]
        rows = [np.bincount(of, n == k, len(names)) for k in (1, 2, 3, 4)] + [
            np.bincount(of, n >= 3, len(names)), np.bincount(of, n, len(names))]
        ends = np.cumsum([len(p[1]) for p in parts])
        payloads = [_pack([(keys[a:b].sum(keepdims=True), "<u8", 8), (owner[a:b], "<u1", 0),
                           *[(s[place[a:b]], "<u8", 0) for s in sums]])
                    for a, b in zip([0, *ends[:-1]], ends)]
        m, k = len(held), len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array([c >> 32 for c, _ in held] + [_STATS_TASK] * k, pa.int32()),
             pa.array([c for c, _ in held] + [-1] * k, pa.int64()), pa.array([bucket] * (m + k), pa.int32()),
             pa.array(payloads + [None] * k, pa.binary()),
             *[pa.array([None] * m + v, pa.int64()) for v in
               [names.view(np.int64).tolist(), *[r.astype(np.int64).tolist() for r in rows]]]],
            names=["task", "chunk", "bucket", "payload", "lang", *_STATISTICS])

    def run(batches):
        bucket, held = None, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if row[0] != bucket and held:
                    yield answered(bucket, held)
                    held = []
                bucket = row[0]
                held.append(row[1:])
        if held:
            yield answered(bucket, held)

    return run


def _ask(requests: DataFrame, width: int, counted: int, name: str) -> tuple[str, list]:
    """Folder of the answers, a folder for each asking task, and the statistics by language."""
    spark = requests.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = requests.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    # stored before they are dealt out, so that the requests are gone by then
    answers = store(dealt.mapInArrow(_answering(width, counted), _ANSWER), f"{name}_by_bucket")
    spread = F.when(F.col("task") == _STATS_TASK, F.col("bucket"))
    folder = new_path(spark, name)
    (answers.repartition(partitions, "task", spread).sortWithinPartitions("task", "chunk", "bucket")
     .write.partitionBy("task").parquet(folder))
    delete(answers)
    rows = spark.read.schema(answers.schema).parquet(folder).where(F.col("task") == _STATS_TASK)
    return qualified(spark, folder), rows.groupBy("lang").agg(*[F.sum(c).alias(c) for c in _STATISTICS]).collect()


def answers_to(folder: str, width: int):
    """Function that gives the owner flags and columns of a chunk's keys. Inside a task; the
    chunks are those of the task, in order."""
    from pyarrow.fs import FileSelector

    files, path = file_system(folder)
    own = f"{path}/task={TaskContext.get().partitionId()}"
    found = files.get_file_info(FileSelector(own, allow_not_found=True))

    def rows():
        for name in sorted(f.path for f in found if f.base_name.startswith("part-")):
            with files.open_input_file(name) as source:
                for batch in pq.ParquetFile(source).iter_batches(64, columns=["chunk", "payload"]):
                    yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

    by_chunk = groupby(rows(), lambda row: row[0])

    def columns(number: int, keys: np.ndarray) -> list[np.ndarray]:
        chunk, held = next(by_chunk, (None, ()))
        parts = [_unpack(payload, ["<u8", "<u1"] + ["<u8"] * width) for _, payload in held]
        sums, flags, *columns = [np.concatenate(p) for p in zip(*parts)] if parts else [np.zeros(0)] * 2
        if chunk != number or len(flags) != len(keys) or sums.sum() != keys.sum():
            raise RuntimeError("the texts were not read again in the same order; they must be stored first")
        return [flags.astype(bool), *[c.astype(np.int64) for c in columns]]

    return columns


@contextmanager
def same_portions(spark: SparkSession) -> Iterator[None]:
    """Inside, files are cut for tasks alike at each reading, however many executors there are
    at the time, and shuffle files are deleted as soon as what was asked is answered."""
    conf = {"spark.sql.files.minPartitionNum": str(spark.sparkContext.defaultParallelism),
            "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    old = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        if name != "spark.sql.files.minPartitionNum" or old[name] is None:
            spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in old.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def discounts(n: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from how many counts are 1, 2, 3 and 4."""
    if not all(n):
        return np.array([0.0, 0.5, 1.0, 1.5])  # no estimate: too few
    y = n[0] / (n[0] + 2 * n[1])
    found = [i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3)]
    return np.array([0.0] + [min(max(x, 0.01), i + 0.99) for i, x in enumerate(found)])


class Languages:
    """Discounts of pairs and of words, number of different pairs and what the words lose
    to the discounts, for each language."""

    def __init__(self, pairs, words):
        of_pairs = {r["lang"]: [int(r[c]) for c in _STATISTICS] for r in pairs}
        rows = sorted((np.int64(r["lang"]).view(np.uint64).item(), r["lang"], [int(r[c]) for c in _STATISTICS])
                      for r in words if r["total"])
        self.hashes = np.array([r[0] for r in rows], np.uint64)
        self.pair = np.array([discounts(of_pairs[r[1]][:4]) for r in rows]).reshape(-1, 4)
        self.word = np.array([discounts(r[2][:4]) for r in rows]).reshape(-1, 4)
        self.total = np.array([r[2][5] for r in rows], np.float64)
        self.lost = np.array([d[1] * r[2][0] + d[2] * r[2][1] + d[3] * r[2][4] for d, r in zip(self.word, rows)])


def log10_probabilities(chunk: Chunk, total: np.ndarray, word: list[np.ndarray], languages: Languages,
                        by_characters: np.ndarray) -> np.ndarray:
    """log10 probability of each word of the chunk after the word before it, with the counts
    of the other texts. ``by_characters`` is the log10 probability of each of its forms."""
    lang = np.searchsorted(languages.hashes, chunk.lang_hashes)[chunk.lang]  # of each text
    size, docs = len(chunk.words), len(chunk.lengths)
    first, pair_of, own = different(chunk.doc * len(chunk.pairs) + chunk.pair)
    seen = total[chunk.pair[first]]
    rest = seen - own
    gone = rest == 0
    # the lowest order: different words before a word
    at, word_of, _ = different(chunk.doc * size + chunk.word)
    kinds_all = word[1][chunk.word[at]]
    kinds = kinds_all - np.bincount(word_of[first], gone, len(at)).astype(np.int64)
    doc = chunk.doc[at]
    cut_all = languages.word[lang[doc], np.minimum(kinds_all, 3)]
    cut = languages.word[lang[doc], np.minimum(kinds, 3)]
    pairs = (languages.total[lang] - np.bincount(chunk.doc[first], gone, docs))[doc]
    lost = np.maximum(languages.lost[lang] - np.bincount(doc, cut_all - cut, docs), 0.0)[doc]
    p = 10.0 ** np.maximum(by_characters[chunk.form[at]], -290.0)
    p = np.where(pairs > 0, (np.maximum(kinds - cut, 0) + lost * p) / np.maximum(pairs, 1), p)
    # pairs
    at, before_of, here = different(chunk.doc * size + chunk.before)
    before, cuts = chunk.before[at], languages.pair[lang[chunk.doc[at]]]
    left = np.zeros(len(at))
    for k in (1, 2, 3):
        n = word[1 + k][before] - np.bincount(before_of[first], np.minimum(seen, 3) == k, len(at)) \
            + np.bincount(before_of[first], np.minimum(rest, 3) == k, len(at))
        left += cuts[:, k] * n
    context = (word[0][before] - here)[before_of]
    taken = np.maximum(rest - languages.pair[lang[chunk.doc[first]], np.minimum(rest, 3)], 0)[pair_of]
    lower = p[word_of]
    return np.log10(np.maximum(np.where(
        context > 0, (taken + left[before_of] * lower) / np.maximum(context, 1), lower), 1e-300))


def statistics(table: DataFrame) -> tuple[str, str, Languages]:
    """Folders of the answers to the pairs and to the words of the portions of ``table``
    (columns text, language), and the numbers of each language."""
    partitions = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(4, (2 * partitions - 1).bit_length())
    schema = "bucket int, chunk bigint, payload binary"

    def ask_pairs(batches):
        for number, rows in portions(batches):
            chunk = Chunk(rows)
            yield _requests(number, chunk.pairs, chunk.lang[chunk.doc[chunk.pair_at]], chunk.lang_hashes,
                            chunk.pair_columns(), bits)

    pairs, pair_counts = _ask(table.mapInArrow(ask_pairs, schema), PAIR, 0, "pairs")

    def ask_words(batches):
        answers = answers_to(pairs, PAIR)
        for number, rows in portions(batches):
            chunk = Chunk(rows)
            owned, total = answers(number, chunk.pairs)
            yield _requests(number, chunk.words, chunk.word_lang, chunk.lang_hashes,
                            chunk.word_columns(total, owned), bits)

    words, word_counts = _ask(table.mapInArrow(ask_words, schema), WORD, 1, "words")
    return pairs, words, Languages(pair_counts, word_counts)
