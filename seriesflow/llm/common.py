"""Helpers of the text operators: rows through Arrow, words, integer mixing."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

SLICE_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
_BATCH, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def share(df: DataFrame, value):
    """Broadcast a value of bounded size; the function returned gives it inside a task."""
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(shared.value)


def small_batches(df: DataFrame) -> None:
    """Let Spark hand over about BATCH_BYTES to Python at a time, unless the session says
    otherwise: at its default of 64 MB the copies of long texts fill the memory."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH, _DEFAULT) == _DEFAULT:
        conf.set(_BATCH, str(BATCH_BYTES))


def crc_mod(column: Column, n: int) -> Column:
    """crc32 of the value as text, modulo n; null ids count as empty text."""
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % n


def parts(items: Iterable, n: int) -> Iterator[list]:
    """Lists of up to n items each."""
    rest = iter(items)
    while part := list(islice(rest, n)):
        yield part


def add_columns(df: DataFrame, make: Callable, fields: list[tuple[str, T.DataType]],
                keep: list[str], text: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """Columns ``keep`` of df and the columns that a function finds for each text.

    ``make()`` is called once per task and returns the function; this takes a list of
    texts (bytes, None for null) and returns one sequence per field. Columns of ``keep``
    whose name is a new field's are replaced by it. No shuffle; a slice of about
    ``limit`` bytes of text, or one longer text, is worked on at a time.
    """
    small_batches(df)
    names = [name for name, _ in fields]
    keep = [c for c in keep if c not in names]
    types = [df.schema[c].dataType for c in keep]
    # a kept text travels once
    again = [c == text and t == T.StringType() for c, t in zip(keep, types)]
    source = df.select(F.col(text).cast("string").alias("0text"),
                       *[F.col(c).alias(f"{i}keep") for i, c in enumerate(keep) if not again[i]])
    places = [0 if a else 1 + sum(not b for b in again[:i]) for i, a in enumerate(again)]
    schema = T.StructType(
        [T.StructField(c, t) for c, t in zip(keep, types)]
        + [T.StructField(c, t) for c, t in fields])
    kinds = [arrow_type(t) for _, t in fields]

    def run(batches):
        work = make()
        for batch in batches:
            texts = batch.column(0)
            rest = [batch.column(i) for i in places]
            lengths = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1,
                                            texts.offset * 4)) if len(texts) else []
            for a, b in ranges(lengths, limit):
                found = work(texts.slice(a, b - a).cast(pa.binary()).to_pylist())
                new = [pa.array(v, kind) for v, kind in zip(found, kinds)]
                yield pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in rest] + new,
                                                 names=[*keep, *names])

    return source.mapInArrow(run, schema)


def ranges(lengths: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose lengths sum to about ``limit``."""
    ends = np.cumsum(np.asarray(lengths, np.int64) + 64)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield start, end
        start = end


def arrow_type(kind: T.DataType) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(),
            "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(),
            "array<double>": pa.list_(pa.float64()),
            "array<bigint>": pa.list_(pa.int64())}[kind.simpleString()]


def mix(values: np.ndarray) -> np.ndarray:
    """One-to-one mixing of 64-bit integers (the finaliser known as splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def numbered(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, equal for equal words, and the hash of each number's word."""
    numbers: dict[bytes, int] = {}
    flat = np.fromiter(map(numbers.setdefault, words, count()), np.int64, len(words))
    places = np.fromiter(numbers.values(), np.int64, len(numbers))
    hashes = np.zeros(len(words), np.uint64)
    hashes[places] = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
    return flat, hashes


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """First positions of segments of the given lengths laid end to end."""
    starts = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=starts[1:])
    return starts


def within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... inside each segment."""
    total = int(np.sum(lengths))
    return np.arange(total) - np.repeat(starts_of(np.asarray(lengths)), lengths)


def different(keys: np.ndarray, size: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A position of each different key, in ascending order of the keys, the place of each key
    among them and how often each occurs. Keys below a ``size`` that is given and not far more
    than there are keys are told apart by a table, others by sorting."""
    if size is not None and size <= 8 * len(keys):
        at = np.full(size, -1, np.int32)
        at[keys] = np.arange(len(keys), dtype=np.int32)
        seen = np.flatnonzero(at >= 0)
        first = at[seen]
        at[seen] = np.arange(len(seen), dtype=np.int32)
        place = at[keys]
        return first, place, np.bincount(place, minlength=len(seen))
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(keys), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    begins = np.flatnonzero(new)
    return order[begins], place, np.diff(begins, append=len(keys))
