"""Fill-in-the-middle texts by displacement scatter, and their way back.

Texts of a batch lie end to end as bytes. Their cuts are scanned from the starts of code
points; a difference array holds at each cut by how much the shift between a byte's place
and its place in the output changes there. Its cumulative sum is the shift of every byte,
and one scatter writes the outputs between their marks. The way back reads the marks of the
outputs, makes the same shifts and gathers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from seriesflow.llm.common import ranges, small_batches, starts_of

# Marks of the parts, by place in the output (P, S, M).
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = len(PREFIX)
PLAIN, PSM, SPM = "plain", "psm", "spm"
SLICE = 4 << 20  # bytes of text worked on together
BLOCK = 1 << 20  # bytes whose shifts are held at a time


def plan(hashes: np.ndarray, sizes: np.ndarray, marked: np.ndarray, plain_percent: int, spm_percent: int):
    """Cuts (in code points) and form of texts of ``sizes`` code points.

    ``hashes`` has four unsigned integers a text. Texts that are empty or hold a mark are
    plain, and so are those whose third hash falls in the last ``plain_percent`` of 100.
    """
    cuts = (hashes[:, :2] % (sizes[:, None] + 1)).astype(np.int64)
    plain = marked | (sizes == 0) | (hashes[:, 2] % 100 >= 100 - plain_percent)
    spm = ~plain & (hashes[:, 3] % 100 < spm_percent)
    return cuts.min(axis=1), cuts.max(axis=1), plain, spm


def hashed(ids: list, seed: str) -> np.ndarray:
    """The first four 8-digit groups of the SHA-256 of ``seed:id``; a null id has no digits."""
    raw = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def code_points(data: np.ndarray, offsets: np.ndarray):
    """Places where code points start, and the number of the first one of each text."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    return starts, np.searchsorted(starts, offsets)


def moved(places: np.ndarray, shifts: np.ndarray, total: int):
    """(first, last, target) of blocks of up to BLOCK bytes.

    The shift of a byte is that of the last of the ascending ``places`` at or before it;
    places that coincide count in turn, so empty parts need no care.
    """
    changes = np.diff(shifts, prepend=0)
    carry = 0
    for a in range(0, total, BLOCK):
        b = min(a + BLOCK, total)
        i, j = np.searchsorted(places, (a, b))
        difference = np.zeros(b - a, np.int64)
        np.add.at(difference, places[i:j] - a, changes[i:j])
        difference[0] += carry
        shift = np.cumsum(difference)
        carry = int(shift[-1])
        yield a, b, np.arange(a, b) + shift


def layout(lengths: np.ndarray, plain: np.ndarray, spm: np.ndarray):
    """Of parts of the given lengths (rows prefix, middle, suffix): first byte of each part
    and of each mark (rows P, M, S) in its output, and the output's size."""
    prefix, middle, suffix = lengths
    order = np.where(spm, suffix, 0)
    p_mark = np.where(spm, MARK + suffix, 0)
    s_mark = np.where(spm, 0, MARK + prefix)
    m_mark = 2 * MARK + prefix + suffix
    marks = np.stack([p_mark, m_mark, s_mark])
    firsts = np.where(plain, np.stack([0 * order, prefix, prefix + middle]), marks + MARK)
    return firsts, marks, prefix + middle + suffix + np.where(plain, 0, 3 * MARK)


def scatter(data: np.ndarray, offsets: np.ndarray, first_cut: np.ndarray, second_cut: np.ndarray,
            plain: np.ndarray, spm: np.ndarray):
    """Outputs end to end and their offsets; cuts are places in ``data``."""
    begins = np.stack([offsets[:-1], first_cut, second_cut])
    ends = np.stack([first_cut, second_cut, offsets[1:]])
    firsts, marks, sizes = layout(ends - begins, plain, spm)
    out_offsets = np.append(starts_of(sizes), sizes.sum()) if len(sizes) else np.zeros(1, np.int64)
    out = np.empty(out_offsets[-1], np.uint8)
    shifts = (firsts + out_offsets[:-1] - begins).T.ravel()
    for a, b, target in moved(begins.T.ravel(), shifts, len(data)):
        out[target] = data[a:b]
    for mark, at in zip((PREFIX, MIDDLE, SUFFIX), marks + out_offsets[:-1]):
        at = at[~plain]
        for k, byte in enumerate(mark):
            out[at + k] = byte
    return out, out_offsets


def gather(out: np.ndarray, offsets: np.ndarray, plain: np.ndarray, spm: np.ndarray):
    """The texts of outputs, from these and their forms alone, and the texts' offsets."""
    lower, upper = offsets[:-1], offsets[1:]
    at = {}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        found = np.flatnonzero((out[:-2] == mark[0]) & (out[1:-1] == mark[1]) & (out[2:] == mark[2]))
        place = np.searchsorted(found, lower)
        at[mark] = np.where(plain, lower, np.append(found, 0)[np.minimum(place, len(found))])
    p, m, s = at[PREFIX], at[MIDDLE], at[SUFFIX]
    prefix = np.where(plain, upper - lower, np.where(spm, m, s) - p - MARK)
    suffix = np.where(plain, 0, np.where(spm, p, m) - s - MARK)
    middle = np.where(plain, 0, upper - m - MARK)
    firsts, _, _ = layout(np.stack([prefix, middle, suffix]), plain, spm)
    sizes = prefix + middle + suffix
    back = np.append(starts_of(sizes), sizes.sum()) if len(sizes) else np.zeros(1, np.int64)
    begins = np.stack([back[:-1], back[:-1] + prefix, back[:-1] + prefix + middle])
    data = np.empty(back[-1], np.uint8)
    for a, b, source in moved(begins.T.ravel(), (firsts + lower - begins).T.ravel(), len(data)):
        data[a:b] = out[source]
    return data, back


def holds_mark(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts hold one of the marks within themselves."""
    marked = np.zeros(len(offsets) - 1, bool)
    if len(data) >= MARK:
        middle = np.isin(data[1:-1], np.frombuffer(PREFIX[1:2] + SUFFIX[1:2] + MIDDLE[1:2], np.uint8))
        found = np.flatnonzero((data[:-2] == PREFIX[0]) & middle & (data[2:] == PREFIX[2]))
        text = np.searchsorted(offsets, found, "right") - 1
        marked[text[found + MARK <= offsets[text + 1]]] = True
    return marked


def _buffers(array: pa.Array):
    """Bytes and offsets of an array of strings or binaries; nulls are empty."""
    array = array.cast(pa.binary()).fill_null(b"")
    offsets = np.frombuffer(array.buffers()[1], np.int32, len(array) + 1, array.offset * 4).astype(np.int64)
    raw = array.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    if offsets[-1] >= 2**31:
        raise ValueError("a batch of outputs must stay below 2 GB")
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, buffers)


def _cut(ids: list, texts: pa.Array, seed: str, plain_percent: int, spm_percent: int):
    data, offsets = _buffers(texts)
    starts, first = code_points(data, offsets)
    sizes = np.diff(first)
    low, high, plain, spm = plan(hashed(ids, seed), sizes, holds_mark(data, offsets), plain_percent, spm_percent)
    starts = np.append(starts, len(data))
    cuts = [np.where(plain, offsets[:-1], starts[first[:-1] + cut]) for cut in (low, high)]
    out, out_offsets = scatter(data, offsets, *cuts, plain, spm)
    form = np.where(plain, PLAIN, np.where(spm, SPM, PSM))
    return [pa.array(sizes, pa.int64()), pa.array(form.tolist(), pa.string()),
            pa.array(low, pa.int64(), mask=plain), pa.array(high - low, pa.int64(), mask=plain),
            _texts(out, out_offsets)]


def _source(df: DataFrame, columns: list, keep: list[str], new: list[str]):
    keep = [c for c in keep if c not in new]
    small_batches(df)
    kept = [F.col(c).alias(f"{i}keep") for i, c in enumerate(keep)]
    fields = [T.StructField(c, df.schema[c].dataType) for c in keep]
    return df.select(*columns, *kept), keep, fields


def transform(docs: DataFrame, keep: list[str], seed: str = "1", plain_percent: int = 10, spm_percent: int = 20,
              text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Columns ``keep``, ``n`` (code points of the text), ``form``, ``prefix_chars``,
    ``middle_chars`` and ``output`` of every row; no shuffle.

    The cuts and the form of a text follow from its doc_id and ``seed`` alone, so equal rows
    have equal outputs. Null texts count as empty; empty texts and texts that hold a mark are
    plain: their output is the text, their parts are null. A null doc_id is hashed without
    digits. Columns of ``keep`` named like a new one are replaced.
    """
    new = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()),
           ("middle_chars", T.LongType()), ("output", T.StringType())]
    source, keep, fields = _source(
        docs, [F.col(doc_id).cast("string").alias("0id"), F.col(text).cast("string").alias("0text")],
        keep, [c for c, _ in new])
    names = [*keep, *[c for c, _ in new]]

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            lengths = np.diff(_buffers(texts)[1])
            for a, b in ranges(lengths, SLICE):
                made = _cut(ids.slice(a, b - a).to_pylist(), texts.slice(a, b - a), seed, plain_percent, spm_percent)
                rest = [batch.column(i + 2).slice(a, b - a) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(rest + made, names=names)

    schema = T.StructType(fields + [T.StructField(c, t) for c, t in new])
    return source.mapInArrow(run, schema)


def restore(made: DataFrame, keep: list[str], output: str = "output", form: str = "form") -> DataFrame:
    """Columns ``keep`` and ``restored``: the exact text, from output and form alone.

    Null outputs count as empty and unknown forms as plain. An output that lacks a mark of
    its form is an error.
    """
    source, keep, fields = _source(made, [F.col(output).cast("string").alias("0out"), F.col(form).alias("0form")],
                                   keep, ["restored"])
    names = [*keep, "restored"]

    def run(batches):
        for batch in batches:
            lengths = np.diff(_buffers(batch.column(0))[1])
            for a, b in ranges(lengths, SLICE):
                out, offsets = _buffers(batch.column(0).slice(a, b - a))
                forms = np.array(batch.column(1).slice(a, b - a).to_pylist(), object)
                spm = forms == SPM
                texts = _texts(*gather(out, offsets, ~spm & (forms != PSM), spm))
                rest = [batch.column(i + 2).slice(a, b - a) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*rest, texts], names=names)

    return source.mapInArrow(run, T.StructType(fields + [T.StructField("restored", T.StringType())]))
