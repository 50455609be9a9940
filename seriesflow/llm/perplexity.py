"""Quality rules with perplexity bands for each language.

Words are scored by a modified Kneser-Ney model of word pairs of their language
(``word_pairs``), which leaves unknown words to the model of characters. That one is a modified Kneser-Ney model of character 4-grams over a folded
alphabet of 40 symbols. Its size is bounded by the alphabet (40**4 n-grams, 2.56 million)
and not by the collection, so it may be held on the driver and broadcast. The counts are
those of all texts, added up by Spark; the model is looked up in sorted arrays of hashes.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from seriesflow.llm.common import add_columns, mix, ranges, share, small_batches, starts_of
from seriesflow.llm.word_pairs import PAIR, WORD, Chunk, answers_to, log10_probabilities, portions, same_portions, statistics
from seriesflow.sources.storage import store

ORDER = 4
SYMBOLS = 40  # 0 space, 1-26 letters, 27 digits, 28 comma, 29 stop, 30 other marks, 31 rest, 32-39 other letters
_TABLE_SIZE = 0x3000
FEW_LANGUAGES = 10_000  # rows of a table that may be broadcast
_FORMS = 50_000  # words looked up together


@dataclass(frozen=True)
class Bands:
    """Perplexity bands: ``spread`` interquartile ranges of a language's log10 perplexity
    beyond its quartiles, and ``short / sqrt(characters)`` more, as the mean of few
    characters scatters more. For the perplexity of words, ``short / sqrt(words)`` more."""

    spread: float = 3.0
    short: float = 2.0


def folding() -> np.ndarray:
    """Symbol of each code point below 0x3000."""
    table = np.full(_TABLE_SIZE, 31, np.uint8)
    for point in range(_TABLE_SIZE):
        c = chr(point)
        low = c.lower()
        if "a" <= low <= "z" and len(low) == 1:
            table[point] = ord(low) - 96
        elif c.isspace():
            table[point] = 0
        elif c.isdigit():
            table[point] = 27
        elif c.isalpha():
            table[point] = 32 + ord(low[0]) % 8
        elif c in ",;":
            table[point] = 28
        elif c in ".!?":
            table[point] = 29
        elif point < 128:
            table[point] = 30
    return table


def fold(points: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Symbols of code points; from 0x3000 on all count as letters."""
    low = points < _TABLE_SIZE
    if low.all():
        return table[points]
    return np.where(low, table[np.where(low, points, 0)], 32 + points % 8).astype(np.uint8)


def grams_of(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """4-gram codes of each character of the texts and of an end space after each; and
    how many each text has. Three spaces stand before a text."""
    lengths, symbols = [], []
    gap = np.zeros(ORDER - 1, np.uint8)
    end = np.zeros(1, np.uint8)
    for text in texts:
        points = np.frombuffer((text or b"").decode().encode("utf-32-le"), np.uint32)
        symbols += [gap, fold(points, table), end]
        lengths.append(len(points) + 1)
    lengths = np.array(lengths, np.int64)
    flat = np.concatenate(symbols).astype(np.int32)
    codes = flat[ORDER - 1:].copy()
    for back in range(1, ORDER):
        codes += flat[ORDER - 1 - back:len(flat) - back] * np.int32(SYMBOLS ** back)
    # positions whose 4-gram ends in the gap before a later text are left out
    keep = np.ones(len(codes), bool)
    begins = starts_of(lengths + ORDER - 1)[1:]
    for back in range(ORDER - 1):
        keep[begins - (ORDER - 1) + back] = False
    return codes[keep], lengths


def count_grams(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows (gram, count) over all texts. A task sends at most one row per n-gram."""
    small_batches(docs)
    source = docs.select(F.col(text).cast("string").cast("binary").alias("text"))

    def run(batches):
        import pyarrow as pa

        table = folding()
        total = np.zeros(SYMBOLS ** ORDER, np.int64)
        for batch in batches:
            column = batch.column(0)
            sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)) \
                if len(column) else []
            for a, b in ranges(sizes, 4 << 20):
                texts = [t for t in column.slice(a, b - a).to_pylist() if t]
                if texts:
                    total += np.bincount(grams_of(texts, table)[0], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["gram", "count"])

    partial = source.mapInArrow(run, "gram int, count bigint")
    return partial.groupBy("gram").agg(F.sum("count").alias("count"))


def kneser_ney(counts: np.ndarray):
    """Interpolated modified Kneser-Ney probabilities from dense 4-gram counts.

    Returns, for each order from 1, the dense probabilities and the weight that each
    history gives to the next lower order. Lower orders count the different symbols
    before an n-gram. Each order has its own three discounts.
    """
    dense = [counts.reshape((SYMBOLS,) * ORDER).astype(np.float64)]
    seen = dense[0]
    while dense[0].ndim > 1:
        dense.insert(0, (seen > 0).sum(axis=0).astype(np.float64))
        seen = seen.sum(axis=0)
    lower = np.full((), 1.0 / SYMBOLS)
    probabilities, weights = [], []
    for c in dense:
        d = _discounts(c)
        cut = np.where(c >= 3, d[2], np.where(c >= 2, d[1], np.where(c >= 1, d[0], 0.0)))
        total = c.sum(axis=-1, keepdims=True)
        share = np.where(total > 0, cut.sum(axis=-1, keepdims=True) / np.maximum(total, 1), 1.0)
        p = np.maximum(c - cut, 0) / np.maximum(total, 1) + share * lower
        probabilities.append(p)
        weights.append(share[..., 0])
        lower = p[None]
    return dense, probabilities, weights


def _discounts(c: np.ndarray) -> tuple[float, float, float]:
    n = [float((c == i).sum()) for i in range(1, 5)]
    if not all(n):
        return 0.5, 1.0, 1.5  # no estimate: too few n-grams
    y = n[0] / (n[0] + 2 * n[1])
    found = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
    return tuple(min(max(x, 0.01), i + 0.99) for i, x in enumerate(found))


class HashedModel:
    """The model as one sorted array of hashes per order, with log10 probabilities and,
    for histories, log10 weights of the lower order."""

    def __init__(self, counts: np.ndarray):
        dense, probabilities, weights = kneser_ney(counts)
        self.levels = []
        for order, (c, p) in enumerate(zip(dense, probabilities), 1):
            seen = np.flatnonzero(c.ravel() > 0)
            keys = mix(seen)
            by = np.argsort(keys)
            self.levels.append((keys[by], np.log10(p.ravel()[seen[by]]).astype(np.float32)))
        self.backoff = []
        for w in weights:
            history = np.flatnonzero(w.ravel() < 1.0) if w.ndim else np.zeros(1, np.int64)
            keys = mix(history)
            by = np.argsort(keys)
            self.backoff.append((keys[by], np.log10(np.maximum(w.ravel()[history[by]], 1e-300)).astype(np.float32)))
        self._found = None  # log10 probabilities of the codes looked up before

    @staticmethod
    def _find(table, codes):
        keys, values = table
        if not len(keys):
            return np.zeros(len(codes), bool), np.zeros(len(codes), np.float32)
        wanted = mix(codes.astype(np.uint64))
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return keys[at] == wanted, values[at]

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of each 4-gram; equal ones are found once."""
        if self._found is None:
            self._found = np.full(SYMBOLS ** ORDER, np.nan)
        out = self._found[codes]
        new = np.isnan(out)
        if new.any():
            different = np.unique(codes[new])
            self._found[different] = self._log10(different)
            out[new] = self._found[codes[new]]
        return out

    def _log10(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes), np.float64)
        rest, added = np.arange(len(codes)), np.zeros(len(codes), np.float64)
        left = codes.astype(np.int64)
        for order in range(ORDER, 0, -1):
            hit, value = self._find(self.levels[order - 1], left)
            out[rest[hit]] = added[hit] + value[hit]
            rest, added, left = rest[~hit], added[~hit], left[~hit]
            if not len(rest):
                return out
            known, weight = self._find(self.backoff[order - 1], left // SYMBOLS)
            added = added + np.where(known, weight, 0.0)
            left = left % SYMBOLS ** (order - 1)
        out[rest] = added - np.log10(SYMBOLS)
        return out


def fit(counts: DataFrame) -> HashedModel:
    """Model from the counted n-grams; at most 40**4 rows come to the driver."""
    found = counts.toPandas()
    dense = np.zeros(SYMBOLS ** ORDER, np.int64)
    dense[found["gram"].to_numpy(np.int64)] = found["count"].to_numpy(np.int64)
    return HashedModel(dense)


_MARKS = b"#*$%&|<>"
_BASE = [("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()),
         ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()), ("base_failed", T.BooleanType())]
_SCORED = [("n_grams", T.LongType()), ("log_perplexity", T.DoubleType())]


def base_counts(texts: list[bytes]):
    """The counts of ``_BASE`` for each text."""
    words = [(t or b"").split() for t in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    chars = [len(b"".join(w).decode()) for w in words]
    symbols = [len(t or b"") - len((t or b"").translate(None, _MARKS)) for t in texts]
    repeated = repeated_words(words, n_words)
    return (n_words.tolist(), chars, symbols, [_repeated_lines(t or b"") for t in texts],
            repeated.tolist(), ((n_words < 10) | (100 * repeated > 20 * n_words)).tolist())


def _repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def repeated_words(words: list[list[bytes]], lengths: np.ndarray, size: int = 5) -> np.ndarray:
    """Words of each text that lie in a window of ``size`` words found twice in it."""
    import pyarrow as pa

    flat = pa.array(list(chain.from_iterable(words)), pa.binary()).dictionary_encode().indices.to_numpy()
    covered = np.zeros(len(flat) + 1, np.int64)
    text_of = np.repeat(np.arange(len(words)), lengths)
    if len(flat) >= size:
        begin = np.arange(len(flat) - size + 1)
        begin = begin[text_of[begin] == text_of[begin + size - 1]]
        key = text_of[begin].astype(np.uint64)
        for i, factor in enumerate(mix(np.arange(1, size + 1)) | np.uint64(1)):
            key += flat[begin + i].astype(np.uint64) * factor
        order = np.argsort(key)
        ordered = key[order]
        pair = np.flatnonzero(ordered[1:] == ordered[:-1])
        a, b = begin[order[pair]], begin[order[pair + 1]]
        same = text_of[a] == text_of[b]
        for i in range(size):
            same &= flat[a + i] == flat[b + i]
        found = np.unique(np.concatenate([a[same], b[same]]))
        np.add.at(covered, found, 1)
        np.add.at(covered, found + size, -1)
    inside = np.cumsum(covered)[:-1] > 0
    return np.bincount(text_of, inside, len(words)).astype(np.int64)


def score(docs: DataFrame, model: HashedModel, keep: list[str], text: str = "text") -> DataFrame:
    """Base counts, number of scored symbols and mean negative log10 probability."""
    shared = share(docs, model)

    def make():
        table, own = folding(), shared()

        def work(texts):
            codes, lengths = grams_of(texts, table)
            sums = np.add.reduceat(own.log10(codes), starts_of(lengths))
            return (*base_counts(texts), lengths.tolist(), (-sums / lengths).tolist())

        return work

    return add_columns(docs, make, _BASE + _SCORED, keep, text)


def score_words(docs: DataFrame, model: HashedModel, keep: list[str], text: str = "text",
                lang: str = "language_", stored: bool = False) -> DataFrame:
    """Columns ``keep`` and those of ``score``, the number of words and one end (``n_tokens``)
    and their mean negative log10 probability after the word before (``log_words``). docs are
    read three times; unless they are ``stored`` in files a copy is."""
    import pyarrow as pa

    fields = [*_BASE, *_SCORED, ("n_tokens", T.LongType()), ("log_words", T.DoubleType())]
    keep = [c for c in keep if c not in [name for name, _ in fields]]
    small_batches(docs)
    table = docs.select(F.coalesce(F.col(text).cast("string").cast("binary"), F.lit("").cast("binary")).alias("text_"),
                        F.col(lang).alias("lang_"), *[F.col(c).alias(f"kept{i}_") for i, c in enumerate(keep)])
    if not stored:
        table = store(table, "texts")
    pair_answers, word_answers, languages = statistics(table.select("text_", "lang_"))
    shared = share(docs, (model, languages))
    schema = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in keep]
                          + [T.StructField(n, t) for n, t in fields])

    def run(batches):
        (own, languages), table = shared(), folding()
        pairs_of, words_of = answers_to(pair_answers, PAIR), answers_to(word_answers, WORD)

        def log_sums(texts):
            sums, sizes = [], []
            for a, b in ranges([len(t) for t in texts], 1 << 20):
                codes, lengths = grams_of(texts[a:b], table)
                sums.append(np.add.reduceat(own.log10(codes), starts_of(lengths)))
                sizes.append(lengths)
            return np.concatenate(sums), np.concatenate(sizes)

        def word_logs(words):
            # one text, four spaces between words: the end of one and the gap before the next
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            logs = own.log10(grams_of(["    ".join(words).encode()], table)[0])
            ends = np.append(0.0, np.cumsum(logs))
            begins = starts_of(sizes + ORDER)
            return ends[begins + sizes + 1] - ends[begins]

        for number, rows in portions(batches):
            chunk = Chunk(rows)
            total, word = pairs_of(number, chunk.pairs)[1], words_of(number, chunk.words)[1:]
            by_characters = np.concatenate([word_logs(chunk.forms[i:i + _FORMS])
                                            for i in range(0, len(chunk.forms), _FORMS)])
            for part in chunk.slices():
                logs = log10_probabilities(part, total, word, languages, by_characters)
                sums, lengths = log_sums(part.texts)
                columns = [*base_counts(part.texts), lengths, -sums / lengths, part.lengths,
                           -np.add.reduceat(logs, part.starts) / part.lengths]
                yield pa.RecordBatch.from_arrays(part.kept + [pa.array(c) for c in columns],
                                                 names=[*keep, *[n for n, _ in fields]])

    return table.mapInArrow(run, schema)


def quality(docs: DataFrame, bands: Bands = Bands(), keep: list[str] | None = None,
            text: str = "text", lang: str = "lang", stored: bool = False) -> DataFrame:
    """Base counts, perplexity of characters and of words, the bands of the row's language and
    ``kept``. Words have an upper limit only: copies are predicted well and are no salad.

    The bands are found over all texts that pass the base rules; a language without such
    texts has none and rejects nothing by perplexity. A null language is a language of its
    own. Null and empty texts have no words and fail the base rules. One row per input row,
    in no given order; an input column named like a new one is replaced.

    ``stored`` says that docs are rows of files, with no shuffle or random choice behind them:
    then they are read again where a copy is stored and read otherwise.
    """
    model = fit(count_grams(docs, text))
    own = ("language_", "perplexity", "perplexity_low", "perplexity_high", "word_perplexity",
           "word_perplexity_high", "kept")
    keep = [c for c in (["doc_id"] if keep is None else keep) if c not in own]
    named = docs.withColumn("language_", F.coalesce(F.col(lang).cast("string"), F.lit("")))
    with same_portions(docs.sparkSession):
        scored = store(score_words(named, model, [*keep, "language_"], text, stored=stored), "perplexity")
    quartiles = scored.groupBy("language_").agg(*[
        F.percentile_approx(F.when(~F.col("base_failed"), F.col(c)), F.array(F.lit(0.25), F.lit(0.75)),
                            F.lit(10_000)).alias(q) for c, q in (("log_perplexity", "q"), ("log_words", "w"))])
    width, word_width = ((F.col(q)[1] - F.col(q)[0]) * bands.spread for q in "qw")
    limits = store(quartiles.select("language_", (F.col("q")[0] - width).alias("low_"),
                                    (F.col("q")[1] + width).alias("high_"),
                                    (F.col("w")[1] + word_width).alias("word_high_")), "bands")
    if limits.count() <= FEW_LANGUAGES:  # else the rows are shuffled to their language
        limits = F.broadcast(limits)
    slack = bands.short / F.sqrt("n_grams")
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low_") - slack, F.col("high_") + slack), F.lit(True))
    word_limit = F.col("word_high_") + bands.short / F.sqrt("n_tokens")
    inside &= F.coalesce(F.col("log_words") <= word_limit, F.lit(True))
    return (scored.join(limits, "language_")
            .select(*[c for c in scored.columns if c not in ("language_", "n_grams", "log_perplexity",
                                                       "n_tokens", "log_words")],
                    F.pow(F.lit(10.0), "log_perplexity").alias("perplexity"),
                    F.pow(F.lit(10.0), F.col("low_") - slack).alias("perplexity_low"),
                    F.pow(F.lit(10.0), F.col("high_") + slack).alias("perplexity_high"),
                    F.pow(F.lit(10.0), "log_words").alias("word_perplexity"),
                    F.pow(F.lit(10.0), word_limit).alias("word_perplexity_high"),
                    (~F.col("base_failed") & inside).alias("kept")))
