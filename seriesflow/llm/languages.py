"""Languages of a text as a mixture, from character trigram likelihoods.

The trigrams are over a folded alphabet of 64 symbols, so a language has at most 64**3
(262,144) counts whatever the size of the collection; the model holds those that occur (12
bytes each) and grows with the number of languages only, of which there may be ``MOST``.
Counts are those of all labelled training texts, added up by Spark.

For a text the shares of the languages are found by expectation-maximisation (``ROUNDS``
rounds) on all its trigrams. The set of languages is then chosen by penalised likelihood: of
the sets of the 1, 2, 3, ... languages with the largest shares, each with shares of its own,
the one with the largest log-likelihood less half log(trigrams) for each language beyond the
first. A text is done when no larger set can win: no mixture is likelier than the one found
for all languages by more than the trigrams times the log of the largest factor by which a
further round would raise a share.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from seriesflow.llm.common import add_columns, ranges, share, small_batches, within
from seriesflow.sources.storage import store

SYMBOLS = 64  # 0 no letter, 1-26 Latin letters, 27-63 other letters
FEATURES = SYMBOLS ** 3
SMOOTHING = 0.5
ROUNDS = 12
MOST = 1000  # languages
CELLS = 4 << 20  # trigrams times languages worked on together
_TABLE_SIZE = 0x3000


def folding() -> np.ndarray:
    """Symbol of each code point below 0x3000; case is not told apart."""
    table = np.zeros(_TABLE_SIZE, np.uint8)
    for point in range(_TABLE_SIZE):
        c = chr(point)
        if c.isalpha():
            low = ord(c.lower()[0])
            table[point] = low - 96 if 97 <= low <= 122 else 27 + low % 37
    return table


def trigrams(text: str, table: np.ndarray) -> np.ndarray:
    """Trigrams of letters and word ends; none that lie wholly outside words."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    symbols = np.zeros(len(points) + 2, np.int32)
    if len(points):
        low = points < _TABLE_SIZE
        inner = table[np.where(low, points, 0)]
        if not low.all():
            far = ~low
            letters = np.fromiter((chr(p).isalpha() for p in points[far].tolist()), bool, int(far.sum()))
            inner[far] = np.where(letters, 27 + points[far] % 37, 0)
        symbols[1:-1] = inner
    codes = (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]
    return codes[symbols[1:-1] > 0]


def count_trigrams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows (lang, feature, count) over all texts with a language. A task sends at most
    one row per language and trigram."""
    small_batches(docs)
    source = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))

    def run(batches):
        table, totals = folding(), {}
        for batch in batches:
            lang_column, text_column = batch.column(0).to_pylist(), batch.column(1)
            lengths = np.array([len(t) for t in text_column.to_pylist()], np.int64)
            for a, b in ranges(lengths, 4 << 20):
                texts = text_column.slice(a, b - a).to_pylist()
                by_lang: dict[str, list] = {}
                for name, t in zip(lang_column[a:b], texts):
                    by_lang.setdefault(name, []).append(trigrams(t, table))
                for name, codes in by_lang.items():
                    if name not in totals:
                        totals[name] = np.zeros(FEATURES, np.int64)
                    totals[name] += np.bincount(np.concatenate(codes), minlength=FEATURES)
        for name, total in totals.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen), pa.string()), pa.array(seen.astype(np.int32)),
                 pa.array(total[seen])], names=["lang", "feature", "count"])

    partial = source.mapInArrow(run, "lang string, feature int, count bigint")
    return partial.groupBy("lang", "feature").agg(F.sum("count").alias("count"))


class LanguageModel:
    """Trigram probabilities of each language, smoothed by adding ``SMOOTHING``; only those
    of trigrams that a language has are held, by trigram."""

    def __init__(self, names: list[str], features: np.ndarray, langs: np.ndarray, counts: np.ndarray):
        self.names = names
        totals = np.bincount(langs, counts, len(names)) + SMOOTHING * FEATURES
        order = np.argsort(features, kind="stable")
        self.starts = np.searchsorted(features[order], np.arange(FEATURES + 1))
        self.langs = langs[order].astype(np.int16)
        self.p = ((counts + SMOOTHING) / totals[langs])[order].astype(np.float32)
        self.unseen = (SMOOTHING / totals).astype(np.float32)

    @classmethod
    def of(cls, names: list[str], counts: np.ndarray) -> LanguageModel:
        """From counts by trigram and language."""
        features, langs = np.nonzero(counts)
        return cls(names, features, langs, counts[features, langs])

    def columns(self, features: np.ndarray) -> np.ndarray:
        """Probabilities of the trigrams, a row for each language."""
        found = np.repeat(self.unseen[:, None], len(features), axis=1)
        sizes = self.starts[features + 1] - self.starts[features]
        at = np.repeat(self.starts[features], sizes) + within(sizes)
        found[self.langs[at], np.repeat(np.arange(len(features)), sizes)] = self.p[at]
        return found


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Model of the languages of docs; at most 64**3 rows per language reach the driver.

    More than ``MOST`` languages are an error: then the column is no language.
    """
    counted = store(count_trigrams(docs, text, lang), "trigrams")  # read twice
    if counted.select("lang").distinct().limit(MOST + 1).count() > MOST:
        raise ValueError(f"more than {MOST} languages")
    langs, features, counts = [], [], []
    number: dict[str, int] = {}
    for batch in counted.toArrow().to_batches():
        named = batch.column(0).dictionary_encode()
        own = np.array([number.setdefault(n, len(number)) for n in named.dictionary.to_pylist()], np.int64)
        langs.append(own[named.indices.to_numpy()])
        features.append(batch.column(1).to_numpy().astype(np.int64))
        counts.append(batch.column(2).to_numpy())
    names = sorted(number)
    if not names:
        return LanguageModel([], *[np.zeros(0, np.int64)] * 3)
    place = np.zeros(len(names), np.int64)
    place[[number[n] for n in names]] = np.arange(len(names))
    return LanguageModel(names, np.concatenate(features), place[np.concatenate(langs)], np.concatenate(counts))


def mixture_of(p: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float, float]:
    """Shares of the languages, log-likelihood, and one that no mixture of them exceeds.

    ``p`` (language x trigram) has a column per different trigram of a text, ``counts`` how
    often it has it.
    """
    shares, total = np.full(len(p), 1.0 / len(p), np.float32), counts.sum()
    for _ in range(rounds):
        shares = shares * (p @ (counts / (shares @ p))) / total
    likelihood = shares @ p
    fit_ = float((counts * np.log(likelihood)).sum(dtype=np.float64))
    factor = float((p @ (counts / likelihood)).max() / total)
    # with room for the rounding of single precision
    return shares, fit_, fit_ + float(total) * max(np.log(factor), 0.0) + 1e-5 * abs(fit_) + 1e-3


def chosen_mixture(p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Shares of the set of languages with the largest penalised likelihood, zero for others."""
    shares, fit_all, limit = mixture_of(p, counts)
    order = np.argsort(-shares, kind="stable")
    penalty, best, chosen = 0.5 * np.log(float(counts.sum())), -np.inf, shares
    for size in range(1, len(p) + 1):
        if limit - (size - 1) * penalty <= best:
            break
        langs = order[:size]
        if size == len(p):
            own, fit_ = shares[langs], fit_all
        else:
            own, fit_, _ = mixture_of(p[langs], counts, 0 if size == 1 else ROUNDS)
        if fit_ - (size - 1) * penalty > best:
            best, chosen = fit_ - (size - 1) * penalty, np.zeros_like(shares)
            chosen[langs] = own
    return chosen


def infer(texts: list[str], model: LanguageModel, table: np.ndarray):
    """Predicted language (``und`` without letters), its share, and all chosen shares."""
    lang, score, mixture = ["und"] * len(texts), [0.0] * len(texts), [{} for _ in texts]
    found = [trigrams(t, table) for t in texts]
    some = [i for i, f in enumerate(found) if len(f)] if model.names else []
    sizes = [len(found[i]) * len(model.names) for i in some]
    for a, b in ranges(sizes, CELLS):
        _infer([found[i] for i in some[a:b]], some[a:b], model, lang, score, mixture)
    return lang, score, mixture


def _infer(found: list[np.ndarray], numbers: list[int], model: LanguageModel, lang, score, mixture) -> None:
    keys = np.concatenate([f.astype(np.int64) + k * FEATURES for k, f in enumerate(found)])
    keys.sort()
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    counts = np.diff(np.append(first, len(keys))).astype(np.float32)
    keys = keys[first]
    ends = np.cumsum(np.bincount(keys // FEATURES, minlength=len(found)))
    p = model.columns(keys % FEATURES)
    for i, a, b in zip(numbers, [0, *ends[:-1]], ends):
        chosen = chosen_mixture(np.ascontiguousarray(p[:, a:b]), counts[a:b])
        top = int(chosen.argmax())
        lang[i], score[i] = model.names[top], float(min(chosen[top], 1.0))
        mixture[i] = {model.names[j]: float(chosen[j]) for j in np.flatnonzero(chosen > 0)}


def predict(docs: DataFrame, model: LanguageModel, keep: list[str] | None = None,
            text: str = "text") -> DataFrame:
    """``lang_pred``, ``score`` (share of that language) and ``mixture`` (languages and
    shares as text) of every text, beside columns ``keep``.

    One row per input row in no given order, repeated rows and null ids included; ``und``
    and 0 for texts that are null, empty or without letters, and for all texts if nothing
    was learned. An input column named like a new one is replaced. Whole texts are read.
    """
    shared = share(docs, model)

    def make():
        own, table = shared(), folding()

        def work(texts):
            lang, score, mixture = infer([(t or b"").decode() for t in texts], own, table)
            return lang, score, [" ".join(f"{k}:{v:.4f}" for k, v in sorted(m.items(), key=lambda x: -x[1]))
                                 for m in mixture]

        return work

    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("mixture", T.StringType())]
    return add_columns(docs, make, fields, ["doc_id"] if keep is None else keep, text, limit=2 << 20)
