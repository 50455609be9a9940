"""Benchmark passages in documents, found also with other numbers, names and units.

Texts are read as templates: a number, a name (a capitalised word that does not begin a
sentence) or a unit becomes a placeholder of its type, other words lose case and outer
punctuation. Windows of ``size`` template words are joined by hash and then compared word by
word. What stands in the slots has to fit: along one alignment of a benchmark item with a
document a name, number or unit of the item always answers to the same one in the document,
and different names to different ones.

Names are told by capitals, which a document may have lost or put everywhere. So each window
is looked up a second time without regard to case, with numbers and units as its only slots;
names other than the item's are found in ordinary spelling only.

Windows of few words beside their slots (*weak* ones) say little by their template. They match
if all their words are equal, or if the whole item is in the document and its slots fit.
An item of slots only has no template and is found by equal words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from seriesflow.llm.common import add_columns, mix, ranges, share, small_batches, starts_of

NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
HOLES = frozenset((NUMBER, NAME, UNIT))
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%)?")
_JOINED = re.compile(r"([+-]?[$€£]?\d[\d.,:/]*)([a-z%$€£]+)", re.I)
_DIGIT = re.compile(r"\d")
_EDGES = "!\"#&'()*,-./:;<=>?@[\\]^_`{|}~«»“”‘’…¿¡"
# Number words and units that are read as placeholders.
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve "
                         "twenty thirty forty fifty hundred thousand million".split())
UNITS = frozenset("mm cm m km mg g kg t ml l s ms h hz khz mhz ghz kb mb gb tb w kw v a c f % € $ £ "
                  "meter meters metre metres kilometer kilometers kilometre kilometres mile miles "
                  "foot feet inch inches yard yards gram grams kilogram kilograms pound pounds ounce "
                  "ounces liter liters litre litres second seconds minute minutes hour hours day days "
                  "week weeks month months year years dollar dollars euro euros cent cents "
                  "degree degrees percent".split())
LETTERS = frozenset(u for u in UNITS if len(u) == 1 and u.isalpha())  # units after a number only


TEMPLATE, FREE, EXACT = range(3)  # ways to look a window up
REMEMBERED = 500_000  # words a task remembers before it starts afresh


@dataclass(frozen=True)
class Matching:
    """An item is found in a document if matching windows cover ``share`` of its template
    words, or ``run`` of them in a row. Windows with fewer than ``plain`` words that are no
    placeholder are weak (short windows: if any word is one).
    ``block_windows`` bounds the benchmark windows broadcast at a time: a larger benchmark
    is taken in several blocks, each against all documents. An alignment is dropped if the
    slots of more than ``misfits`` of its windows do not fit those before."""

    size: int = 8
    plain: int = 4
    share: float = 0.5
    run: int = 13
    misfits: float = 0.25
    block_windows: int = 1_000_000


def template_word(word: str) -> tuple[str, str, bool, bool]:
    """Template word if it begins a sentence, template word else, ends a sentence, is kept."""
    inner = word.strip(_EDGES)
    ends = word.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", "…")
    if not inner:
        return "", "", ends, False
    low = inner.lower()
    if _NUMBER.fullmatch(inner) or low in NUMBER_WORDS:
        return NUMBER, NUMBER, ends, True
    if low in UNITS and low not in LETTERS:
        return UNIT, UNIT, ends, True
    return low, NAME if inner[0].isupper() else low, ends, True


def joined(word: str) -> tuple[str, str] | None:
    """A number and its unit written as one word, apart; the unit takes what follows it along."""
    inner = word.strip(_EDGES)
    found = _JOINED.fullmatch(inner)
    if not found or found[2].lower() not in UNITS or found[2] in "%$€£":
        return None
    cut = word.index(inner) + len(found[1])
    return word[:cut], word[cut:]


class Reader:
    """Template words of texts as numbers, remembered word by word."""

    def __init__(self):
        self.forms: dict[str, int] = {}
        self.words: dict[str, int] = {}
        self.table = np.zeros((0, 6), np.int64)
        self.raw: list[str] = []
        self.apart: dict[int, tuple[int, int]] = {}  # words that are a number and its unit
        self._hashes = np.zeros(0, np.uint64)
        self._word_hashes = np.zeros(0, np.uint64)

    def form(self, s: str) -> int:
        return self.forms.setdefault(s, len(self.forms))

    def _learn(self, words):
        rows, forms, mark = [], self.forms, len(self.words)
        for number, w in enumerate(words, mark):
            if w.isalpha():  # most words: nothing to strip, no digits, no end of a sentence
                low = w.lower()
                first = later = low
                if low in NUMBER_WORDS:
                    first = later = NUMBER
                elif low in UNITS and len(low) > 1:
                    first = later = UNIT
                elif w[0].isupper():
                    later = NAME
                ends, kept, letter = False, True, low in LETTERS
            else:
                first, later, ends, kept = template_word(w)
                letter = w.strip(_EDGES).lower() in LETTERS
            self.words[w] = number
            at = forms.setdefault(first, len(forms))
            rows += (at, at if first is later else forms.setdefault(later, len(forms)), ends, kept, first == NUMBER, letter)
            self.raw.append(w)
        if rows:
            self.table = np.concatenate([self.table, np.array(rows, np.int64).reshape(-1, 6)])

    def read(self, texts: list[str]):
        """Of all kept words, end to end: template number, that without regard to case, word
        number and text."""
        split = [t.split() for t in texts]
        lengths = np.array([len(w) for w in split], np.int64)
        new = set().union(*split) - self.words.keys()
        pairs = {w: two for w in new if not w.isalpha() and _DIGIT.search(w) and (two := joined(w))}
        self._learn(new | {part for two in pairs.values() for part in two} - self.words.keys())
        self.apart.update((self.words[w], (self.words[a], self.words[b])) for w, (a, b) in pairs.items())
        flat = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.int64, int(lengths.sum()))
        text_of = np.repeat(np.arange(len(texts)), lengths)
        if self.apart:
            flat, text_of = self._parted(flat, text_of)
        if not len(flat):
            return flat, flat, flat, flat
        starts = np.ones(len(flat), bool)
        starts[1:] = (self.table[flat[:-1], 2] > 0) | (text_of[1:] != text_of[:-1])
        free = self.table[flat, 0]
        form = np.where(starts, free, self.table[flat, 1])
        unit = np.zeros(len(flat), bool)
        unit[1:] = (self.table[flat[:-1], 4] & self.table[flat[1:], 5]) > 0
        unit &= ~starts
        if unit.any():
            form[unit] = free[unit] = self.form(UNIT)
        kept = self.table[flat, 3] > 0
        return form[kept], free[kept], flat[kept], text_of[kept]

    def _parted(self, flat: np.ndarray, text_of: np.ndarray):
        whole = np.fromiter(self.apart, np.int64, len(self.apart))
        is_pair = np.zeros(len(self.raw), bool)
        is_pair[whole] = True
        at = np.flatnonzero(is_pair[flat])
        if not len(at):
            return flat, text_of
        parts = np.array([self.apart[w] for w in flat[at].tolist()], np.int64)
        flat = np.insert(flat, at + 1, parts[:, 1])
        flat[at + np.arange(len(at))] = parts[:, 0]
        return flat, np.insert(text_of, at + 1, text_of[at])

    def hashes(self) -> np.ndarray:
        """Hash of each template word, by number."""
        known = len(self._hashes)
        if known < len(self.forms):
            names = list(self.forms)[known:]
            more = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))
            self._hashes = np.concatenate([self._hashes, more])
        return self._hashes

    def word_hashes(self) -> np.ndarray:
        """Hash of each word without case and outer punctuation, by number."""
        known = len(self._word_hashes)
        if known < len(self.raw):
            more = np.fromiter((xxhash.xxh64_intdigest(bare(w)) for w in self.raw[known:]), np.uint64,
                               len(self.raw) - known)
            self._word_hashes = np.concatenate([self._word_hashes, more])
        return self._word_hashes


def bare(word: str) -> str:
    return word.strip(_EDGES).lower()


def window_hashes(value: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of ``size`` values."""
    if len(value) < size:
        return np.zeros(0, np.uint64)
    width, total, base = 1, value, np.uint64(0x9E3779B97F4A7C15)
    for bit in bin(size)[3:]:  # windows of twice the width, and one more where the bit says so
        power = np.uint64(pow(int(base), width, 1 << 64))
        total = total[:-width] * power + total[width:]
        width *= 2
        if bit == "1":
            total = total[:-1] * base + value[width:]
            width += 1
    return mix(total)


class Keys:
    """Sorted window hashes with their places, behind a table of their leading bits."""

    def __init__(self, rows: list[tuple]):
        rows = sorted(rows)
        self.keys, self.places = np.array([r[0] for r in rows], np.uint64), [r[1:] for r in rows]
        self.shift = np.uint64(64 - min(22, max(12, len(rows).bit_length() + 4)))
        self.there = np.zeros(1 << (64 - int(self.shift)), bool)
        self.there[self.keys >> self.shift] = True

    def find(self, own: np.ndarray):
        """Pairs (place in own, row number of the first equal key)."""
        maybe = np.flatnonzero(self.there[own >> self.shift])
        at = np.searchsorted(self.keys, own[maybe])
        equal = self.keys[np.minimum(at, len(self.keys) - 1)] == own[maybe]
        return maybe[equal], at[equal]


class Items:
    """Templates of a block of benchmark items and their sorted window hashes, by width.

    Items of fewer than ``size`` template words are one window of their own width. Weak
    windows are in ``exact``, by their words; that with most plain words is in ``windows``
    too if the item has no other there. ``free`` has the windows that are not weak without
    regard to case, names as words. The first word is looked up under each way to read
    it, as a document may have it within a sentence or after a number.
    """

    def __init__(self, rows: list[tuple[int, str]], matching: Matching):
        self.matching = matching
        reader = Reader()
        form, free, word, text_of = reader.read([t for _, t in rows])
        unit = reader.form(UNIT)
        names = list(reader.forms)
        value = reader.hashes()[form] if len(form) else np.zeros(0, np.uint64)
        own = reader.word_hashes()[word] if len(form) else value
        low = reader.hashes()[free] if len(form) else value
        self.ids = [i for i, _ in rows]
        bounds = np.searchsorted(text_of, np.arange(len(rows) + 1))
        self.forms = [[names[f] for f in form[a:b]] for a, b in zip(bounds, bounds[1:])]
        self.free_forms = [[names[f] for f in free[a:b]] for a, b in zip(bounds, bounds[1:])]
        self.slots = [[reader.raw[w].strip(_EDGES) for w in word[a:b]] for a, b in zip(bounds, bounds[1:])]
        self.weak: list[set[int]] = [set() for _ in rows]
        self.plain = [sum(f not in HOLES for f in forms) for forms in self.forms]
        found: dict[int, list] = {}
        exact: dict[int, list] = {}
        cased: dict[int, list] = {}
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            width = min(matching.size, int(b - a))
            if not width:
                continue
            keys = window_hashes(value[a:b], width).tolist()
            plain = [sum(f not in HOLES for f in self.forms[k][at:at + width]) for at in range(len(keys))]
            self.weak[k] = {at for at, n in enumerate(plain) if n < min(matching.plain, width)}
            same = window_hashes(own[a:b], width).tolist()
            exact.setdefault(width, []).extend((same[at], k, at) for at in self.weak[k])
            caseless = window_hashes(low[a:b], width).tolist()
            looked_up = [at for at in range(len(keys)) if at not in self.weak[k]]
            cased.setdefault(width, []).extend((caseless[at], k, at) for at in looked_up)
            if not looked_up and self.plain[k]:
                # not the first window if another will do: its first word may be a name
                looked_up = [max(range(len(keys)), key=lambda at: (plain[at] > 0, at > 0, plain[at]))]
            for at in looked_up:
                found.setdefault(width, []).append((keys[at], k, at))
                if at == 0:
                    others = {*reader.table[word[a], :2].tolist(), *([unit] * int(reader.table[word[a], 5]))}
                    for other in others - {int(form[a])}:
                        first = value[a:a + width].copy()
                        first[0] = reader.hashes()[other]
                        found[width].append((int(window_hashes(first, width)[0]), k, 0))
        self.windows, self.exact, self.free = (
            {width: Keys(some) for width, some in by_width.items() if some} for by_width in (found, exact, cased))


def matches(texts: list[str], items: Items, reader: Reader):
    """Rows (text, item, windows, coverage) of the items found in each text."""
    form, free, word, text_of = reader.read(texts)
    if not len(form):
        return
    hits: dict[tuple[int, int, int], list] = {}
    for kind, windows in ((TEMPLATE, items.windows), (FREE, items.free), (EXACT, items.exact)):
        if not windows:
            continue
        value = reader.word_hashes()[word] if kind == EXACT else reader.hashes()[free if kind == FREE else form]
        for width, keys in windows.items():
            own = window_hashes(value, width)
            if not len(own):
                continue
            found, rows = keys.find(own)
            inside = text_of[found] == text_of[found + width - 1]
            for p, k in zip(found[inside].tolist(), rows[inside].tolist()):
                while k < len(keys.keys) and keys.keys[k] == own[p]:
                    item, begin = keys.places[k]
                    hits.setdefault((int(text_of[p]), item, p - begin), []).append((begin, width, kind))
                    k += 1
    if not hits:
        return
    names = list(reader.forms)

    def slots(item, shift, begin, end, rename=False):
        """Slots of the item's words and what the document has there; None if words differ."""
        pairs = []
        for i in range(begin, end):
            kind, ours = items.forms[item][i], items.slots[item][i]
            other, theirs = names[form[shift + i]], reader.raw[word[shift + i]].strip(_EDGES)
            if kind == other:
                if kind in HOLES:
                    pairs.append((kind, _quantity(items, item, i), theirs))
            elif i or ours.lower() != theirs.lower():
                if i or not rename or not (ours[0].isupper() and theirs[0].isupper()):
                    return None
                pairs.append((NAME, ours, theirs))
        return pairs

    def caseless_slots(item, shift, begin, end):
        pairs = []
        for i in range(begin, end):
            kind = items.free_forms[item][i]
            if kind != names[free[shift + i]]:
                return None
            if kind in HOLES:
                pairs.append((kind, _quantity(items, item, i), reader.raw[word[shift + i]].strip(_EDGES)))
        return pairs

    covered: dict[tuple[int, int], tuple[set, set]] = {}
    for (text, item, shift), windows in hits.items():
        n, weak = len(items.forms[item]), items.weak[item]
        fitting = []
        for kind in (TEMPLATE, FREE):
            there, back, own, others = {}, {}, [], 0
            for begin, width, found in sorted(windows):
                if found != kind or kind == TEMPLATE and begin in weak:
                    continue
                pairs = (slots if kind == TEMPLATE else caseless_slots)(item, shift, begin, begin + width)
                if pairs is None:
                    continue  # equal hash, other words
                if _fits(pairs, there, back):
                    own.append((begin, width))
                else:
                    others += 1
            if others > items.matching.misfits * (others + len(own)):
                break  # names that contradict each other do so in any case
            fitting += own
        fitting += [(begin, width) for begin, width, kind in windows
                    if kind == EXACT and all(bare(reader.raw[word[shift + i]]) == items.slots[item][i].lower()
                                             for i in range(begin, begin + width))]
        if weak and items.plain[item] and shift >= 0 and shift + n <= len(form) \
                and text_of[shift] == text == text_of[shift + n - 1]:
            pairs = slots(item, shift, 0, n, rename=n > items.matching.size)
            if pairs is not None and _fits(pairs, {}, {}):
                width = min(n, items.matching.size)
                fitting = [(begin, width) for begin in range(n - width + 1)]
        if fitting:
            words, starts = covered.setdefault((text, item), (set(), set()))
            words.update(i for begin, width in fitting for i in range(begin, begin + width))
            starts.update(begin for begin, _ in fitting)
    for (text, item), (words, starts) in sorted(covered.items()):
        n = len(items.forms[item])
        longest = run = 0
        for i in range(n):
            run = run + 1 if i in words else 0
            longest = max(longest, run)
        if len(words) >= items.matching.share * n or longest >= items.matching.run:
            yield text, items.ids[item], len(starts), len(words) / n


def _quantity(items: Items, item: int, i: int) -> str:
    """What stands in a slot; a number with the word after it, as equal numbers of different
    things need not stay equal."""
    kind, ours = items.forms[item][i], items.slots[item][i]
    if kind != NUMBER:
        return ours
    after = items.slots[item][i + 1].lower() if i + 1 < len(items.slots[item]) else ""
    return f"{ours} {after}"


def _fits(pairs, there, back) -> bool:
    """Whether the slots agree with those seen; if so they are remembered."""
    new_there, new_back = {}, {}
    for kind, ours, theirs in pairs:
        known = there.get((kind, ours), new_there.get((kind, ours), theirs))
        if known != theirs:
            return False
        new_there[kind, ours] = theirs
        if kind == NAME:
            if back.get(theirs, new_back.get(theirs, ours)) != ours:
                return False
            new_back[theirs] = ours
    there.update(new_there)
    back.update(new_back)
    return True


def blocks_of(benchmark: DataFrame, matching: Matching):
    """The benchmark's items in blocks of about ``matching.block_windows`` words."""
    known = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    words = known.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = max(1, -(-int(words) // matching.block_windows))
    for block in range(blocks):
        some = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield Items(sorted((r.item_id, r.text) for r in some.collect()), matching)


def without_contaminations(docs: DataFrame, benchmark: DataFrame, matching: Matching = Matching(),
                           text: str = "text") -> DataFrame:
    """The rows of docs in which no benchmark item is found, by the rules of ``contaminations``."""
    columns = docs.columns
    for items in blocks_of(benchmark, matching):
        shared = share(docs, items)

        def make(shared=shared):
            items, reader = shared(), Reader()

            def work(texts):
                if len(reader.raw) > REMEMBERED:
                    reader.__init__()
                found = {row[0] for row in matches([(t or b"").decode() for t in texts], items, reader)}
                return ([i in found for i in range(len(texts))],)

            return work

        docs = add_columns(docs, make, [("contaminated_", T.BooleanType())], columns, text)
        docs = docs.where(~F.col("contaminated_")).select(*columns)
    return docs


def contaminations(docs: DataFrame, benchmark: DataFrame, matching: Matching = Matching(),
                   keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """A row for each row of docs and benchmark item found in it.

    Columns ``keep``, ``item_id``, ``windows`` (of the item that match), ``coverage`` (share
    of the item's template words) and ``contaminated`` (true). Null and empty texts match
    nothing; benchmark rows without id or text are left out; repeated rows count each. An
    input column named like a new one is replaced. Documents are not shuffled; each block of
    items (one unless the benchmark has over ``matching.block_windows`` words) is sent to
    all tasks.
    """
    new = [("item_id", T.LongType()), ("windows", T.LongType()), ("coverage", T.DoubleType()),
           ("contaminated", T.BooleanType())]
    names = [n for n, _ in new]
    keep = [c for c in (["doc_id"] if keep is None else keep) if c not in names]
    schema = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in keep]
                          + [T.StructField(n, t) for n, t in new])
    small_batches(docs)
    source = docs.select(F.col(text).cast("string").cast("binary").alias("text_"),
                         *[F.col(c).alias(f"kept{i}_") for i, c in enumerate(keep)])
    found = None
    for items in blocks_of(benchmark, matching):
        part = source.mapInArrow(_searching(share(docs, items), keep, names), schema)
        found = part if found is None else found.unionByName(part)
    return found


def _searching(shared, keep, names):
    def run(batches):
        items = shared()
        reader = Reader()
        for batch in batches:
            texts = batch.column(0)
            if not len(texts):
                continue
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4))
            for a, b in ranges(sizes, 4 << 20):
                if len(reader.raw) > REMEMBERED:
                    reader = Reader()
                rows = list(matches([(t or b"").decode() for t in texts.slice(a, b - a).to_pylist()], items, reader))
                if rows:
                    at = pa.array([a + r[0] for r in rows], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(i + 1).take(at) for i in range(len(keep))]
                        + [pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                           pa.array([r[3] for r in rows], pa.float64()), pa.array([True] * len(rows))],
                        names=[*keep, *names])

    return run
