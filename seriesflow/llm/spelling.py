"""Spelling variants grouped under their most frequent near word.

Words are counted over all texts. One edit leaves one half of a word as it is, so near words
meet under the exact half that they share: each word is put into an index under the prefixes
and suffixes that can be such a half, and looks under its own two. A task searches its
words in a bidirectional FM-index (``fm_index``). Halves that very many words have are cut
into blocks of words, each of which is asked by all that look there.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seriesflow.llm.common import parts, small_batches
from seriesflow.llm.fm_index import Vocabulary
from seriesflow.sources.storage import store

LETTERS = "a-zA-ZÀ-ÿ"
REMEMBERED = 300_000  # words whose counts a task gathers before it hands them on
INDEX_WORDS = 60_000  # words of an index
HOT_HALVES = 100_000  # cut halves at most; their table is broadcast
SLIP = 199


def word_counts(docs: DataFrame, shortest: int = 6, slip: int | None = SLIP, text: str = "text",
                doc_id: str = "doc_id") -> DataFrame:
    """Rows (word, n): lower-cased (A-Z) runs of letters of all texts with ``shortest`` code
    points or more, and their number.

    With ``slip``, the runs of one document whose crc32 of ``<doc_id>:<run>`` it divides lose
    the code point that the crc32 names. Null texts have no words, a null doc_id no digits.
    """
    small_batches(docs)
    find = f"[{LETTERS}]{{{shortest},}}"

    def run(batches):
        words = re.compile(find).findall
        counts: dict[str, int] = {}
        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if raw is None:
                    continue
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in Counter(words(raw.lower().decode("utf-8", "replace"))).items():
                    if slip:
                        code = zlib.crc32(word.encode(), start)
                        if code % slip == 0:
                            place = code % len(word)
                            word = word[:place] + word[place + 1:]
                            if len(word) < shortest:
                                continue
                    counts[word] = counts.get(word, 0) + n
                if len(counts) >= REMEMBERED:
                    yield from _counted(counts)
                    counts = {}
        yield from _counted(counts)

    source = docs.select(F.col(doc_id).cast("string").alias("0id"),
                         F.col(text).cast("string").cast("binary").alias("0text"))
    return source.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(counts: dict[str, int]):
    for some in parts(counts.items(), 100_000):
        words, numbers = zip(*some)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(numbers, pa.int64())],
                                         names=["word", "n"])


def _halves(length, side: int):
    """Length of the half that a word of this length keeps exactly: the left one is the shorter."""
    return F.floor((length + side) / 2).cast("int")


def _routes(words: DataFrame) -> DataFrame:
    """Rows (side, half, asks, word, n): where each word is found, and where it asks."""
    length = F.char_length("word")

    def half(side, size):
        return F.substr("word", F.lit(1), size) if side == 0 else F.substr("word", length - size + 1, size)

    def route(side, asks, size):
        return F.struct(F.lit(side).alias("side"), half(side, size).alias("half"), F.lit(asks).alias("asks"))

    found = [F.array_distinct(F.array(*[route(side, False, _halves(length + more, side)) for more in (-1, 0, 1)]))
             for side in (0, 1)]
    asking = F.array(*[route(side, True, _halves(length, side)) for side in (0, 1)])
    return words.select("word", "n", F.explode(F.concat(*found, asking)).alias("r")).select("r.*", "word", "n")


def near_words(words: DataFrame) -> DataFrame:
    """Rows (word, n_near, best_n, best) of the words that have near words among ``words``:
    how many, and of these the one of largest n, the smallest in code-point order if several.

    ``words`` has different words (without zero characters) and their n.
    """
    total = words.count()
    routes = _routes(words)
    limit = max(INDEX_WORDS, -(-5 * total // HOT_HALVES))
    hot = (routes.where("not asks").groupBy("side", "half").agg(F.count("*").alias("size")).where(F.col("size") > limit)
           .withColumn("blocks", F.ceil(F.col("size") / limit).cast("int")))
    # at most 4 total / limit rows, so no more than HOT_HALVES
    routes = routes.join(F.broadcast(hot.drop("size")), ["side", "half"], "left")
    routes = routes.withColumn("block", F.explode(
        F.when(F.col("blocks").isNull(), F.array(F.lit(0)))
        .when(F.col("asks"), F.sequence(F.lit(0), F.col("blocks") - 1))
        .otherwise(F.array(F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")))))
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-4 * total // INDEX_WORDS))
    dealt = routes.repartition(tasks, "side", "half", "block").select(
        "side", "asks", "word", "n", F.when(F.col("blocks").isNotNull(), F.col("half")).alias("cut"))
    partial = dealt.mapInArrow(_search, "word string, n_near bigint, best_n bigint, best string")
    # by two steps: fewest of the negative count first, then the smallest word
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("b")
    return (partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
            .select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best")))


def _search(batches):
    """Near words of a task's rows: every word that asks, in every index of up to INDEX_WORDS words."""
    frames = [b for b in batches if b.num_rows]
    if not frames:
        return
    rows = pa.Table.from_batches(frames)
    asks = rows.column("asks").to_numpy()
    words = rows.filter(~asks).to_pydict()
    counts = dict(zip(words["word"], words["n"]))
    # A word that asks under a cut half may meet words of its other blocks, which another task
    # (or a half that came here by chance) gives: it takes those that came under its half.
    under: dict = {}
    for side, cut, word in zip(words["side"], words["cut"], words["word"]):
        if cut is not None:
            under.setdefault((side, cut), set()).add(word)
    asking = rows.filter(asks).to_pydict()
    cuts: tuple[dict, dict] = {}, {}  # the words that ask on each side, once
    for side, cut, word in zip(asking["side"], asking["cut"], asking["word"]):
        cuts[side][word] = cut
    del rows, frames, words, asking
    for some in parts(sorted(counts), INDEX_WORDS):
        index = Vocabulary(some)
        numbers = np.array([counts[w] for w in some], np.int64)
        for side in (0, 1):
            queries = list(cuts[side])
            if not queries:
                continue
            query, found = index.one_error(queries, side == 0)
            keep = np.ones(len(query), bool)
            for i, (q, w) in enumerate(zip(query.tolist(), found.tolist())):
                text, cut = queries[q], cuts[side][queries[q]]
                if cut is not None and some[w] not in under.get((side, cut), ()):
                    keep[i] = False
                elif side == 1 and some[w].startswith(text[:len(text) // 2]):
                    keep[i] = False  # found on the other side
            query, found = query[keep], found[keep]
            if not len(query):
                continue
            order = np.lexsort((found, -numbers[found], query))
            query, found = query[order], found[order]
            first = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([queries[q] for q in query[first]], pa.string()),
                 pa.array(np.diff(np.append(first, len(query))), pa.int64()),
                 pa.array(numbers[found[first]], pa.int64()),
                 pa.array([some[w] for w in found[first]], pa.string())],
                names=["word", "n_near", "best_n", "best"])


def roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root) of rows (word, form): the last of the forms that follow each other.

    Each round lets every word jump to the root of its root and is written to the shared
    folder; a chain of k forms takes log2(k) rounds. Chains must not be rings.
    """
    now = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = store(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                              F.col("next").isNotNull().alias("moved")), "roots")
        now = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return now


def variants(docs: DataFrame, shortest: int = 6, least: int = 5, times: int = 5, slip: int | None = SLIP,
             text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) of the words that occur ``least`` times or more.

    Near words differ by one code point inserted, deleted or replaced. A word's form is its
    near word of largest n (the smallest in code-point order if several), if that n is at
    least ``times`` its own, else null; its root is the last form that follows, or the word.
    Tables without words give no rows; further columns of docs are not looked at.
    """
    if times < 2:
        raise ValueError("forms must be more frequent than their words")
    words = store(word_counts(docs, shortest, slip, text, doc_id).where(F.col("n") >= least), "words")
    near = near_words(words)
    is_form = F.col("best_n") >= times * F.col("n")
    named = store(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    last = roots(named.where("form is not null"))
    return named.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
