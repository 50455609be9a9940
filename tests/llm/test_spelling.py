"""Spelling variants against brute force, and the index against plain comparison."""

import random
import re
import zlib
from collections import Counter

import pytest

from seriesflow.llm import spelling
from seriesflow.llm.fm_index import Vocabulary
from tests.llm.conftest import COLUMNS, edge_rows

COMMON = ["harbour", "harbours", "harbor", "weather", "whether", "planet", "planets", "élément", "elément", "straße",
          "zzzzzz", "zzzzzzz", "abcabc", "abcabcabc"]


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, shortest=6, least=5, times=5, slip=199):
    counts = Counter()
    for doc_id, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip and h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= shortest:
                counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= least}
    around = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    rows = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n[w], len(around[w]), n[form[w]] if form[w] else None))
    return sorted(rows, key=repr)


def rows_of(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=repr)


@pytest.mark.parametrize("letters", ["ab", "abé", "abcdefgh漢"])
def test_index_finds_all_words_one_edit_apart(letters):
    rng = random.Random(8)
    for _ in range(30):
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(1, 50))})
        queries = words[::2] + ["".join(rng.choice(letters + "x") for _ in range(rng.randint(2, 8))) for _ in range(20)]
        index = Vocabulary(words)
        for left in (True, False):
            found = set(zip(*(x.tolist() for x in index.one_error(queries, left))))
            assert found == {(i, j) for i, q in enumerate(queries) for j, w in enumerate(words) if near(q, w) and (
                w.startswith(q[:len(q) // 2]) if left else w.endswith(q[len(q) // 2:]))}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    words = COMMON + [rng.choice(COMMON)[:4] + "".join(rng.choice("aeinrst") for _ in range(rng.randint(2, 4)))
                      for _ in range(60)]
    words += [w[:i] + rng.choice("aeinrst") + w[i + 1:] for w in words for i in (1, len(w) - 1)]
    weights = [6 ** rng.randint(0, 4) for _ in words]
    rows = [(rng.choice([i, None, 7]), " ".join(rng.choices(words, weights, k=150))) for i in range(250)]
    return rows + [(1, None), (2, ""), (3, "Harbour,HARBOUR;harbour-" * 40), (3, "x" * 100_000)]


@pytest.mark.parametrize("index_words, hot_halves", [(60_000, 100_000), (5, 10**9)])
def test_variants_equal_brute_force(spark, texts, monkeypatch, index_words, hot_halves):
    monkeypatch.setattr(spelling, "INDEX_WORDS", index_words)
    monkeypatch.setattr(spelling, "HOT_HALVES", hot_halves)
    monkeypatch.setattr(spelling, "REMEMBERED", 50)
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    expected = brute(texts)
    assert len({r[2] for r in expected}) < len(expected) and any(r[1] != r[2] for r in expected if r[1])
    assert rows_of(spelling.variants(docs)) == expected


def test_roots_of_long_chains(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(40)] + [("a", "w38"), ("b", "c")]
    found = spelling.roots(spark.createDataFrame(links, "word string, form string")).collect()
    assert {r.word: r.root for r in found} == {**{f"w{i}": "w40" for i in range(40)}, "a": "w40", "b": "c"}


def test_edge_rows_and_empty_tables(spark, edges, none):
    rows = [(r[0], r[1]) for r in edge_rows()]
    assert rows_of(spelling.variants(edges, least=1)) == brute(rows, least=1)
    assert rows_of(spelling.variants(none)) == []
    twice = spark.createDataFrame([(1, "planet planets", *"xyzabcdefg")] * 5, COLUMNS.replace("score", "word").replace(
        "n_chars bigint", "n string"))
    assert rows_of(spelling.variants(twice, slip=None)) == [("planet", None, "planet", 5, 1, None),
                                                            ("planets", None, "planets", 5, 1, None)]
    with pytest.raises(ValueError):
        spelling.variants(edges, times=1)
