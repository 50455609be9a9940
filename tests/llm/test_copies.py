"""SimHash components, repeated passages, benchmark templates: brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from seriesflow.llm import repeats, simhash, templates
from tests.llm.conftest import PASSAGE, edge_rows


def brute_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """(fingerprint, component) of (doc_id, text) rows, all pairs of fingerprints compared."""
    prints = [brute_fingerprint(t) for _, t in rows]
    different = sorted(set(prints))
    root = {f: f for f in different}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(different):
        for b in different[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for (i, _), f in zip(rows, prints):
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return sorted((str(i), f"{f:016x}", str(least.get(find(f)))) for (i, _), f in zip(rows, prints))


def test_trie_join_finds_all_pairs():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 200, dtype=np.int64).astype(np.uint64)
    flips = [base[:80] ^ np.uint64(1 << b) for b in (0, 31, 63)] + [base[:40] ^ np.uint64(5 << 40)]
    values = np.unique(np.concatenate([base, *flips]))
    for budget in (0, 1, 2, 3):
        for small in (1 << 20, 16):
            simhash.FRONTIER = small
            a, b = simhash.trie_join(values[:250], values[100:], budget)
            assert sorted(zip(a.tolist(), b.tolist())) == [
                (i, j) for i in range(250) for j in range(len(values) - 100)
                if int(values[i] ^ values[100 + j]).bit_count() <= budget]
    simhash.FRONTIER = 1 << 20


@pytest.mark.parametrize("slice_rows", [1 << 18, 20])
def test_links_have_the_components_of_all_pairs(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(simhash, "SLICE_ROWS", slice_rows)
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(150)}
    for v in list(values)[:50]:
        for _ in range(4):  # chains
            v ^= 1 << rng.randrange(64)
            v ^= 1 << rng.randrange(64)
            values.add(v)
    values |= {i for i in range(40)}  # one node holds them all
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    found = simhash.components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp_ bigint"), 2))
    root = {r.v: r.root for r in found.collect()}
    group = {v: root.get(s, s) for v, s in zip(values, signed)}
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    ordered = sorted(values)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    for a in ordered:
        for b in ordered:
            assert (find(a) == find(b)) == (group[a] == group[b])


def test_components_of_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    rows += [(10_000 + i, t + " x" * (i % 2)) for i, t in rows[:40]]
    spark = documents.sparkSession
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = sorted((str(r.doc_id), r.fingerprint, str(r.component_id))
                   for r in simhash.near_components(docs).collect())
    assert found == brute_components(rows)


def test_simhash_on_edges(edges, none):
    rows = simhash.near_components(edges, keep=edges.columns).collect()
    found = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows)
    assert found == brute_components([r[:2] for r in edge_rows()])
    assert {r.score for r in rows} == {"s"}
    assert simhash.near_components(none).count() == 0


def brute_repeats(rows, size=20):
    """(n_words, kept words) of each row, ids in order, nulls last."""
    seen, out = set(), {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][2]))
    for i in order:
        doc, text, tie = rows[i]
        if (doc, text) in out:
            continue
        words = (text or "").encode().split()
        gone = set()
        for k in range(len(words) - size + 1):
            window = tuple(words[k:k + size])
            if window in seen:
                gone.update(range(k, k + size))
            seen.add(window)
        out[doc, text] = len(words), [w for k, w in enumerate(words) if k not in gone]
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_windows_of_random_words(monkeypatch, hot):
    rng = random.Random(3)
    for trial in range(120):
        size = rng.choice([3, 5, 20])
        docs = [[rng.choice([b"a", b"b", b"cc"]) for _ in range(rng.randint(0, 60))] for _ in range(6)]
        if trial % 3 == 0:
            docs[3], docs[4] = docs[1][:], docs[1][5:40]
        monkeypatch.setattr(repeats, "LONGEST", rng.choice([1, 4, 2048]))
        none = np.zeros(0, np.uint64)
        marked = np.unique(repeats._kmers_of(docs, size, none)[5])[::2] if hot else none
        flat, text, start, first, sizes, minimiser = repeats._kmers_of(docs, size, marked)
        buckets = {}
        for k in range(len(first)):
            content = b" ".join(flat[first[k]:first[k] + sizes[k] + size - 1])
            buckets.setdefault(int(minimiser[k]) % 3, []).append(
                (int(text[k]), 0, int(start[k]), int(sizes[k]), content))
        found = set()
        for some in buckets.values():
            rng.shuffle(some)
            halves = [h for h in (some[:len(some) // 2], some[len(some) // 2:]) if h]
            payloads = [repeats.pack(*([r[i] for r in h] for i in range(5))) for h in halves]
            for i, _, s, n in zip(*repeats._decided(payloads, size)):
                found |= {(int(i), int(s) + k) for k in range(int(n))}
        seen, wanted = set(), set()
        for d, words in enumerate(docs):
            for k in range(len(words) - size + 1):
                if tuple(words[k:k + size]) in seen:
                    wanted.add((d, k))
                seen.add(tuple(words[k:k + size]))
        assert found == wanted


def test_equal_hashes_of_different_windows(monkeypatch):
    monkeypatch.setattr(repeats, "_power", lambda base, n: np.uint64(0))
    contents = [b"a b c d z", b"q b c d z", b"a b c d z"]
    ids, zero = np.arange(3), np.zeros(3, np.int64)
    found = repeats.find_repeats(ids, zero, zero, np.full(3, 3), contents, 3)
    assert sorted((int(i), int(s), int(n)) for i, _, s, n in zip(*found)) == [(1, 1, 2), (2, 0, 3)]


def with_ties(spark, rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    ties = docs.select("doc_id", "text", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tie")).collect()
    return [(r.doc_id, r.text, r.tie) for r in ties]


@pytest.mark.parametrize("hot", [False, True])
def test_removal_on_edges(spark, edges, none, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(repeats, "hot_minimisers", lambda source, size: np.sort(
            repeats._kmers_of([PASSAGE.encode().split()], size, np.zeros(0, np.uint64))[5]))
    wanted = brute_repeats(with_ties(spark, [r[:2] for r in edge_rows()]))
    rows = repeats.remove_repeats(edges, keep=edges.columns).collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        n, kept = wanted[r.doc_id, r.text]
        assert (r.n_words, r.n_removed, r.kept_text) == (n, n - len(kept), b" ".join(kept).decode())
    hashed = repeats.remove_repeats(edges, keep=["doc_id", "text"], digest=True).collect()
    for r in hashed:
        assert r.kept_sha256 == hashlib.sha256(b" ".join(wanted[r.doc_id, r.text][1])).hexdigest()
    assert repeats.remove_repeats(none).count() == 0


def test_removal_over_documents_with_a_shared_passage(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, t + " " + passage + " " + t[:50] if i % 3 == 0 else t) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    wanted = brute_repeats(with_ties(spark, rows))
    source = repeats._identified(docs, "text", "doc_id")
    assert len(repeats.hot_minimisers(source, 20))
    for r in repeats.remove_repeats(docs, keep=["doc_id", "text"]).collect():
        n, kept = wanted[r.doc_id, r.text]
        assert (r.n_words, r.kept_text) == (n, b" ".join(kept).decode())


def one(item, text, **settings):
    matching = templates.Matching(**settings)
    return [row[1:] for row in templates.matches([text], templates.Items([(7, item)], matching), templates.Reader())]


ITEM = "Then Tom Baker bought 3 kg of apples and Tom Baker sold 2 kg of these apples to Anna for 5 dollars."


def test_other_numbers_names_and_units_are_found():
    other = "So it went. Then Mia Jones bought 7.5 km of apples and Mia Jones sold nine km of these apples to Eve for 11 euros. End"
    assert one(ITEM, other) == [(7, 15, 1.0)]
    for text in (ITEM.lower(), ITEM.upper(), ITEM.title()):
        assert [(i, share) for i, _, share in one(ITEM, f"so it went. {text} and more")] == [(7, 1.0)]
    assert one(ITEM, ITEM) == [(7, 15, 1.0)]


CASES = (str, str.lower, str.upper, str.title)


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("item, other", [
    ("What is the capital of France?", None),
    ("The old farmer sold 5 apples and 5 pears to his two neighbours that day.",
     "The old farmer sold 9 apples and 7 pears to his two neighbours that day."),
    ("A bag of 5 kg falls 12 m in the first second, how far in the next?",
     "A bag of 7kg falls 30m in the first second, how far in the next?"),
    ("Then in 1905 Albert Einstein wrote four papers in Bern that changed what Max Planck and Marie Curie had thought.", None),
    ("The price is 5 kg for 15 dollars and 15 cents.", "The price is 8kg for 3 dollars and 99 cents."),
])
def test_any_case_joined_units_and_shared_values(case, item, other):
    for text in (item, other or item):
        found = one(item, f"we read, as always, {case(text)} and so on")
        assert len(found) == 1 and found[0][2] > 0.8, text
    assert one(item, "we read, as always, nothing of the kind in 15 dollars and then some more of it") == []


def brute_items(item, text, matching=templates.Matching()):
    """Words of the item covered by windows whose template words are equal one by one, when
    slots are left out of account (an upper bound), or whose words are (a lower bound)."""
    def words(source, plain):
        reader = templates.Reader()
        form, free, word, _ = reader.read([source])
        names = list(reader.forms)
        return [templates.bare(reader.raw[w]) for w in word] if plain else [names[f] for f in free]

    found = []
    for plain in (True, False):
        ours, theirs = words(item, plain), words(text, plain)
        size = min(matching.size, len(ours))
        covered = {b + i for b in range(len(ours) - size + 1) for p in range(len(theirs) - size + 1)
                   if ours[b:b + size] == theirs[p:p + size] for i in range(size)} if size else set()
        found.append(2 * len(covered) >= len(ours) > 0)
    return found


def test_random_items_against_brute_force():
    import random

    rng = random.Random(6)
    vocabulary = [f"w{c}" for c in "abcdefghijkl"]
    some = lambda n: [rng.choice(vocabulary) if rng.random() < 0.9 else str(rng.randint(1, 3)) for _ in range(n)]
    hits = 0
    for _ in range(1500):
        ours = some(rng.randint(1, 24))
        theirs = some(rng.randint(0, 10)) + [w if rng.random() < 0.97 else "other" for w in ours] + some(5)
        if rng.random() < 0.3:
            theirs = some(30)
        item, text = " ".join(ours), rng.choice(CASES)(" ".join(theirs))
        equal, alike = brute_items(item, text)
        found = bool(one(item, text))
        assert equal <= found, (item, text)
        if not any(w.isdigit() for w in ours) and len(ours) >= 8:
            assert found <= alike, (item, text)
        hits += found
    assert 500 < hits < 1500


def test_slots_that_do_not_fit_are_not_found():
    assert one(ITEM, "Then Mia Jones bought 7 km of apples and Bob Lee sold 9 kg of these apples to Eve for 11 euros.") == []
    # two names of the item cannot answer to one
    assert one("x y met Ann Lee then z met Bob Ray there", "x y met Ann Lee then z met Ann Lee there") == []


PAID = "Anna Lee, Bob Ray and Carl Poe paid 3 dollars, 4 dollars and 5 dollars."


@pytest.mark.parametrize("item, other", [
    ("What is 15 plus 27?", "What is 3 plus 9?"),
    ("Who wrote Romeo and Juliet?", "Who wrote Tristan and Isolde?"),
    ("Is a cat a mammal?", "is a cat a mammal"),
    ("Convert 5 kg to g.", "Convert 12 mg to g."),
    ("Solve 3 x + 4 = 19", "Solve 7 x + 2 = 16"),
    (PAID, "Mia Fox, Eve Kay and Tom Roe paid 6 euros, 7 euros and 8 euros."),
])
def test_short_items_and_items_full_of_slots(item, other):
    for text in (item, other):
        for before in ("", "So it went. ", "they had it as ", "In part 7 "):
            found = one(item, f"{before}{text} then more")
            assert [(i, share) for i, _, share in found] == [(7, 1.0)], (before, text)


def test_passages_full_of_slots_need_equal_words_or_the_whole_item():
    assert one(PAID, "Mia May, Eve May and Tom Roe paid 6 euros, 7 euros and 8 euros.") == []  # two names for one
    assert one(PAID, "Ann Lee and Bob Ray and Carl Poe paid 6 euros, 7 euros and 8 euros.") == []
    assert one(PAID, "so Bob Ray and Carl Poe paid 3 dollars, 4 dollars and 5 dollars.") == [(7, 6, 13 / 15)]
    assert one("What is 15 plus 15?", "What is 3 plus 9?")[0][2] == 1.0  # two numbers that happen to be equal
    twice = "He took 3 kg of it home and then sold 3 kg of it again."  # one quantity
    assert one(twice, twice.replace("3", "8")) and not one(twice, "He took 8 kg of it home and then sold 9 kg of it again.")
    assert one("3 4 5", "so 3 4 5") == [(7, 1, 1.0)] and one("3 4 5", "so 6 7 8") == []
    # letters are units after a number only
    assert one("pipes of 5 m or 3 m in a row", "pipes of 6 km or 2 km in a row") == [(7, 3, 1.0)]
    assert one("is a cat", "is m cat") == []


def test_short_items_and_partial_passages():
    assert one("five short words only here", "so five short words only here too") == [(7, 1, 1.0)]
    assert one("five short words only here", "five short words only there") == []
    words = [f"word{i}" for i in range(40)]
    assert one(" ".join(words), " ".join(words[5:18]) + " etc")[0][1:] == (6, 13 / 40)
    assert one(" ".join(words), " ".join(words[5:15])) == []


def test_documents_that_hold_items_are_found(spark, documents, sf):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = [(r.item_id, " ".join(r.text.split())) for r in benchmark.collect()]
    rows = [(r.doc_id, " ".join(r.text.split())) for r in documents.collect()]
    wanted = {(d, i) for d, t in rows for i, s in items if s in t}
    for blocks in (10**6, 50):
        found = templates.contaminations(documents, benchmark, templates.Matching(block_windows=blocks)).collect()
        got = {(r.doc_id, r.item_id) for r in found}
        assert wanted and wanted <= got and len(found) == len(got)
        hit = {d for d, _ in got}
        left = templates.without_contaminations(documents, benchmark, templates.Matching(block_windows=blocks))
        assert left.columns == documents.columns
        assert {r.doc_id for r in left.collect()} == {d for d, _ in rows} - hit


def test_templates_on_edges(spark, edges, none):
    benchmark = spark.createDataFrame([(1, PASSAGE), (None, "x"), (2, None), (3, ""), (4, "!!"), (1, PASSAGE)],
                                      "item_id bigint, text string")
    found = templates.contaminations(edges, benchmark, keep=edges.columns).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 1), (None, 1)}
    assert {r.score for r in found} == {"s"}
    assert templates.contaminations(none, benchmark).count() == 0
    assert templates.contaminations(edges, benchmark.limit(0)).count() == 0
    left = templates.without_contaminations(edges, benchmark)
    assert left.columns == edges.columns and left.count() == len(edge_rows()) - 4
