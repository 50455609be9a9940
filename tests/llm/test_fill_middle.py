"""Fill-in-the-middle texts against a plain version, and the exact way back."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from seriesflow.llm import fill_middle
from tests.llm.conftest import edge_rows

LETTERS = "ab<>PSM é漢😀\n\x00"


def plainly(doc_id, text, seed="1", plain=10, spm=20):
    text = text or ""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("block", [1 << 20, 7])
def test_batches_equal_the_plain_version(monkeypatch, block):
    monkeypatch.setattr(fill_middle, "BLOCK", block)
    rng = random.Random(3)
    for size in (0, 1, 2, 40):
        for _ in range(40):
            ids = [rng.choice([None, rng.randrange(10**6)]) for _ in range(size)]
            texts = [rng.choice([None, "", "".join(rng.choice(LETTERS) for _ in range(rng.randrange(25)))])
                     for _ in range(size)]
            found = fill_middle._cut(ids, pa.array(texts, pa.string()), "1", 10, 20)
            rows = list(zip(*[c.to_pylist() for c in found]))
            assert rows == [plainly(i, t) for i, t in zip(ids, texts)]
            out, offsets = fill_middle._buffers(found[4])
            forms = np.array([r[1] for r in rows], object)
            back = fill_middle._texts(*fill_middle.gather(out, offsets, forms == "plain", forms == "spm"))
            assert back.to_pylist() == [t or "" for t in texts]


def test_marks_across_a_cut_or_a_border_do_not_count():
    ids = list(range(400))
    texts = ["P>x<S" + "<" * (i % 5) for i in ids]
    found = fill_middle._cut(ids, pa.array(texts), "1", 0, 50)
    assert set(found[1].to_pylist()) == {"psm", "spm"}
    out, offsets = fill_middle._buffers(found[4])
    spm = np.array(found[1].to_pylist(), object) == "spm"
    assert fill_middle._texts(*fill_middle.gather(out, offsets, np.zeros(400, bool), spm)).to_pylist() == texts


def test_edge_rows(edges, none):
    made = fill_middle.transform(edges, edges.columns, plain_percent=0)
    rows = fill_middle.restore(made, made.columns).collect()
    expected = [(r[0], *plainly(r[0], r[1], plain=0)) for r in edge_rows()]
    assert sorted(map(repr, expected)) == sorted(
        repr((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in rows)
    assert all(r.restored == (r.text or "") for r in rows)
    empty = fill_middle.transform(none, ["doc_id"])
    assert fill_middle.restore(empty, empty.columns).count() == 0


def test_clashing_names_are_replaced(spark):
    docs = spark.createDataFrame([(1, "some text", "x", 3)], "doc_id bigint, text string, output string, n bigint")
    made = fill_middle.transform(docs, docs.columns)
    assert made.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert made.first().n == 9
