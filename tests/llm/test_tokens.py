"""Token counts and piece encoding against the libraries that they must equal."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from seriesflow.llm import pieces, token_counts
from tests.llm.conftest import edge_rows

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LETTERS = "aabbc  \n\t.,'s'll12é漢字  \x1c\x1f\x85\x00ſ́😀▁<s>٣½<0x41>the<|endoftext|>"


def odd_texts():
    rng = random.Random(4)
    some = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    some += ["".join(rng.choice("aberthin -=_*") for _ in range(rng.randint(0, 90))) for _ in range(3000)]
    return some + ["", " ", "a" * 4000, "ab" * 3000, " " * 3000, "=-" * 2000, "x <|endoftext|> y", "  ▁a"]


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.Vocabulary(BYTES)


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(PIECES)


def test_whole_tokens_are_those_that_encode_alone(vocabulary):
    library = Tokenizer.from_file(BYTES)
    letters = token_counts.byte_letters()
    byte_of = {c: i for i, c in enumerate(letters)}
    for raw, i in library.get_vocab().items():
        if i == 50256:
            continue
        text = bytes(byte_of[c] for c in raw)
        alone = library.model.tokenize(raw)
        assert (text in vocabulary.whole) == (len(alone) == 1), raw


@pytest.mark.parametrize("long_text", [8 << 20, 10])
def test_counts_equal_the_library(vocabulary, monkeypatch, long_text):
    monkeypatch.setattr(token_counts, "LONG_TEXT", long_text)
    monkeypatch.setattr(token_counts, "PRE_TOKENS", 7)
    monkeypatch.setattr(token_counts, "REMEMBERED", 500)
    texts = odd_texts()
    library = Tokenizer.from_file(BYTES)
    count = token_counts.counter(vocabulary)
    found = [n for k in range(0, len(texts), 1000) for n in count(texts[k:k + 1000])]
    assert found == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("long_text", [8 << 20, 10])
def test_pieces_equal_the_library(model, monkeypatch, long_text):
    monkeypatch.setattr(pieces, "LONG_TEXT", long_text)
    monkeypatch.setattr(pieces, "WORDS", 7)
    monkeypatch.setattr(pieces, "REMEMBERED", 500)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts, code = odd_texts(), pieces.text_coder(model)
    for k in range(0, len(texts), 1000):
        for text, (n, ids, raw) in zip(texts[k:k + 1000], code(texts[k:k + 1000])):
            wanted = library.encode(text)
            assert (n, ids) == (len(wanted), ",".join(map(str, wanted)))
            assert raw.decode() == library.decode(wanted)


def test_merges_wait_for_better_pairs_made_to_the_left():
    """A merged symbol may pair at a lower rank than the round's: later places wait."""
    import numpy as np

    from seriesflow.llm.merges import Pairs, merge_words

    rng = random.Random(9)
    for _ in range(400):
        size = rng.randint(3, 7)
        table = {}
        for _ in range(rng.randint(1, 12)):
            table.setdefault((rng.randrange(size), rng.randrange(size)), (rng.randrange(6), rng.randrange(size)))
        rows = [(a, b, r, m) for (a, b), (r, m) in table.items()]
        pairs = Pairs(*zip(*rows), size)
        words = [[rng.randrange(size) for _ in range(rng.randint(1, 25))] for _ in range(5)]
        flat, lengths = merge_words(np.array(sum(words, [])), np.array([len(w) for w in words]), pairs)
        wanted = []
        for w in words:
            w = list(w)
            while True:
                best = min(((table[p][0], i) for i, p in enumerate(zip(w, w[1:])) if p in table), default=None)
                if best is None:
                    break
                i = best[1]
                w[i:i + 2] = [table[w[i], w[i + 1]][1]]
            wanted.append(w)
        assert flat.tolist() == sum(wanted, []) and lengths.tolist() == [len(w) for w in wanted]


def test_decode_of_any_ids(model):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = library.encode("  two  spaces é 漢字") + model.encode("☃ snow")
    assert model.decode(ids) == library.decode(ids)
    assert model.decode([]) == ""


def test_queries_on_edges(edges, none):
    library = Tokenizer.from_file(BYTES)
    found = token_counts.token_counts(edges, BYTES, keep=edges.columns).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.score) for r in found) == sorted(
        (str(r[0]), len((r[1] or "").encode()), len(library.encode(r[1] or "").ids), "s") for r in edge_rows())
    assert token_counts.token_counts(none, BYTES).count() == 0
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = pieces.encode_texts(edges, PIECES, ["doc_id", "text"]).collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        assert list(r.ids) == sp.encode(r.text or "") and r.decoded == sp.decode(list(r.ids))
    hashed = pieces.encode_texts(edges, PIECES, ["text"], digests=True).collect()
    for r in hashed:
        ids = sp.encode(r.text or "")
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    assert pieces.encode_texts(none, PIECES).count() == 0
