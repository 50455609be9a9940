"""SentencePiece encoding and decoding of a pair-merging model, without the library.

A text is cut into words at places that no piece of the vocabulary reaches over, as found
when the model is read: where a space mark follows another character (a model with pieces
across such places gets whole texts as words), and before marks that no piece has behind a
letter, if the text has them behind no other character that pieces join with them. The different words of a slice are laid end to end
in flat arrays and merged in rounds (``merges.merge_words``).
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, types as T

from seriesflow.llm.common import add_columns, parts, share
from seriesflow.llm.merges import Pairs, merge_words

SPACE = "▁"
REMEMBERED = 600_000  # words kept in a task before the memory starts afresh
LONG_TEXT = 8 << 20  # characters; longer texts are read in parts
WORDS = 500_000  # of one long text at a time
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class PieceModel:
    """Pieces, merge table and byte pieces of a model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        kinds = {p.type for p in proto.pieces}
        plain = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE} \
                or plain.precompiled_charsmap or plain.remove_extra_whitespaces \
                or proto.denormalizer_spec.precompiled_charsmap \
                or proto.trainer_spec.treat_whitespace_as_suffix or not proto.trainer_spec.byte_fallback:
            raise ValueError("not a plain pair-merging model with byte pieces")
        self.dummy_prefix = plain.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.bytes = np.zeros(256, np.int64)
        self.surface = []
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = i
                self.surface.append(bytes([int(p.piece[1:-1], 16)]))
            elif p.type == NORMAL:
                self.surface.append(p.piece.replace(SPACE, " ").encode())
            else:
                self.surface.append(b" \xe2\x81\x87 " if p.type == UNKNOWN else b"")
        self.surface = np.array(self.surface, object)
        self.digits = np.array([str(i) for i in range(len(self.surface))], object)
        # marks before which a text may be cut, unless one of some characters precedes them
        before = {c: {p[i - 1] for p in self.ids for i in range(1, len(p)) if p[i] == c}
                  for c in MARKS}
        self.marks = [c for c in MARKS if not any(x.isalpha() for x in before[c])]
        self.blocked = "|".join(f"[{re.escape(''.join(sorted(before[c] - {SPACE})))}]{re.escape(c)}"
                                for c in self.marks if before[c] - {SPACE})
        self.whole_texts = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        # symbols: ids of pieces, then further characters that occur in pieces
        self.symbol = dict(self.ids)
        for piece in self.ids:
            for c in piece:
                self.symbol.setdefault(c, len(proto.pieces) + len(self.symbol))
        size = max(self.symbol.values()) + 1
        rank = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        splits = [(self.symbol[p[:k]], self.symbol[p[k:]], rank[score[p]], i)
                  for p, i in self.ids.items() for k in range(1, len(p))
                  if p[:k] in self.symbol and p[k:] in self.symbol]
        self.pairs = Pairs(*(zip(*splits) if splits else ((), (), (), ())), size)
        self.n_pieces = len(proto.pieces)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words (none empty; spaces already marked) end to end, and their numbers."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        text = "".join(words)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kinds, back = np.unique(points, return_inverse=True)
        table = np.array([self.symbol.get(chr(c), -1 - i) for i, c in enumerate(kinds)], np.int64)
        symbols, lengths = merge_words(table[back], np.array([len(w) for w in words]), self.pairs)
        # characters without a piece become their bytes
        known = (symbols >= 0) & (symbols < self.n_pieces)
        if not known.all():
            unknown = {s: chr(kinds[-1 - s]) if s < 0 else None for s in np.unique(symbols[~known]).tolist()}
            extra = {i: c for c, i in self.symbol.items() if i >= self.n_pieces}
            spelt = {s: self.bytes[list((c or extra[s]).encode())] for s, c in unknown.items()}
            sizes = np.ones(len(symbols), np.int64)
            where = np.flatnonzero(~known)
            sizes[where] = [len(spelt[s]) for s in symbols[where].tolist()]
            ids = np.repeat(symbols.astype(np.int64), sizes)
            ids[np.repeat(~known, sizes)] = np.concatenate([spelt[s] for s in symbols[where].tolist()])
            word = np.repeat(np.arange(len(words)), lengths)
            lengths = np.bincount(word, sizes, len(words)).astype(np.int64)
            symbols = ids
        return symbols, lengths

    def words(self, text: str):
        """Words of a text as the model reads it."""
        if not text:
            return []
        text = (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)
        if self.whole_texts:
            return [text]
        if DOUBLE in text or len(text) > LONG_TEXT or "\x00" in text:
            return (m.group() for m in WORD.finditer(text))
        text = text.replace(SPACE, "\x00" + SPACE)
        if not (self.blocked and re.search(self.blocked, text)):
            for mark in self.marks:
                if SPACE + mark not in text:
                    text = text.replace(mark, "\x00" + mark)
        return [w for w in text.split("\x00") if w]

    def encode(self, text: str) -> list[int]:
        return self.encode_words(list(self.words(text)))[0].tolist()

    def decode(self, ids) -> str:
        """Text of ids: pieces joined, byte pieces put together to characters, a broken
        character read as U+FFFD for each byte, the space before the text taken off."""
        raw = b"".join(self.surface[np.asarray(ids, np.int64)])
        if self.dummy_prefix and raw.startswith(b" ") and self._first_is_space(ids):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")

    def _first_is_space(self, ids) -> bool:
        first = next((s for s in self.surface[np.asarray(ids, np.int64)] if s), b"")
        return first.startswith(b" ") and first != b" \xe2\x81\x87 "


DOUBLE = SPACE + SPACE
MARKS = ",.\n"
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def text_coder(model: PieceModel):
    """Function from a list of texts to token counts, joined ids and decoded bytes.

    The decoded text is put together from the surfaces of the ids found, never copied
    from the input.
    """
    memory: dict[str, tuple[int, str, bytes]] = {}

    def learn(words):
        new = [w for w in words if w not in memory]
        if len(memory) + len(new) > REMEMBERED:
            memory.clear()
            new = list(words)
        ids, lengths = model.encode_words(new)
        digits, surfaces = model.digits[ids].tolist(), model.surface[ids].tolist()
        a = 0
        for word, n in zip(new, lengths.tolist()):
            memory[word] = n, ",".join(digits[a:a + n]), b"".join(surfaces[a:a + n])
            a += n

    def joined(parts_of_words):
        n, ids, raw = 0, [], []
        for some in parts_of_words:
            found = [memory[w] for w in some]
            if found:
                sizes, digits, surfaces = zip(*found)
                n += sum(sizes)
                ids.append(",".join(digits))
                raw.append(b"".join(surfaces))
        whole = b"".join(raw)
        return n, ",".join(ids), whole[1:] if model.dummy_prefix and whole[:1] == b" " else whole

    def in_parts(text):
        for some in parts(model.words(text), WORDS):
            learn(set(some))
            yield some

    def code(texts: list[str]):
        out = [joined(in_parts(t)) if len(t) > LONG_TEXT else None for t in texts]
        split = [list(model.words(t)) if done is None else None for t, done in zip(texts, out)]
        learn(set().union(*(s for s in split if s)))
        return [joined([words]) if done is None else done for words, done in zip(split, out)]

    return code


def encode_texts(docs: DataFrame, path: str, keep: list[str] | None = None, text: str = "text",
                 digests: bool = False) -> DataFrame:
    """Ids and decoded text of every text, beside columns ``keep``.

    ``n_tokens`` and ``ids``, ``decoded``; with ``digests`` the SHA-256 of the decimal ids
    joined by commas and of the decoded text in UTF-8 instead. One row per input row, in no
    given order, repeated rows and null ids included; null and empty texts have no ids and
    decode to the empty text. An input column named like a new one is replaced. No begin or
    end ids. The model's tables are broadcast; their size is the file's.
    """
    shared = share(docs, PieceModel(path))

    def make():
        code = text_coder(shared())

        def work(texts):
            found = list(code([(t or b"").decode() for t in texts]))
            n = [f[0] for f in found]
            if digests:
                return (n, [hashlib.sha256(f[1].encode()).hexdigest() for f in found],
                        [hashlib.sha256(f[2]).hexdigest() for f in found])
            return (n, [[int(i) for i in f[1].split(",")] if f[1] else [] for f in found],
                    [f[2].decode() for f in found])

        return work

    fields = [("n_tokens", T.LongType())] + (
        [("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())] if digests
        else [("ids", T.ArrayType(T.LongType())), ("decoded", T.StringType())])
    return add_columns(docs, make, fields, ["doc_id"] if keep is None else keep, text)
