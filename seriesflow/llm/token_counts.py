"""Token counts of a byte-level pair vocabulary, most of them without a merge.

Vocabulary strings that encode alone as one token are found beforehand by running the
merges on the vocabulary itself. A pre-token among them counts one at once; the others
are merged, all different ones of a slice together.
"""

from __future__ import annotations

import json
import re

import numpy as np
import regex
from pyspark.sql import DataFrame, types as T

from seriesflow.llm.common import add_columns, parts, share
from seriesflow.llm.merges import Pairs, merge_words

# Fixed value: the pattern of the byte-level pre-tokeniser.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
# White space as the pattern has it, and chunks of it with the characters that follow.
_WHITE = " \t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNKS = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
SPACED = re.compile(f"[{_WHITE}] ")
CUT = "\x00 "  # a space with a mark to split at
PRE_TOKENS = 500_000  # chunks of one text at a time
LONG_TEXT = 8 << 20  # characters; longer texts are read in parts
REMEMBERED = 1_000_000  # counts kept in a task before the memory starts afresh


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself where it is a
    visible Latin-1 character, else the next free one from code point 256."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, free = [], 256
    for byte in range(256):
        if byte in visible:
            letters.append(chr(byte))
        else:
            letters.append(chr(free))
            free += 1
    return letters


class Vocabulary:
    """Merge table, byte symbols, whole tokens and special strings of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        step = spec["pre_tokenizer"]
        if (step["type"], step.get("use_regex", True), spec["normalizer"]) != ("ByteLevel", True, None) \
                or step["add_prefix_space"] or model.get("ignore_merges"):
            raise ValueError("not a plain byte-level pair vocabulary")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pairs = Pairs([vocab[a] for a, _ in merges], [vocab[b] for _, b in merges],
                           range(len(merges)), [vocab[a + b] for a, b in merges],
                           max(vocab.values()) + 1)
        letters = byte_letters()
        self.byte_ids = np.array([vocab[c] for c in letters], np.int32)
        self.special = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special strings that take in their surroundings")
        byte_of = {c: i for i, c in enumerate(letters)}
        raw = [bytes(byte_of[c] for c in s) for s in vocab if s and all(c in byte_of for c in s)]
        self.whole = frozenset(s for s, n in zip(raw, self.merged_counts(raw)) if n == 1)

    def merged_counts(self, words: list[bytes]) -> list[int]:
        """Number of tokens of each pre-token (none empty) by merging."""
        if not words:
            return []
        flat = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        return merge_words(flat, np.array([len(w) for w in words]), self.pairs)[1].tolist()


def counter(vocabulary: Vocabulary):
    """Function from texts (str) to token counts.

    No pre-token has white space behind other characters, so the text may be cut before
    any space that follows a visible character: such chunks are split and counted by
    themselves, and the counts of chunks are remembered. Pre-tokens that are whole tokens
    count one at once; all others of a slice are merged together.
    """
    pattern = regex.compile(PATTERN)
    special = regex.compile("|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))))
    whole = set()
    for raw in vocabulary.whole:
        try:
            whole.add(raw.decode())
        except UnicodeDecodeError:
            pass  # part of a character: never a pre-token
    counts: dict[str, int] = {}
    merged: dict[str, int] = dict.fromkeys(whole, 1)

    def learn(chunks):
        """Remember the counts of chunks; the first of a text may lack the space before it."""
        new = [c for c in chunks if c not in counts]
        if len(counts) + len(new) > REMEMBERED:
            counts.clear()
            new = list(chunks)
        if len(merged) > len(whole) + REMEMBERED // 2:
            merged.clear()
            merged.update(dict.fromkeys(whole, 1))
        if not new:
            return
        bare = [c for c in new if c[0] != " " or c[-1].isspace()]
        spaced = [c for c in new if c[0] == " " and not c[-1].isspace()]
        tokens = pattern.findall("".join(spaced))
        per_chunk = np.searchsorted(np.cumsum([len(c) for c in spaced]),
                                    np.cumsum([len(t) for t in tokens]))
        own = [pattern.findall(c) for c in bare]
        rest = [t for t in set(tokens).union(*own) if t not in merged]
        merged.update(zip(rest, vocabulary.merged_counts([t.encode() for t in rest])))
        each = np.bincount(per_chunk, list(map(merged.__getitem__, tokens)), len(spaced))
        counts.update(zip(spaced, each.astype(int).tolist()))
        for chunk, found in zip(bare, own):
            counts[chunk] = sum(map(merged.__getitem__, found))

    def chunks_of(segment):
        if SPACED.search(segment):
            return CHUNKS.findall(segment)
        if CUT[0] in segment:
            return CHUNKS.findall(segment)
        pieces = segment.replace(" ", CUT).split(CUT[0])
        return pieces if pieces[0] else pieces[1:]

    def count(texts: list[str]) -> list[int]:
        split, totals = [], []
        for text in texts:
            segments = special.split(text) if vocabulary.special else [text]
            total = len(segments) - 1
            chunks = []
            for segment in segments:
                if len(segment) <= LONG_TEXT:
                    chunks += chunks_of(segment)
                else:
                    for some in parts((m.group() for m in CHUNKS.finditer(segment)), PRE_TOKENS):
                        learn(set(some))
                        total += sum(map(counts.__getitem__, some))
            split.append(chunks)
            totals.append(total)
        learn(set().union(*split))
        return [n + sum(map(counts.__getitem__, chunks)) for n, chunks in zip(totals, split)]

    return count


def token_counts(docs: DataFrame, path: str, limit: int = 512, keep: list[str] | None = None,
                 text: str = "text") -> DataFrame:
    """``n_bytes``, ``n_tokens`` and ``over_limit`` of every text, beside columns ``keep``.

    One row per input row in no given order, repeated rows and null ids included; null and
    empty texts have no bytes and no tokens. An input column named like a new one is
    replaced. The vocabulary is read on the driver and broadcast; its size is the file's.
    """
    shared = share(docs, Vocabulary(path))

    def make():
        count = counter(shared())

        def work(texts):
            n = count([(t or b"").decode() for t in texts])
            return [len(t or b"") for t in texts], n, [x > limit for x in n]

        return work

    fields = [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType())]
    return add_columns(docs, make, fields, ["doc_id"] if keep is None else keep, text)
