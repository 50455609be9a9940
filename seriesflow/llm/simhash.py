"""SimHash fingerprints and the components of those that differ in few bits.

The different fingerprints are joined with themselves as a binary trie: pairs of nodes are
walked together from the top bit down, the bits in which their paths differ are added up,
and a pair is given up once they exceed the budget. The walk is dealt out by the nodes of
the first bits: a fingerprint goes to each pair of such nodes within the budget that its
node belongs to. Nodes with very many fingerprints are cut into slices, every slice of one
against every slice of the other.
"""

from __future__ import annotations

import math
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from seriesflow.llm.common import add_columns
from seriesflow.sources.storage import store

SEED = 42
NODE_ROWS = 1 << 16  # fingerprints meant for one node
SLICE_ROWS = 1 << 18  # of a node before it is cut
FRONTIER = 1 << 20  # node pairs walked at a time
LEAF = 8  # node pairs of up to so many fingerprint pairs are compared one by one
_PART = 1 << 18  # shingles at a time


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bits set in over half the hashes of a text's shingles; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for k in range(0, len(starts), _PART):
        pieces = [joined[a:b] for a, b in zip(starts[k:k + _PART], ends[k:k + _PART])]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(pieces))
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        for j in range(0, len(bits), 255):  # sums that fit in a byte
            counts += bits[j:j + 255].sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = 3, text: str = "text") -> DataFrame:
    """Column ``fp_``: the fingerprint as a signed 64-bit integer; null texts have none set."""

    def make():
        def work(texts):
            found = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64)
            return (found.view(np.int64),)

        return work

    return add_columns(docs, make, [("fp_", T.LongType())], keep, text)


def trie_join(left: np.ndarray, right: np.ndarray, budget: int, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the sorted arrays of all pairs that differ in at most ``budget`` bits.

    The arrays hold different unsigned fingerprints; each is the trie's list of leaves,
    and a node is a range of it. All of an array share their first ``depth`` bits, whose
    difference is counted at the start. Pairs of nodes wait on a stack of bounded blocks.
    """
    none = np.zeros(0, np.int64)
    if not len(left) or not len(right):
        return none, none
    shared = (int(left[0]) ^ int(right[0])) >> (64 - depth) if depth else 0
    start = np.array([[0], [len(left)], [0], [len(right)], [shared.bit_count()]], np.int64)
    stack = [(depth, start)] if start[4, 0] <= budget else []
    out_left, out_right = [], []
    while stack:
        level, block = stack.pop()
        if block.shape[1] > FRONTIER:
            half = block.shape[1] // 2
            stack += [(level, block[:, :half]), (level, block[:, half:])]
            continue
        sizes = (block[1] - block[0]) * (block[3] - block[2])
        small = (sizes <= LEAF) | (level == 64)
        if small.any():
            a, b = _expand(block[:, small])
            near = np.bitwise_count(left[a] ^ right[b]) <= budget
            out_left.append(a[near])
            out_right.append(b[near])
            block = block[:, ~small]
        if not block.shape[1]:
            continue
        bit = np.uint64(63 - level)
        cut_left = _cut(left, block[0], block[1], bit)
        cut_right = _cut(right, block[2], block[3], bit)
        low_left, high_left, low_right, high_right, spent = block
        children = np.concatenate([
            np.stack([low_left, cut_left, low_right, cut_right, spent]),
            np.stack([cut_left, high_left, cut_right, high_right, spent]),
            np.stack([low_left, cut_left, cut_right, high_right, spent + 1]),
            np.stack([cut_left, high_left, low_right, cut_right, spent + 1])], axis=1)
        alive = (children[0] < children[1]) & (children[2] < children[3]) & (children[4] <= budget)
        stack.append((level + 1, children[:, alive]))
    return (np.concatenate(out_left), np.concatenate(out_right)) if out_left else (none, none)


def _cut(values, low, high, bit):
    """First position of each range whose fingerprint has the bit set."""
    first = values[low]
    bound = ((first >> bit) | np.uint64(1)) << bit
    return np.clip(np.searchsorted(values, bound), low, high)


def _expand(block):
    """All pairs of positions of the node pairs."""
    rows, columns = block[1] - block[0], block[3] - block[2]
    sizes = rows * columns
    node = np.repeat(np.arange(len(sizes)), sizes)
    k = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return block[0][node] + k // columns[node], block[2][node] + k % columns[node]


def _spanning(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """Smallest member of each member's component in a graph of ``count`` members."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def links(found: DataFrame, budget: int) -> DataFrame:
    """Links (u, v), u < v, whose components are those of all pairs of ``fp_`` (different
    values) within the budget: of each node pair a spanning forest."""
    count = found.count()
    depth = max(4, math.ceil(math.log2(max(1, count) / NODE_ROWS)) if count > NODE_ROWS else 4)
    node = F.shiftrightunsigned("fp_", 64 - depth)
    masks = [0] + [sum(1 << i for i in some) for k in range(1, budget + 1)
                   for some in combinations(range(depth), k)]
    nodes = found.select("fp_", node.alias("node"))
    slices = (nodes.groupBy("node").count()
              .select(F.col("node").alias("n"), F.ceil(F.col("count") / SLICE_ROWS).alias("slices")))
    pairs = (nodes.withColumn("other", F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks])))
             .withColumn("other", F.col("node").bitwiseXOR(F.col("other"))))
    if slices.where("slices > 1").isEmpty():
        pairs = pairs.withColumns({"own": F.lit(1), "theirs": F.lit(1)})
    else:
        pairs = (pairs.join(slices.select(F.col("n").alias("node"), F.col("slices").alias("own")), "node")
                 .join(slices.select(F.col("n").alias("other"), F.col("slices").alias("theirs")), "other"))
    mine = F.pmod(F.xxhash64("fp_"), F.col("own"))
    pairs = pairs.withColumns({"mine": mine, "all": F.explode(F.sequence(F.lit(0), F.col("theirs") - 1))})
    first = pairs.where("node <= other").select(
        F.col("node").alias("a"), F.col("other").alias("b"), F.col("mine").cast("int").alias("i"),
        F.col("all").cast("int").alias("j"), F.lit(True).alias("first"), "fp_")
    second = pairs.where("node >= other").select(
        F.col("other").alias("a"), F.col("node").alias("b"), F.col("all").cast("int").alias("i"),
        F.col("mine").cast("int").alias("j"), F.lit(False).alias("first"), "fp_")

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        values = rows["fp_"].to_numpy(np.int64).view(np.uint64)
        side = rows["first"].to_numpy(bool)
        a, b = np.sort(values[side]), np.sort(values[~side])
        at_a, at_b = trie_join(a, b, budget, depth)
        members = np.unique(np.concatenate([a[at_a], b[at_b]]))
        u, v = np.searchsorted(members, a[at_a]), np.searchsorted(members, b[at_b])
        label = members[_spanning(u, v, len(members))]
        moved = label != members
        return pd.DataFrame({"u": label[moved].view(np.int64), "v": members[moved].view(np.int64)})

    both = first.unionByName(second)
    return both.groupBy("a", "b", "i", "j").applyInPandas(walk, "u bigint, v bigint").where("u != v")


def components(edges: DataFrame) -> DataFrame:
    """Rows (v, root): the smallest member reachable from each linked one but the root itself.

    Large-star and small-star rounds until the links stay the same; each round is written
    to the shared folder. A member's smallest neighbour is an aggregate, joined back to the
    links, so no neighbourhood is held in one place.
    """
    edges = store(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = store(both.groupBy("u").agg(F.min("v").alias("m"))
                       .select("u", F.least("u", "m").alias("m")), "lowest")
        # large star: the larger neighbours of each member move to its smallest one
        large = store(both.join(lowest, "u").where("v > u").select(F.col("m").alias("u"), "v")
                      .where("u != v").distinct(), "links")
        # small star: a member and its smaller neighbours move to the smallest of these
        lowest = store(large.groupBy("v").agg(F.min("u").alias("m")), "lowest")
        joined = large.join(lowest, "v")
        edges = store(joined.select(F.col("m").alias("u"), F.col("u").alias("v")).where("u != v")
                      .unionByName(lowest.select(F.col("m").alias("u"), "v")).distinct(), "links")
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == mark:
            return edges.select("v", F.col("u").alias("root"))
        mark = new


def near_components(docs: DataFrame, shingle: int = 3, budget: int = 2, keep: list[str] | None = None,
                    text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``fingerprint`` (16 hex digits), ``component_id`` and ``component_fp`` of every row,
    beside columns ``keep``.

    Texts are linked if their fingerprints differ in at most ``budget`` bits; component_id
    is the smallest doc_id reachable, null if no row of the component has an id;
    component_fp is one fingerprint of the component and tells components apart. Null texts
    and texts without words have fingerprint zero and are linked like any other; repeated
    rows are each returned. An input column named like a new one is replaced.
    """
    keep = [c for c in ([doc_id] if keep is None else keep)
            if c not in ("fingerprint", "component_id", "component_fp", "fp_", "root_", "lowest_")]
    source = docs.withColumn("lowest_", F.col(doc_id))
    rows = store(fingerprints(source, [*keep, "lowest_"], shingle, text), "fingerprints")
    different = store(rows.groupBy("fp_").agg(F.min("lowest_").alias("lowest_")), "different")
    roots = components(links(different.select("fp_"), budget))
    rooted = different.join(roots.select(F.col("v").alias("fp_"), F.col("root").alias("root_")), "fp_", "left")
    rooted = store(rooted.withColumn("root_", F.coalesce("root_", "fp_")), "rooted")
    least = rooted.groupBy("root_").agg(F.min("lowest_").alias("component_id"))
    named = store(rooted.join(least, "root_").select("fp_", "root_", "component_id"), "named")
    return rows.join(named, "fp_").select(
        *keep, _digits("fp_").alias("fingerprint"), "component_id", _digits("root_").alias("component_fp"))


def _digits(name: str):
    return F.lower(F.lpad(F.hex(name), 16, "0"))
