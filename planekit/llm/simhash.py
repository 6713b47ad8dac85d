"""SimHash near-dedup with a binary trie self-join.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``shingle`` words joined by a space (repeats included; a text of fewer words
is one shingle; no word gives fingerprint 0), XXH64 with seed 42; a bit is 1
if it is set in over half of the hashes.

Self-join: fingerprints that differ in at most ``max_bits`` bits.  Copies are
reduced to distinct fingerprints.  The 64 bits are cut into ``max_bits + 2``
blocks: two fingerprints within the budget agree on at least two blocks, so
they meet in the group of some pair of blocks (15 groups per fingerprint for 4
bits).  Inside a group a binary trie over the sorted fingerprints is joined
with itself: node pairs are traversed together, each step adds a differing
bit or none, and a pair of nodes is dropped once the budget is exceeded.  Two
shortcuts keep every link's connection: if the bits below cannot exceed what
is left of the budget all leaves of both nodes are linked, and two nodes that
are each, and together, one component already need no visit.  A group emits
edges from each fingerprint to its local root, never its pairs.  A group of
more than ``split_above`` fingerprints is first cut into pairs of trie nodes a
few levels down (within the budget), each pair a group of its own.

Components of the edges come from ``components``; the component's id is its
smallest document id.  Null text has no word.  A null id gets the component of
its fingerprint and is never the smallest unless all are null.
"""

from __future__ import annotations

import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planekit.llm.common import byte_values, id_and_text
from planekit.llm.components import connected_components
from planekit.session import cut_lineage

SHINGLE = 4
MAX_BITS = 4
SPLIT_ABOVE = 1 << 18
#: node pairs of at most so many leaf pairs are compared leaf by leaf
LEAF_PAIRS = 256
SEED = 42


def simhash(raw: bytes, shingle: int = SHINGLE) -> int:
    words = raw.lower().split()  # on bytes: A-Z, and ASCII white space, only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    hashes = np.array([xxhash.xxh64_intdigest(joined[s:e], SEED)
                       for s, e in zip(starts.tolist(), ends.tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype(">u8")
        ones += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _signed(x: int) -> int:
    return x - ((x >> 63) << 64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) of ``doc_id, text``."""
    def run(batches):
        for b in batches:
            fps = [_signed(simhash(raw or b"", shingle)) for raw in byte_values(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.mapInArrow(run, "doc_id long, fp long")


def trie_self_join(fps: list[int], max_bits: int = MAX_BITS) -> list[int]:
    """For sorted distinct fingerprints, each one's local root (an index)."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def link(i, j):
        i, j = find(i), find(j)
        if i != j:
            parent[max(i, j)] = min(i, j)

    def one_component(a, b, c, d):
        root = find(a)
        return all(find(i) == root for i in range(a, b)) and all(find(i) == root for i in range(c, d))

    def middle(lo, hi, bit):
        """Where the node ``fps[lo:hi]`` splits on ``bit``; the bits above are equal."""
        return bisect_left(fps, (fps[lo] >> (bit + 1) << (bit + 1)) | (1 << bit), lo, hi)

    # a node is a range of leaves; a pair is (a, b, c, d, bit, differing bits so far)
    stack = [(0, len(fps), 0, len(fps), 63, 0)] if fps else []
    while stack:
        a, b, c, d, bit, differ = stack.pop()
        if a == c and b - a < 2:
            continue
        if differ + bit + 1 <= max_bits:
            for i in range(a, b):
                link(i, a)
            for i in range(c, d):
                link(i, a)
            continue
        if (b - a) * (d - c) <= LEAF_PAIRS:
            for i in range(a, b):
                x = fps[i]
                for j in range(max(c, i + 1), d):
                    if (x ^ fps[j]).bit_count() <= max_bits:
                        link(i, j)
            continue
        if a != c and one_component(a, b, c, d):
            continue
        m = middle(a, b, bit)
        if a == c:
            # popped in reverse: both halves are joined before their cross pair is
            if differ < max_bits and a < m < b:
                stack.append((a, m, m, b, bit - 1, differ + 1))
            stack += [(lo, hi, lo, hi, bit - 1, differ) for lo, hi in ((a, m), (m, b)) if hi - lo > 1]
            continue
        n = middle(c, d, bit)
        for lo, hi, one in ((a, m, 0), (m, b, 1)):
            for lo2, hi2, two in ((c, n, 0), (n, d, 1)):
                if lo < hi and lo2 < hi2 and differ + (one != two) <= max_bits:
                    stack.append((lo, hi, lo2, hi2, bit - 1, differ + (one != two)))
    return [find(i) for i in range(len(fps))]


def _blocks(max_bits: int) -> list[tuple[int, int]]:
    """``(shift, width)`` of each of the ``max_bits + 2`` blocks."""
    n = max_bits + 2
    edges = [64 * i // n for i in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]


def _keyed(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``pair, shared, fp``: one row for each pair of blocks."""
    blocks = _blocks(max_bits)
    pairs = [(i, j) for i in range(len(blocks)) for j in range(i)]
    masks = [_signed(sum(((1 << w) - 1) << s for s, w in (blocks[i], blocks[j]))) for i, j in pairs]
    options = F.array(*[F.struct(F.lit(k).alias("pair"), F.col("fp").bitwiseAND(F.lit(m)).alias("shared"))
                        for k, m in enumerate(masks)])
    return distinct.select("fp", F.explode(options).alias("o")).select("o.pair", "o.shared", "fp")


def _split_groups(keyed: DataFrame, hot: DataFrame, max_bits: int, split_above: int) -> DataFrame:
    """Rows of hot groups, copied to every pair of trie nodes within the budget that they belong to."""
    blocks = _blocks(max_bits)
    free = [next(b for k, b in enumerate(blocks) if k not in (i, j))
            for i in range(len(blocks)) for j in range(i)]
    shift = F.element_at(F.array(*[F.lit(s) for s, _ in free]), F.col("pair") + 1)
    width = F.element_at(F.array(*[F.lit(w) for _, w in free]), F.col("pair") + 1)
    rows = keyed.join(hot, ["pair", "shared"])
    levels = F.least(width, F.ceil(F.log2(F.col("n") / split_above)).cast("int") + 1)
    rows = rows.withColumn("levels", levels).withColumn("shift", shift)
    nodes = F.call_function("shiftleft", F.lit(1), F.col("levels"))
    rows = rows.withColumn("node", F.call_function("shiftrightunsigned", F.col("fp"), F.col("shift"))
                           .bitwiseAND((nodes - 1).cast("long")))
    near = F.filter(F.sequence(F.lit(0).cast("long"), (nodes - 1).cast("long")),
                    lambda v: F.bit_count(v.bitwiseXOR(F.col("node"))) <= max_bits)
    return (rows.withColumn("other", F.explode(near))
            .select("pair", "shared", F.least("node", "other").alias("low"),
                    F.greatest("node", "other").alias("high"), "fp"))


def _joined_groups(rows: DataFrame, keys: list[str], max_bits: int) -> DataFrame:
    """Edges ``u, v`` of each group's trie self-join; rows are streamed group by group."""
    ordered = rows.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys, "fp")
    k = len(keys)

    def edges_of(group: list[int]):
        fps = sorted(x & (2**64 - 1) for x in group)
        for x, root in zip(fps, trie_self_join(fps, max_bits)):
            if fps[root] != x:
                yield _signed(x), _signed(fps[root])

    def run(batches):
        at, group = None, []
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(k + 1)]
            out = []
            for row in zip(*cols):
                if row[:k] != at:
                    if len(group) > 1:
                        out += edges_of(group)
                    at, group = row[:k], []
                group.append(row[k])
            yield _edges(out)
        if len(group) > 1:
            yield _edges(list(edges_of(group)))

    return ordered.mapInArrow(run, "u long, v long")


def _edges(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["u", "v"])


def fingerprint_edges(distinct: DataFrame, max_bits: int = MAX_BITS, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """Edges that connect all distinct fingerprints within ``max_bits`` of each other."""
    keyed = _keyed(distinct, max_bits)
    counts = cut_lineage(keyed.groupBy("pair", "shared").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    # most groups hold one fingerprint: they have no pair and need not be dealt out
    small = keyed.join(counts.where(F.col("n") <= split_above), ["pair", "shared"], "left_semi")
    edges = _joined_groups(small, ["pair", "shared"], max_bits)
    hot = counts.where(F.col("n") > split_above)
    if not hot.isEmpty():
        split = _split_groups(keyed, hot, max_bits, split_above)
        edges = edges.unionByName(_joined_groups(split.distinct(), ["pair", "shared", "low", "high"], max_bits))
    return edges


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """``doc_id, fp, component_id``, one row per input row."""
    found = cut_lineage(fingerprints(id_and_text(docs, id_col, text_col), shingle))
    distinct = cut_lineage(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(fingerprint_edges(distinct.select("fp"), max_bits, split_above))
    placed = (distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = cut_lineage(placed.select("fp", "root").join(smallest, "root").select("fp", "component_id"))
    return found.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
