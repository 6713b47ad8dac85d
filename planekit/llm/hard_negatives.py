"""Hard-negative mining by exact integer scores from a residue-number-system product.

Components become integers, ``floor(scale * x)``, and a score is the integer
inner product of two vectors.  Matrices are taken modulo several small primes
and multiplied in float32: residues are centred and the inner dimension is cut
so that every sum stays below 2^24, where float32 is exact.  The signed score
comes back by Chinese remaindering with balanced mixed-radix digits.  As many
primes are used as twice the largest squared norm of the table needs.

Anchors (the stated query set) meet all rows in blocks.  They are taken in
waves of at most ``WAVE_BYTES`` of vectors, the bound on what is sent to the
tasks at once; a wave makes two passes over the written table of integer
vectors.  The first keeps each anchor's best rows of its own label, the second,
for each of these positives, the best rows of other labels whose score lies in
the positive's window.  A task holds the leaders of its wave and a block of
rows; only leaders are shuffled.  No order of magnitude switches the method.

Defined results: rows with a null label, a null vector or a null or non-finite
component take no part; nor do rows without an id, or whose squared integer norm
reaches 2^62, as their scores need not fit a long.  A shorter vector counts as
padded with zeros, an empty one as zero.  Another row has another id; rows that
repeat an id are candidates of their own, and each anchor row has its own list.
An empty table, or one without anchors, gives no rows.  Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planekit.session import cut_lineage

#: bytes of anchor vectors that one wave may hold, as 64-bit integers
WAVE_BYTES = 32 << 20
#: float32 holds every integer up to this
EXACT = 1 << 24
#: residues modulo primes below this; half of it squared, times 64, stays within EXACT
PRIMES_BELOW = 1024
ANCHORS, ROWS = 1024, 2048
NONE = np.iinfo(np.int64).min + 1


def primes_for(bound: int) -> list[int]:
    """The largest primes below ``PRIMES_BELOW``, until their product exceeds ``2 * bound``."""
    sieve = np.ones(PRIMES_BELOW, bool)
    for p in range(2, int(PRIMES_BELOW ** 0.5) + 1):
        sieve[p * p::p] = False
    out, product = [], 1
    for p in np.flatnonzero(sieve)[:2:-1].tolist():
        if product > 2 * bound:
            break
        out.append(p)
        product *= p
    return out


class Residues:
    """Integer matrices modulo primes, and their exact products."""

    def __init__(self, primes: list[int]):
        self.primes = primes

    def of(self, x: np.ndarray) -> list[np.ndarray]:
        return [_centred(x, p).astype(np.float32) for p in self.primes]

    def product(self, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """``a @ b.T`` as int64, exact while scores are within half the primes' product."""
        total, radix = None, 1
        for p, x, y in zip(self.primes, a, b):
            step = EXACT // (p // 2) ** 2
            c = (x[:, :step] @ y[:, :step].T).astype(np.int64)
            for k in range(step, x.shape[1], step):
                c = _centred(c, p) + (x[:, k:k + step] @ y[:, k:k + step].T).astype(np.int64)
            if total is None:
                total = _centred(c, p)
            else:
                digit = _centred((c - total) % p * pow(radix, -1, p), p)
                total = total + digit * np.array(radix & ((1 << 64) - 1), np.uint64).astype(np.int64)
            radix *= p
        return total


def _centred(x: np.ndarray, p: int) -> np.ndarray:
    half = p // 2
    return (x + half) % p - half


class Leaders:
    """The ``most`` best (score, id) of every slot; higher scores first, ties by smaller id."""

    def __init__(self, slots: int, most: int):
        self.most = most
        self.scores = np.full((slots, most), NONE)
        self.ids = np.zeros((slots, most), np.int64)

    def offer(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray, ok: np.ndarray) -> None:
        """``scores`` and ``ok`` are ``(len(slots), len(ids))``; slots are distinct."""
        ok &= scores >= self.scores[slots, -1][:, None]
        crowded = np.flatnonzero(ok.sum(axis=1) > 4 * self.most)
        if len(crowded):
            held = np.where(ok[crowded], scores[crowded], NONE)
            ok[crowded] &= scores[crowded] >= np.partition(held, -self.most, axis=1)[:, -self.most][:, None]
        r, c = np.nonzero(ok)
        if not len(r):
            return
        mine = np.unique(r)
        kept_r, kept_k = np.nonzero(self.scores[slots[mine]] != NONE)
        own = slots[mine][kept_r]
        r = np.concatenate([r, mine[kept_r]])
        s = np.concatenate([scores[r[:len(c)], c], self.scores[own, kept_k]])
        i = np.concatenate([ids[c], self.ids[own, kept_k]])
        order = np.lexsort((i, -s, r))
        r, s, i = r[order], s[order], i[order]
        first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        place = np.arange(len(r)) - np.repeat(first, np.diff(np.r_[first, len(r)]))
        use = place < self.most
        self.scores[slots[mine]] = NONE
        self.scores[slots[r[use]], place[use]] = s[use]
        self.ids[slots[r[use]], place[use]] = i[use]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, k = np.nonzero(self.scores != NONE)
        return slot, self.ids[slot, k], self.scores[slot, k]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as an integer matrix, short rows padded with zeros."""
    out = np.zeros((len(column), width), np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(out)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def share_of(scores: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """``percent`` hundredths of integer scores, rounded down and up, without overflow."""
    whole, rest = np.divmod(scores, 100)
    return whole * percent + rest * percent // 100, whole * percent - (-rest * percent // 100)


def _integers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column, scale: int) -> DataFrame:
    raw = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                         F.col(vector_col).cast("array<double>").alias("v"), anchor.alias("anchor"))
    fit = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    raw = raw.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & fit)
    q = raw.withColumn("q", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))))
    size = F.aggregate("v", F.lit(0.0), lambda t, x: t + F.pow(F.floor(x * F.lit(float(scale))).cast("double"), 2.0))
    return q.withColumn("norm", size).where(F.col("norm") < float(1 << 62)).select(
        "id", "label", "q", "norm", F.coalesce("anchor", F.lit(False)).alias("anchor"),
        F.monotonically_increasing_id().alias("row"))


def _wave(rows: DataFrame, wave: Column) -> pa.Table:
    """The anchors of one wave: at most a constant share of WAVE_BYTES, whatever the table's size."""
    return rows.where(F.col("anchor") & wave).select("row", "id", "label", "q").toArrow().combine_chunks()


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        yield part.column(0).to_numpy(), np.array(part.column(1).to_pylist(), object), matrix(part.column(2), width)


def mine_hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                        label_col: str = "label", n_positives: int = 5, n_negatives: int = 10, low: int = 30,
                        high: int = 90, scale: int = 256, wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor`` says which rows are anchors.  An anchor's positives are its
    ``n_positives`` best other rows of its label; a positive's negatives are the
    ``n_negatives`` best rows of other labels whose scores lie between ``low``
    and ``high`` percent of the positive's.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(_integers(vectors, id_col, vector_col, label_col, anchor, scale))
    size = rows.agg(F.sum(F.col("anchor").cast("long")).alias("anchors"), F.max(F.size("q")).alias("width"),
                    F.max("norm").alias("norm")).first()
    width, anchors = max(1, size["width"] or 1), size["anchors"] or 0
    field = Residues(primes_for(int((size["norm"] or 0.0) * (1 + 1e-6)) + 1))
    # waves by the row's hash hold half of the bound on average
    waves = max(1, -(-anchors * width * 16 // wave_bytes))
    out = None
    for w in range(waves if anchors else 1):
        wave = F.pmod(F.xxhash64("row"), F.lit(waves)) == w
        found = cut_lineage(_mine(spark, rows, wave, field, width, n_positives, n_negatives, low, high))
        out = found if out is None else out.unionByName(found)
    return out


def _best(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The best ``most`` rows of each key, each task's leaders being few."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _mine(spark, rows: DataFrame, wave: Column, field: Residues, width: int, n_positives: int, n_negatives: int,
          low: int, high: int) -> DataFrame:
    table = _wave(rows, wave)
    names = ["id", "label", "q"]
    own = spark.sparkContext.broadcast((table["id"].to_numpy(), np.array(table["label"].to_pylist(), object),
                                        matrix(table["q"].chunk(0), width) if len(table) else np.zeros((0, width), np.int64)))

    def positives(batches):
        ids, labels, vectors = own.value
        best, mine = Leaders(len(ids), n_positives), {}
        for slot, label in enumerate(labels):
            mine.setdefault(label, []).append(slot)
        mine = {k: (np.array(v), field.of(vectors[v])) for k, v in mine.items()}
        for batch in batches:
            for row_ids, row_labels, x in _blocks(batch, width):
                for label in set(row_labels) & set(mine):
                    at = np.flatnonzero(row_labels == label)
                    y, (slots, a) = field.of(x[at]), mine[label]
                    for k in range(0, len(slots), ANCHORS):
                        part = slots[k:k + ANCHORS]
                        scores = field.product([m[k:k + ANCHORS] for m in a], y)
                        best.offer(part, scores, row_ids[at], ids[part][:, None] != row_ids[at][None, :])
        yield pa.RecordBatch.from_arrays(list(map(pa.array, best.found())), names=["slot", "id", "score"])

    few = rows.select(*names)
    taken = _best(few.mapInArrow(positives, "slot long, id long, score long"), ["slot"], n_positives)
    chosen = taken.select("slot", "rank", "id", "score").toArrow()  # n_positives a slot
    pos_ids = np.zeros((len(table), n_positives), np.int64)
    pos_scores = np.full((len(table), n_positives), NONE)
    at = chosen["slot"].to_numpy(), chosen["rank"].to_numpy() - 1
    pos_ids[at], pos_scores[at] = chosen["id"].to_numpy(), chosen["score"].to_numpy()
    theirs = spark.sparkContext.broadcast((pos_ids, pos_scores))

    def negatives(batches):
        ids, labels, vectors = own.value
        pos_ids, pos_scores = theirs.value
        there = pos_scores != NONE
        known = np.where(there, pos_scores, 0)
        least, most = np.where(there, share_of(known, low)[1], 1), np.where(there, share_of(known, high)[0], 0)
        code = {label: k for k, label in enumerate(dict.fromkeys(labels))}
        a, codes = field.of(vectors), np.array([code[x] for x in labels], np.int64)
        best = [Leaders(len(ids), n_negatives) for _ in range(n_positives)]
        for batch in batches:
            for row_ids, row_labels, x in _blocks(batch, width):
                y, row_codes = field.of(x), np.array([code.get(v, -1) for v in row_labels], np.int64)
                for k in range(0, len(ids), ANCHORS):
                    part = np.arange(k, min(k + ANCHORS, len(ids)))
                    scores = field.product([m[part] for m in a], y)
                    other = codes[part][:, None] != row_codes[None, :]
                    for p in range(n_positives):
                        ok = other & (scores >= least[part, p][:, None]) & (scores <= most[part, p][:, None])
                        best[p].offer(part, scores, row_ids, ok)
        for p, leaders in enumerate(best):
            slot, neg, score = leaders.found()
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in (slot, np.full(len(slot), p), ids[slot], pos_ids[slot, p], pos_scores[slot, p],
                                       neg, score)],
                names=["slot", "p", "anchor_id", "positive_id", "positive_score", "id", "score"])

    found = few.mapInArrow(negatives, "slot long, p long, anchor_id long, positive_id long, positive_score long, id long, score long")
    return _best(found, ["slot", "p"], n_negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
