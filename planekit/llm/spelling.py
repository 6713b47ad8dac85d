"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

Words are counted in Spark.  One inserted, deleted or replaced letter changes a
word's vector of letter counts by an L1 distance of at most two: one letter more,
one less, or both.  So each word asks, per pair of lengths (its own, one less and
one more), a k-d tree over the distinct vectors of that length for those within
the distance.  A subtree goes when its box needs more letters added or taken away
than the edit allows.  Letter order is then verified: words of two vectors found
near meet on the hash of what is left without the letter that differs, and are
compared letter by letter.

In Spark, a length with more words than ``BOX`` is cut into the leaves of a coarse
tree built on a sample of at most about ``SAMPLE`` words (the documented bound; it
decides where words are compared, never which are near).  A word lives in one leaf
and asks all leaves that its edits can reach.  A leaf that still holds more words
or questions than ``BOX`` is cut into slices that meet pairwise, so a task's group is
bounded whatever the words are.  Only counts and best neighbours leave a task,
never pairs.

A word's *form* is its near word of largest count (ties: smallest in code-point
order) if that is at least ``factor`` times its own; its *root* is where the forms
end.  Counts grow by ``factor`` on the way, so pointer doubling takes a few rounds.

Defined results: null text has no words; a null id counts as empty text in the hash.
Repeated rows count as often as they stand.  An empty table gives no words.  Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planekit.session import cut_lineage

#: words, or questions, that one group holds at most about
BOX = 65_536
SAMPLE = 100_000
LEAF = 8
#: pairs of vectors whose words are compared at once
AT_ONCE = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MOST = np.iinfo(np.int32).max
_BASE = 0x9E3779B97F4A7C15 | 1
_CODES = np.random.default_rng(97).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


class KdTree:
    """A k-d tree over integer vectors; boxes are the points' own, or with ``regions`` those that the cuts leave."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, regions: bool = False):
        width = points.shape[1]
        self.lo, self.hi, self.cut, self.members = [], [], [], []
        self.leaves = 0
        everything = np.zeros(width, np.int32), np.full(width, _MOST, np.int32)
        waiting = [(np.arange(len(points)), *everything, None, 0)]
        while waiting:
            idx, lo, hi, parent, side = waiting.pop()
            node, part = len(self.cut), points[idx]
            if parent is not None:
                self.cut[parent][2 + side] = node
            if not regions and len(idx):
                lo, hi = part.min(axis=0), part.max(axis=0)
            self.lo.append(lo)
            self.hi.append(hi)
            best = 0
            if len(idx) > leaf:
                cuts = np.floor(part.mean(axis=0)).astype(np.int32)
                right = (part > cuts).sum(axis=0)
                even = np.minimum(right, len(idx) - right)
                dim = int(even.argmax())
                best = int(even[dim])
            if not best:
                self.cut.append([-1, self.leaves, -1, -1])
                self.members.append(idx)
                self.leaves += 1
                continue
            self.cut.append([dim, int(cuts[dim]), -1, -1])
            goes = part[:, dim] > cuts[dim]
            below, above = hi.copy(), lo.copy()
            below[dim], above[dim] = cuts[dim], cuts[dim] + 1
            waiting += [(idx[goes], above, hi, node, 1), (idx[~goes], lo, below, node, 0)]

    def place(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        out, waiting = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
        while waiting:
            node, idx = waiting.pop()
            dim, at, left, right = self.cut[node]
            if dim < 0:
                out[idx] = at
            elif len(idx):
                goes = points[idx, dim] > at
                waiting += [(left, idx[~goes]), (right, idx[goes])]
        return out

    def reach(self, queries: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each leaf with the queries that ``up`` added and ``down`` removed letters can bring into its box."""
        waiting = [(0, np.arange(len(queries)))]
        while waiting:
            node, idx = waiting.pop()
            q = queries[idx]
            idx = idx[(np.maximum(self.lo[node] - q, 0).sum(axis=1) <= up)
                      & (np.maximum(q - self.hi[node], 0).sum(axis=1) <= down)]
            if len(idx):
                dim, at, left, right = self.cut[node]
                if dim < 0:
                    yield at, idx
                else:
                    waiting += [(left, idx), (right, idx)]


def letter_counts(letters: np.ndarray, width: int = 256) -> np.ndarray:
    """``(words, width)`` counts of an array of words of one length, as Latin-1 bytes or other small codes."""
    out, rows = np.zeros((len(letters), width), np.int32), np.arange(len(letters))
    for column in letters.T:
        out[rows, column] += 1
    return out


def as_letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of Latin-1 bytes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


class Side:
    """Words of one length over ``width`` letters: distinct count vectors and their words, prefix hashes."""

    def __init__(self, letters: np.ndarray, width: int):
        self.letters = letters
        self.counts = counts = letter_counts(letters, width)
        rows = np.ascontiguousarray(counts).view(np.dtype((np.void, counts.shape[1] * 4))).ravel()
        _, first, own = np.unique(rows, return_index=True, return_inverse=True)
        self.vectors = counts[first]
        self.words = np.argsort(own, kind="stable")
        self.size = np.bincount(own, minlength=len(first))
        self.start = np.cumsum(self.size) - self.size
        self.places = np.argsort(letters, axis=1, kind="stable").astype(np.int32)
        self.offset = np.cumsum(counts, axis=1, dtype=np.int32) - counts
        power = _powers(letters.shape[1])
        self.prefix = np.zeros((len(letters), letters.shape[1] + 1), np.uint64)
        np.cumsum(_CODES[letters] * power[None, :letters.shape[1]], axis=1, out=self.prefix[:, 1:])

    def of(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row of ``classes`` and the word, for each word of each class."""
        return _spread(self.start[classes], self.size[classes], self.words)

    def at(self, words: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row of ``words`` and the place, for each place of its letter."""
        n = self.counts[words, letter]
        row = np.repeat(np.arange(len(words)), n)
        k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        return row, self.places[words[row], self.offset[words[row], letter[row]] + k]

    def whole(self, words: np.ndarray) -> np.ndarray:
        return self.prefix[words, -1]

    def masked(self, words: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The hash with the letter at ``place`` blanked."""
        return self.whole(words) - (self.prefix[words, place + 1] - self.prefix[words, place])

    def without(self, words: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The hash of the word without the letter at ``place``."""
        rest = self.whole(words) - self.prefix[words, place + 1]
        return self.prefix[words, place] + rest * np.array(pow(_BASE, -1, 1 << 64), np.uint64)


def _powers(length: int) -> np.ndarray:
    out = np.ones(length + 1, np.uint64)
    out[1:] = np.array(_BASE, np.uint64)
    return np.cumprod(out, dtype=np.uint64)


def _spread(start: np.ndarray, size: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row = np.repeat(np.arange(len(size)), size)
    return row, values[np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + start[row]]


def _meet(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs with equal keys."""
    order = np.argsort(b, kind="stable")
    lo, hi = (np.searchsorted(b[order], a, side) for side in ("left", "right"))
    row, place = _spread(lo, hi - lo, np.arange(len(b)))
    return row, order[place]


def _verified(asks: Side, has: Side, qc: np.ndarray, rc: np.ndarray, up: int, down: int) -> np.ndarray:
    """Near pairs ``(asking word, word)`` among the words of pairs of vectors, each once."""
    change = has.vectors[rc] - asks.vectors[qc]
    gained, lost = change.argmax(axis=1), change.argmin(axis=1)
    (q_pair, q), (r_pair, r) = asks.of(qc), has.of(rc)
    pair_code = np.arange(len(qc), dtype=np.uint64) * _CODES[0]
    if down:
        row, q_at = asks.at(q, lost[q_pair])
        q, q_pair = q[row], q_pair[row]
    if up:
        row, r_at = has.at(r, gained[r_pair])
        r, r_pair = r[row], r_pair[row]
    if up and down:  # what is left, in its place
        q_key = asks.masked(q, q_at) + q_at.astype(np.uint64) * _CODES[1]
        r_key = has.masked(r, r_at) + r_at.astype(np.uint64) * _CODES[1]
    else:
        q_key = asks.without(q, q_at) if down else asks.whole(q)
        r_key = has.without(r, r_at) if up else has.whole(r)
    i, j = _meet(q_key + pair_code[q_pair], r_key + pair_code[r_pair])
    if not len(i):
        return np.zeros((0, 2), np.int64)
    a, b = asks.letters[q[i]], has.letters[r[j]]
    if up and down:
        near = (a != b).sum(axis=1) == 1
    elif down:
        near = (_cut(a, q_at[i]) == b).all(axis=1)
    else:
        near = (a == _cut(b, r_at[j])).all(axis=1)
    return np.unique(np.stack([q[i][near], r[j][near]], axis=1), axis=0)


def _cut(letters: np.ndarray, place: np.ndarray) -> np.ndarray:
    keep = np.arange(letters.shape[1] - 1)[None, :]
    return np.take_along_axis(letters, keep + (keep >= place[:, None]), axis=1)


def near_words(asking: list[str], words: list[str]) -> Iterator[np.ndarray]:
    """Blocks of index pairs of words exactly one edit apart; each list holds distinct words of one length."""
    more = len(words[0]) - len(asking[0])
    up, down = (1, 1) if more == 0 else (int(more > 0), int(more < 0))
    both = as_letters(asking), as_letters(words)
    used = np.unique(np.concatenate([np.unique(x) for x in both]))
    asks, has = (Side(np.searchsorted(used, x).astype(np.uint8), len(used)) for x in both)
    tree, found, size = KdTree(has.vectors), [], 0
    for leaf, idx in tree.reach(asks.vectors, up, down):
        members = tree.members[leaf]
        apart = np.abs(asks.vectors[idx][:, None, :] - has.vectors[members][None, :, :]).sum(axis=2)
        q, r = np.nonzero(apart == up + down)
        found.append((idx[q], members[r]))
        size += len(q)
        if size >= AT_ONCE:
            yield _verified(asks, has, *map(np.concatenate, zip(*found)), up, down)
            found, size = [], 0
    if size:
        yield _verified(asks, has, *map(np.concatenate, zip(*found)), up, down)


def count_words(docs: DataFrame, id_col: str, text_col: str, least_letters: int, least_count: int) -> DataFrame:
    """``word, n``: lower-cased letter runs, one letter deleted where 97 divides the hash of id and run."""
    letter = "[A-Za-zÀ-ÿ]"
    run = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"{letter}{{{least_letters},}}+"), F.lit(0)))
    df = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run.alias("run"))
    df = df.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    df = df.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    place = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), place), F.substr("run", place + 2))
    word = F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("run"))
    return (df.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") >= least_count) & (F.char_length("word") >= least_letters)))


def _coarse(words: DataFrame, box: int, sample: int) -> dict[int, KdTree]:
    """A tree per length that has more than ``box`` words, from at most about ``sample`` of all words."""
    crowded = {r["len"]: r["n"] for r in words.groupBy("len").agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") > box).collect()}  # at most words / box
    if not crowded:
        return {}
    share = min(1.0, sample / sum(crowded.values()))
    unit = F.xxhash64("word").bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)
    taken: dict[int, list[str]] = {}
    for r in words.where((unit < share) & F.col("len").isin(*crowded)).select("word", "len").collect():
        taken.setdefault(r["len"], []).append(r["word"])
    return {n: KdTree(letter_counts(as_letters(some)), max(1, int(box * len(some) / crowded[n])), regions=True)
            for n, some in taken.items()}


def _placed(words: DataFrame, trees: dict[int, KdTree]) -> DataFrame:
    """``len, leaf, asks, word, n``: each word where it lives, and wherever a near word could live."""
    def place(batches):
        for batch in batches:
            words, n = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_numpy()
            lengths, out = np.array([len(w) for w in words]), []
            for length in np.unique(lengths).tolist():
                idx = np.flatnonzero(lengths == length)
                vectors = letter_counts(as_letters(words[idx].tolist()))
                tree = trees.get(length)
                out.append((length, tree.place(vectors) if tree else np.zeros(len(idx), np.int64), False, idx))
                for target, up, down in ((length - 1, 0, 1), (length, 1, 1), (length + 1, 1, 0)):
                    if target in trees:
                        out += [(target, np.full(len(q), leaf), True, idx[q]) for leaf, q in trees[target].reach(vectors, up, down)]
                    else:
                        out.append((target, np.zeros(len(idx), np.int64), True, idx))
            sizes = [len(o[3]) for o in out]
            at = np.concatenate([o[3] for o in out]) if out else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat([o[0] for o in out], sizes).astype(np.int32)),
                pa.array(np.concatenate([o[1] for o in out]) if out else np.zeros(0, np.int64)),
                pa.array(np.repeat([o[2] for o in out], sizes).astype(bool)),
                pa.array(words[at], pa.string()), pa.array(n[at], pa.int64())], names=["len", "leaf", "asks", "word", "n"])

    return words.select("word", "n").mapInArrow(place, "len int, leaf long, asks boolean, word string, n long")


def _search(group: pa.Table) -> pa.Table:
    """Per asking word of a group: how many near words live there, and the best of them."""
    asks = group.column("asks").to_numpy(zero_copy_only=False)
    words, n = np.array(group.column("word").to_pylist(), object), group.column("n").to_numpy()
    has = np.flatnonzero(~asks)
    lengths = np.array([len(w) for w in words])
    rank = np.empty(len(has), np.int64)
    rank[np.argsort(words[has], kind="stable")] = np.arange(len(has))
    out_word, out_near, out_n, out_form = [], [], [], []
    for length in np.unique(lengths[asks]).tolist() if len(has) else ():
        own = np.flatnonzero(asks & (lengths == length))
        for pairs in near_words(words[own].tolist(), words[has].tolist()):
            if len(pairs):
                q, r = own[pairs[:, 0]], has[pairs[:, 1]]
                order = np.lexsort((rank[pairs[:, 1]], -n[r], q))
                q, r = q[order], r[order]
                first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
                out_word += words[q[first]].tolist()
                out_near += np.diff(np.r_[first, len(q)]).tolist()
                out_n += n[r[first]].tolist()
                out_form += words[r[first]].tolist()
    return pa.table({"word": pa.array(out_word, pa.string()), "near": pa.array(out_near, pa.int64()),
                     "form_n": pa.array(out_n, pa.int64()), "form": pa.array(out_form, pa.string())})


def near_summary(words: DataFrame, box: int = BOX, sample: int = SAMPLE) -> DataFrame:
    """``word, n, n_near`` and the near word of largest count (``form, form_n``) of a written table ``word, n, len``."""
    placed = cut_lineage(_placed(words, _coarse(words, box, sample)))
    home = ["len", "leaf"]
    sizes = placed.groupBy(*home).agg(F.count_if(~F.col("asks")).alias("live"), F.count_if("asks").alias("ask"))
    sizes = sizes.where("live > 0").select(*home, *[F.ceil(F.col(c) / box).cast("int").alias(f"{c}_slices") for c in ("live", "ask")])
    own = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cells = placed.join(sizes, home)
    live = cells.where("not asks").withColumn("a", own("live_slices")).withColumn("b", every("ask_slices"))
    ask = cells.where("asks").withColumn("a", every("live_slices")).withColumn("b", own("ask_slices"))
    rows = placed.count()
    key = [*home, "a", "b"]
    # the search costs far more than its few bytes: as many tasks as rows ask for, not as bytes do
    both = live.unionByName(ask).select(*key, "asks", "word", "n").repartition(max(1, min(10_000, rows // 32_000)), *key)
    found = both.groupBy(*key).applyInArrow(_search, "word string, near long, form_n long, form string")
    alone = words.select("word", F.lit(0).cast("long").alias("near"), F.lit(None).cast("long").alias("form_n"),
                         F.lit(None).cast("string").alias("form"), "n")
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form"))))
    return (alone.unionByName(found.withColumn("n", F.lit(None).cast("long"))).groupBy("word")
            .agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), best.alias("best"))
            .select("word", "n", "n_near", F.col("best.form").alias("form"), (-F.col("best.n")).alias("form_n")))


def _roots(links: DataFrame) -> DataFrame:
    """``word, root`` of ``word, root`` links without cycles, by pointer doubling."""
    while True:
        step = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = cut_lineage(links.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if links.where("moved").isEmpty():
            return links.select("word", "root")


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = 5,
                   least_count: int = 3, factor: int = 2, box: int = BOX, sample: int = SAMPLE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts."""
    counted = count_words(docs, id_col, text_col, least_letters, least_count)
    words = cut_lineage(counted.withColumn("len", F.char_length("word")))
    near = near_summary(words, box, sample)
    real = F.col("form_n") >= factor * F.col("n")
    out = cut_lineage(near.select("word", "n", "n_near", F.when(real, F.col("form")).alias("form"),
                                  F.when(real, F.col("form_n")).alias("form_n")))
    roots = _roots(out.where("form is not null").select("word", F.col("form").alias("root")))
    return out.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
