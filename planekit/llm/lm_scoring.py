"""Language-model scoring by deleted interpolation of word n-grams (unigrams and bigrams).

Tokens: A-Z lower-cased words ``[^\\x20\\x09-\\x0D]+``, then one end.  The
model's probability of a token w after h is

    l2[b] * c(h, w) / c(h)  +  l1[b] * c(w) / N  +  l0[b] / (V + 1)

with maximum-likelihood counts over all training documents, where b is the
bucket of the context's frequency, floor(log2(c(h) + 1)).  The weights of each
bucket are learned by expectation-maximisation on *deleted* training documents
(one in ``DELETED``, by a hash of the id), whose counts are left out of the
estimates while the weights are learned and put back for scoring.

How the counts travel.  n-grams are 64-bit hashes of their words.

1. A task packs the documents it reads into *chunks* of a few megabytes (one
   compressed row each; deleted documents in chunks of their own).
2. Each chunk's distinct n-gram hashes, sorted, are cut into hash ranges; one
   row per chunk and range carries them, delta-coded, with their counts.  A
   range's task adds the counts of all chunks and answers each chunk with the
   totals in the order in which it asked, so no hash travels back.
3. The answers meet their chunk, and its documents are scored.

The number of ranges follows the number of tokens, so a range's share stays
bounded; an n-gram that every document holds is one entry per chunk.

Null text is empty: one end token.  Without training documents every token has
probability 1 / (V + 1) = 1.  A null id counts as id text ''.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planekit.llm.common import byte_values, split_of
from planekit.session import cut_lineage

CHUNK_BYTES = 4 << 20
#: tokens per range task; a task holds about 30 bytes for each
RANGE_TOKENS = 2_000_000
DELETED = 32
ITERATIONS = 10
BUCKETS = 48

_CHUNK = "chunk long, part int, deleted boolean, n long, payload binary"
_COLS = ["chunk", "part", "deleted", "n", "payload"]
_TYPES = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary()]
#: the part of a chunk's own row, after all of its ranges
_DOCS = 2**31 - 1
#: not words, as they hold a space
_START, _END = b" <s>", b" </s>"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [()] * len(_COLS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], names=_COLS)


def _pack(*arrays: np.ndarray) -> bytes:
    """Equally long arrays as byte planes, compressed."""
    planes = np.concatenate([a.astype("<u8").view(np.uint8).reshape(-1, 8).T.ravel() for a in arrays])
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(payload: bytes, arrays: int, n: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(payload, arrays * n * 8, codec="zstd", asbytes=True), np.uint8)
    return [np.ascontiguousarray(p.reshape(8, n).T).view("<u8").ravel() for p in raw.reshape(arrays, -1)]


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """Rows of ``doc_id, text, held_out, deleted`` packed into chunk rows; ``n`` is the number of tokens."""
    def run(batches):
        base, made = TaskContext.get().partitionId() << 30, 0
        held: dict[bool, list] = {False: [], True: []}
        size = {False: 0, True: 0}

        def flush(deleted: bool):
            nonlocal made
            rows = held[deleted]
            table = pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.bool_())], names=["doc_id", "text", "held_out"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_batch(table)
            tokens = sum(len(r[1].split()) + 1 for r in rows)
            out = _batch([(base + made, _DOCS, deleted, tokens, sink.getvalue().to_pybytes())])
            made, size[deleted], held[deleted] = made + 1, 0, []
            return out

        for b in batches:
            for doc, raw, out_, gone in zip(b.column(0).to_pylist(), byte_values(b.column(1)),
                                            b.column(2).to_pylist(), b.column(3).to_pylist()):
                held[gone].append((doc, (raw or b"").lower(), out_))
                size[gone] += len(raw or b"") + 16
                if size[gone] >= chunk_bytes:
                    yield flush(gone)
        for gone in (False, True):
            if held[gone]:
                yield flush(gone)

    return docs.mapInArrow(run, _CHUNK)


class _Grams:
    """The n-grams of a chunk: sorted distinct hashes, and each token's place among them."""

    def __init__(self, payload: bytes):
        table = pa.ipc.open_stream(payload).read_all()
        self.doc_ids = table["doc_id"].to_pylist()
        self.held_out = np.array(table["held_out"].to_pylist(), bool)
        place: dict[bytes, int] = {_START: 0, _END: 1}
        sequence: list[int] = []
        lengths = []
        for text in table["text"].to_pylist():
            before = len(sequence)
            sequence.append(0)
            sequence += [place.setdefault(w, len(place)) for w in text.split()]
            sequence.append(1)
            lengths.append(len(sequence) - before - 1)
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in place], np.uint64)
        words = np.array(sequence, np.int64)
        pair = words[:-1] != 1  # not across documents
        context, token = words[:-1][pair], words[1:][pair]
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1])).astype(np.int64)
        mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        bigrams = (mixed[context] ^ hashes[token]) * np.uint64(0xBF58476D1CE4E5B9)
        bigrams ^= bigrams >> np.uint64(31)
        self.bigrams, self.bigram_at = np.unique(bigrams, return_inverse=True)
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.unigrams, self.token_at = hashes[order], rank[token]
        # the start occurs once a document, like the end
        self.context_at = rank[np.where(context == 0, 1, context)]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of ``bigrams`` and of ``unigrams``."""
        train = np.repeat(~self.held_out, self.lengths).astype(float)
        return tuple(np.bincount(at, train, len(keys)).astype(np.int64) for at, keys in
                     ((self.bigram_at, self.bigrams), (self.token_at, self.unigrams)))


def _requests(chunks: DataFrame, ranges: int) -> DataFrame:
    """One row per chunk and range: bigrams are parts ``0..ranges``, unigrams the parts after."""
    edges = [np.uint64((i << 64) // ranges) for i in range(ranges)]

    def run(batches):
        for b in batches:
            for chunk, deleted, payload in zip(*(b.column(i).to_pylist() for i in range(3))):
                grams, rows = _Grams(payload), []
                for shift, keys, counts in zip((0, ranges), (grams.bigrams, grams.unigrams), grams.counts()):
                    cuts = np.append(np.searchsorted(keys, np.array(edges, np.uint64)), len(keys)).tolist()
                    for r, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                        if lo < hi:
                            steps = np.diff(keys[lo:hi], prepend=np.uint64(0))
                            rows.append((chunk, shift + r, deleted, hi - lo, _pack(steps, counts[lo:hi])))
                yield _batch(rows)

    return chunks.select("chunk", "deleted", "payload").mapInArrow(run, _CHUNK)


def _answers(requests: DataFrame, ranges: int) -> DataFrame:
    """For each request the totals of its n-grams; and, as chunk -1, the unigram ranges' sums.

    A deleted chunk is answered with the totals of the retained documents too.
    """
    ordered = requests.repartition(F.col("part")).sortWithinPartitions("part", "chunk")

    def add_up(part: int, asked: list[tuple]):
        if not asked:
            return
        sizes = [n for _, _, n, _ in asked]
        opened = [_unpack(payload, 2, n) for _, _, n, payload in asked]
        keys = np.concatenate([np.cumsum(steps, dtype=np.uint64) for steps, _ in opened])
        counts = np.concatenate([c for _, c in opened]).astype(float)
        gone = np.repeat([d for _, d, _, _ in asked], sizes)
        del opened
        distinct, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, counts, len(distinct)).astype(np.int64)
        retained = total - np.bincount(at, counts * gone, len(distinct)).astype(np.int64)
        rows, lo = [], 0
        for (chunk, deleted, n, _), hi in zip(asked, np.cumsum(sizes).tolist()):
            mine = at[lo:hi]
            rows.append((chunk, part, deleted, n, _pack(total[mine], retained[mine]) if deleted else _pack(total[mine])))
            lo = hi
        if part >= ranges:
            sums = np.array([total.sum(), (total > 0).sum(), retained.sum()])
            rows.append((-1, part, False, 3, _pack(sums)))
        yield _batch(rows)

    def run(batches):
        at, asked = None, []
        for b in batches:
            for chunk, part, deleted, n, payload in zip(*(c.to_pylist() for c in b.columns)):
                if part != at:
                    yield from add_up(at, asked)
                    at, asked = part, []
                asked.append((chunk, deleted, n, payload))
        yield from add_up(at, asked)

    return ordered.mapInArrow(run, _CHUNK)


def _answered(chunks: DataFrame, answers: DataFrame, use, schema: str) -> DataFrame:
    """Bring each chunk's answers to it; ``use(grams, bigram totals, unigram totals)`` makes a record batch."""
    ordered = (answers.unionByName(chunks).repartition(F.col("chunk")).sortWithinPartitions("chunk", "part"))

    def run(batches):
        answered: list[list[np.ndarray]] = []
        for b in batches:
            for _, part, deleted, n, payload in zip(*(c.to_pylist() for c in b.columns)):
                if part < _DOCS:
                    answered.append(_unpack(payload, 2 if deleted else 1, n))
                    continue
                grams = _Grams(payload)
                totals = [np.concatenate(x).astype(float) for x in zip(*answered)]
                k = len(grams.bigrams)
                answered = []
                yield use(grams, [t[:k] for t in totals], [t[k:] for t in totals])

    return ordered.mapInArrow(run, schema)


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(np.log2(context + 1)).astype(np.int64), BUCKETS - 1)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros_like(a), where=b > 0)


def _weights(events: DataFrame, floor: float, iterations: int) -> np.ndarray:
    """``(BUCKETS, 3)`` by expectation-maximisation over ``bucket, p2, p1, n``."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    for _ in range(iterations):
        l2, l1, l0 = (F.element_at(F.array(*[F.lit(float(x)) for x in weights[:, i]]), F.col("bucket") + 1)
                      for i in range(3))
        parts = [l2 * F.col("p2"), l1 * F.col("p1"), l0 * F.lit(floor)]
        all_ = parts[0] + parts[1] + parts[2]
        sums = events.groupBy("bucket").agg(*[F.sum(F.col("n") * p / all_).alias(f"s{i}")
                                              for i, p in enumerate(parts)]).collect()  # BUCKETS rows at most
        # one added event for each weight: a bucket without events mixes evenly
        weights = np.ones((BUCKETS, 3))
        for r in sums:
            weights[r["bucket"]] += [r["s0"], r["s1"], r["s2"]]
        weights /= weights.sum(axis=1, keepdims=True)
    return weights


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held: int = 2,
          chunk_bytes: int = CHUNK_BYTES, range_tokens: int = RANGE_TOKENS, deleted_one_in: int = DELETED,
          iterations: int = ITERATIONS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row per input row."""
    doc_id = F.col(id_col)
    held_out = split_of(doc_id, modulus) == held
    chosen = F.pmod(F.xxhash64(F.lit("deleted"), doc_id), F.lit(deleted_one_in)) == 0
    rows = docs.select(doc_id.cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       held_out.alias("held_out"), (chosen & ~held_out).alias("deleted"))
    chunks = cut_lineage(_chunks(rows, chunk_bytes))
    ranges = max(1, math.ceil((chunks.agg(F.sum("n")).first()[0] or 0) / range_tokens))
    answers = cut_lineage(_answers(_requests(chunks, ranges), ranges))
    sums = [_unpack(bytes(r["payload"]), 1, 3)[0] for r in answers.where("chunk = -1").select("payload").collect()]
    total, vocabulary, retained = (int(sum(int(s[i]) for s in sums)) for i in range(3))
    answers = answers.where("chunk >= 0")
    floor = 1 / (vocabulary + 1)

    def events(grams, bigram, unigram):
        c2, context, c1 = bigram[1][grams.bigram_at], unigram[1][grams.context_at], unigram[1][grams.token_at]
        triples, n = np.unique(np.stack([c2, context, c1]), axis=1, return_counts=True)
        c2, context, c1 = triples
        return pa.RecordBatch.from_arrays(
            [pa.array(_bucket(context), pa.int32()), pa.array(_ratio(c2, context)), pa.array(c1 / max(1, retained)), pa.array(n)],
            names=["bucket", "p2", "p1", "n"])

    learned = cut_lineage(_answered(chunks.where("deleted"), answers.where("deleted"), events,
                                    "bucket int, p2 double, p1 double, n long"))
    weights = _weights(learned, floor, iterations)
    # an unseen context has no bigram estimate
    weights[0] = np.array([0.0, *weights[0, 1:]]) / weights[0, 1:].sum()

    def scores(grams, bigram, unigram):
        c2, context, c1 = bigram[0][grams.bigram_at], unigram[0][grams.context_at], unigram[0][grams.token_at]
        mix = weights[_bucket(context)].T
        p1 = c1 / total if total else np.full(len(c1), floor)
        p = mix[0] * _ratio(c2, context) + mix[1] * p1 + mix[2] * floor
        base = np.log10((c1 + 1) / (total + vocabulary + 1))
        add = lambda x: np.add.reduceat(x, grams.starts)  # noqa: E731  every document has its end token
        return pa.RecordBatch.from_arrays(
            [pa.array(grams.doc_ids, pa.int64()), pa.array(grams.held_out), pa.array(grams.lengths),
             pa.array(add((c1 > 0).astype(np.int64))), pa.array(np.full(len(grams.lengths), total)),
             pa.array(add(base)), pa.array(add(np.log10(p)))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return _answered(chunks, answers, scores, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                              "train_tokens long, base_score double, score double")
