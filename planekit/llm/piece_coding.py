"""SentencePiece encoding and decoding with N-best segmentation.

The lattice of a text has one edge for each vocabulary piece that matches;
a character without a piece is one edge of byte pieces.  A space becomes the
vocabulary's word-start mark and one is put in front, so no piece spans from
one *chunk* (spaces, then other characters) into the next: the lattice is a
chain of chunk lattices, and chunks repeat.

1. Forward Viterbi over the distinct chunks of a batch, many chunks at once,
   longest first, edge by edge, gives the best score up to every position.
2. Backward A-star from a chunk's end: a hypothesis is a suffix of pieces, its
   priority is its own score plus the forward score at its start, which is
   exact, so complete segmentations leave the queue in order of score.
3. A text's n-th best differs from its best in few chunks: each chunk's second
   best loses the least over all edges off its best path (forward score + edge
   + backward score), so only the ``n_best - 1`` chunks that lose least can
   differ; A-star runs on those, and a queue over their alternatives combines
   them in order of total score.

A chunk of more than ``LONG`` characters (text without spaces) is walked
instead: position by position, with open ends at most the longest piece ahead,
keeping per position the best few scores and back-pointers.  Its best,
second best and N best come from those, so memory is a few bytes a character.

Scores: the vocabulary fixes them (its own file ranks merges, which is no
lattice score), by Zipf's law over piece ids; bytes score below every piece.
Ties in score keep the order in which the search makes them, which depends on
the text alone.
Decoding joins the pieces' bytes and drops the mark in front; encoding then
decoding gives back every text exactly, also one that holds the mark itself.

Null text counts as empty and has no pieces and one, empty, segmentation.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from array import array
from collections.abc import Callable, Collection, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planekit.llm.pieces import VOCABULARY, Pieces, found_edges

N_BEST = 3
#: distinct chunks whose best segmentations a task keeps
CACHE = 150_000
#: and the bytes, of chunks and their pieces, that it keeps
CACHE_BYTES = 24_000_000
#: chunks of more characters are walked, not listed span by span
LONG = 64
#: bytes of text that are coded at a time (or one text)
SLICE_BYTES = 1_000_000
SLICE_ROWS = 8192
#: spans of the chunks that are coded together
GROUP_SPANS = 1_000_000

_CHUNK = re.compile(r" *[^ ]+| +$")


def zipf_scores(pieces: Pieces) -> np.ndarray:
    """Log-probability by rank, the vocabulary's order; bytes get the lowest rank twice."""
    scores = -np.log(np.arange(pieces.size) + 2.0)
    scores[pieces.byte_ids] = -2.0 * math.log(pieces.size + 2.0)
    return scores


def chunks_of(text: str) -> list[str]:
    return _CHUNK.findall(" " + text) if text else []


class Coder:
    """Encodes texts with one vocabulary; keeps what it knows of chunks, up to ``CACHE`` and ``CACHE_BYTES``."""

    def __init__(self, pieces: Pieces, scores: np.ndarray | None = None):
        scores = zipf_scores(pieces) if scores is None else scores
        self.pieces, self.scores = pieces, scores
        self.scored = np.append(scores, -np.inf)
        self.score_of = self.scores.tolist()
        self.lengths = [0] * pieces.size
        for piece, i in pieces.ids.items():
            self.lengths[i] = len(piece)
        self.byte_score = float(scores[pieces.byte_ids[0]])
        # chunk -> (ids of the best as int32 bytes, its score, what the second best loses)
        self.known: dict[str, tuple[bytes, float, float]] = {}
        self.held = 0
        self.best_of = lru_cache(maxsize=20_000)(self._n_best)

    def learn(self, chunks: Collection[str]) -> None:
        fresh = [c for c in chunks if c not in self.known]
        if len(self.known) + len(fresh) > CACHE or self.held + 8 * sum(map(len, fresh)) > CACHE_BYTES:
            # what these texts share with those before stays: most of it is common
            self.known = {c: self.known[c] for c in chunks if c in self.known}
            self.held = 8 * sum(map(len, self.known))
        self.held += 8 * sum(map(len, fresh))
        for c in fresh:
            if len(c) > LONG:
                found = self._walk(c, 2)
                less = found[0][0] - found[1][0] if len(found) > 1 else math.inf
                self.known[c] = (found[0][1].tobytes(), found[0][0], less)
        short = sorted((c for c in fresh if len(c) <= LONG), key=len, reverse=True)
        at = 0
        while at < len(short):
            step = max(1, GROUP_SPANS // (len(short[at]) * min(len(short[at]), self.pieces.longest)))
            self._viterbi(short[at:at + step])
            at += step

    def _viterbi(self, words: list[str]) -> None:
        """Codes words sorted by falling length, all at once, edge by edge."""
        at, bounds, rows, ids = found_edges(words, self.pieces)
        scores = self.scored[np.maximum(ids, 0)]
        lost = ids < 0
        scores[lost] = -ids[lost] * self.byte_score
        lengths, every = np.fromiter(map(len, words), np.int64, len(words)), np.arange(len(words))
        n = int(lengths[0])
        alpha = np.full((n + 1, len(words)), -np.inf)
        beta = np.full((n + 1, len(words)), -np.inf)
        last = np.zeros((n + 1, len(words)), np.int64)
        alpha[0], beta[lengths, every] = 0.0, 0.0
        edges = [(i, j, lo, hi) for (i, j), lo, hi in zip(at, bounds.tolist(), bounds[1:].tolist()) if lo < hi]
        for i, j, lo, hi in edges:
            own = rows[lo:hi]
            now = alpha[i][own] + scores[lo:hi]
            better = np.flatnonzero(now > alpha[j][own])
            own = own[better]
            alpha[j][own] = now[better]
            last[j][own] = better + lo
        for i, j, lo, hi in reversed(edges):
            own = rows[lo:hi]
            beta[i][own] = np.maximum(beta[i][own], beta[j][own] + scores[lo:hi])
        starts, ends = (np.repeat(np.array(side), np.diff(bounds)) for side in zip(*at))
        on_path, j, live = np.zeros(len(ids), bool), lengths.copy(), every
        while live.size:
            e = last[j[live], live]
            on_path[e] = True
            j[live] = starts[e]
            live = live[j[live] > 0]
        through = alpha[starts, rows] + scores + beta[ends, rows]
        through[on_path] = -np.inf
        second = np.full(len(words), -np.inf)
        np.maximum.at(second, rows, through)
        totals = alpha[lengths, every]
        loss = totals - second
        # edges are ordered by end, so a word's pieces come out in reading order
        path = np.flatnonzero(on_path)
        path = path[np.argsort(rows[path], kind="stable")]
        flat, stops = ids[path], np.cumsum(np.bincount(rows[path], minlength=len(words))).tolist()
        raw, start = flat.astype(np.int32).tobytes(), 0
        spelled = np.zeros(len(words), bool)
        spelled[rows[path[flat < 0]]] = True
        for word, end, total, less, bytewise in zip(words, stops, totals.tolist(), loss.tolist(), spelled.tolist()):
            if bytewise:
                own, at_char = [], 0
                for piece in flat[start:end].tolist():
                    own += self.pieces.bytes_of(word[at_char]) if piece < 0 else [piece]
                    at_char += 1 if piece < 0 else self.lengths[piece]
                self.known[word] = (np.array(own, np.int32).tobytes(), total, less)
            else:
                self.known[word] = (raw[4 * start:4 * end], total, less)
            start = end

    def _walk(self, chunk: str, n_best: int) -> list[tuple[float, np.ndarray]]:
        """The best segmentations of one chunk, keeping ``n_best`` scores and back-pointers per position."""
        get, longest, n = self.pieces.ids.get, self.pieces.longest, len(chunk)
        scores = self.score_of
        back = np.zeros((n + 1, n_best), np.uint16)  # length of the last piece
        rank = np.zeros((n + 1, n_best), np.min_scalar_type(n_best))  # which of the best at its start
        # open[k]: the best so far, (score, length, rank), at k characters ahead
        open_: list[list[tuple[float, int, int]]] = [[(0.0, 0, 0)]] + [[] for _ in range(longest)]
        for i in range(n):
            here = open_.pop(0)
            open_.append([])
            for r, (_, length, of) in enumerate(here):
                back[i, r], rank[i, r] = length, of
            for length in range(1, min(longest, n - i) + 1):
                piece = get(chunk[i:i + length])
                if piece is not None:
                    edge = scores[piece]
                elif length == 1:
                    edge = self.byte_score * len(self.pieces.bytes_of(chunk[i]))
                else:
                    continue
                there = open_[length - 1]
                for r, (score, _, _) in enumerate(here):
                    total = score + edge
                    if len(there) == n_best and total <= there[-1][0]:
                        break
                    at = len(there)
                    while at and there[at - 1][0] < total:
                        at -= 1
                    there.insert(at, (total, length, r))
                    del there[n_best:]
        last = open_[0]
        for r, (_, length, of) in enumerate(last):
            back[n, r], rank[n, r] = length, of
        return [(score, self._traced(chunk, back, rank, r)) for r, (score, _, _) in enumerate(last)]

    def _traced(self, chunk: str, back: np.ndarray, rank: np.ndarray, r: int) -> np.ndarray:
        own, j = array("i"), len(chunk)
        while j:
            i = j - int(back[j, r])
            piece = self.pieces.ids.get(chunk[i:j])
            own.extend(reversed(self.pieces.bytes_of(chunk[i])) if piece is None else (piece,))
            r, j = int(rank[j, r]), i
        return np.frombuffer(own, np.int32)[::-1].copy()

    def _n_best(self, chunk: str, n_best: int) -> list[tuple[float, tuple[int, ...]]]:
        """The best segmentations of one chunk, by A-star from its end."""
        get, longest, n = self.pieces.ids.get, self.pieces.longest, len(chunk)
        into: list[list] = [[] for _ in range(n + 1)]
        alpha = [0.0] + [-math.inf] * n
        for j in range(1, n + 1):
            for i in range(max(0, j - longest), j):
                if (piece := get(chunk[i:j])) is not None:
                    own, score = (piece,), float(self.scores[piece])
                elif j - i == 1:
                    own = tuple(self.pieces.bytes_of(chunk[i]))
                    score = self.byte_score * len(own)
                else:
                    continue
                into[j].append((i, own, score))
                alpha[j] = max(alpha[j], alpha[i] + score)
        # a hypothesis: priority, serial number (ties in order of making), start, score, linked pieces
        serial, queue, out = 0, [(-alpha[n], 0, n, 0.0, None)], []
        while queue and len(out) < n_best:
            _, _, j, score, pieces = heapq.heappop(queue)
            if j == 0:
                whole: list[int] = []
                while pieces:
                    whole += pieces[0]
                    pieces = pieces[1]
                out.append((score, tuple(whole)))
                continue
            for i, own, edge in into[j]:
                serial += 1
                heapq.heappush(queue, (-(alpha[i] + edge + score), serial, i, edge + score, (own, pieces)))
        return out

    def encode(self, chunks: list[str]) -> bytes:
        """The best segmentation as int32 bytes; the chunks must have been learned."""
        known = self.known
        return b"".join([known[c][0] for c in chunks])

    def look_up(self, chunks: list[str]) -> tuple[tuple, tuple, tuple]:
        """The chunks' best segmentations, their scores, and what the second best lose; they must have been learned."""
        return tuple(zip(*map(self.known.__getitem__, chunks))) if chunks else ((), (), ())

    def n_best(self, chunks: list[str], n_best: int) -> list[tuple[float, list[tuple[int, tuple]]]]:
        """``(score, [(chunk position, its pieces)])``: what differs from the best, best first."""
        _, totals, losses = self.look_up(chunks)
        return self.ranked(np.array(totals, np.float64), np.array(losses, np.float64), chunks.__getitem__, n_best)

    def ranked(self, totals: np.ndarray, losses: np.ndarray, chunk_at: Callable[[int], str],
               n_best: int) -> list[tuple[float, list[tuple[int, tuple]]]]:
        """``n_best`` of a text's chunks, from their ``losses``; ``chunk_at`` gives the chunk at a position."""
        base = math.fsum(totals.tolist())
        if n_best < 2 or not len(totals):
            return [(base, [])]
        close = np.arange(len(losses))
        if len(losses) >= n_best:
            close = np.flatnonzero(losses <= np.partition(losses, n_best - 2)[n_best - 2])
        close = close[np.argsort(losses[close], kind="stable")[:n_best - 1]].tolist()
        options = []
        for k in sorted(close):
            # a long chunk's segmentations are too large to keep
            chunk = chunk_at(k)
            found = (self.best_of if len(chunk) <= LONG else self._walk)(chunk, n_best)
            options.append((k, [(found[0][0] - s, own) for s, own in found]))
        # each state picks one alternative per close chunk; a step worsens one of them
        queue, seen, out = [(0.0, (0,) * len(options))], {(0,) * len(options)}, []
        while queue and len(out) < n_best:
            loss, picks = heapq.heappop(queue)
            out.append((base - loss, [(k, alts[p][1]) for (k, alts), p in zip(options, picks) if p]))
            for o, (_, alts) in enumerate(options):
                if picks[o] + 1 < len(alts):
                    nxt = picks[:o] + (picks[o] + 1,) + picks[o + 1:]
                    if nxt not in seen:
                        seen.add(nxt)
                        heapq.heappush(queue, (math.fsum(a[p][0] for (_, a), p in zip(options, nxt)), nxt))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.pieces.texts.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of at most ``SLICE_ROWS`` rows and ``SLICE_BYTES`` bytes of text (or one row)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and (i - start == SLICE_ROWS or held + size > SLICE_BYTES):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def _strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column without nulls, and where each value begins (and the last ends)."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def chunk_column(texts: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """``chunks_of`` all texts: the chunks, where each text's begin (and the last's end), the texts with their space."""
    marked = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise("", texts, " "))
    raw, at = _strings(marked)
    space = raw == 32
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[at[:-1][at[:-1] < at[1:]]] = True
    begins = np.flatnonzero(first)
    offsets = np.append(begins, len(raw)).astype(np.int32)
    chunks = pa.Array.from_buffers(pa.string(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    return chunks, np.searchsorted(begins, at), marked


class _Slice:
    """The best segmentations of a column of texts, text after text; chunks are looked up once for all texts."""

    def __init__(self, coder: Coder, texts: pa.Array):
        chunks, self.chunk_at, self.marked = chunk_column(texts)
        coded = chunks.dictionary_encode()
        self.coder, self.distinct = coder, coded.dictionary.to_pylist()
        self.codes = coded.indices.to_numpy()
        coder.learn(self.distinct)
        best, totals, losses = coder.look_up(self.distinct)
        known = np.frombuffer(b"".join(best), np.int32)
        sizes = np.fromiter(map(len, best), np.int64, len(best)) // 4
        self.totals, self.losses = np.array(totals, np.float64), np.array(losses, np.float64)
        each = sizes[self.codes]
        self.piece_at = np.concatenate([[0], np.cumsum(each)])
        shift = (np.cumsum(sizes) - sizes)[self.codes] - self.piece_at[:-1]
        self.ids = known[np.arange(self.piece_at[-1]) + np.repeat(shift, each)]
        self.offsets = self.piece_at[self.chunk_at]

    def ranked(self, row: int, n_best: int) -> list[tuple[float, int, str]]:
        """``score, n_pieces, ids_sha256`` of a text's best segmentations."""
        lo, hi = self.chunk_at[row:row + 2].tolist()
        codes, view, out = self.codes[lo:hi], memoryview(self.ids).cast("B"), []
        begin, end = self.offsets[row:row + 2].tolist()
        for score, changes in self.coder.ranked(self.totals[codes], self.losses[codes],
                                                lambda k: self.distinct[codes[k]], n_best):
            digest, at, size = hashlib.sha256(), begin, end - begin
            for k, own in changes:
                start, stop = self.piece_at[lo + k:lo + k + 2].tolist()
                digest.update(view[4 * at:4 * start])
                digest.update(np.array(own, np.int32).tobytes())
                at, size = stop, size + len(own) - (stop - start)
            digest.update(view[4 * at:4 * end])
            out.append((score, size, digest.hexdigest()))
        return out

    def round_trips(self, spelled: pa.Array) -> list[bool]:
        """Whether the pieces, by their bytes ``spelled``, give back each text."""
        back, ends = _strings(spelled.take(pa.array(self.ids)))
        text, at = _strings(self.marked)
        back, text = memoryview(back), memoryview(text)
        got, want = ends[self.offsets].tolist(), at.tolist()
        return [back[a:b] == text[c:d] for a, b, c, d in zip(got, got[1:], want, want[1:])]


def _coded(b: pa.RecordBatch, coder: Coder, spelled: pa.Array, n_best: int, with_ids: bool) -> pa.RecordBatch:
    """``encode``'s rows of one slice; nothing else of the slice is held when the next is coded."""
    texts = pc.fill_null(b.column(1), "")
    part = _Slice(coder, texts)
    ranked = [part.ranked(row, n_best) for row in range(len(texts))]
    score, size, digest = zip(*(r for best in ranked for r in best))
    best = pa.ListArray.from_arrays(
        pa.array(np.cumsum([0] + [len(best) for best in ranked]), pa.int32()),
        pa.StructArray.from_arrays([pa.array(score, pa.float64()), pa.array(size, pa.int64()),
                                    pa.array(digest, pa.string())], ["score", "n_pieces", "ids_sha256"]))
    out = [b.column(0), pc.utf8_length(texts).cast(pa.int64()), pa.array(np.diff(part.offsets), pa.int64()),
           pa.array([r[0][2] for r in ranked], pa.string()), pa.array(part.round_trips(spelled)), best]
    names = ["doc_id", "n_chars", "n_pieces", "ids_sha256", "round_trip", "n_best"]
    if with_ids:
        out.insert(3, pa.ListArray.from_arrays(pa.array(part.offsets, pa.int32()), pa.array(part.ids)))
        names.insert(3, "ids")
    return pa.RecordBatch.from_arrays(out, names=names)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_best: int = N_BEST,
           vocabulary: str = VOCABULARY, with_ids: bool = True) -> DataFrame:
    """One row per input row: ``doc_id, n_chars, n_pieces, ids, ids_sha256, round_trip, n_best``.

    ``ids`` is the best segmentation (left out without ``with_ids``);
    ``n_best`` is an array, best first, of ``score, n_pieces, ids_sha256``; a
    hash is over the ids as little-endian 32-bit integers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.read(vocabulary).tables())

    def run(batches):
        coder = Coder(Pieces(*shared.value))
        spelled = pa.array(coder.pieces.texts, pa.binary())
        for whole in batches:
            for b in slices(whole):
                yield _coded(b, coder, spelled, n_best, with_ids)

    ids = "ids array<int>, " if with_ids else ""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id long, n_chars long, n_pieces long, {ids}ids_sha256 string, round_trip boolean, "
             "n_best array<struct<score: double, n_pieces: long, ids_sha256: string>>")


def decode(coded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, text`` of piece ids; null ids give null."""
    shared = coded.sparkSession.sparkContext.broadcast(Pieces.read(vocabulary).tables())

    def run(batches):
        coder = Coder(Pieces(*shared.value))
        for b in batches:
            texts = [None if ids is None else coder.decode(ids) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return coded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, "doc_id long, text string")
