"""A public SentencePiece vocabulary as plain tables, and batch lattices over it.

The vocabulary file is read on the driver only; its pieces travel to the tasks
as a broadcast of fixed size.  Inside this subpackage a space stands for the
vocabulary's word-start mark, so the mark itself, where a text holds it, is an
ordinary character (and, having no piece, falls back to bytes).
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: of a hash, to rule out spans without a look-up
LOW_BITS = (1 << 20) - 1


class Pieces:
    """``ids``: piece text to id; ``byte_ids``: the ids of the 256 byte pieces."""

    def __init__(self, ids: dict[str, int], byte_ids: list[int], size: int):
        self.ids, self.byte_ids, self.size = ids, byte_ids, size
        self.longest = max(map(len, self.ids))
        hashes, owners = [], []
        for length, group in by_length(self.ids).items():
            hashes.append(_span_hashes(group, length, [(0, length)])[0])
            owners += [self.ids[w] for w in group]
        self.hashes = np.concatenate(hashes)
        self.owners = np.array(owners, np.int32)
        by_hash = np.argsort(self.hashes)
        self.hashes, self.owners = self.hashes[by_hash], self.owners[by_hash]
        #: whether a piece's hash has these low bits: most spans are no piece
        self.likely = np.zeros(LOW_BITS + 1, bool)
        self.likely[self.hashes & np.uint64(LOW_BITS)] = True
        self.texts = [b""] * size
        for piece, i in self.ids.items():
            self.texts[i] = piece.encode()
        for value, i in enumerate(byte_ids):
            self.texts[i] = bytes([value])

    @classmethod
    def read(cls, path: str = VOCABULARY) -> "Pieces":
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        byte = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        ids = {sp.id_to_piece(i).replace(MARK, " "): i for i in range(n) if i not in special}
        return cls(ids, [byte[i] for i in range(256)], n)

    def tables(self) -> tuple:
        """What the constructor takes: plain data, to broadcast."""
        return self.ids, self.byte_ids, self.size

    def find(self, hashes: np.ndarray, also: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The hashes that may be a piece's (or are marked in ``also``), by position, and their pieces (-1: none)."""
        maybe = self.likely[hashes & np.uint64(LOW_BITS)]
        where = np.flatnonzero(maybe if also is None else maybe | also)
        some = hashes[where]
        place = np.minimum(np.searchsorted(self.hashes, some), len(self.hashes) - 1)
        return where, np.where(self.hashes[place] == some, self.owners[place], np.int32(-1))

    def bytes_of(self, char: str) -> list[int]:
        """The byte pieces of a character without a piece of its own."""
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]


def spans(n: int, longest: int) -> list[tuple[int, int]]:
    """The possible edges of a lattice over ``n`` characters, by end, then start."""
    return [(i, j) for j in range(1, n + 1) for i in range(max(0, j - longest), j)]


def by_length(words: Iterable[str]) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    for w in words:
        out.setdefault(len(w), []).append(w)
    return out


def _span_hashes(words: list[str], n: int, at: list[tuple[int, int]]) -> np.ndarray:
    """``(spans, words)``: a 64-bit hash of each span's characters."""
    chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = chars.reshape(len(words), n).T.astype(np.uint64)
    out, wanted = np.empty((len(at), len(words)), np.uint64), {span: e for e, span in enumerate(at)}
    reach: dict[int, int] = {}
    for i, j in at:
        reach[i] = max(j, reach.get(i, 0))
    for i in reach:
        h = np.full(len(words), 0x9E3779B97F4A7C15, np.uint64)
        for j in range(i, reach[i]):
            h = (h ^ chars[j]) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            if (e := wanted.get((i, j + 1))) is not None:
                out[e] = h
    return out


def edge_ids(words: list[str], n: int, pieces: Pieces, missing: int) -> np.ndarray:
    """``(words, edges)``: the piece on each of ``spans(n)``, or ``missing``.

    Spans are looked up by a 64-bit hash.  A character without a piece gets
    ``-k``, minus the number of its bytes.
    """
    at = spans(n, pieces.longest)
    hashes = _span_hashes(words, n, at).ravel()
    where, owners = pieces.find(hashes)
    found = owners >= 0
    ids = np.full(len(hashes), missing, np.result_type(pieces.owners, np.min_scalar_type(missing)))
    ids[where[found]] = owners[found]
    ids = ids.reshape(len(at), len(words)).T.copy()
    single = [e for e, (i, j) in enumerate(at) if j - i == 1]
    for r, c in zip(*np.nonzero(ids[:, single] == missing)):
        ids[r, single[c]] = -len(words[r][at[single[c]][0]].encode("utf-8", "surrogatepass"))
    return ids


def found_edges(words: list[str], pieces: Pieces) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray, np.ndarray]:
    """The edges that exist, of words sorted by falling length: ``spans, bounds, rows, ids``.

    Span ``e`` has the edges ``bounds[e]`` to ``bounds[e + 1]``, each of the word
    ``rows`` with the piece ``ids``; a character without a piece gets ``-k``,
    minus the number of its bytes.  Only the words that reach a span are hashed.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    n, begins = int(lengths[0]), np.cumsum(lengths) - lengths
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = np.zeros((n, len(words)), np.uint64)
    chars[np.arange(len(flat)) - np.repeat(begins, lengths), np.repeat(np.arange(len(words)), lengths)] = flat
    reach = np.searchsorted(-lengths, -np.arange(n + 1), side="right").tolist()  # words of at least so many characters
    at = spans(n, pieces.longest)
    starts = np.cumsum([0] + [reach[j] for _, j in at])
    place = dict(zip(at, starts.tolist()))
    hashes, single = np.empty(starts[-1], np.uint64), np.zeros(starts[-1], bool)
    for i in range(n):
        h = np.full(reach[i + 1], 0x9E3779B97F4A7C15, np.uint64)
        for j in range(i + 1, min(n, i + pieces.longest) + 1):
            out = hashes[place[i, j]:place[i, j] + reach[j]]
            np.bitwise_xor(h[:reach[j]], chars[j - 1, :reach[j]], out=out)
            out *= np.uint64(0xD6E8FEB86659FD93)
            out ^= out >> np.uint64(32)
            h = out
        single[place[i, i + 1]:place[i, i + 1] + reach[i + 1]] = True
    cells, ids = pieces.find(hashes, single)
    kept = (ids >= 0) | single[cells]
    cells, ids = cells[kept], ids[kept]
    bounds = np.searchsorted(cells, starts)
    span = np.repeat(np.arange(len(at)), np.diff(bounds))
    rows = cells - starts[span]
    if (lost := np.flatnonzero(ids < 0)).size:
        code = chars[np.array([i for i, _ in at])[span[lost]], rows[lost]]
        ids[lost] = -1 - (code >= 0x80).astype(np.int32) - (code >= 0x800) - (code >= 0x10000)
    return at, bounds, rows, ids
