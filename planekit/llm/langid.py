"""Language identification by segmentation-marginalised unigrams.

Words are runs of letters, lower-cased, with a word-start mark.  A language
gives each piece of a fixed public vocabulary a probability; a word's
probability is the sum, over all of its segmentations into pieces, of the
product of their probabilities, which a forward pass over its lattice adds up in
logs.  A word of any length is walked whole, position by position, with the
positions of the longest piece kept; its edges are looked up ``SEGMENT`` positions at
a time.  A character without a piece is spelled by bytes, each at the vocabulary's
floor probability.  A text's log-likelihood is the sum over its words; the
score is the posterior of the best language under equal priors.

Training: expectation-maximisation.  Word counts per language come from every
labelled document (with ``per_lang``, from about so many of each language: those
whose hashed id is below per_lang / n).  Each iteration spreads every word's count over its
segmentations by forward-backward in the tasks and sums expected piece counts;
the model is languages x vocabulary numbers, however large the corpus, and what a
task computes with besides is bounded by ``CELLS`` numbers, whatever the number of
languages.

``in_known_language`` compares a text's best language with a background model,
which holds every piece for equally likely.  A text is in a known language iff
its best language's lead over the background, per letter, and its share of
letters among characters other than white space each reach a margin: half of
what all but 0.1 % of all held-out labelled texts have (that itself, where it is
negative; 0 without such texts).  Both count as if ``TYPICAL`` more characters of
the held-out median stood in the text, so a short text is not judged by a few.  With few training rows a text in an unlearned
language, spelled by the same short pieces, can pass.  Without training rows
every text with a letter passes.

Null text, or text without a letter: ``und`` with score 0.  Without training
rows every text is ``und``.  Ties go to the first language in sorted order.
"""

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planekit.llm.common import split_of
from planekit.llm.pieces import VOCABULARY, Pieces, by_length, edge_ids, spans
from planekit.session import cut_lineage

ITERATIONS = 3
#: added to every expected count; the floor of a piece that a language never uses
SMOOTHING = 0.1
#: words whose likelihoods a task keeps
CACHE = 200_000
#: positions whose edges are held at once
SEGMENT = 256
#: numbers that a block of words' edges, or the kept likelihoods, may take
CELLS = 2_000_000
UNKNOWN = "und"
#: usual characters that a text's evidence is mixed with
TYPICAL = 20

#: characters of the texts whose new words are looked up together, about
PART = 1_000_000

_LETTERS = re.compile(r"[^\W\d_]+")
_ASCII_LETTERS = str.maketrans({chr(c): " " for c in range(128) if not chr(c).isalpha()})


def words_in(text: str | None) -> list[str]:
    """Lower-cased letter runs, with a start mark."""
    text = (text or "").lower()
    if text.isascii():
        return [" " + w for w in text.translate(_ASCII_LETTERS).split()]
    found, out = _LETTERS.findall(text), []
    if "".join(found).isalpha():
        return [" " + w for w in found]
    for w in found:
        if not w.isalpha():  # numerals such as superscripts are word characters, not letters
            w = "".join(filter(str.isalpha, w))
            if not w:
                continue
        out.append(" " + w)
    return out


def _parts(texts) -> Iterator[list]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= PART:
            yield part
            part, size = [], 0
    yield part


def _logs(probs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities ``(V + 1, langs)``, a piece's next to each other, and each language's floor."""
    with np.errstate(divide="ignore"):
        logs = np.ascontiguousarray(np.log(probs).T)
    return logs, logs[:-1].min(axis=0)


def _edges(words: list[str], lo: int, hi: int, pieces: Pieces, logs: np.ndarray, floor: np.ndarray):
    """Of the characters ``lo`` to ``hi``: spans, piece ids ``(words, edges)`` and logs ``(edges, words, langs)``."""
    ids = edge_ids([w[lo:hi] for w in words], hi - lo, pieces, pieces.size)
    by_edge = np.ascontiguousarray(ids.T)
    out = logs.take(np.maximum(by_edge, 0), axis=0)
    if (lost := by_edge < 0).any():
        out[lost] = floor * -by_edge[lost][:, None]
    return spans(hi - lo, pieces.longest), ids, out


def _log_sum(terms: np.ndarray) -> np.ndarray:
    top = terms.max(axis=0)
    return top + np.log(np.exp(terms - top).sum(axis=0))


def _forward(words: list[str], n: int, pieces: Pieces, logs: np.ndarray, floor: np.ndarray) -> Iterator[np.ndarray]:
    """Log of the summed probability of all ways to each position 0 to ``n``: ``(words, langs)`` each."""
    window = [np.zeros((len(words), logs.shape[1]))]
    yield window[0]
    for start in range(0, n, SEGMENT):
        lo, hi = max(0, start - pieces.longest), min(n, start + SEGMENT)
        at, _, edges = _edges(words, lo, hi, pieces, logs, floor)
        e = 0
        for j in range(lo + 1, hi + 1):
            size = min(j - lo, pieces.longest)
            if j > start:
                window.append(_log_sum(np.stack(window[-size:]) + edges[e:e + size]))
                yield window[-1]
                del window[:-pieces.longest]
            e += size


def _blocks(words: list[str], n: int, langs: int, longest: int) -> Iterator[list[str]]:
    step = max(1, CELLS // (langs * longest * min(n, SEGMENT)))
    return (words[at:at + step] for at in range(0, len(words), step))


def log_likelihoods(words: list[str], pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """``(words, langs)`` natural logs of the marginal probabilities."""
    out, place = np.empty((len(words), len(probs))), {w: k for k, w in enumerate(words)}
    logs, floor = _logs(probs)
    for n, group in by_length(words).items():
        for part in _blocks(group, n, len(probs), pieces.longest):
            for last in _forward(part, n, pieces, logs, floor):
                pass
            out[[place[w] for w in part]] = last
    return out


def _expected_counts(words: list[str], counts: np.ndarray, pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """Expected piece counts ``(V,)`` of weighted words under one language's ``probs`` ``(1, V + 1)``."""
    total = np.zeros(pieces.size + 1)
    weight = dict(zip(words, counts))
    logs, floor = _logs(probs)
    for n, group in by_length(words).items():
        for part in _blocks(group, n, 1, pieces.longest):
            ahead = [a[:, 0] for a in _forward(part, n, pieces, logs, floor)]
            scale = np.array([weight[w] for w in part])
            behind = {n: np.zeros(len(part))}
            for start in range((n - 1) // SEGMENT * SEGMENT, -1, -SEGMENT):
                end, hi = min(n, start + SEGMENT), min(n, start + SEGMENT + pieces.longest)
                at, ids, edges = _edges(part, start, hi, pieces, logs, floor)
                of: dict[int, list[int]] = {}
                for e, (i, _) in enumerate(at):
                    of.setdefault(start + i, []).append(e)
                for i in range(end - 1, start - 1, -1):
                    terms = edges[of[i], :, 0] + np.stack([behind[start + at[e][1]] for e in of[i]])
                    behind[i] = _log_sum(terms)
                    behind.pop(i + pieces.longest, None)
                    share = np.exp(ahead[i] + terms - ahead[n]) * scale
                    own = ids[:, of[i]].T
                    known = own >= 0
                    np.add.at(total, own[known], share[known])
    return total[:-1]


class LanguageModel:
    """``langs`` and their piece probabilities ``(langs, V + 1)``, the last column 0."""

    def __init__(self, langs: list[str], probs: np.ndarray, pieces: Pieces):
        self.langs, self.probs, self.pieces = langs, probs, pieces

    def totals(self, texts) -> Iterator[tuple[list[str], np.ndarray | None]]:
        """Each text's words and the languages' log-likelihoods (null without words or languages)."""
        if not hasattr(self, "_known"):
            self._known, self._table = {}, []
        for part in _parts(texts):
            words = [words_in(t) for t in part]
            if not self.langs:
                yield from ((ws, None) for ws in words)
                continue
            coded = pa.array(list(chain.from_iterable(words)), pa.large_string()).dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            fresh = [w for w in distinct if w not in self._known]
            if len(self._known) + len(fresh) > min(CACHE, CELLS // len(self.langs)):
                self._known, self._table, fresh = {}, [], distinct
            if fresh:
                start = len(self._known)
                self._known.update((w, start + k) for k, w in enumerate(fresh))
                self._table.append(log_likelihoods(fresh, self.pieces, self.probs))
            if len(self._table) > 1:
                self._table = [np.concatenate(self._table)]
            rows = np.array([self._known[w] for w in distinct], np.intp)[coded.indices.to_numpy()]
            end = 0
            for ws in words:
                start, end = end, end + len(ws)
                yield ws, self._table[0].take(rows[start:end], axis=0).sum(axis=0) if ws else None

    def score(self, texts) -> tuple[list, list]:
        langs, scores = [], []
        for _, total in self.totals(texts):
            if total is None:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            best = int(total.argmax())
            langs.append(self.langs[best])
            scores.append(float(1.0 / np.exp(total - total[best]).sum()))
        return langs, scores


def _labelled(labelled: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``id, text, lang`` of the rows that have a language and a text."""
    return labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                           F.col(lang_col).cast("string").alias("lang")).where("lang is not null and text is not null")


def _languages(rows: DataFrame, per_lang: int | None) -> tuple[list, DataFrame]:
    """The languages of ``rows``, and the rows; with ``per_lang`` about so many of each."""
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()  # one row a language
    if per_lang is None:
        return [r["lang"] for r in sizes], rows
    keep = F.lit(False)
    unit = (F.xxhash64(F.lit("sample"), "id").bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52))
    for r in sizes:
        keep = keep | ((F.col("lang") == r["lang"]) & (unit < min(1.0, per_lang / r["n"])))
    return [r["lang"] for r in sizes], rows.where(keep)


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_lang: int | None = None, iterations: int = ITERATIONS, vocabulary: str = VOCABULARY) -> LanguageModel:
    """Learn from the rows of ``labelled`` whose language and text are not null."""
    spark = labelled.sparkSession
    pieces = Pieces.read(vocabulary)
    langs, rows = _languages(_labelled(labelled, id_col, text_col, lang_col), per_lang)
    if not langs:
        return LanguageModel([], np.zeros((0, pieces.size + 1)), pieces)

    def count(batches):
        for b in batches:
            found: dict[str, Counter] = {}
            for lang, text in zip(b.column(1).to_pylist(), b.column(0).to_pylist()):
                found.setdefault(lang, Counter()).update(words_in(text))
            for lang, n in found.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n), pa.string()), pa.array(list(n), pa.string()),
                     pa.array(list(n.values()), pa.int64())], names=["lang", "word", "n"])

    counted = rows.select("text", "lang").mapInArrow(count, "lang string, word string, n long")
    # words of one language and length next to each other: a task computes them together
    words = cut_lineage(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).sortWithinPartitions("lang", F.length("word")))
    shared = spark.sparkContext.broadcast(pieces.tables())
    probs = np.full((len(langs), pieces.size + 1), 1.0 / pieces.size)
    probs[:, -1] = 0.0
    for _ in range(iterations):
        now = spark.sparkContext.broadcast(probs)

        def expect(batches):
            own, total = Pieces(*shared.value), np.zeros((len(langs), pieces_size))
            for b in batches:
                lang = np.array(b.column(0).to_pylist())
                word, n = b.column(1).to_pylist(), b.column(2).to_numpy()
                for k, name in enumerate(langs):
                    if len(mine := np.flatnonzero(lang == name)):
                        total[k] += _expected_counts([word[i] for i in mine], n[mine].astype(float),
                                                     own, now.value[k:k + 1])
            k, piece = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(piece, pa.int64()),
                                              pa.array(total[k, piece])], names=["k", "piece", "n"])

        pieces_size = pieces.size
        sums = (words.mapInArrow(expect, "k long, piece long, n double")
                .groupBy("k", "piece").agg(F.sum("n").alias("n")).toPandas())  # langs x vocabulary at most
        probs = np.full((len(langs), pieces.size + 1), SMOOTHING)
        probs[sums["k"], sums["piece"]] += sums["n"]
        probs[:, -1] = 0.0
        probs /= probs.sum(axis=1, keepdims=True)
    return LanguageModel(langs, probs, pieces)


def predict(model: LanguageModel, spark, text: Column) -> Column:
    """``struct<lang_pred string, score double>`` of a text column."""
    shared = spark.sparkContext.broadcast((model.langs, model.probs, model.pieces.tables()))

    @F.pandas_udf("lang_pred string, score double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        langs, probs, tables = shared.value
        own = LanguageModel(langs, probs, Pieces(*tables))
        for texts in batches:
            langs, scores = own.score([None if t is None else t for t in texts.tolist()])
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return udf(text)


def _lead(model: LanguageModel, spark, text: Column) -> Column:
    """``lead`` per letter, ``share`` of letters (null without a letter) and the counts under them."""
    probs = np.vstack([model.probs, np.append(np.full(model.pieces.size, 1.0 / model.pieces.size), 0.0)])
    shared = spark.sparkContext.broadcast((model.langs, probs, model.pieces.tables()))

    @F.pandas_udf("lead double, share double, letters long, size long")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        langs, probs, tables = shared.value
        own = LanguageModel(langs + [UNKNOWN], probs, Pieces(*tables))
        for texts in batches:
            texts, rows = [t or "" for t in texts.tolist()], []
            for text, (words, total) in zip(texts, own.totals(texts)):
                letters = sum(len(w) - w.startswith(" ") for w in words)
                size = max(letters, sum(map(len, text.split())))
                rows.append((np.nan, np.nan, 0, size) if total is None else
                            (float(total[:-1].max() - total[-1]) / letters, letters / size, letters, size))
            out = pd.DataFrame(rows, columns=["lead", "share", "letters", "size"])
            yield out.astype({"lead": float, "share": float, "letters": "int64", "size": "int64"})

    return udf(text)


def in_known_language(model: LanguageModel, text: Column, held: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", lang_col: str = "lang") -> Column:
    """Whether a language of ``model`` explains a text; all labelled rows of ``held``, not trained on, set the margins."""
    spark = held.sparkSession
    if not model.langs:
        return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    known = _labelled(held, id_col, text_col, lang_col)
    seen = known.select(_lead(model, spark, F.col("text")).alias("p")).agg(
        *[F.percentile_approx(f"p.{c}", [0.001, 0.5]) for c in ("lead", "share")]).first()
    found, good = _lead(model, spark, text), F.lit(True)
    for name, size, (lowest, usual) in zip(("lead", "share"), ("letters", "size"), (q or (0.0, 0.0) for q in seen)):
        held_to = (found[name] * found[size] + TYPICAL * usual) / (found[size] + TYPICAL)
        good = good & (held_to >= min(lowest, lowest / 2))
    return F.coalesce(good, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             modulus: int = 4, held: int = 2, **kw) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learned from the rows that are not held out."""
    doc_id = F.col(id_col)
    held_out = split_of(doc_id, modulus) == held
    model = train(docs.where(~held_out), id_col, text_col, lang_col, **kw)
    out = docs.select(doc_id.cast("long").alias("doc_id"), held_out.alias("held_out"),
                      predict(model, docs.sparkSession, F.col(text_col)).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")
