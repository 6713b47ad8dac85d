"""Quality rules as a short-circuit cascade, with DataFrame functions only.

``measure`` counts words, symbols and repetition of every whole text.  A rule
rejects a document by these counts or by a look of its own at the text.  The
cascade first writes a sample of about ``SAMPLE`` documents (the documented
bound; the sample decides the order, never a verdict) and finds each rule's cost
(the time its evaluation adds to a scan of the sample) and which sampled
documents it rejects.  Rules are then ordered greedily: next comes the rule that
rejects most per cost of the documents that the rules before it leave.  One CASE
expression evaluates them in that order and stops at the first that rejects, so
the dear rules see only what the cheap ones keep.  Whether a document is kept does
not depend on the order; ``rejected_by``, the first rule that rejects, does.

Rules on counts that are measured anyway cost next to nothing and come first.
The thresholds are the published ones of web-corpus filters: see ``RULES``.

Defined results: null text has no words, like empty text (rejected by
``few_words``).  Rows are independent, so repeated ids and texts are judged row by
row; an empty table gives an empty result.  Other columns are not read.  Cost per
text is near-linear in its length (one sort of its three-word windows, and only if
one of them repeats).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planekit.session import cut_lineage

#: documents that the order of the rules is estimated on, at most about
SAMPLE = 2000
RUNS = 2
#: no rule costs less than this (seconds over the sample)
LEAST_COST = 1e-3

_SPACES = "\t\n\x0b\x0c\r"
_A_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
BULLETS = r"^[\x20\x09-\x0D]*[-*•‣▪●]"
ELLIPSIS = r"(?:\.\.\.|…)[\x20\x09-\x0D]*$"


def _plain(text: Column) -> Column:
    """All of ``[\\x20\\x09-\\x0D]`` as spaces."""
    for c in _SPACES:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def _pieces(plain: Column) -> Column:
    return F.array_remove(F.split(plain, " ", -1), "")


def lines_of(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(_A_WORD))


_PLACE = (1 << 31) - 1


def _twice(ordered: str, key: Callable[[Column], Column]) -> Column:
    """The elements of a sorted array whose key another element has too."""
    def same(p: Column, k: Column) -> Column:
        near = [F.coalesce(key(F.get(F.col(ordered), k + d)) == key(p), F.lit(False)) for d in (-1, 1)]
        return near[0] | near[1]
    return F.filter(ordered, same)


def _with_repeated_words(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words in three-word windows that ``_words`` holds twice or more.

    Window hashes without a repetition end the search.  Otherwise the positions
    (low bits) sorted by hash (high bits) give those that may repeat, and only
    their windows are compared as text.  Each step is a column of its own that the
    next refers to several times, so it is computed once.
    """
    # an empty array whose elements cannot be null: Spark sorts such arrays as plain longs
    words, none = F.col("_words"), F.slice(F.array(F.lit(0).cast("long")), 1, 0)
    hashes = F.transform(words, lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))
    df = df.withColumn("_h", F.when(F.size(words) > 3, F.slice(hashes, 1, F.greatest(F.size(words) - 2, F.lit(0)))).otherwise(none))
    packed = F.transform("_h", lambda x, i: x.bitwiseAND(~_PLACE).bitwiseOR(i.cast("long")))
    df = df.withColumn("_h", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(packed)).otherwise(none))

    def window(p: Column) -> Column:
        i = p.bitwiseAND(F.lit(_PLACE)).cast("int")
        return F.struct(F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i"))

    df = df.withColumn("_h", F.sort_array(F.transform(_twice("_h", lambda p: F.shiftright(p, 31)), window)))
    df = df.withColumn("_h", F.sort_array(F.transform(_twice("_h", lambda p: p["w"]), lambda p: p["i"])))
    step = F.transform("_h", lambda s, k: F.coalesce(F.least(F.get(F.col("_h"), k + 1) - s, F.lit(3)), F.lit(3)))
    return df.withColumn("n_repeat_words", F.aggregate(step, F.lit(0), lambda n, x: n + x)).drop("_h")


class Document(NamedTuple):
    """What a rule looks at: the counts ``m``, the text, its words and its lines with a word."""
    m: Column
    text: Column
    words: Column
    lines: Column


def measure(docs: DataFrame) -> DataFrame:
    """Add ``m``, the counts of ``text`` (all long): words, their code points, symbols, lines with a word, and
    repetition; and ``words`` and ``lines`` themselves."""
    df = docs.withColumn("_plain", _plain(F.coalesce("text", F.lit(""))))
    df = df.withColumn("_words", _pieces(F.col("_plain"))).withColumn("_lines", lines_of(F.coalesce("text", F.lit(""))))
    df = _with_repeated_words(df)
    counts = F.struct(*[c.cast("long").alias(name) for name, c in (
        ("n_words", F.size("_words")), ("word_chars", F.char_length(F.replace("_plain", F.lit(" "), F.lit("")))),
        ("n_symbols", F.regexp_count("_plain", F.lit(SYMBOLS))), ("n_lines", F.size("_lines")),
        ("n_dup_lines", F.size("_lines") - F.size(F.array_distinct("_lines"))), ("n_repeat_words", F.col("n_repeat_words")))])
    return df.select(*docs.columns, counts.alias("m"), F.col("_words").alias("words"), F.col("_lines").alias("lines"))


def _share(pieces: Column, pattern: str) -> Column:
    """The share of the pieces of a text that match; 0 without pieces."""
    found = F.size(F.filter(pieces, lambda x: x.rlike(pattern)))
    return F.when(F.size(pieces) > 0, found / F.size(pieces)).otherwise(F.lit(0.0))


#: name -> whether a document goes.  Fixed values: Rae et al. 2021 (few_words to
#: ellipsis), Raffel et al. 2020 (placeholder).
RULES: dict[str, Callable[[Document], Column]] = {
    "few_words": lambda d: d.m["n_words"] < 50,
    "repeated_words": lambda d: 100 * d.m["n_repeat_words"] > 50 * d.m["n_words"],
    "word_length": lambda d: (d.m["word_chars"] < 3 * d.m["n_words"]) | (d.m["word_chars"] > 10 * d.m["n_words"]),
    "symbols": lambda d: 10 * d.m["n_symbols"] > d.m["n_words"],
    "dup_lines": lambda d: 10 * d.m["n_dup_lines"] > 3 * d.m["n_lines"],
    "letters": lambda d: _share(d.words, r"\p{L}") < 0.8,
    "bullets": lambda d: _share(d.lines, BULLETS) > 0.9,
    "ellipsis": lambda d: _share(d.lines, ELLIPSIS) > 0.3,
    "placeholder": lambda d: F.contains(F.lower(d.text), F.lit("lorem ipsum")),
}
#: the rules whose verdict the contract calls base
BASE_RULES = ("few_words", "repeated_words")


def _rejects(name: str, rules) -> Column:
    return F.coalesce(rules[name](Document(*map(F.col, Document._fields))), F.lit(False))


def estimate(sample: DataFrame, rules=RULES, runs: int = RUNS) -> tuple[dict[str, float], list[tuple[frozenset, int]]]:
    """Each rule's cost in seconds over ``sample`` (measured), and how many documents each set of rules rejects."""
    def seconds(what: Column) -> float:
        began, took = time.perf_counter(), []
        for _ in range(runs):
            sample.agg(what).collect()
            took.append(time.perf_counter() - began)
            began = time.perf_counter()
        return min(took)

    idle = seconds(F.sum(F.length("text") + F.col("m.n_words") + F.size("words") + F.size("lines")))
    cost = {name: max(LEAST_COST, seconds(F.count_if(_rejects(name, rules))) - idle) for name in rules}
    # at most 2 to the number of rules, and at most the sample's size
    mask = F.concat_ws(",", *[F.when(_rejects(name, rules), F.lit(name)) for name in rules])
    sets = [(frozenset(filter(None, r["mask"].split(","))), r["n"])
            for r in sample.groupBy(mask.alias("mask")).agg(F.count(F.lit(1)).alias("n")).collect()]
    return cost, sets


def order_rules(cost: dict[str, float], sets: list[tuple[frozenset, int]]) -> list[str]:
    """Greedily the rule that rejects most per cost among the documents that are left; cheap ones first among equals."""
    out, left = [], list(sets)
    while len(out) < len(cost):
        def gain(name: str) -> tuple[float, float, str]:
            return -sum(n for s, n in left if name in s) / cost[name], cost[name], name
        out.append(min((name for name in cost if name not in out), key=gain))
        left = [(s, n) for s, n in left if out[-1] not in s]
    return out


def apply_cascade(measured: DataFrame, order: list[str], rules=RULES) -> DataFrame:
    """Add ``rejected_by`` and ``kept``: one CASE that stops at the first rule that rejects."""
    found = F.lit(None).cast("string")
    for name in reversed(order):
        found = F.when(_rejects(name, rules), F.lit(name)).otherwise(found)
    return measured.withColumn("rejected_by", found).withColumn("kept", F.col("rejected_by").isNull())


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES,
                  sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, the counts of ``measure``, ``base_failed``, ``rejected_by`` and ``kept`` of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.count()
    few = rows.sample(False, min(1.0, sample / total), seed=1) if total else rows
    order = order_rules(*estimate(cut_lineage(measure(few)), rules))
    out = apply_cascade(measure(rows), order, rules)
    base = F.lit(False)
    for name in BASE_RULES:
        base = base | _rejects(name, RULES)
    return out.select("doc_id", "m.*", base.alias("base_failed"), "rejected_by", "kept")
