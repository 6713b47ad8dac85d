"""Benchmark decontamination with DataFrame functions only.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z
lower-cased: ASCII letters and digits, and everything beyond ASCII.  A window
is ``width`` consecutive words of a benchmark item; an item of fewer words,
but at least one, is one window.  A document word inside any occurrence of a
window is hit; a document is contaminated if 5 % of its words are hit.

The benchmark's distinct windows form a hash set: a table keyed by a 64-bit
window hash, broadcast only if a byte bound taken from its exact size fits the
broadcast threshold, else joined by shuffle.  A document's window hashes are
built by doubling: hashes of 1, 2, 4, 8 consecutive words, then two
overlapping ones for any width; they fold case by ``lower``, which never
separates what the contract's A-Z folding joins.  The scan explodes them into
the join, and each find is verified, word by word and with A-Z folded, before
it counts.  Finds are joined back to their document to be verified and
merged into word positions, so overlapping windows count a word once.

Null text has no words; a text without words is not contaminated.  Finds are
carried back by (id, text hash), so rows that repeat an id, or have none, are
judged by their own text.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planekit.llm.common import id_and_text
from planekit.plans.guard import threshold_bytes
from planekit.session import cut_lineage

WIDTH = 13
#: contaminated if n_hit * SHARE >= n_words
SHARE = 20
#: between words, before A-Z are folded
NOT_A_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), NOT_A_WORD), "")


def _folded(words: Column) -> Column:
    return F.transform(words, lambda w: F.translate(w, string.ascii_uppercase, string.ascii_lowercase))


def _pairs(hashes: Column, apart: int) -> Column:
    """Each hash combined with the one ``apart`` places on; shorter by ``apart``."""
    n = F.size(hashes)
    ahead = F.slice(hashes, F.lit(apart + 1), F.greatest(n - apart, F.lit(0)))
    here = F.slice(hashes, F.lit(1), F.greatest(n - apart, F.lit(0)))
    return F.zip_with(here, ahead, lambda a, b: F.xxhash64(a, b))


def with_window_hashes(df: DataFrame, words: str, widths: list[int]) -> DataFrame:
    """Add ``w<width>``, the hashes of all windows of that many words, for each width."""
    df = df.withColumn("_h1", F.transform(words, lambda w: F.xxhash64(F.lower(w))))
    have = 1
    while have * 2 <= max(widths, default=0):
        df = df.withColumn(f"_h{have * 2}", _pairs(F.col(f"_h{have}"), have))
        have *= 2
    for width in widths:
        base = 1 << (width.bit_length() - 1)
        whole = F.col(f"_h{base}") if base == width else _pairs(F.col(f"_h{base}"), width - base)
        df = df.withColumn(f"w{width}", whole)
    return df.drop(*[c for c in df.columns if c.startswith("_h")])


def benchmark_windows(benchmark: DataFrame, width: int, item_col: str, text_col: str) -> DataFrame:
    """``hash, size, window, items``: the distinct windows and the items that hold each."""
    items = benchmark.select(F.col(item_col).alias("item"), _folded(words_of(F.col(text_col))).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("size", F.least(F.size("words"), F.lit(width)))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)
    windows = items.select("item", "size", F.explode(F.transform(
        starts, lambda i: F.slice("words", i, F.col("size")))).alias("window"))
    return windows.groupBy("window", "size").agg(F.collect_set("item").alias("items"))


def _window_sets(benchmark: DataFrame, width: int, item_col: str, text_col: str) -> list[tuple]:
    """``(size, its windows, whether they are small enough to broadcast)`` for each size that occurs."""
    windows = benchmark_windows(benchmark, width, item_col, text_col)
    weight = (F.aggregate("window", F.lit(0).cast("long"), lambda n, w: n + F.octet_length(w) + 24)
              + 16 * F.size("items") + 64)
    sizes = windows.groupBy("size").agg(F.sum(weight).alias("bytes")).collect()  # at most `width` rows
    limit = threshold_bytes(benchmark.sparkSession)
    out = []
    for r in sorted(sizes, key=lambda r: r["size"]):
        own = with_window_hashes(windows.where(F.col("size") == r["size"]), "window", [r["size"]])
        own = own.select(F.element_at(f"w{r['size']}", 1).alias("hash"), "window", "items")
        out.append((r["size"], own, 0 < 2 * r["bytes"] <= limit))
    return out


def find_candidates(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, item_col: str = "item_id",
                    bench_text: str = "text") -> DataFrame:
    """``doc_id, text_hash, found`` of ``doc_id, text``: an array of ``at, size, window, items``.

    Finds by hash, not verified yet; ``at`` counts words from 0.  The exploded
    rows carry no text and go straight into the join, in one generated stage.
    """
    sets = _window_sets(benchmark, width, item_col, bench_text)
    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    base = with_window_hashes(base, "words", [size for size, _, _ in sets])
    out = None
    for size, windows, small in sets:
        # outer: an inner explode makes Catalyst push a size filter, with the
        # whole chain of hash expressions in it, down to the scan
        scan = base.select("doc_id", "text_hash", F.posexplode_outer(f"w{size}").alias("at", "hash"))
        found = scan.join(F.broadcast(windows) if small else windows, "hash")
        found = found.select("doc_id", "text_hash",
                             F.struct("at", F.lit(size).alias("size"), "window", "items").alias("find"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        item = benchmark.schema[item_col].dataType.simpleString()
        out = base.select("doc_id", "text_hash", F.lit(None).cast(
            f"struct<at:int,size:int,window:array<string>,items:array<{item}>>").alias("find")).where("false")
    # bounded by the document: one find a word and window size
    return out.groupBy("doc_id", "text_hash").agg(F.collect_set("find").alias("found"))


def judge(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", bench_text: str = "text", width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """``doc_id, text_hash, n_words, n_hit, items`` (sorted ids as strings), ``hit_words`` (positions), ``contaminated``."""
    docs = id_and_text(docs, id_col, text_col)
    # a table, so that its measured size decides whether the join broadcasts it
    found = cut_lineage(find_candidates(docs, benchmark, width, item_col, bench_text)
                        .withColumnsRenamed({"doc_id": "d", "text_hash": "t"}))
    rows = docs.withColumn("text_hash", F.xxhash64("text"))
    rows = rows.join(found, rows.doc_id.eqNullSafe(found.d) & (rows.text_hash == found.t), "left")
    rows = rows.select("doc_id", "text_hash", "found", words_of(F.col("text")).alias("words"))
    verified = F.filter("found", lambda f: _folded(F.slice("words", f["at"] + 1, f["size"])) == f["window"])
    rows = rows.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), verified.alias("found"))
    covered = F.array_distinct(F.flatten(F.transform(
        "found", lambda f: F.sequence(f["at"], f["at"] + f["size"] - 1))))
    items = F.array_distinct(F.flatten(F.transform("found", lambda f: f["items"])))
    rows = rows.select(
        "doc_id", "text_hash", "n_words",
        F.array_sort(F.coalesce(covered, F.array().cast("array<int>"))).alias("hit_words"),
        F.array_sort(F.coalesce(F.transform(items, lambda i: i.cast("string")),
                                F.array().cast("array<string>"))).alias("items"))
    return rows.withColumn("n_hit", F.size("hit_words").cast("long")).withColumn(
        "contaminated", F.expr(f"n_hit > 0 and {int(share)} * n_hit >= n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **kw) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not contaminated."""
    bad = (judge(docs, benchmark, id_col, text_col, **kw).where("contaminated")
           .select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).distinct())
    bad = cut_lineage(bad)
    mine = docs[id_col].cast("long").eqNullSafe(bad["_d"]) & (F.xxhash64(docs[text_col]) == bad["_t"])
    return docs.join(bad, mine, "left_anti")
