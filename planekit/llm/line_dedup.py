"""Line dedup over levelled sorted runs of line hashes.

The key of a line is the line with ``[\\x20\\x09-\\x0D]`` stripped at both ends
and A-Z lower-cased; its hash is BLAKE2b cut to 16 bytes.  Documents are taken
in batches of descending id ranges.  The index is a set of *runs*, tables in
the shared folder sorted by hash.  Each new batch is aggregated to one row per
hash and merge-joined with the runs: hashes that the join does not find (the
anti-join) are new, and the batch adds them with the largest id that holds
them, which is the largest of all documents because batches descend; hashes
that it finds add only a count.  A level that has ``fanout`` runs is compacted
into one run of the next level, so an entry is rewritten once a level, not
once a batch.

At the end, keys found in at least ``min_docs`` documents are frequent; all
their lines go, save those of the document that first added them.

Defined cases: null or empty text is one empty line and stays; a document
without an id takes no part in counting and keeps all lines; rows that repeat
an id count as one document, and each of them is cleaned by that id.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planekit.llm.common import SPACE_BYTES, byte_values, code_points, id_and_text
from planekit.session import cut_lineage

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 2

_RUN = "key binary, n_docs long, keeper long"


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE_BYTES).lower()  # bytes.lower touches A-Z only


def key_hash(key: bytes, min_chars: int) -> bytes | None:
    if len(key) < min_chars or (len(key) < 4 * min_chars and code_points(key) < min_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def line_occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, key``: the distinct long-line hashes of each row with an id."""
    def run(batches):
        for b in batches:
            ids, keys = [], []
            for doc, raw in zip(b.column(0).to_pylist(), byte_values(b.column(1))):
                found = {key_hash(line_key(x), min_chars) for x in (raw or b"").split(b"\n")}
                found.discard(None)
                ids += [doc] * len(found)
                keys += found
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], names=["doc_id", "key"])

    return (docs.where("doc_id is not null and text is not null")
            .mapInArrow(run, "doc_id long, key binary"))


class LineRuns:
    """Levels of runs ``key, n_docs, keeper``; ``keeper`` is set where a key was first added."""

    def __init__(self, spark, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def rows(self) -> DataFrame:
        out = self.spark.createDataFrame([], _RUN)
        for run in [r for level in self.levels for r in level]:
            out = out.unionByName(run)
        return out

    def add(self, batch: DataFrame) -> DataFrame:
        """Add ``key, n_docs, keeper`` (one row per key); return the run written for it."""
        known = self.rows().where("keeper is not null").select("key", F.lit(True).alias("known"))
        run = (batch.join(known.hint("merge"), "key", "left")
               .select("key", "n_docs", F.when(F.col("known").isNull(), F.col("keeper")).alias("keeper")))
        run = cut_lineage(run.sortWithinPartitions("key"))
        self._put(0, run)
        return run

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = cut_lineage(_merged(self.levels[level]).sortWithinPartitions("key"))
            self.levels[level] = []
            self._put(level + 1, merged)

    def totals(self) -> DataFrame:
        return _merged([self.rows()])


def _merged(runs: list[DataFrame]) -> DataFrame:
    rows = runs[0]
    for r in runs[1:]:
        rows = rows.unionByName(r)
    return rows.groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))


def _descending_batches(ids: DataFrame, n_batches: int) -> list:
    """Upper bounds (exclusive) of the batches; any bounds give the same result."""
    shares = [i / n_batches for i in range(1, n_batches)]
    cuts = ids.agg(F.percentile_approx("doc_id", shares, 1000).alias("q")).first()["q"] if shares else []
    return sorted(set(cuts or []), reverse=True)


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                   n_batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``doc_id, keys``: for each document that loses lines, the hashes of those lines."""
    cuts = _descending_batches(docs.where("doc_id is not null").select("doc_id"), n_batches)
    batch_no = F.lit(len(cuts))
    for i, cut in reversed(list(enumerate(cuts))):
        batch_no = F.when(F.col("doc_id") > cut, i).otherwise(batch_no)
    found = cut_lineage(line_occurrences(docs, min_chars).withColumn("batch", batch_no),
                        partition_by="batch")
    index = LineRuns(docs.sparkSession, fanout)
    for i in range(len(cuts) + 1):
        rows = found.where(F.col("batch") == i).select("key", "doc_id").distinct()
        index.add(rows.groupBy("key").agg(F.count("doc_id").alias("n_docs"),
                                          F.max("doc_id").alias("keeper")))
    # a table of its own: both sides of the join below are then plain shuffles,
    # of which AQE can split a line that a third of all documents hold
    frequent = cut_lineage(index.totals().where(F.col("n_docs") >= min_docs).select("key", "keeper"))
    return (found.select("doc_id", "key").join(frequent, "key")
            .where(F.col("doc_id") != F.col("keeper"))
            .groupBy("doc_id").agg(F.collect_set("key").alias("keys")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                n_batches: int = BATCHES, fanout: int = FANOUT,
                carry: list[str] | None = None) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` (the kept text), one row per input row.

    ``carry`` names further columns of ``docs`` to pass through, returned as
    one struct column ``carried``.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.struct(*[F.col(c) for c in carry or []] or [F.lit(0).alias("_")]).alias("carried"))
    dropped = repeated_lines(id_and_text(docs, id_col, text_col), min_docs, min_chars, n_batches, fanout)
    rows = (base.where("doc_id is not null").join(dropped, "doc_id", "left")
            .select("doc_id", "text", "carried", "keys")
            .unionByName(base.where("doc_id is null")
                         .withColumn("keys", F.lit(None).cast("array<binary>"))))

    def run(batches):
        for b in batches:
            n_lines, n_dropped, kept = [], [], []
            for raw, keys in zip(byte_values(b.column("text")), b.column("keys").to_pylist()):
                lines = (raw or b"").split(b"\n")
                gone = set(keys or ())
                stay = [x for x in lines if key_hash(line_key(x), min_chars) not in gone] if gone else lines
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                 pa.array(kept, pa.binary()), b.column("carried")],
                names=["doc_id", "n_lines", "n_dropped", "text", "carried"])

    carried = rows.schema["carried"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id long, n_lines long, n_dropped long, text binary, carried {carried}")
    out = out.withColumn("text", F.col("text").cast("string"))
    return out if carry else out.drop("carried")
