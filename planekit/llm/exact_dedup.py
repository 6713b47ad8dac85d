"""Exact dedup with an extendible-hash index on shared files.

Texts are equal when identical after deleting every ``[\\x20\\x09-\\x0D]``.

1. *Records.*  One pass normalises the texts.  Each task groups what it has
   buffered by the bytes themselves, so a group of copies leaves a task as one
   *representative* (with its bytes) and rows that point to it.  This is the
   record file of the index, a table in the shared folder.
2. *Directory.*  It starts with one bucket; while a bucket holds more
   representatives than ``capacity`` the directory doubles and the bucket
   splits on its next hash bit.  Bucket sizes come from a histogram of hash
   prefixes; the directory grows as representatives / capacity, not with rows.
3. *Pages.*  Every representative's entry (hash, record pointer) goes to the
   page of its bucket; the task that owns a range of buckets writes its pages
   sorted by (bucket, hash) and marks hashes that more than one entry has.
4. *Owners.*  Only entries whose hash occurs more than once need their bytes.
   The task that owns a key range reads them in hash order and keeps, for the
   hash at hand, a chain of distinct texts; each entry's bytes are compared
   with the chain and it joins a link or extends the chain.  A hot text has at
   most one entry per task buffer; owners work in two levels, first within
   about sqrt(P) buckets of the P input partitions, then on the survivors.

Of equal texts the row with the most code points stays, then the smallest id
(null ids last), then the first read.  Null text counts as empty.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planekit.llm.common import SPACE_BYTES, byte_values, code_points, id_and_text
from planekit.plans.guard import size_guard
from planekit.session import cut_lineage

CAPACITY = 1 << 14
#: bytes of text that a task buffers before it writes its local groups
BUFFER_BYTES = 32 << 20
HASH_BITS = 64
#: the histogram's resolution, and so the directory's largest depth
MAX_DEPTH = 20

_RECORD = pa.schema([
    ("rid", pa.int64()), ("rep", pa.int64()), ("part", pa.int64()), ("doc_id", pa.int64()),
    ("n_cp", pa.int64()), ("h", pa.int64()), ("sha", pa.binary()), ("body", pa.binary()),
    ("grp_n", pa.int64()), ("grp_cp", pa.int64()), ("grp_id", pa.int64()), ("grp_rid", pa.int64())])
_RECORD_DDL = ("rid long, rep long, part long, doc_id long, n_cp long, h long, sha binary, body binary, "
               "grp_n long, grp_cp long, grp_id long, grp_rid long")


def _records(docs: DataFrame, hash_bits: int, buffer_bytes: int) -> DataFrame:
    def flush(buffer: dict, part: int):
        rows = []
        for body, (sha, members) in buffer.items():
            h = xxhash.xxh64_intdigest(body) >> (64 - hash_bits) << (64 - hash_bits)
            h -= (h >> 63) << 64
            best = max(members, key=lambda m: (m[2], m[1] is not None, -(m[1] or 0), -m[0]))
            for k, (rid, doc, n_cp) in enumerate(members):
                rows.append((rid, members[0][0], part, doc, n_cp, h, sha)
                            + ((body, len(members), best[2], best[1], best[0]) if k == 0 else (None,) * 5))
        cols = list(zip(*rows)) or [()] * len(_RECORD)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _RECORD)], schema=_RECORD)

    def run(batches):
        part = TaskContext.get().partitionId()
        rid, held, buffer = part << 36, 0, {}
        for b in batches:
            for doc, raw in zip(b.column(0).to_pylist(), byte_values(b.column(1))):
                raw = raw or b""
                body = raw.translate(None, SPACE_BYTES)
                group = buffer.get(body)
                if group is None:
                    group = buffer[body] = (hashlib.sha256(body).digest(), [])
                    held += len(body)
                group[1].append((rid, doc, code_points(raw)))
                rid, held = rid + 1, held + 32
                if held >= buffer_bytes:
                    yield flush(buffer, part)
                    buffer, held = {}, 0
        yield flush(buffer, part)

    return docs.mapInArrow(run, _RECORD_DDL)


def build_directory(entries: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> list[tuple]:
    """``(prefix, depth)`` of every bucket, in hash order.

    Starts with one bucket of depth 0 and doubles while any bucket is over
    capacity; at ``max_depth`` a page simply grows.  Each doubling counts the
    prefixes of the overfull buckets only.
    """
    done, open_ = [], [(0, 0)]
    step = 5
    while open_:
        depth = open_[0][1]
        deep = min(max_depth, depth + step)
        if depth:
            chosen = F.shiftrightunsigned("h", 64 - depth).isin([p for p, _ in open_])
            rows = entries.where(chosen)
        else:
            rows = entries
        counts = {r["p"]: r["n"] for r in
                  rows.groupBy(F.shiftrightunsigned("h", 64 - deep).alias("p"))
                  .agg(F.count(F.lit(1)).alias("n")).collect()}
        level = {p: sum(n for q, n in counts.items() if q >> (deep - depth) == p) for p, _ in open_}
        open_ = []
        while level:
            split: dict = {}
            for p, n in level.items():
                if n <= capacity or depth == max_depth:
                    done.append((p, depth))
                elif depth == deep:
                    open_.append((p, depth))
                else:
                    split |= {2 * p: 0, 2 * p + 1: 0}
            if split:
                depth += 1
                for q, n in counts.items():
                    if (p := q >> (deep - depth)) in split:
                        split[p] += n
            level = split
    return sorted(done, key=lambda b: b[0] << (64 - b[1]))


def _directory_frame(spark, buckets: list[tuple]) -> tuple[DataFrame, int]:
    """One row per directory slot of the global depth, pointing to a bucket."""
    depth = max(d for _, d in buckets)
    slots = [((p << (depth - d)) + i, k) for k, (p, d) in enumerate(buckets) for i in range(1 << (depth - d))]
    return spark.createDataFrame(slots, "slot long, bucket long"), depth


def _pages(placed: DataFrame) -> DataFrame:
    """Entries by bucket and hash; ``shared`` marks those whose hash another entry has too."""
    ordered = placed.repartition("bucket").sortWithinPartitions("bucket", "h", "rid")

    def run(batches):
        # an entry is written once its successor, maybe of the next batch, is known
        held, equal_before = None, False
        for b in batches:
            rows = pa.concat_batches([held, b]) if held is not None else b
            if rows.num_rows:
                bucket, h = rows.column(0).to_numpy(), rows.column(1).to_numpy()
                equal = (bucket[1:] == bucket[:-1]) & (h[1:] == h[:-1])
                shared = np.append(equal, False) | np.insert(equal, 0, equal_before)
                n = rows.num_rows - 1
                held, equal_before = rows.slice(n), bool(shared[n])
                yield _flagged(rows.slice(0, n), shared[:n])
        if held is not None:
            yield _flagged(held, np.array([equal_before]))

    return ordered.mapInArrow(run, "bucket long, h long, rid long, part long, shared boolean")


def _flagged(rows: pa.RecordBatch, shared: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(shared)], names=[*rows.schema.names, "shared"])


def chain_equal(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rid, head`` of ``keys, rid, body``: equal bodies under equal keys share the smallest rid."""
    ordered = rows.select(*keys, "rid", "body").repartition(*keys).sortWithinPartitions(*keys, "rid")
    k = len(keys)

    def run(batches):
        at, chain = None, []
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(k + 2)]
            rids, heads = cols[k], []
            for row in range(b.num_rows):
                key, body = tuple(c[row] for c in cols[:k]), cols[k + 1][row]
                if key != at:
                    at, chain = key, []
                head = next((r for r, known in chain if known == body), None)
                if head is None:
                    head = rids[row]
                    chain.append((head, body))
                heads.append(head)
            yield pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(heads, pa.int64())],
                                             names=["rid", "head"])

    return ordered.mapInArrow(run, "rid long, head long")


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY, hash_bits: int = HASH_BITS,
                buffer_bytes: int = BUFFER_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row per input row."""
    spark = docs.sparkSession
    records = cut_lineage(_records(id_and_text(docs, id_col, text_col), hash_bits, buffer_bytes))
    reps = records.where("rid = rep")
    entries = reps.select("h", "rid", "part")
    buckets = build_directory(entries, capacity, min(MAX_DEPTH, hash_bits))
    slots, depth = _directory_frame(spark, buckets)
    slot = F.shiftrightunsigned("h", 64 - depth) if depth else F.lit(0).cast("long")
    placed = (entries.withColumn("slot", slot).join(size_guard(slots, 1 << depth), "slot")
              .select("bucket", "h", "rid", "part"))
    pages = cut_lineage(_pages(placed))

    parts = (records.agg(F.max("part")).first()[0] or 0) + 1
    clash = pages.where("shared").withColumn("salt", F.floor(F.col("part") / math.isqrt(parts)).cast("long"))
    clash = cut_lineage(clash.join(reps.select("rid", "body"), "rid"))
    first = cut_lineage(chain_equal(clash, ["bucket", "h", "salt"]))
    heads = first.select(F.col("head").alias("rid")).distinct()
    second = chain_equal(clash.join(heads, "rid", "left_semi"), ["bucket", "h"])
    linked = first.join(second.select(F.col("rid").alias("head"), F.col("head").alias("top")), "head")

    classes = (reps.select("rid", "grp_n", "grp_cp", "grp_id", "grp_rid")
               .join(linked.select("rid", "top"), "rid", "left")
               .withColumn("class", F.coalesce("top", "rid")))
    # ~id and ~rid turn "smallest" into "largest"; a null id is smallest and so loses
    best = F.max(F.struct(F.col("grp_cp"), F.bitwise_not("grp_id").alias("i"),
                          F.bitwise_not("grp_rid").alias("r"))).alias("best")
    stats = classes.groupBy("class").agg(F.sum("grp_n").alias("group_size"), best)
    by_rep = cut_lineage(classes.select("rid", "class").join(stats, "class").select(
        F.col("rid").alias("rep"), "group_size", F.bitwise_not("best.i").alias("keep_id"),
        F.bitwise_not("best.r").alias("keep_rid")))
    return records.select("rid", "rep", "doc_id", "sha").join(by_rep, "rep").select(
        "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
