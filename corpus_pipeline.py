"""A corpus-cleaning pipeline over ``documents``: five stages, each one operator of ``planekit.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
``run`` writes as Parquet to the shared folder and reads back as the next
stage's ``docs``.  All but the last return the columns of ``documents``;
where a stage changes a text, ``n_chars`` follows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planekit.llm.common import split_of
from planekit.llm.decontaminate import decontaminate
from planekit.llm.langid import in_known_language, train
from planekit.llm.line_dedup import dedup_lines
from planekit.llm.piece_coding import encode
from planekit.llm.simhash import near_duplicates
from planekit.session import cut_lineage


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that no learned language explains better than a background model, or without a letter.

    Null and empty texts go.  Without labelled rows every text with a letter stays.
    Rows are judged one by one, so repeated ids and texts share a verdict only by
    their text.  An empty table stays empty.
    """
    part = split_of(F.col("doc_id"), 4)
    return docs.where(in_known_language(train(docs.where(part != 2)), F.col("text"), docs.where(part == 2)))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them.

    Every row stays.  Null text becomes empty.  Rows that repeat an id count as one
    document for how many hold a line, and each keeps or loses its own lines.
    """
    out = dedup_lines(docs, carry=[c for c in docs.columns if c not in ("doc_id", "text")])
    fields = {c: F.col(f"carried.{c}") for c in docs.columns if c not in ("doc_id", "text")}
    if "n_chars" in fields:
        fields["n_chars"] = F.char_length("text").cast("long")
    return out.withColumns(fields).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates exactly one row stays: the one with the smallest id.

    Rows count, not ids: each gets a number of its own, in a written table.  Rows that
    share an id but not their text are apart; of rows with one text and one id, or
    without an id, one stays (a row with an id before one without).  Null text
    counts as empty, and all empty texts are one group.  An empty table stays empty.
    """
    rows = cut_lineage(docs.withColumn("_row", F.monotonically_increasing_id()))
    groups = near_duplicates(rows, "_row").select(F.col("doc_id").alias("_row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))
    stay = groups.join(rows.select("_row", "doc_id"), "_row").groupBy("component_id").agg(first.alias("first"))
    return rows.join(stay.select("first._row"), "_row", "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go.

    Null and empty texts hold none and stay, as does everything where the benchmark
    is empty.  An empty table stays empty.
    """
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of each text, checked by decoding them, and the scores of its best segmentations.

    One row per row; null text has no pieces, like empty text.
    """
    return encode(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

#: the language-ID and encoding stages have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
