"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ``[\x20\x09-\x0D]``
SPACE_BYTES = b" \t\n\x0b\x0c\r"
#: UTF-8 continuation bytes: a text has as many code points as other bytes
CONTINUATION = bytes(range(0x80, 0xC0))


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` (long) and ``text`` only, so no other column can clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def code_points(raw: bytes) -> int:
    return len(raw) if raw.isascii() else len(raw.translate(None, CONTINUATION))


def byte_values(column: pa.Array) -> list:
    """The UTF-8 bytes of a string column, ``None`` for null."""
    return column.cast(pa.binary()).to_pylist()


def split_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def text_at(table: str, spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
