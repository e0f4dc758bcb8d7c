"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.session import scratch_path, stored

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ROW = "row_key"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def columns_of(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns with clashing names cannot interfere."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def with_row_key(df: DataFrame) -> DataFrame:
    """A key of the row itself, as ids may be null or repeated.

    It is made of the partition and the place in it. Rows read from files get the same key on every
    read, also in a retried task; call it on a table as read, or on one that was written.
    """
    return df.withColumn(ROW, F.monotonically_increasing_id())


def id_hash_mod(column: str, n: int):
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


__all__ = [
    "DOCUMENT_COLUMNS",
    "ROW",
    "columns_of",
    "id_hash_mod",
    "read_table",
    "scratch_path",
    "stored",
    "with_row_key",
]
