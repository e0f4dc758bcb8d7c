"""Scans of transaction files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardwatch.functions.calendar import Day, as_date, days_between_inclusive
from cardwatch.functions.numeric import decoded, file_stem
from cardwatch.schema import TRANSACTION_SCHEMA

Paths = str | Sequence[str]


def split_paths(paths: Paths) -> list[str]:
    """Paths from a list or from comma-separated text; each may be a glob."""
    parts = paths.split(",") if isinstance(paths, str) else paths
    return [p.strip() for p in parts if p.strip()]


def scan_csv(spark: SparkSession, paths: Paths, schema: StructType = TRANSACTION_SCHEMA):
    """CSV without a header; ``#`` lines are comments and an unreadable cell becomes NULL."""
    reader = spark.read.schema(schema).option("comment", "#").option("header", False)
    return reader.csv(split_paths(paths))


def scan_parquet(
    spark: SparkSession,
    paths: Paths,
    schema: StructType | None = None,
    *,
    merge_schema: bool = False,
) -> DataFrame:
    """The union of Parquet files; their own schema is used when none is given."""
    reader = spark.read.option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*split_paths(paths))


def scan(
    spark: SparkSession, paths: Paths, fmt: str, schema: StructType | None = TRANSACTION_SCHEMA
) -> DataFrame:
    if fmt == "csv":
        return scan_csv(spark, paths, schema or TRANSACTION_SCHEMA)
    if fmt == "parquet":
        return scan_parquet(spark, paths, schema)
    raise ValueError(f"unknown source format {fmt!r}: use csv or parquet")


def day_folders(root: str, first: Day, last: Day) -> str:
    """One glob for the folders ``root/YYYY-MM-DD.parquet``; missing days are skipped."""
    start = as_date(first)
    days = [start + dt.timedelta(days=i) for i in range(days_between_inclusive(first, last))]
    names = ",".join(day.isoformat() for day in days)
    return f"{root.rstrip('/')}/{{{names}}}.parquet"


def scan_day_folders(
    spark: SparkSession, roots: Paths, first: Day, last: Day, schema: StructType | None = None
) -> DataFrame:
    """The folders ``YYYY-MM-DD.parquet`` of the days below each root; missing days are skipped."""
    globs = [day_folders(root, first, last) for root in split_paths(roots)]
    return scan_parquet(spark, globs, schema)


def listed_files(spark: SparkSession, paths: Paths) -> DataFrame:
    """``path`` and ``stem`` of the input files, as a table; nothing of them is read."""
    files = spark.read.format("binaryFile").load(split_paths(paths))
    return files.select("path", file_stem("path").alias("stem"))


def source_stem() -> Column:
    """The stem of the file that a scanned row comes from."""
    return file_stem(decoded(F.col("_metadata.file_name")))
