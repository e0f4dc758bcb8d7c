"""Parquet sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cardwatch.operators.filters import PARTITION_DAY
from cardwatch.schema import TRANSACTION_SCHEMA
from cardwatch.session import stored
from cardwatch.sources.readers import Paths, listed_files, scan_csv, source_stem

PARTITION_FILE = "source_file"


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def overwrite_single_file(df: DataFrame, path: str) -> None:
    """One output file: for small results, since one task writes it.

    The shuffle keeps the work before it parallel, which merging partitions would not.
    """
    df.repartition(1).write.mode("overwrite").parquet(path)


def overwrite_copies(df: DataFrame, paths: Sequence[str]) -> None:
    """The same rows at several places: computed once, then copied from the first place."""
    first, *others = paths
    overwrite(df, first)
    for path in others:
        overwrite(df.sparkSession.read.schema(df.schema).parquet(first), path)


def write_days(
    df: DataFrame, path: str, *, ts: str = "tx_datetime", order: Sequence[str] = ()
) -> None:
    """One ``tx_date=YYYY-MM-DD`` folder per day present, in order of time within each file.

    Rows without a time go to a folder of their own, as a missing day. A day written before is
    replaced and other days stay. Rows are rebalanced by day: adaptive
    execution merges small days and spreads a large one over several tasks and files.
    """
    dated = df.withColumn(PARTITION_DAY, F.to_date(ts))
    (
        dated.hint("rebalance", F.col(PARTITION_DAY))
        .sortWithinPartitions(PARTITION_DAY, ts, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_DAY)
        .parquet(path)
    )


def run_days(df: DataFrame, ts: str = "tx_datetime") -> DataFrame:
    """The days of a run as a small written table; reads nothing but the time of the rows."""
    return stored(df.select(F.to_date(ts).alias("run_day")).distinct(), "run-days")


def write_day_copies(
    df: DataFrame,
    paths: Sequence[str],
    days: Column | DataFrame | None = None,
    *,
    ts: str = "tx_datetime",
    **options,
) -> None:
    """:func:`write_days` at several places. The later places get the days of this run alone from
    the first, however many it holds.

    ``days`` is a condition for them or a table of :func:`run_days`; without it they are taken from
    ``df``, which then is read twice.
    """
    first, *others = paths
    if others and days is None:
        days = run_days(df, ts)
    write_days(df, first, ts=ts, **options)
    for path in others:
        written = df.sparkSession.read.parquet(first)
        if isinstance(days, DataFrame):
            mine = F.col(PARTITION_DAY).eqNullSafe(F.col("run_day"))
            written = written.join(days, mine, "left_semi")
        else:
            written = written.filter(days)
        write_days(written.select(*df.columns), path, ts=ts, **options)


def convert_csv(spark: SparkSession, source: Paths, targets: Sequence[str]) -> None:
    """CSV files to Parquet, one ``source_file=<stem>`` folder per input file, in one job.

    The text is parsed once; further targets copy the folders just written. Two input files of one
    name would share a folder, so they are refused before anything is written.
    """
    first, *others = targets
    files = stored(listed_files(spark, source), "input-files")
    twice = files.groupBy("stem").agg(F.count("*").alias("n"), F.min("path").alias("path"))
    clash = twice.filter("n > 1").orderBy("stem").first()
    if clash:
        raise ValueError(f"{clash['n']} input files are named {clash['stem']!r}, such as {clash['path']}")
    rows = scan_csv(spark, source, TRANSACTION_SCHEMA)
    _write_files(rows.withColumn(PARTITION_FILE, source_stem()), first)
    for path in others:
        written = read_converted(spark, first)
        mine = written.join(files, F.col(PARTITION_FILE) == F.col("stem"), "left_semi")
        _write_files(mine, path)


def read_converted(spark: SparkSession, path: str) -> DataFrame:
    """Transactions and ``source_file`` as text, also where the stems look like dates."""
    schema = StructType([*TRANSACTION_SCHEMA.fields, StructField(PARTITION_FILE, StringType())])
    return spark.read.schema(schema).parquet(path)


def _write_files(df: DataFrame, path: str) -> None:
    (
        df.hint("rebalance", F.col(PARTITION_FILE))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_FILE)
        .parquet(path)
    )
