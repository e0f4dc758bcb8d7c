"""Queries over scans and sinks: transactions are written, read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwatch.operators.filters import between_days
from cardwatch.plans.jobs import convert_job, feature_job, label_job
from cardwatch.plans.registry import query
from cardwatch.plans.tables import TX_LIST, TX_SQL, as_text, plain, transactions
from cardwatch.plans.window_queries import OUTPUT_DAYS, features_sql
from cardwatch.schema import TRANSACTION_COLUMNS, TRANSACTION_SCHEMA
from cardwatch.session import scratch_path
from cardwatch.sources import readers, writers

_ALL_SQL = f"WITH {TX_SQL} SELECT {TX_LIST} FROM tx"
_SMALL = "tx_amount <= 50"
_LARGE = "tx_amount > 50"


def _write_csv(df, path):
    """Raw text without a header, with a comment line after each fraud."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    line = F.concat_ws(",", *cells)
    noted = F.when(F.col("tx_fraud") == 1, F.concat(line, F.lit("\n# flagged"))).otherwise(line)
    df.select(noted.alias("value")).write.text(path)


@query("csv_typed_scan", _ALL_SQL)
def csv_typed_scan(spark, sf):
    path = scratch_path(spark, "csv")
    _write_csv(transactions(spark, sf), path)
    return plain(readers.scan_csv(spark, path))


@query(
    "csv_unreadable_cells",
    f"""WITH {TX_SQL}
SELECT transaction_id,
  CASE WHEN tx_amount > 100 THEN NULL ELSE tx_datetime END AS tx_datetime,
  customer_id, CASE WHEN tx_fraud = 0 THEN CAST(terminal_id AS VARCHAR) END AS terminal_id, tx_amount,
  tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario FROM tx""",
)
def csv_unreadable_cells(spark, sf):
    path = scratch_path(spark, "csv")
    time = F.when(F.col("tx_amount") > 100, "bad").otherwise(F.col("tx_datetime").cast("string"))
    place = F.when(F.col("tx_fraud") == 1, "").otherwise(F.col("terminal_id").cast("string"))
    broken = transactions(spark, sf).withColumns({"tx_datetime": time, "terminal_id": place})
    _write_csv(broken, path)
    return plain(as_text(readers.scan_csv(spark, path), "terminal_id"))


@query("parquet_multi_path_scan", _ALL_SQL)
def parquet_multi_path_scan(spark, sf):
    rows = transactions(spark, sf)
    paths = [scratch_path(spark, name) for name in ("small", "large")]
    writers.overwrite(rows.filter(_SMALL), paths[0])
    writers.overwrite(rows.filter(_LARGE), paths[1])
    return plain(readers.scan_parquet(spark, paths, TRANSACTION_SCHEMA))


@query("parquet_glob_scan", _ALL_SQL)
def parquet_glob_scan(spark, sf):
    rows = transactions(spark, sf)
    paths = [scratch_path(spark, name) for name in ("small", "large")]
    writers.overwrite(rows.filter(_SMALL), paths[0])
    writers.overwrite(rows.filter(_LARGE), paths[1])
    return plain(readers.scan_parquet(spark, ",".join(f"{p}/*.parquet" for p in paths)))


@query(
    "scan_by_format",
    f"""WITH {TX_SQL}, n AS (SELECT count(*) AS rows, sum(tx_time_seconds)::BIGINT AS seconds FROM tx)
SELECT 'csv' AS format, rows, seconds FROM n UNION ALL SELECT 'parquet', rows, seconds FROM n""",
)
def scan_by_format(spark, sf):
    paths = {fmt: scratch_path(spark, fmt) for fmt in ("csv", "parquet")}
    rows = transactions(spark, sf)
    _write_csv(rows, paths["csv"])
    writers.overwrite(rows, paths["parquet"])
    counted = [
        readers.scan(spark, path, fmt).agg(
            F.lit(fmt).alias("format"),
            F.count("*").alias("rows"),
            F.sum("tx_time_seconds").alias("seconds"),
        )
        for fmt, path in paths.items()
    ]
    return counted[0].unionByName(counted[1])


@query(
    "parquet_merged_schema_scan",
    f"""WITH {TX_SQL}
SELECT {", ".join(TRANSACTION_COLUMNS[:-2])},
  CASE WHEN tx_amount <= 50 THEN CAST(tx_fraud AS VARCHAR) END AS tx_fraud,
  CASE WHEN tx_amount <= 50 THEN CAST(tx_fraud_scenario AS VARCHAR) END AS tx_fraud_scenario FROM tx""",
)
def parquet_merged_schema_scan(spark, sf):
    rows = transactions(spark, sf)
    paths = [scratch_path(spark, name) for name in ("labelled", "unlabelled")]
    writers.overwrite(rows.filter(_SMALL), paths[0])
    writers.overwrite(rows.filter(_LARGE).drop("tx_fraud", "tx_fraud_scenario"), paths[1])
    merged = readers.scan_parquet(spark, paths, merge_schema=True)
    columns = merged.select(*TRANSACTION_COLUMNS)
    return plain(as_text(columns, "tx_fraud", "tx_fraud_scenario"))


@query("parquet_two_targets", f"{_ALL_SQL} UNION ALL SELECT {TX_LIST} FROM tx")
def parquet_two_targets(spark, sf):
    paths = [scratch_path(spark, name) for name in ("first", "second")]
    writers.overwrite_copies(transactions(spark, sf), paths)
    return plain(readers.scan_parquet(spark, paths))


@query(
    "parquet_single_file",
    f"WITH {TX_SQL} SELECT tx_time_days, count(*) AS rows, CAST(1 AS BIGINT) AS files "
    "FROM tx GROUP BY tx_time_days",
)
def parquet_single_file(spark, sf):
    path = scratch_path(spark, "single")
    per_day = transactions(spark, sf).groupBy("tx_time_days").agg(F.count("*").alias("rows"))
    writers.overwrite_single_file(per_day, path)
    stored = readers.scan_parquet(spark, path)
    files = stored.agg(F.count_distinct("_metadata.file_name")).scalar()
    return stored.select("tx_time_days", "rows", files.alias("files"))


@query("csv_to_parquet_by_file", f"WITH {TX_SQL} SELECT {TX_LIST}, true AS same_file FROM tx")
def csv_to_parquet_by_file(spark, sf):
    """Raw files converted in one job; every row must lie in the folder named after its file."""
    raw = scratch_path(spark, "raw")
    targets = [scratch_path(spark, name) for name in ("converted", "converted-copy")]
    rows = transactions(spark, sf)
    _write_csv(rows.repartition("tx_time_days"), raw)
    convert_job(spark, raw, targets)
    origin = readers.scan_csv(spark, raw).select(
        "transaction_id", readers.source_stem().alias("_stem")
    )
    stored = writers.read_converted(spark, targets[1]).join(origin, "transaction_id")
    same = F.col("source_file") == F.col("_stem")
    return plain(stored.select(*TRANSACTION_COLUMNS, same.alias("same_file")))


# File names with characters that paths, URLs and folder names write differently.
ODD_STEMS = ("a b", "50% off", "x+y", "100%25=é")
_STEMS_SQL = " ".join(f"WHEN {i} THEN '{stem}'" for i, stem in enumerate(ODD_STEMS))


def _rename(spark, source, target):
    """Move a file or folder that this query has written."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(target).getParent())
    for status in files.globStatus(path(source)):
        files.rename(status.getPath(), path(target))


@query(
    "csv_odd_file_names",
    f"""WITH {TX_SQL} SELECT {TX_LIST}, CASE transaction_id % {len(ODD_STEMS)} {_STEMS_SQL} END
  AS source_file FROM tx""",
)
def csv_odd_file_names(spark, sf):
    """Each output folder has the true name of its file, at both targets."""
    raw = scratch_path(spark, "raw")
    targets = [scratch_path(spark, name) for name in ("converted", "converted-copy")]
    rows = transactions(spark, sf)
    for i, stem in enumerate(ODD_STEMS):
        part = scratch_path(spark, "part")
        _write_csv(rows.filter(F.col("transaction_id") % len(ODD_STEMS) == i).coalesce(1), part)
        _rename(spark, f"{part}/part-*", f"{raw}/{stem}.txt")
    convert_job(spark, raw, targets)
    return plain(writers.read_converted(spark, targets[1]))


@query(
    "day_partitioned_sink",
    f"WITH {TX_SQL} SELECT {TX_LIST}, CAST(CAST(tx_datetime AS DATE) AS VARCHAR) AS tx_date FROM tx",
)
def day_partitioned_sink(spark, sf):
    """Written by day, then some days written again: the result holds every row once."""
    path = scratch_path(spark, "days")
    rows = transactions(spark, sf)
    writers.write_days(rows, path, order=["transaction_id"])
    writers.write_days(between_days(rows, *OUTPUT_DAYS), path, order=["transaction_id"])
    return plain(spark.read.parquet(path).select(*TRANSACTION_COLUMNS, "tx_date"))


@query(
    "feature_job",
    f"SELECT *, CAST(CAST(tx_datetime AS DATE) AS VARCHAR) AS tx_date FROM ({features_sql()}) "
    "WHERE tx_datetime >= '2024-01-20' AND tx_datetime < '2024-01-25'",
)
def feature_job_output(spark, sf):
    """The whole job: day-partitioned input, look-back, windows, day-partitioned output, a copy."""
    source = scratch_path(spark, "transactions")
    targets = [scratch_path(spark, name) for name in ("features", "features-copy")]
    writers.write_days(transactions(spark, sf), source)
    feature_job(spark, source, targets, *OUTPUT_DAYS)
    return plain(spark.read.parquet(targets[1]))


@query(
    "feature_job_day_folders",
    f"SELECT *, CAST(CAST(tx_datetime AS DATE) AS VARCHAR) AS tx_date FROM ({features_sql()}) "
    "WHERE tx_datetime >= '2024-01-20' AND tx_datetime < '2024-01-25'",
)
def feature_job_day_folders(spark, sf):
    """Input as one folder ``YYYY-MM-DD.parquet`` a day; days after the output are missing."""
    days, root = scratch_path(spark, "days"), scratch_path(spark, "root")
    target = scratch_path(spark, "features")
    rows = between_days(transactions(spark, sf), "2024-01-01", OUTPUT_DAYS[1])
    writers.write_days(rows, days)
    written = spark.read.parquet(days).select("tx_date").distinct().collect()  # one row a day
    for row in written:
        _rename(spark, f"{days}/tx_date={row[0]}", f"{root}/{row[0]}.parquet")
    feature_job(spark, root, [target], *OUTPUT_DAYS, day_folders=True)
    return plain(spark.read.parquet(target))


@query(
    "label_job",
    f"""WITH {TX_SQL}, r AS (
  SELECT *, row_number() OVER (PARTITION BY tx_time_days
                               ORDER BY md5('0:' || transaction_id), transaction_id) AS pos FROM tx),
x AS (SELECT * REPLACE (CAST(CASE WHEN pos <= 10 THEN 2 WHEN tx_amount > 160 THEN 1 ELSE 0 END
                             AS BIGINT) AS tx_fraud_scenario) FROM r)
SELECT transaction_id, tx_datetime, customer_id, terminal_id, tx_amount, tx_time_seconds,
  tx_time_days, CAST(tx_fraud_scenario > 0 AS BIGINT) AS tx_fraud, tx_fraud_scenario,
  CAST(CAST(tx_datetime AS DATE) AS VARCHAR) AS tx_date FROM x""",
)
def label_job_output(spark, sf):
    source, target = (scratch_path(spark, name) for name in ("unlabelled", "labelled"))
    writers.write_days(transactions(spark, sf), source)
    label_job(spark, source, [target])
    return plain(spark.read.parquet(target))
