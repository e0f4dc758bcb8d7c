"""The given tables in their roles as transactions, profiles and predictions.

Each role has a DataFrame form and the same role as DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions.calendar import days_since, seconds_since
from cardwatch.schema import AMOUNT_LIMIT, TRANSACTION_COLUMNS
from cardwatch.session import use_utc

# Column types of the given files; naming them saves the job that would infer them.
FILE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP",
    "lineitem": "l_orderkey BIGINT, l_suppkey BIGINT, l_extendedprice DOUBLE, l_returnflag STRING",
    "customer": "c_custkey BIGINT",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "labels": "quality INT, toxic INT",
    "pages": "page_id BIGINT, url STRING",
}

BATCH_START = "2024-01-01"
ORDER_START = "1995-01-01"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    use_utc(spark)
    return spark.read.schema(FILE_SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as transactions: the user pays at terminal ``props.k``; errors are frauds."""
    return (
        read(spark, folder, "events")
        .selectExpr(
            "event_id AS transaction_id",
            "ts AS tx_datetime",
            "user_id AS customer_id",
            "CAST(get_json_object(props, '$.k') AS BIGINT) AS terminal_id",
            "value AS tx_amount",
            "CAST(event_type = 'error' AS BIGINT) AS tx_fraud",
        )
        .select(
            "transaction_id",
            "tx_datetime",
            "customer_id",
            "terminal_id",
            "tx_amount",
            seconds_since("tx_datetime", BATCH_START).alias("tx_time_seconds"),
            days_since("tx_datetime", BATCH_START).alias("tx_time_days"),
            "tx_fraud",
            F.expr(
                f"CAST(CASE WHEN tx_fraud = 0 THEN 0 WHEN tx_amount > {AMOUNT_LIMIT} THEN 1 ELSE 2 "
                "END AS BIGINT)"
            ).alias("tx_fraud_scenario"),
        )
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` with ``orders`` as transactions: whole days as times, so many equal times."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_extendedprice", "l_returnflag"
    )
    ts = F.col("o_orderdate")
    fraud = F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("long")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("transaction_id"),
        ts.alias("tx_datetime"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_suppkey").alias("terminal_id"),
        F.col("l_extendedprice").alias("tx_amount"),
        seconds_since(ts, ORDER_START).alias("tx_time_seconds"),
        days_since(ts, ORDER_START).alias("tx_time_days"),
        fraud.alias("tx_fraud"),
        (fraud * 2).alias("tx_fraud_scenario"),
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions with the over-limit rule as prediction."""
    rejected = F.when(F.col("tx_amount") > AMOUNT_LIMIT, 1).otherwise(0)
    return transactions(spark, folder).withColumn("prediction", rejected)


def document_labels(spark: SparkSession, folder: str) -> DataFrame:
    """``labels`` as truth (toxic) and prediction (quality)."""
    return read(spark, folder, "labels").select(
        F.col("toxic").alias("tx_fraud"), F.col("quality").alias("prediction")
    )


def customer_places(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return read(spark, folder, "customer").select(
        key.alias("customer_id"),
        (key * 7919 % 10000 / 100).alias("x_customer_id"),
        (key * 104729 % 10000 / 100).alias("y_customer_id"),
    )


def terminal_places(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return read(spark, folder, "supplier").select(
        key.alias("terminal_id"),
        (key * 6151 % 10000 / 100).alias("x_terminal_id"),
        (key * 3571 % 10000 / 100).alias("y_terminal_id"),
    )


def plain(df: DataFrame) -> DataFrame:
    """Times without a zone, as the given tables hold them, and dates as text."""
    target = {"timestamp": "timestamp_ntz", "date": "string"}
    return df.withColumns(
        {c: F.col(c).cast(target[t]) for c, t in df.dtypes if t in target}
    )


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Whole numbers that may be missing, as text: a missing one looks the same everywhere."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


TX_SQL = f"""tx AS (
  SELECT event_id AS transaction_id, ts AS tx_datetime, user_id AS customer_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS terminal_id, value AS tx_amount,
         epoch_us(ts) // 1000000 - 1704067200 AS tx_time_seconds,
         (epoch_us(ts) // 1000000 - 1704067200) // 86400 AS tx_time_days,
         CAST(event_type = 'error' AS BIGINT) AS tx_fraud,
         CAST(CASE WHEN event_type <> 'error' THEN 0 WHEN value > {AMOUNT_LIMIT} THEN 1 ELSE 2 END
              AS BIGINT) AS tx_fraud_scenario,
         epoch_us(ts) // 1000000 AS s
  FROM events)"""

LINES_SQL = """tx AS (
  SELECT l_orderkey AS transaction_id, o_orderdate AS tx_datetime, o_custkey AS customer_id,
         l_suppkey AS terminal_id, l_extendedprice AS tx_amount,
         epoch_us(o_orderdate) // 1000000 - 788918400 AS tx_time_seconds,
         (epoch_us(o_orderdate) // 1000000 - 788918400) // 86400 AS tx_time_days,
         CAST(l_returnflag = 'R' AS BIGINT) AS tx_fraud,
         CAST(l_returnflag = 'R' AS BIGINT) * 2 AS tx_fraud_scenario,
         epoch_us(o_orderdate) // 1000000 AS s
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

PLACES_SQL = """c AS (
  SELECT c_custkey AS customer_id, (c_custkey * 7919 % 10000) / 100 AS x_customer_id,
         (c_custkey * 104729 % 10000) / 100 AS y_customer_id FROM customer),
t AS (
  SELECT s_suppkey AS terminal_id, (s_suppkey * 6151 % 10000) / 100 AS x_terminal_id,
         (s_suppkey * 3571 % 10000) / 100 AS y_terminal_id FROM supplier)"""

TX_LIST = ", ".join(TRANSACTION_COLUMNS)
