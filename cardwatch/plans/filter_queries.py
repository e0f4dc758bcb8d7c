"""Queries over filters, projections, scalar functions, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwatch.functions import calendar as cal
from cardwatch.functions import numeric as num
from cardwatch.operators import filters as fl
from cardwatch.operators.ordering import add_chronological_id, chronological
from cardwatch.plans.registry import query
from cardwatch.plans.tables import (
    BATCH_START,
    LINES_SQL,
    TX_LIST,
    TX_SQL,
    as_text,
    order_lines,
    plain,
    read,
    transactions,
)
from cardwatch.schema import TRANSACTION_COLUMNS


def _where(condition: str, columns: str = TX_LIST) -> str:
    return f"WITH {TX_SQL} SELECT {columns} FROM tx WHERE {condition}"


@query("days_half_open", _where("tx_datetime >= '2024-01-08' AND tx_datetime < '2024-01-15'"))
def days_half_open(spark, sf):
    return plain(fl.between_days(transactions(spark, sf), "2024-01-08", "2024-01-14"))


@query(
    "days_closed",
    _where("tx_datetime >= '2024-01-08' AND tx_datetime <= '2024-01-14 23:59:59'"),
)
def days_closed(spark, sf):
    return plain(fl.between_days(transactions(spark, sf), "2024-01-08", "2024-01-14", closed=True))


@query("days_with_lookback", _where("tx_datetime >= '2024-01-06' AND tx_datetime < '2024-01-22'"))
def days_with_lookback(spark, sf):
    return plain(fl.with_lookback(transactions(spark, sf), "2024-01-20", "2024-01-21"))


@query(
    "trailing_days",
    """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 90 DAY""",
)
def trailing_days(spark, sf):
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return plain(fl.trailing_days(orders, 90, ts="o_orderdate"))


@query("single_day", _where("tx_time_days = 12"))
def single_day(spark, sf):
    return plain(fl.on_day(transactions(spark, sf), 12))


@query("day_number_range", _where("tx_time_days >= 5 AND tx_time_days < 8"))
def day_number_range(spark, sf):
    return plain(fl.in_day_range(transactions(spark, sf), 5, 3))


@query(
    "membership_in_table",
    _where("terminal_id IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12)"),
)
def membership_in_table(spark, sf):
    suppliers = read(spark, sf, "supplier").filter(F.col("s_nationkey") < 12).select("s_suppkey")
    return plain(fl.members(transactions(spark, sf), "terminal_id", suppliers))


@query("membership_in_list", _where("terminal_id IN (3, 14, 15, 92, 65)"))
def membership_in_list(spark, sf):
    return plain(fl.members(transactions(spark, sf), "terminal_id", [3, 14, 15, 92, 65]))


@query("frauds_only", _where("tx_fraud = 1"))
def frauds_only(spark, sf):
    return plain(fl.frauds(transactions(spark, sf)))


@query(
    "projection",
    f"""WITH {TX_SQL} SELECT terminal_id AS place, customer_id, transaction_id AS id,
  tx_amount * 2 AS tx_amount, CAST(1 AS INTEGER) AS marker, CAST(tx_fraud + 1 AS BIGINT) AS tx_fraud
FROM tx""",
)
def projection(spark, sf):
    return (
        transactions(spark, sf)
        .select("terminal_id", "customer_id", "transaction_id", "tx_amount", "tx_fraud")
        .withColumnsRenamed({"terminal_id": "place", "transaction_id": "id"})
        .withColumns(
            {
                "tx_amount": F.col("tx_amount") * 2,
                "marker": F.lit(1),
                "tx_fraud": F.col("tx_fraud") + 1,
            }
        )
    )


_GAPS_SQL = f"""{TX_SQL}, g AS (
  SELECT transaction_id, CASE WHEN tx_fraud = 0 THEN terminal_id END AS terminal_id,
    CASE WHEN tx_amount <= 100 THEN tx_amount END AS tx_amount,
    CASE WHEN tx_time_days <> 3 THEN tx_datetime END AS tx_datetime FROM tx)"""


def _with_gaps(spark, sf):
    return transactions(spark, sf).select(
        "transaction_id",
        F.when(F.col("tx_fraud") == 0, F.col("terminal_id")).alias("terminal_id"),
        F.when(F.col("tx_amount") <= 100, F.col("tx_amount")).alias("tx_amount"),
        F.when(F.col("tx_time_days") != 3, F.col("tx_datetime")).alias("tx_datetime"),
    )


@query(
    "fill_zero_scoped",
    f"WITH {_GAPS_SQL} SELECT transaction_id, CAST(terminal_id AS VARCHAR) AS terminal_id, "
    "coalesce(tx_amount, 0) AS tx_amount, "
    "tx_datetime FROM g",
)
def fill_zero_scoped(spark, sf):
    filled = fl.fill_zero(_with_gaps(spark, sf), ["tx_amount"])
    return plain(as_text(filled, "terminal_id"))


@query(
    "fill_zero_everywhere",
    f"WITH {_GAPS_SQL} SELECT transaction_id, coalesce(terminal_id, 0) AS terminal_id, "
    "coalesce(tx_amount, 0) AS tx_amount, tx_datetime FROM g",
)
def fill_zero_everywhere(spark, sf):
    return plain(fl.fill_zero(_with_gaps(spark, sf)))


@query(
    "over_limit_label",
    f"WITH {TX_SQL} SELECT transaction_id, CAST(tx_amount > 160 AS BIGINT) AS tx_fraud FROM tx",
)
def over_limit_label(spark, sf):
    return transactions(spark, sf).select("transaction_id", fl.over_limit().alias("tx_fraud"))


@query(
    "time_functions",
    f"""WITH {TX_SQL} SELECT transaction_id, s AS epoch_second, tx_time_seconds, tx_time_days,
  TIMESTAMP '2024-01-01' + to_seconds(tx_time_seconds) AS rebuilt,
  date_trunc('day', tx_datetime)::TIMESTAMP AS day_start,
  date_trunc('day', tx_datetime)::TIMESTAMP + INTERVAL '23 hours 59 minutes 59 seconds' AS day_end,
  strftime(tx_datetime, '%Y-%m-%d') AS day_text,
  CAST(CAST(tx_datetime AS DATE) + 7 AS VARCHAR) AS week_later,
  CAST(CAST(tx_datetime AS DATE) - DATE '2024-01-01' + 1 AS INTEGER) AS days_so_far,
  CAST(strptime(strftime(tx_datetime, '%Y-%m-%d'), '%Y-%m-%d') AS TIMESTAMP) AS parsed FROM tx""",
)
def time_functions(spark, sf):
    date = F.to_date("tx_datetime")
    return plain(
        transactions(spark, sf).select(
            "transaction_id",
            cal.event_seconds().alias("epoch_second"),
            cal.seconds_since("tx_datetime", BATCH_START).alias("tx_time_seconds"),
            cal.days_since("tx_datetime", BATCH_START).alias("tx_time_days"),
            cal.time_from_offset("tx_time_seconds", BATCH_START).alias("rebuilt"),
            cal.day_start("tx_datetime").alias("day_start"),
            cal.day_end("tx_datetime").alias("day_end"),
            cal.day_text("tx_datetime").alias("day_text"),
            F.date_add(date, 7).alias("week_later"),
            (F.datediff(date, F.lit(cal.as_date(BATCH_START))) + 1).alias("days_so_far"),
            F.to_timestamp(cal.day_text("tx_datetime"), "yyyy-MM-dd").alias("parsed"),
        )
    )


@query(
    "day_spine_counts",
    f"""WITH {TX_SQL}, d AS (
  SELECT CAST(unnest(generate_series(DATE '2023-12-25', DATE '2024-02-05', INTERVAL 1 DAY)) AS DATE)
    AS tx_date)
SELECT CAST(tx_date AS VARCHAR) AS tx_date, count(transaction_id) AS rows
FROM d LEFT JOIN tx ON CAST(tx_datetime AS DATE) = tx_date GROUP BY tx_date""",
)
def day_spine_counts(spark, sf):
    """Rows of every calendar day, also days without any."""
    per_day = (
        transactions(spark, sf)
        .groupBy(F.to_date("tx_datetime").alias("tx_date"))
        .agg(F.count("*").alias("rows"))
    )
    spine = cal.day_spine(spark, "2023-12-25", "2024-02-05")
    joined = spine.join(per_day, "tx_date", "left")
    return plain(joined.select("tx_date", F.coalesce("rows", F.lit(0)).alias("rows")))


@query(
    "numeric_functions",
    f"""WITH {TX_SQL} SELECT transaction_id,
  CAST(round(tx_amount * 100) AS BIGINT) AS units,
  round_even(tx_amount, 1) AS one_place,
  coalesce(tx_amount / nullif(tx_fraud, 0), 0) AS amount_per_fraud,
  coalesce(tx_fraud * 100 / nullif(tx_fraud_scenario, 0), 0) AS fraud_percent,
  sqrt((tx_amount - terminal_id) * (tx_amount - terminal_id)
     + CAST((customer_id - tx_time_days) * (customer_id - tx_time_days) AS DOUBLE)) AS apart,
  md5('42:' || transaction_id) AS draw,
  tx_fraud = 1 OR tx_amount > 100 AND tx_time_days < 10 AS suspicious FROM tx""",
)
def numeric_functions(spark, sf):
    c = F.col
    return transactions(spark, sf).select(
        "transaction_id",
        num.money_units("tx_amount").alias("units"),
        num.round_half_even("tx_amount", 1).alias("one_place"),
        num.ratio_or_zero(c("tx_amount"), c("tx_fraud")).alias("amount_per_fraud"),
        num.percent(c("tx_fraud"), c("tx_fraud_scenario")).alias("fraud_percent"),
        num.distance(
            c("tx_amount"), c("customer_id"), c("terminal_id"), c("tx_time_days")
        ).alias("apart"),
        num.hash_draw(42, "transaction_id").alias("draw"),
        ((c("tx_fraud") == 1) | (c("tx_amount") > 100) & (c("tx_time_days") < 10)).alias(
            "suspicious"
        ),
    )


@query(
    "file_stems",
    r"""SELECT page_id, regexp_replace(regexp_extract(url, '([^/]+)$', 1), '\.[^.]+$', '') AS stem
FROM pages""",
)
def file_stems(spark, sf):
    return read(spark, sf, "pages").select("page_id", num.file_stem(F.col("url")).alias("stem"))


@query("chronological_order", f"WITH {TX_SQL} SELECT {TX_LIST} FROM tx ORDER BY tx_datetime")
def chronological_order(spark, sf):
    return plain(chronological(transactions(spark, sf), "tx_datetime", "transaction_id"))


@query(
    "chronological_ids",
    f"""WITH {TX_SQL} SELECT row_number() OVER (ORDER BY tx_datetime, customer_id, tx_amount) - 1
  AS transaction_id, tx_datetime, customer_id, terminal_id, tx_amount FROM tx""",
)
def chronological_ids(spark, sf):
    rows = transactions(spark, sf).select("tx_datetime", "customer_id", "terminal_id", "tx_amount")
    return plain(add_chronological_id(rows, ties=["customer_id", "tx_amount"]))


@query(
    "order_line_chronological_ids",
    f"""WITH {LINES_SQL} SELECT row_number() OVER (ORDER BY tx_datetime, customer_id, terminal_id,
  transaction_id, tx_amount, tx_fraud) - 1 AS line_number,
  {", ".join(TRANSACTION_COLUMNS[:5])}, tx_fraud FROM tx""",
)
def order_line_chronological_ids(spark, sf):
    rows = order_lines(spark, sf).select(*TRANSACTION_COLUMNS[:5], "tx_fraud")
    ties = ["customer_id", "terminal_id", "transaction_id", "tx_amount", "tx_fraud"]
    return plain(add_chronological_id(rows, ties=ties, name="line_number"))


@query(
    "union_of_inputs",
    f"WITH {TX_SQL} SELECT {TX_LIST} FROM tx WHERE tx_fraud = 1 UNION ALL SELECT {TX_LIST} FROM tx",
)
def union_of_inputs(spark, sf):
    rows = transactions(spark, sf)
    return plain(fl.frauds(rows).unionByName(rows))


@query("distinct_rows", f"WITH {LINES_SQL} SELECT DISTINCT customer_id, terminal_id FROM tx")
def distinct_rows(spark, sf):
    return order_lines(spark, sf).select("customer_id", "terminal_id").distinct()
