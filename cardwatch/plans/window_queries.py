"""Queries over event-time windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwatch.operators import features as ft
from cardwatch.operators.filters import fill_zero
from cardwatch.plans.jobs import features_for_days
from cardwatch.plans.registry import query
from cardwatch.plans.tables import (
    LINES_SQL,
    TX_LIST,
    TX_SQL,
    order_lines,
    plain,
    transactions,
)
from cardwatch.schema import DELAY_DAYS, WINDOW_DAYS, customer_average

WIDE_WINDOWS = (1, 7, 30)
OUTPUT_DAYS = ("2024-01-20", "2024-01-24")

_DAY = 86400


def _frame(key: str, start: int, end: int) -> str:
    return (
        f"(PARTITION BY {key} ORDER BY s "
        f"RANGE BETWEEN {start} PRECEDING AND {end} PRECEDING)"
    )


def _customer_sql(windows=WINDOW_DAYS) -> str:
    parts = []
    for d in windows:
        w = _frame("customer_id", d * _DAY, 0)
        parts.append(f"count(*) OVER {w} AS customer_id_nb_tx_{d}day_window")
        parts.append(
            f"CAST(sum(CAST(round(tx_amount * 100) AS BIGINT)) OVER {w} AS BIGINT) "
            f"/ count(tx_amount) OVER {w} / 100 AS customer_id_avg_amount_{d}day_window"
        )
    return ",\n  ".join(parts)


def _terminal_sql(windows=WINDOW_DAYS, delay=DELAY_DAYS) -> str:
    parts = []
    for d in windows:
        w = _frame("terminal_id", (delay + d) * _DAY, delay * _DAY + 1)
        parts.append(f"count(tx_fraud) OVER {w} AS terminal_id_nb_tx_{d}day_window")
        parts.append(
            f"coalesce(CAST(sum(tx_fraud) OVER {w} AS BIGINT) / nullif(count(tx_fraud) OVER {w}, 0)"
            f", 0) AS terminal_id_risk_{d}day_window"
        )
    return ",\n  ".join(parts)


_FLAGS_SQL = """CAST(dayofweek(tx_datetime) IN (0, 6) AS INTEGER) AS tx_during_weekend,
  CAST(hour(tx_datetime) <= 6 AS INTEGER) AS tx_during_night"""


def features_sql(base=TX_SQL, windows=WINDOW_DAYS) -> str:
    return (
        f"WITH {base} SELECT {TX_LIST},\n  {_FLAGS_SQL},\n  {_customer_sql(windows)},\n"
        f"  {_terminal_sql(windows)} FROM tx"
    )


@query("feature_table", features_sql())
def feature_table(spark, sf):
    return plain(ft.feature_table(transactions(spark, sf)))


@query("feature_table_split_plan", features_sql())
def feature_table_split_plan(spark, sf):
    return plain(ft.feature_table(transactions(spark, sf), plan="split", block_days=10))


@query("feature_table_wide_windows", features_sql(windows=WIDE_WINDOWS))
def feature_table_wide_windows(spark, sf):
    return plain(ft.feature_table(transactions(spark, sf), WIDE_WINDOWS))


@query("order_line_features", features_sql(LINES_SQL))
def order_line_features(spark, sf):
    return plain(ft.feature_table(order_lines(spark, sf)))


@query("order_line_features_split_plan", features_sql(LINES_SQL))
def order_line_features_split_plan(spark, sf):
    return plain(ft.feature_table(order_lines(spark, sf), plan="split"))


@query(
    "features_for_days",
    f"SELECT * FROM ({features_sql()}) "
    "WHERE tx_datetime >= '2024-01-20' AND tx_datetime < '2024-01-25'",
)
def features_of_days(spark, sf):
    return plain(features_for_days(transactions(spark, sf), *OUTPUT_DAYS))


_WEEK_SQL = TX_SQL.replace(
    "FROM events)", "FROM events WHERE ts >= '2024-01-13' AND ts < '2024-01-25')"
)


@query(
    "features_for_days_short_lookback",
    f"""WITH {_WEEK_SQL}
SELECT * FROM (SELECT {TX_LIST},
  {_FLAGS_SQL},
  {_customer_sql()},
  {_terminal_sql()} FROM tx)
WHERE tx_datetime >= '2024-01-20' AND tx_datetime < '2024-01-25'""",
)
def features_short_lookback(spark, sf):
    return plain(features_for_days(transactions(spark, sf), *OUTPUT_DAYS, lookback=7))


@query("features_all_columns_filled", features_sql())
def features_all_columns_filled(spark, sf):
    return plain(fill_zero(ft.feature_table(transactions(spark, sf))))


@query("customer_spending", f"WITH {TX_SQL} SELECT transaction_id, {_customer_sql()} FROM tx")
def customer_spending(spark, sf):
    rows = transactions(spark, sf).select(
        "transaction_id", "customer_id", "tx_datetime", "tx_amount"
    )
    return ft.add_customer_spending(rows).drop("customer_id", "tx_datetime", "tx_amount")


def _fine_sql() -> str:
    """Means of amounts with five places: whole cents and ten-thousandths of a cent apart."""
    parts = []
    for d in WINDOW_DAYS:
        w = _frame("customer_id", d * _DAY, 0)
        parts.append(
            f"(CAST(sum(units) OVER {w} AS BIGINT) + CAST(sum(parts) OVER {w} AS BIGINT) / 10000.0::DOUBLE) "
            f"/ count(*) OVER {w} / 100 AS customer_id_avg_amount_{d}day_window"
        )
    return ",\n  ".join(parts)


@query(
    "spending_fine_amounts",
    f"""WITH {TX_SQL}, fine AS (SELECT *, tx_amount / 8 * 100 AS scaled FROM tx),
split AS (SELECT *, CAST(round_even(scaled, 0) AS BIGINT) AS units,
  CAST(round_even((scaled - round_even(scaled, 0)) * 10000, 0) AS BIGINT) AS parts FROM fine)
SELECT transaction_id, {_fine_sql()} FROM split""",
)
def spending_fine_amounts(spark, sf):
    """Mean spending where amounts have more places than the currency."""
    rows = transactions(spark, sf).select(
        "transaction_id", "customer_id", "tx_datetime", (F.col("tx_amount") / 8).alias("tx_amount")
    )
    means = [customer_average(d) for d in WINDOW_DAYS]
    return ft.add_customer_spending(rows).select("transaction_id", *means)


@query("terminal_risk", f"WITH {TX_SQL} SELECT transaction_id, {_terminal_sql()} FROM tx")
def terminal_risk(spark, sf):
    rows = transactions(spark, sf).select(
        "transaction_id", "terminal_id", "tx_datetime", "tx_fraud"
    )
    return ft.add_terminal_risk(rows).drop("terminal_id", "tx_datetime", "tx_fraud")


def _label_sums_sql() -> str:
    parts = []
    for label, days in [("delay", 7)] + [(f"delay_{d}day_window", 7 + d) for d in WINDOW_DAYS]:
        w = _frame("terminal_id", days * _DAY, 0)
        parts.append(f"CAST(sum(tx_fraud) OVER {w} AS BIGINT) AS nb_fraud_{label}")
        parts.append(f"count(tx_fraud) OVER {w} AS nb_tx_{label}")
    return ", ".join(parts)


@query("terminal_label_sums", f"WITH {TX_SQL} SELECT transaction_id, {_label_sums_sql()} FROM tx")
def terminal_label_sums(spark, sf):
    rows = transactions(spark, sf).select(
        "transaction_id", "terminal_id", "tx_datetime", "tx_fraud"
    )
    return ft.add_terminal_label_sums(rows).drop("terminal_id", "tx_datetime", "tx_fraud")


@query("calendar_flags", f"WITH {TX_SQL} SELECT transaction_id, {_FLAGS_SQL} FROM tx")
def calendar_flags(spark, sf):
    flags = ft.add_calendar_flags(transactions(spark, sf))
    return flags.select("transaction_id", "tx_during_weekend", "tx_during_night")
