"""Column names and types shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

# The transaction layout exchanged between the jobs.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("tx_datetime", T.TimestampType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("terminal_id", T.LongType()),
        T.StructField("tx_amount", T.DoubleType()),
        T.StructField("tx_time_seconds", T.LongType()),
        T.StructField("tx_time_days", T.LongType()),
        T.StructField("tx_fraud", T.LongType()),
        T.StructField("tx_fraud_scenario", T.LongType()),
    ]
)
TRANSACTION_COLUMNS = TRANSACTION_SCHEMA.fieldNames()

# Window lengths and label delay, in days.
WINDOW_DAYS = (1, 3, 7)
DELAY_DAYS = 7
SECONDS_PER_DAY = 86_400

# Labelling rules.
AMOUNT_LIMIT = 160
TERMINAL_SCENARIO_DAYS = 3
CUSTOMER_SCENARIO_DAYS = 7
CUSTOMER_SCENARIO_SHARE = (1, 3)
DAILY_SAMPLE_ROWS = 10
COMPROMISED_CUSTOMERS_PER_DAY = 50
COMPROMISED_TERMINALS_PER_DAY = (0, 1)  # either, by chance

# Columns that tell rows without an id apart.
ID_SUBSTITUTES = ("tx_time_seconds", "customer_id", "terminal_id")

LABEL = "tx_fraud"


def customer_count(days: int) -> str:
    return f"customer_id_nb_tx_{days}day_window"


def customer_average(days: int) -> str:
    return f"customer_id_avg_amount_{days}day_window"


def terminal_count(days: int) -> str:
    return f"terminal_id_nb_tx_{days}day_window"


def terminal_risk(days: int) -> str:
    return f"terminal_id_risk_{days}day_window"


def customer_features(windows=WINDOW_DAYS) -> list[str]:
    return [name(d) for d in windows for name in (customer_count, customer_average)]


def terminal_features(windows=WINDOW_DAYS) -> list[str]:
    return [name(d) for d in windows for name in (terminal_count, terminal_risk)]


def model_inputs(windows=WINDOW_DAYS) -> list[str]:
    """The model's inputs: the amount, two calendar flags and the window columns."""
    flags = ["tx_amount", "tx_during_weekend", "tx_during_night"]
    return flags + customer_features(windows) + terminal_features(windows)
