"""Counts that describe a transaction table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.numeric import percent, ratio_or_zero


def profile(df: DataFrame, *, days: int | None = None, approximate: bool = False) -> DataFrame:
    """One row: size, distinct keys, time range, and averages per day and per customer.

    ``days`` fixes the divisor of the daily average; without it the days present are counted.
    ``approximate`` counts distinct keys by sketches, without a shuffle of the keys.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    counted = df.agg(
        F.count("*").alias("rows"),
        distinct(F.col("customer_id")).alias("customers"),
        distinct(F.col("terminal_id")).alias("terminals"),
        distinct(F.to_date("tx_datetime")).alias("days"),
        F.min("tx_datetime").alias("first_tx"),
        F.max("tx_datetime").alias("last_tx"),
        F.max("tx_time_days").alias("last_day_number"),
    )
    divisor = F.col("days") if days is None else F.lit(days)
    return counted.select(
        "*",
        ratio_or_zero(F.col("rows"), divisor).alias("rows_per_day"),
        ratio_or_zero(F.col("rows"), F.col("customers")).alias("rows_per_customer"),
    )


def scenario_totals(df: DataFrame, *, scenario: str = "tx_fraud_scenario") -> DataFrame:
    """Fraud rows by scenario and their percentage of all rows."""
    return (
        df.groupBy(F.col(scenario).alias("scenario"))
        .agg(F.count("*").alias("frauds"))
        .select(
            "scenario",
            "frauds",
            # At most one row per scenario reaches this window.
            F.sum("frauds").over(Window.partitionBy()).alias("_all"),
        )
        .filter(F.col("scenario") > 0)
        .select("scenario", "frauds", percent(F.col("frauds"), F.col("_all")).alias("percent"))
    )


def first_scenario_totals(labelled: DataFrame) -> DataFrame:
    """As :func:`scenario_totals`, but a row of several scenarios counts for the earliest."""
    first = (
        F.when(F.col("over_limit") == 1, 1)
        .when(F.col("on_terminal") == 1, 2)
        .when(F.col("on_customer") == 1, 3)
        .otherwise(0)
    )
    return scenario_totals(labelled.withColumn("_first", first), scenario="_first")
