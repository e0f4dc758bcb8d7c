"""Calendar flags, customer spending and delayed terminal risk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.calendar import days_to_seconds, night_flag, weekend_flag
from cardwatch.functions.numeric import money_parts, money_total, money_units
from cardwatch.operators.rolling import (
    BLOCK_DAYS,
    add_frame_sums,
    quoted,
)
from cardwatch.schema import (
    DELAY_DAYS,
    TRANSACTION_COLUMNS,
    WINDOW_DAYS,
    customer_average,
    customer_count,
    customer_features,
    terminal_count,
    terminal_features,
    terminal_risk,
)


def add_calendar_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({"tx_during_weekend": weekend_flag(), "tx_during_night": night_flag()})


def add_customer_spending(
    df: DataFrame,
    windows: Sequence[int] = WINDOW_DAYS,
    *,
    amount_scale: int = 2,
    fill: bool = True,
    **rolling,
) -> DataFrame:
    """Transactions and mean amount of the customer over the last d days, for each d.

    The frame is ``[t - d days, t]`` in whole seconds with both ends, the row itself and all rows
    of the same second. A missing amount counts as a transaction and not towards the mean. Amounts
    may be finer than ``amount_scale`` places: they are summed as whole units and whole parts of a
    unit, to four places more.
    """
    units = money_units("tx_amount", amount_scale)
    measures = {
        "_n": F.lit(1),
        "_priced": F.when(units.isNotNull(), 1).otherwise(0),
        "_units": units,
        "_parts": money_parts("tx_amount", amount_scale),
    }
    frames = {str(d): (days_to_seconds(d), 0) for d in windows}
    sums = add_frame_sums(df, "customer_id", measures, frames, **rolling)
    columns = []
    for d in windows:
        total = money_total(f"_units_{d}", f"_parts_{d}")
        mean = f"try_divide({total}, _priced_{d}) / {10**amount_scale}"
        columns += [
            f"_n_{d} AS {customer_count(d)}",
            f"{f'coalesce({mean}, 0D)' if fill else mean} AS {customer_average(d)}",
        ]
    return sums.selectExpr(*quoted(df.columns), *columns)


def add_terminal_risk(
    df: DataFrame, windows: Sequence[int] = WINDOW_DAYS, delay: int = DELAY_DAYS, **rolling
) -> DataFrame:
    """Transactions of the terminal and their fraud share in the d days before the label delay.

    Labels are known ``delay`` days late, so the frame holds the rows with
    ``t - delay - d <= s < t - delay``. The share is 0 where the frame is empty.
    """
    late = days_to_seconds(delay)
    frames = {str(d): (late + days_to_seconds(d), late + 1) for d in windows}
    sums = add_frame_sums(df, "terminal_id", _label_measures(), frames, **rolling)
    columns = []
    for d in windows:
        columns += [
            f"_known_{d} AS {terminal_count(d)}",
            f"coalesce(try_divide(_fraud_{d}, _known_{d}), 0D) AS {terminal_risk(d)}",
        ]
    return sums.selectExpr(*quoted(df.columns), *columns)


def add_terminal_label_sums(
    df: DataFrame, windows: Sequence[int] = WINDOW_DAYS, delay: int = DELAY_DAYS, **rolling
) -> DataFrame:
    """The undelayed sums behind the terminal risk: over the delay, and over delay plus window.

    Columns ``nb_fraud_delay`` and ``nb_tx_delay``, then ``nb_fraud_delay_{d}day_window`` and
    ``nb_tx_delay_{d}day_window`` for each d.
    """
    late = days_to_seconds(delay)
    frames = {"delay": (late, 0)}
    frames |= {f"delay_{d}day_window": (late + days_to_seconds(d), 0) for d in windows}
    sums = add_frame_sums(df, "terminal_id", _label_measures(), frames, **rolling)
    columns = []
    for label in frames:
        columns += [
            f"_fraud_{label} AS nb_fraud_{label}",
            f"_known_{label} AS nb_tx_{label}",
        ]
    return sums.selectExpr(*quoted(df.columns), *columns)


def feature_table(
    df: DataFrame,
    windows: Sequence[int] = WINDOW_DAYS,
    delay: int = DELAY_DAYS,
    *,
    amount_scale: int = 2,
    context: DataFrame | None = None,
    customer_context: DataFrame | None = None,
    plan: str = "split",
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """Transactions with flags, customer and terminal columns, in the order the model reads.

    ``context`` holds earlier transactions that count in the windows and are not in the result;
    ``customer_context`` a shorter part of it that is enough for the customer windows.
    """
    base = df.select(*TRANSACTION_COLUMNS)
    shared = {"source": base, "block_days": block_days, "plan": plan}
    spent = add_customer_spending(
        add_calendar_flags(base),
        windows,
        amount_scale=amount_scale,
        context=context if customer_context is None else customer_context,
        **shared,
    )
    out = add_terminal_risk(
        spent, windows, delay, context=context, **shared
    )
    return out.select(
        *TRANSACTION_COLUMNS,
        "tx_during_weekend",
        "tx_during_night",
        *customer_features(windows),
        *terminal_features(windows),
    )


def _label_measures():
    label = F.col("tx_fraud")
    return {
        "_fraud": F.coalesce(label, F.lit(0)),
        "_known": F.when(label.isNotNull(), 1).otherwise(0),
    }
