"""Fraud labels: over-limit amounts, compromised terminals, compromised customers, daily samples.

A compromised list is a table ``(tx_time_days, entity)``: the entity is compromised from that day on
for a number of days.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from cardwatch.functions.numeric import hash_draw
from cardwatch.operators.filters import over_limit
from cardwatch.operators.sampling import sample_rows_per_group, share_cutoffs, within_cut
from cardwatch.schema import (
    AMOUNT_LIMIT,
    CUSTOMER_SCENARIO_DAYS,
    CUSTOMER_SCENARIO_SHARE,
    DAILY_SAMPLE_ROWS,
    TERMINAL_SCENARIO_DAYS,
)
from cardwatch.session import stored


def covered_days(listed: DataFrame, entity: str, length: int) -> DataFrame:
    """One row per listed entity and day in ``[day, day + length)``; ``list_day`` is the first.

    Turning the range into equal keys makes the interval join a plain equi-join on entity and day. A
    list is a set: an entity listed twice on a day counts once.
    """
    day = F.col("tx_time_days")
    return listed.select(entity, day).distinct().select(
        F.col(entity).alias("_entity"),
        day.alias("list_day"),
        F.explode(F.sequence(day, day + length - 1)).alias("_day"),
    )


def _stored_days(listed: DataFrame, entity: str, length: int) -> DataFrame:
    """The covered days as a written table, so that Spark joins by their true size."""
    return stored(covered_days(listed, entity, length), f"{entity}-days")


def _match(df: DataFrame, days: DataFrame, entity: str) -> Column:
    return (df[entity] == days["_entity"]) & (df["tx_time_days"] == days["_day"])


def transactions_of_listed(
    df: DataFrame, listed: DataFrame, entity: str, length: int
) -> DataFrame:
    """Transactions of a listed entity within its days, each once."""
    days = _stored_days(listed, entity, length)
    return df.join(days, _match(df, days, entity), "left_semi")


def compromised_terminal_transactions(
    df: DataFrame, listed: DataFrame, length: int = TERMINAL_SCENARIO_DAYS
) -> DataFrame:
    return transactions_of_listed(df, listed, "terminal_id", length)


def compromised_customer_matches(
    df: DataFrame, listed: DataFrame, length: int = CUSTOMER_SCENARIO_DAYS
) -> DataFrame:
    """Transactions of listed customers, once per list day whose interval holds them."""
    return _customer_matches(df, _stored_days(listed, "customer_id", length))


def _customer_matches(df: DataFrame, days: DataFrame) -> DataFrame:
    return df.join(days, _match(df, days, "customer_id")).select("list_day", *df.columns)


def drawn_customer_days(
    df: DataFrame,
    listed: DataFrame,
    length: int = CUSTOMER_SCENARIO_DAYS,
    share: tuple[int, int] = CUSTOMER_SCENARIO_SHARE,
    *,
    seed: int = 11,
) -> DataFrame:
    """Per listed customer and covered day, the list days with the cut of their random third.

    ``cuts`` holds at most ``length`` entries. A transaction is drawn if it lies within one of
    them, which a row can tell by itself. The matches of the list are written once as narrow rows;
    the cuts and the days they apply to both come from these.
    """
    ids = df.select("transaction_id", "customer_id", "tx_time_days")
    matches = stored(
        _customer_matches(ids, covered_days(listed, "customer_id", length)), "customer-matches"
    )
    cuts = share_cutoffs(matches, ["list_day"], share, seed=seed)
    days = matches.select(
        "list_day", F.col("customer_id").alias("_entity"), F.col("tx_time_days").alias("_day")
    ).distinct()
    drawn = (
        days.join(cuts, "list_day")
        .groupBy("_entity", "_day")
        .agg(F.collect_list(F.struct("list_day", "cut_draw", "cut_id")).alias("cuts"))
    )
    return stored(drawn, "drawn-customer-days")


def is_drawn(cuts: Column | str = "cuts", id_column: str = "transaction_id", seed: int = 11):
    """Whether the row lies within one of the cuts of its customer and day."""
    row_id = F.col(id_column)
    return F.exists(
        cuts,
        lambda c: within_cut(
            hash_draw(seed, c["list_day"], row_id), row_id, c["cut_draw"], c["cut_id"]
        ),
    )


def compromised_customer_transactions(
    df: DataFrame,
    listed: DataFrame,
    length: int = CUSTOMER_SCENARIO_DAYS,
    share: tuple[int, int] = CUSTOMER_SCENARIO_SHARE,
    *,
    seed: int = 11,
) -> DataFrame:
    """A random third of each list day's matches; a transaction drawn several times comes once."""
    days = drawn_customer_days(df, listed, length, share, seed=seed)
    return (
        df.join(days, _match(df, days, "customer_id"))
        .filter(is_drawn(days["cuts"], seed=seed))
        .select(*[df[c] for c in df.columns])
    )


def scenario_priority(*scenarios: Column) -> Column:
    """The later scenario wins; a missing one counts as none."""
    return F.greatest(*[F.coalesce(s, F.lit(0)) for s in scenarios], F.lit(0)).cast("long")


def label_by_lists(
    df: DataFrame,
    terminals: DataFrame,
    customers: DataFrame,
    *,
    limit: float = AMOUNT_LIMIT,
    seed: int = 11,
) -> DataFrame:
    """Label by amount (1), compromised terminal (2) and compromised customer (3).

    Every scenario that applies is kept in ``over_limit``, ``on_terminal`` and ``on_customer``.
    The lists turn into tables per entity and day, written once; the transactions themselves are
    matched with these and need no shuffle while the lists are small enough to broadcast.
    """
    covered = covered_days(terminals, "terminal_id", TERMINAL_SCENARIO_DAYS)
    covered = covered.select("_entity", "_day").distinct()
    # The two lists have nothing to do with one another, so their short jobs run side by side.
    with ThreadPoolExecutor(1) as pool:
        write = inheritable_thread_target(df.sparkSession)(copy_context().run)
        pending = pool.submit(write, stored, covered, "terminal-days")
        customer_days = drawn_customer_days(df, customers, seed=seed)
        terminal_days = pending.result()
    on_terminal = F.when(terminal_days["_entity"].isNotNull(), 1).otherwise(0)
    on_customer = F.when(is_drawn(customer_days["cuts"], seed=seed), 1).otherwise(0)
    flags = {
        "over_limit": over_limit(limit),
        "on_terminal": on_terminal.cast("long"),
        "on_customer": on_customer.cast("long"),
    }
    marked = (
        df.join(terminal_days, _match(df, terminal_days, "terminal_id"), "left")
        .join(customer_days, _match(df, customer_days, "customer_id"), "left")
        .select(*_unlabelled(df), *[c.alias(n) for n, c in flags.items()])
    )
    scenario = scenario_priority(
        F.col("over_limit"), F.col("on_terminal") * 2, F.col("on_customer") * 3
    )
    return _with_label(marked, scenario)


def label_by_daily_sample(
    df: DataFrame, rows: int = DAILY_SAMPLE_ROWS, *, limit: float = AMOUNT_LIMIT, seed: int = 7
) -> DataFrame:
    """Label by amount (1) and ``rows`` random transactions of each day (2).

    The last drawn row of each day is its cut. The cuts, one row per day, are written first, so
    that Spark joins them by their true size.
    """
    ids = df.select("transaction_id", "tx_time_days")
    drawn = sample_rows_per_group(ids, ["tx_time_days"], rows, seed=seed)
    last = F.max(F.struct(hash_draw(seed, "transaction_id"), "transaction_id"))
    cuts = drawn.groupBy(F.col("tx_time_days").alias("_day")).agg(last.alias("_last"))
    cuts = stored(cuts, "day-cuts")
    mine = F.struct(hash_draw(seed, "transaction_id"), "transaction_id")
    marked = df.join(cuts, df["tx_time_days"] == cuts["_day"], "left")
    sampled = F.when(mine <= F.col("_last"), 2).otherwise(0)
    scenario = scenario_priority(over_limit(limit), sampled).alias("_scenario")
    marked = marked.select(*_unlabelled(df), scenario)
    return _with_label(marked, F.col("_scenario")).drop("_scenario")


def _unlabelled(df: DataFrame) -> list[Column]:
    return [df[c] for c in df.columns if c not in ("tx_fraud", "tx_fraud_scenario")]


def _with_label(df: DataFrame, scenario: Column) -> DataFrame:
    fraud = F.when(scenario > 0, 1).otherwise(0).cast("long")
    return df.select("*", fraud.alias("tx_fraud"), scenario.alias("tx_fraud_scenario"))
