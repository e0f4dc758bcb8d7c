"""Queries over labelling rules, interval and radius joins, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwatch.operators import labels as lb
from cardwatch.operators import profile as pf
from cardwatch.operators import sampling as sm
from cardwatch.operators import spatial
from cardwatch.operators import split as sp
from cardwatch.plans.registry import query
from cardwatch.plans.tables import (
    LINES_SQL,
    PLACES_SQL,
    TX_LIST,
    TX_SQL,
    as_text,
    customer_places,
    order_lines,
    plain,
    terminal_places,
    transactions,
)
from cardwatch.schema import (
    COMPROMISED_CUSTOMERS_PER_DAY,
    COMPROMISED_TERMINALS_PER_DAY,
    TRANSACTION_COLUMNS,
)

def _active_sql(name: str, entity: str, per_day: str, seed: int) -> str:
    return f"""{name} AS (SELECT tx_time_days, {entity} FROM (
  SELECT *, row_number() OVER (PARTITION BY tx_time_days
    ORDER BY md5('{seed}:' || tx_time_days || ':' || {entity}), {entity}) AS pos
  FROM (SELECT DISTINCT tx_time_days, {entity} FROM tx)) WHERE pos <= {per_day})"""


# None or one terminal, by a draw of the day.
_TERMINALS_SQL = _active_sql(
    "lt",
    "terminal_id",
    "CAST('0x' || substr(md5('1:count:' || tx_time_days), 1, 8) AS BIGINT) % 2",
    1,
)
_CUSTOMERS_SQL = _active_sql("lc", "customer_id", str(COMPROMISED_CUSTOMERS_PER_DAY), 2)
_TWO_TERMINALS_SQL = _active_sql("lt", "terminal_id", "2", 1)

_MATCHES_SQL = """m AS (
  SELECT lc.tx_time_days AS list_day, tx.* FROM tx JOIN lc ON tx.customer_id = lc.customer_id
    AND tx.tx_time_days >= lc.tx_time_days AND tx.tx_time_days < lc.tx_time_days + 7)"""

_DRAWN_SQL = """drawn AS (SELECT DISTINCT transaction_id FROM (
  SELECT *, row_number() OVER (PARTITION BY list_day
      ORDER BY md5('11:' || list_day || ':' || transaction_id), transaction_id) AS pos,
    count(*) OVER (PARTITION BY list_day) AS n FROM m) WHERE pos <= n // 3)"""

_ON_TERMINAL_SQL = """EXISTS (SELECT 1 FROM lt WHERE lt.terminal_id = tx.terminal_id
    AND tx.tx_time_days >= lt.tx_time_days AND tx.tx_time_days < lt.tx_time_days + 3)"""

_LABELLED_SQL = f"""{TX_SQL}, {_TERMINALS_SQL}, {_CUSTOMERS_SQL}, {_MATCHES_SQL}, {_DRAWN_SQL},
f AS (SELECT *, CAST(tx_amount > 160 AS BIGINT) AS over_limit,
    CAST({_ON_TERMINAL_SQL} AS BIGINT) AS on_terminal,
    CAST(transaction_id IN (SELECT transaction_id FROM drawn) AS BIGINT) AS on_customer FROM tx),
lab AS (SELECT * REPLACE (greatest(over_limit, on_terminal * 2, on_customer * 3)
    AS tx_fraud_scenario) FROM f)"""


def _terminals(rows):
    return sm.active_entities(rows, "terminal_id", COMPROMISED_TERMINALS_PER_DAY, seed=1)


def _customers(rows):
    return sm.active_entities(rows, "customer_id", COMPROMISED_CUSTOMERS_PER_DAY, seed=2)


def _labelled(spark, sf):
    rows = transactions(spark, sf)
    return lb.label_by_lists(rows, _terminals(rows), _customers(rows))


@query("active_terminal_sample", f"WITH {TX_SQL}, {_TERMINALS_SQL} SELECT * FROM lt")
def active_terminal_sample(spark, sf):
    return _terminals(transactions(spark, sf))


@query("active_terminal_sample_of_two", f"WITH {TX_SQL}, {_TWO_TERMINALS_SQL} SELECT * FROM lt")
def active_terminal_sample_of_two(spark, sf):
    return sm.active_entities(transactions(spark, sf), "terminal_id", 2, seed=1)


@query("active_customer_sample", f"WITH {TX_SQL}, {_CUSTOMERS_SQL} SELECT * FROM lc")
def active_customer_sample(spark, sf):
    return _customers(transactions(spark, sf))


@query(
    "compromised_terminal_transactions",
    f"WITH {TX_SQL}, {_TERMINALS_SQL} SELECT {TX_LIST} FROM tx WHERE {_ON_TERMINAL_SQL}",
)
def compromised_terminal_transactions(spark, sf):
    rows = transactions(spark, sf)
    return plain(lb.compromised_terminal_transactions(rows, _terminals(rows)))


@query(
    "compromised_customer_matches",
    f"WITH {TX_SQL}, {_CUSTOMERS_SQL}, {_MATCHES_SQL} SELECT list_day, {TX_LIST} FROM m",
)
def compromised_customer_matches(spark, sf):
    rows = transactions(spark, sf)
    return plain(lb.compromised_customer_matches(rows, _customers(rows)))


@query(
    "compromised_customer_transactions",
    f"""WITH {TX_SQL}, {_CUSTOMERS_SQL}, {_MATCHES_SQL}, {_DRAWN_SQL}
SELECT {TX_LIST} FROM tx WHERE transaction_id IN (SELECT transaction_id FROM drawn)""",
)
def compromised_customer_transactions(spark, sf):
    rows = transactions(spark, sf)
    return plain(lb.compromised_customer_transactions(rows, _customers(rows)))


@query(
    "labels_by_lists",
    f"""WITH {_LABELLED_SQL} SELECT {", ".join(TRANSACTION_COLUMNS[:7])},
  over_limit, on_terminal, on_customer,
  CAST(tx_fraud_scenario > 0 AS BIGINT) AS tx_fraud, tx_fraud_scenario FROM lab""",
)
def labels_by_lists(spark, sf):
    return plain(_labelled(spark, sf))


_SCENARIOS_SQL = """SELECT {s} AS scenario, count(*) AS frauds,
  count(*) * 100 / (SELECT count(*) FROM tx) AS percent FROM lab WHERE {s} > 0 GROUP BY 1"""


@query("scenario_totals", f"WITH {_LABELLED_SQL} " + _SCENARIOS_SQL.format(s="tx_fraud_scenario"))
def scenario_totals(spark, sf):
    return pf.scenario_totals(_labelled(spark, sf))


@query(
    "first_scenario_totals",
    f"WITH {_LABELLED_SQL} "
    + _SCENARIOS_SQL.format(
        s="CAST(CASE WHEN over_limit = 1 THEN 1 WHEN on_terminal = 1 THEN 2 "
        "WHEN on_customer = 1 THEN 3 ELSE 0 END AS INTEGER)"
    ),
)
def first_scenario_totals(spark, sf):
    return pf.first_scenario_totals(_labelled(spark, sf))


_DAILY_SQL = f"""{TX_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY tx_time_days
  ORDER BY md5('7:' || transaction_id), transaction_id) AS pos FROM tx)"""


@query("daily_sample", f"WITH {_DAILY_SQL} SELECT {TX_LIST} FROM r WHERE pos <= 10")
def daily_sample(spark, sf):
    return plain(sm.sample_rows_per_group(transactions(spark, sf), ["tx_time_days"]))


LARGE_SAMPLE = 1500


@query("daily_sample_large", f"WITH {_DAILY_SQL} SELECT {TX_LIST} FROM r WHERE pos <= {LARGE_SAMPLE}")
def daily_sample_large(spark, sf):
    """More rows a day than Spark cuts ahead of a window."""
    rows = transactions(spark, sf)
    return plain(sm.sample_rows_per_group(rows, ["tx_time_days"], LARGE_SAMPLE))


@query(
    "labels_by_daily_sample",
    f"""WITH {_DAILY_SQL}, lab AS (SELECT * REPLACE (CAST(CASE WHEN pos <= 10 THEN 2
  WHEN tx_amount > 160 THEN 1 ELSE 0 END AS BIGINT) AS tx_fraud_scenario) FROM r)
SELECT {", ".join(TRANSACTION_COLUMNS[:7])}, CAST(tx_fraud_scenario > 0 AS BIGINT) AS tx_fraud,
  tx_fraud_scenario FROM lab""",
)
def labels_by_daily_sample(spark, sf):
    return plain(lb.label_by_daily_sample(transactions(spark, sf)))


@query(
    "third_of_each_day",
    f"""WITH {TX_SQL} SELECT {TX_LIST} FROM (SELECT *, row_number() OVER (PARTITION BY tx_time_days
    ORDER BY md5('11:' || tx_time_days || ':' || transaction_id), transaction_id) AS pos,
  count(*) OVER (PARTITION BY tx_time_days) AS n FROM tx) WHERE pos <= n // 3""",
)
def third_of_each_day(spark, sf):
    return plain(sm.sample_share_per_group(transactions(spark, sf), ["tx_time_days"], (1, 3)))


_LISTED_SQL = """coalesce(list_sort(array_agg(terminal_id) FILTER (terminal_id IS NOT NULL)), [])
    AS available_terminals, count(terminal_id) AS nb_terminals"""


def _radius_sql(r: float) -> str:
    return f"""WITH {PLACES_SQL}
SELECT customer_id, x_customer_id, y_customer_id, {_LISTED_SQL}
FROM c LEFT JOIN t ON sqrt((x_customer_id - x_terminal_id) * (x_customer_id - x_terminal_id)
  + (y_customer_id - y_terminal_id) * (y_customer_id - y_terminal_id)) < {r}
GROUP BY ALL"""


def _flat(listed):
    """The list as text, which every engine compares alike."""
    return F.array_join(listed.cast("array<string>"), ",")


@query(
    "terminals_within_radius",
    f"SELECT * REPLACE (array_to_string(available_terminals, ',') AS available_terminals) "
    f"FROM ({_radius_sql(5)})",
)
def terminals_within_radius(spark, sf):
    return spatial.terminals_within_radius(
        customer_places(spark, sf), terminal_places(spark, sf), form=_flat
    )


@query(
    "terminals_within_wide_radius",
    f"SELECT customer_id, nb_terminals FROM ({_radius_sql(50)})",
)
def terminals_within_wide_radius(spark, sf):
    return spatial.terminal_counts_within_radius(
        customer_places(spark, sf), terminal_places(spark, sf), 50
    ).select("customer_id", "nb_terminals")


@query(
    "customer_terminal_pairs",
    f"""WITH {PLACES_SQL} SELECT customer_id, terminal_id FROM c JOIN t
ON sqrt((x_customer_id - x_terminal_id) * (x_customer_id - x_terminal_id)
  + (y_customer_id - y_terminal_id) * (y_customer_id - y_terminal_id)) < 5""",
)
def customer_terminal_pairs(spark, sf):
    return spatial.customer_terminal_pairs(customer_places(spark, sf), terminal_places(spark, sf))


_IS_TRAIN_SQL = "substr(md5('42:' || transaction_id), 1, 8) < 'cccccccd'"


@query(
    "stratified_split",
    f"WITH {TX_SQL} SELECT transaction_id, tx_fraud, {_IS_TRAIN_SQL} AS is_train FROM tx",
)
def stratified_split(spark, sf):
    return sp.with_split(transactions(spark, sf)).select("transaction_id", "tx_fraud", "is_train")


_NO_ID_SQL = r"""coalesce(md5('42:' || id),
  md5('42:\N:' || tx_time_seconds || ':' || customer_id || ':' || terminal_id))"""


@query(
    "split_without_ids",
    f"""WITH {TX_SQL}, n AS (
  SELECT *, CASE WHEN customer_id % 3 > 0 THEN transaction_id END AS id FROM tx)
SELECT CAST(id AS VARCHAR) AS transaction_id, tx_datetime, customer_id, terminal_id,
  substr({_NO_ID_SQL}, 1, 8) < 'cccccccd' AS is_train FROM n""",
)
def split_without_ids(spark, sf):
    """Rows without an id are dealt out by their time, customer and terminal."""
    kept = F.when(F.col("customer_id") % 3 > 0, F.col("transaction_id"))
    rows = sp.with_split(transactions(spark, sf).withColumn("transaction_id", kept))
    named = rows.select("transaction_id", "tx_datetime", "customer_id", "terminal_id", "is_train")
    return plain(as_text(named, "transaction_id"))


@query(
    "stratified_sample",
    f"""WITH {TX_SQL} SELECT {TX_LIST} FROM tx WHERE tx_fraud = 1
  OR substr(md5('42:' || transaction_id), 1, 8) < '40000000'""",
)
def stratified_sample(spark, sf):
    return plain(sm.stratified_sample(transactions(spark, sf), {0: 0.25, 1: 1.0}))


@query("label_values", f"WITH {TX_SQL} SELECT DISTINCT tx_fraud FROM tx")
def label_values(spark, sf):
    return sp.label_values(transactions(spark, sf))


@query(
    "split_report",
    f"""WITH {TX_SQL} SELECT {_IS_TRAIN_SQL} AS is_train, count(*) AS rows,
  CAST(sum(tx_fraud) AS BIGINT) AS frauds, sum(tx_fraud)::BIGINT * 100 / count(*) AS fraud_percent
FROM tx GROUP BY 1""",
)
def split_report(spark, sf):
    return sp.split_report(sp.with_split(transactions(spark, sf)))


_COPIES_SQL = f"""{LINES_SQL}, s AS (SELECT customer_id, terminal_id, tx_fraud FROM tx),
train AS (SELECT * FROM s WHERE substr(md5('42:' || customer_id), 1, 8) < '80000000'
  AND tx_fraud = 1)"""


def _copies(spark, sf):
    """Rows with many equal copies, and the train rows among them."""
    rows = order_lines(spark, sf).select("customer_id", "terminal_id", "tx_fraud")
    return rows, sm.stratified_sample(rows, {1: 0.5}, id_column="customer_id")


@query(
    "test_set_by_subtract", f"WITH {_COPIES_SQL} SELECT * FROM s EXCEPT SELECT * FROM train"
)
def test_set_by_subtract(spark, sf):
    return sp.test_by_subtract(*_copies(spark, sf))


@query(
    "test_set_by_except_all", f"WITH {_COPIES_SQL} SELECT * FROM s EXCEPT ALL SELECT * FROM train"
)
def test_set_by_except_all(spark, sf):
    return sp.test_by_except_all(*_copies(spark, sf))


@query("test_set_by_split", f"WITH {TX_SQL} SELECT {TX_LIST} FROM tx WHERE NOT {_IS_TRAIN_SQL}")
def test_set_by_split(spark, sf):
    return plain(sp.train_test(transactions(spark, sf))[1])
