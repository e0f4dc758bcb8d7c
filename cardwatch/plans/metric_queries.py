"""Queries over profiles, classification metrics and business indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwatch.operators import metrics as mt
from cardwatch.operators import profile as pf
from cardwatch.plans.registry import query
from cardwatch.plans.tables import (
    LINES_SQL,
    TX_SQL,
    document_labels,
    order_lines,
    plain,
    predictions,
    transactions,
)


def _profile_sql(base: str, days: str = "count(DISTINCT CAST(tx_datetime AS DATE))") -> str:
    return f"""WITH {base} SELECT count(*) AS rows, count(DISTINCT customer_id) AS customers,
  count(DISTINCT terminal_id) AS terminals, count(DISTINCT CAST(tx_datetime AS DATE)) AS days,
  min(tx_datetime) AS first_tx, max(tx_datetime) AS last_tx,
  CAST(max(tx_time_days) AS BIGINT) AS last_day_number, count(*) / {days} AS rows_per_day,
  count(*) / count(DISTINCT customer_id) AS rows_per_customer FROM tx"""


@query("profile", _profile_sql(TX_SQL))
def profile(spark, sf):
    return plain(pf.profile(transactions(spark, sf)))


@query("profile_fixed_days", _profile_sql(TX_SQL, "31"))
def profile_fixed_days(spark, sf):
    return plain(pf.profile(transactions(spark, sf), days=31))


@query("order_line_profile", _profile_sql(LINES_SQL))
def order_line_profile(spark, sf):
    return plain(pf.profile(order_lines(spark, sf)))


@query(
    "approximate_profile",
    f"""WITH {TX_SQL} SELECT count(*) AS rows, min(tx_datetime) AS first_tx, max(tx_datetime) AS last_tx,
  CAST(max(tx_time_days) AS BIGINT) AS last_day_number, true AS customers_near,
  true AS terminals_near, true AS days_near FROM tx""",
)
def approximate_profile(spark, sf):
    """Sketches differ between engines; that they come within 15 % of the exact counts does not."""
    rows = transactions(spark, sf)
    sketched = pf.profile(rows, approximate=True)
    exact = pf.profile(rows).select(
        *[F.col(c).alias(f"_{c}") for c in ("customers", "terminals", "days")]
    )

    def near(name):
        return (F.abs(F.col(name) / F.col(f"_{name}") - 1) <= 0.15).alias(f"{name}_near")

    both = sketched.join(exact)
    return plain(
        both.select(
            "rows", "first_tx", "last_tx", "last_day_number", near("customers"), near("terminals"), near("days")
        )
    )


_PREDICTED_SQL = f"""{TX_SQL}, p AS (
  SELECT *, CAST(tx_amount > 160 AS INTEGER) AS prediction FROM tx)"""
_DOCUMENTS_SQL = "p AS (SELECT toxic AS tx_fraud, quality AS prediction FROM labels)"

_COUNTS_SQL = """n AS (SELECT count(*) FILTER (tx_fraud = 0 AND prediction = 0) AS tn,
  count(*) FILTER (tx_fraud = 0 AND prediction = 1) AS fp,
  count(*) FILTER (tx_fraud = 1 AND prediction = 0) AS fn,
  count(*) FILTER (tx_fraud = 1 AND prediction = 1) AS tp FROM p)"""

_CELLS_SQL = f"""WITH {{base}}, {_COUNTS_SQL}
SELECT 0 AS label, 0 AS prediction, tn AS rows FROM n UNION ALL SELECT 0, 1, fp FROM n
UNION ALL SELECT 1, 0, fn FROM n UNION ALL SELECT 1, 1, tp FROM n"""


@query("confusion_cells", _CELLS_SQL.format(base=_PREDICTED_SQL))
def confusion_cells(spark, sf):
    return mt.confusion_cells(predictions(spark, sf))


@query("document_confusion_cells", _CELLS_SQL.format(base=_DOCUMENTS_SQL))
def document_confusion_cells(spark, sf):
    return mt.confusion_cells(document_labels(spark, sf))


@query(
    "confusion_matrix",
    f"""WITH {_PREDICTED_SQL}, {_COUNTS_SQL}
SELECT 0 AS label, tn AS predicted_0, fp AS predicted_1 FROM n UNION ALL SELECT 1, fn, tp FROM n""",
)
def confusion_matrix(spark, sf):
    return mt.confusion_matrix(predictions(spark, sf))


@query(
    "confusion_matrix_by_prediction",
    f"""WITH {_PREDICTED_SQL}, {_COUNTS_SQL}
SELECT 0 AS prediction, tn AS label_0, fn AS label_1 FROM n UNION ALL SELECT 1, fp, tp FROM n""",
)
def confusion_matrix_by_prediction(spark, sf):
    return mt.confusion_matrix(predictions(spark, sf), rows_are="prediction")


_QUALITY_SQL = f"""WITH {{base}}, {_COUNTS_SQL}
SELECT coalesce(round_even(tp / nullif(tp + fp, 0), 4), 0) AS precision,
  coalesce(round_even(tp / nullif(tp + fn, 0), 4), 0) AS recall,
  coalesce(round_even(2 * tp / nullif(2 * tp + fp + fn, 0), 4), 0) AS f1,
  coalesce(round_even((tp + tn) / nullif(tp + tn + fp + fn, 0), 4), 0) AS accuracy FROM n"""


@query("precision_recall_f1", _QUALITY_SQL.format(base=_PREDICTED_SQL))
def precision_recall_f1(spark, sf):
    return mt.quality(predictions(spark, sf))


@query("document_precision_recall_f1", _QUALITY_SQL.format(base=_DOCUMENTS_SQL))
def document_precision_recall_f1(spark, sf):
    return mt.quality(document_labels(spark, sf))


@query(
    "accuracy",
    f"WITH {_PREDICTED_SQL} SELECT count(*) FILTER (tx_fraud = prediction) / count(*) AS accuracy "
    "FROM p",
)
def accuracy(spark, sf):
    return mt.accuracy(predictions(spark, sf))


_CLASSES_SQL = f"""WITH {{base}}, {_COUNTS_SQL}, k AS (
  SELECT 'non-fraud' AS class, coalesce(tn / nullif(tn + fn, 0), 0) AS precision,
    coalesce(tn / nullif(tn + fp, 0), 0) AS recall,
    coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f1, tn + fp AS support FROM n
  UNION ALL SELECT 'fraud', coalesce(tp / nullif(tp + fp, 0), 0),
    coalesce(tp / nullif(tp + fn, 0), 0), coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), tp + fn
  FROM n), r AS (
SELECT * FROM k UNION ALL SELECT 'accuracy', NULL, NULL, (tp + tn) / (tp + tn + fp + fn),
  tp + tn + fp + fn FROM n
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM k
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
  sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)::BIGINT
FROM k)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
  support FROM r"""


def _report(df):
    report = mt.class_report(df)
    scores = [F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")]
    return report.select("class", *scores, "support")


@query("class_report", _CLASSES_SQL.format(base=_PREDICTED_SQL))
def class_report(spark, sf):
    return _report(predictions(spark, sf))


@query("document_class_report", _CLASSES_SQL.format(base=_DOCUMENTS_SQL))
def document_class_report(spark, sf):
    return _report(document_labels(spark, sf))


_AUC_SQL = """WITH {base}, r AS (
  SELECT tx_fraud, rank() OVER (ORDER BY tx_amount) * 2
    + count(*) OVER (PARTITION BY tx_amount) - 1 AS twice_rank FROM tx),
a AS (SELECT sum(twice_rank) FILTER (tx_fraud = 1) AS w, sum(tx_fraud) AS pos,
  count(*) - sum(tx_fraud) AS neg FROM r)
SELECT CAST(w - pos * (pos + 1) AS DOUBLE) / (2 * CAST(pos AS DOUBLE) * CAST(neg AS DOUBLE))
  AS roc_auc, CAST(pos AS BIGINT) AS positives, CAST(neg AS BIGINT) AS negatives FROM a"""


@query("roc_auc", _AUC_SQL.format(base=TX_SQL))
def roc_auc(spark, sf):
    return mt.roc_auc(transactions(spark, sf), "tx_amount")


@query("order_line_roc_auc", _AUC_SQL.format(base=LINES_SQL))
def order_line_roc_auc(spark, sf):
    return mt.roc_auc(order_lines(spark, sf), "tx_amount")


_MONTHS_SQL = """WITH {base}, p AS (SELECT *, tx_amount > {limit} AS rejected FROM tx), m AS (
SELECT CAST(CAST(date_trunc('month', tx_datetime) AS DATE) AS VARCHAR) AS month,
  count(*) AS transactions,
  count(*) FILTER (tx_fraud = 1 AND NOT rejected) AS executed_frauds,
  CAST(coalesce(sum(CAST(round(tx_amount * 100) AS BIGINT))
    FILTER (tx_fraud = 1 AND NOT rejected), 0) AS BIGINT) / 100 AS executed_fraud_amount,
  count(*) FILTER (tx_fraud = 0 AND rejected) AS rejected_good,
  count(*) FILTER (tx_fraud = 0) AS good FROM p GROUP BY 1), k AS (
SELECT month, transactions, executed_frauds, executed_frauds / transactions AS executed_fraud_share,
  executed_fraud_amount, rejected_good,
  coalesce(rejected_good / nullif(good, 0), 0) AS rejected_good_share FROM m)
SELECT *, executed_fraud_share <= 0.02 AND executed_fraud_amount <= 500000
  AND rejected_good_share <= 0.05 AS within_goals FROM k"""

ORDER_LINE_LIMIT = 50_000


@query("monthly_indicators", _MONTHS_SQL.format(base=TX_SQL, limit=160))
def monthly_indicators(spark, sf):
    return plain(mt.meets_goals(mt.monthly_indicators(predictions(spark, sf))))


@query("order_line_monthly_indicators", _MONTHS_SQL.format(base=LINES_SQL, limit=ORDER_LINE_LIMIT))
def order_line_monthly_indicators(spark, sf):
    rejected = F.when(F.col("tx_amount") > ORDER_LINE_LIMIT, 1).otherwise(0)
    lines = order_lines(spark, sf).withColumn("prediction", rejected)
    return plain(mt.meets_goals(mt.monthly_indicators(lines)))
