"""Classification quality and business indicators, computed as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.numeric import (
    money_parts,
    money_total,
    money_units,
    ratio_or_zero,
    round_half_even,
)
from cardwatch.session import stored

PLACES = 4


def confusion_counts(
    df: DataFrame, label: str = "tx_fraud", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """One row (or one per ``by`` group): true and false negatives and positives."""
    truth, said = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*by).agg(
        F.count_if(~truth & ~said).alias("tn"),
        F.count_if(~truth & said).alias("fp"),
        F.count_if(truth & ~said).alias("fn"),
        F.count_if(truth & said).alias("tp"),
    )


def confusion_cells(df: DataFrame, label: str = "tx_fraud", prediction: str = "prediction"):
    """Four rows ``(label, prediction, rows)``, also those with 0."""
    counts = confusion_counts(df, label, prediction)
    cells = "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (label, prediction, rows)"
    return counts.selectExpr(cells)


def confusion_matrix(
    df: DataFrame,
    label: str = "tx_fraud",
    prediction: str = "prediction",
    *,
    rows_are: str = "label",
) -> DataFrame:
    """The 2 x 2 matrix. Rows are the truth; ``rows_are="prediction"`` turns it around."""
    counts = confusion_counts(df, label, prediction)
    if rows_are == "label":
        cells = "stack(2, 0, tn, fp, 1, fn, tp) AS (label, predicted_0, predicted_1)"
        return counts.selectExpr(cells)
    if rows_are == "prediction":
        cells = "stack(2, 0, tn, fn, 1, fp, tp) AS (prediction, label_0, label_1)"
        return counts.selectExpr(cells)
    raise ValueError("rows_are is label or prediction")


def quality(
    df: DataFrame,
    label: str = "tx_fraud",
    prediction: str = "prediction",
    *,
    by: Sequence[str] = (),
    places: int | None = PLACES,
) -> DataFrame:
    """Precision, recall, F1 and accuracy; 0 where a denominator is 0."""
    counts = confusion_counts(df, label, prediction, by)
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    precision, recall, f1 = _scores(F.col("tp"), F.col("fp"), F.col("fn"))
    scores = {
        "precision": precision,
        "recall": recall,
        "f1": f1,
        "accuracy": ratio_or_zero(F.col("tp") + F.col("tn"), total),
    }
    return counts.select(*by, *[_rounded(c, places).alias(n) for n, c in scores.items()])


def accuracy(df: DataFrame, label: str = "tx_fraud", prediction: str = "prediction") -> DataFrame:
    same = (F.col(label) == F.col(prediction)).cast("int")
    return df.agg(F.avg(same).alias("accuracy"))


def class_report(
    df: DataFrame,
    label: str = "tx_fraud",
    prediction: str = "prediction",
    *,
    names: tuple[str, str] = ("non-fraud", "fraud"),
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    counts = confusion_counts(df, label, prediction)
    good = _scores(F.col("tn"), F.col("fn"), F.col("fp"))
    bad = _scores(F.col("tp"), F.col("fp"), F.col("fn"))
    n_good, n_bad = F.col("tn") + F.col("fp"), F.col("tp") + F.col("fn")
    n = n_good + n_bad
    missing = F.lit(None).cast("double")
    hit = ratio_or_zero(F.col("tp") + F.col("tn"), n)
    lines = [
        (names[0], *good, n_good),
        (names[1], *bad, n_bad),
        ("accuracy", missing, missing, hit, n),
        ("macro avg", *[(g + b) / 2 for g, b in zip(good, bad)], n),
        ("weighted avg", *[ratio_or_zero(g * n_good + b * n_bad, n) for g, b in zip(good, bad)], n),
    ]
    fields = ("class", "precision", "recall", "f1", "support")
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("class"), *[c.alias(f) for f, c in zip(fields[1:], values)])
            for name, *values in lines
        ]
    )
    return counts.select(F.inline(rows))


def roc_auc(
    df: DataFrame, score: str, label: str = "tx_fraud", *, by: Sequence[str] = ()
) -> DataFrame:
    """Exact area under the ROC curve: ``roc_auc``, ``positives``, ``negatives``, one row or one per
    ``by`` group.

    The area is the share of (positive, negative) pairs in the right order, ties counting half.
    Rows are read once and added up per distinct score. These points are range-sorted and written
    with the number of their partition. Pairs within a partition come from a running count in it,
    pairs across partitions from one total per partition, so nothing but these totals passes through
    one task. The area is NULL if a class is missing.
    """
    groups = list(by)
    value = F.col(score).cast("double")
    rows = df.select(*groups, value.alias("_score"), (F.col(label) == 1).alias("_hit")).filter(
        F.col("_score").isNotNull() & F.col("_hit").isNotNull()
    )
    points = rows.groupBy(*groups, "_score").agg(
        F.count_if(F.col("_hit")).alias("_pos"), F.count_if(~F.col("_hit")).alias("_neg")
    )
    ordered = points.orderBy(*groups, "_score").withColumn("_part", F.spark_partition_id())
    placed = stored(ordered, "score-points")
    below = (
        Window.partitionBy(*groups, "_part")
        .orderBy("_score")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # Twice the number of pairs in order, so that ties stay whole numbers.
    won = 2 * _big(F.col("_pos")) * F.coalesce(F.sum("_neg").over(below), F.lit(0))
    totals = (
        placed.withColumn("_won", _big(won + _big(F.col("_pos")) * F.col("_neg")))
        .groupBy(*groups, "_part")
        .agg(
            F.sum("_pos").alias("_pos"),
            F.sum("_neg").alias("_neg"),
            F.sum("_won").cast("decimal(38,0)").alias("_won"),
        )
    )
    # One row per group and partition from here on.
    earlier = (
        Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    across = F.coalesce(F.sum("_neg").over(earlier), F.lit(0))
    carried = totals.select(
        *groups, "_pos", "_neg", (F.col("_won") + _big(2 * _big(F.col("_pos")) * across)).alias("_won")
    )
    summed = carried.groupBy(*groups).agg(
        F.sum("_won").cast("double").alias("_won"),
        F.sum("_pos").alias("positives"),
        F.sum("_neg").alias("negatives"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    area = F.try_divide(F.col("_won"), 2 * pairs).alias("roc_auc")
    return summed.select(*groups, area, "positives", "negatives")


def monthly_indicators(
    df: DataFrame,
    label: str = "tx_fraud",
    prediction: str = "prediction",
    *,
    amount: str = "tx_amount",
) -> DataFrame:
    """Per month: executed fraud as a share of all transactions and in money, good ones rejected.

    A transaction is executed unless it is predicted to be fraud.
    """
    executed_fraud = (F.col(label) == 1) & (F.col(prediction) == 0)
    rejected_good = (F.col(label) == 0) & (F.col(prediction) == 1)
    return (
        df.groupBy(F.to_date(F.date_trunc("month", "tx_datetime")).alias("month"))
        .agg(
            F.count("*").alias("transactions"),
            F.count_if(executed_fraud).alias("executed_frauds"),
            F.sum(F.when(executed_fraud, money_units(amount))).alias("_units"),
            F.sum(F.when(executed_fraud, money_parts(amount))).alias("_parts"),
            F.count_if(rejected_good).alias("rejected_good"),
            F.count_if(F.col(label) == 0).alias("_good"),
        )
        .select(
            "month",
            "transactions",
            "executed_frauds",
            ratio_or_zero(F.col("executed_frauds"), F.col("transactions")).alias(
                "executed_fraud_share"
            ),
            (F.expr(f"coalesce({money_total('_units', '_parts')}, 0D)") / 100).alias(
                "executed_fraud_amount"
            ),
            "rejected_good",
            ratio_or_zero(F.col("rejected_good"), F.col("_good")).alias("rejected_good_share"),
        )
    )


def meets_goals(
    indicators: DataFrame,
    *,
    fraud_share: float = 0.02,
    fraud_amount: float = 500_000,
    rejected_share: float = 0.05,
) -> DataFrame:
    """Mark the months that keep to the stated limits."""
    return indicators.withColumn(
        "within_goals",
        (F.col("executed_fraud_share") <= fraud_share)
        & (F.col("executed_fraud_amount") <= fraud_amount)
        & (F.col("rejected_good_share") <= rejected_share),
    )


def _scores(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    return (
        ratio_or_zero(tp, tp + fp),
        ratio_or_zero(tp, tp + fn),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    )


def _rounded(value: Column, places: int | None) -> Column:
    return value if places is None else round_half_even(value, places)


def _big(value: Column) -> Column:
    return value.cast("decimal(38,0)")
