"""Train and test sets, distinct rows and set differences."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.numeric import draw_below, percent, row_draw
from cardwatch.operators.sampling import id_substitutes, in_stratified_sample
from cardwatch.schema import LABEL

TRAIN_SHARE = 0.8


def with_split(
    df: DataFrame,
    fraction: float | Mapping = TRAIN_SHARE,
    *,
    label: str = LABEL,
    id_column: str = "transaction_id",
    seed: int = 42,
) -> DataFrame:
    """Add ``is_train``; one column and no shuffle.

    A number is the share of all rows, whatever their labels. A mapping gives a share for each
    label it names and none for others. Rows without an id are dealt out by the columns of
    ``ID_SUBSTITUTES`` that they have.
    """
    if isinstance(fraction, Mapping):
        keep = in_stratified_sample(
            fraction, label=label, id_column=id_column, substitutes=id_substitutes(df), seed=seed
        )
    else:
        keep = draw_below(row_draw(seed, id_column, *id_substitutes(df)), fraction)
    return df.withColumn("is_train", keep)


def train_test(df: DataFrame, *args, **kwargs) -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, *args, **kwargs)
    return (
        marked.filter("is_train").drop("is_train"),
        marked.filter(~F.col("is_train")).drop("is_train"),
    )


def test_by_subtract(df: DataFrame, train: DataFrame) -> DataFrame:
    """All rows but the train rows, as distinct rows: every copy of a train row goes."""
    return df.subtract(train)


def test_by_except_all(df: DataFrame, train: DataFrame) -> DataFrame:
    """All rows but the train rows, copy by copy."""
    return df.exceptAll(train)


def label_values(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.select(label).distinct()


def split_report(split: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows, frauds and fraud share of train and test, in one pass."""
    fraud = F.count_if(F.col(label) == 1)
    return split.groupBy("is_train").agg(
        F.count("*").alias("rows"),
        fraud.alias("frauds"),
        percent(fraud, F.count("*")).alias("fraud_percent"),
    )
