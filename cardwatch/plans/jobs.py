"""The batch jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.functions.calendar import Day, as_date, day_end
from cardwatch.operators import model as ml
from cardwatch.operators.features import feature_table
from cardwatch.operators.filters import PARTITION_DAY, between_days, days_before, lookback_days
from cardwatch.operators.labels import label_by_daily_sample, label_by_lists
from cardwatch.operators.metrics import quality, roc_auc
from cardwatch.operators.sampling import active_entities
from cardwatch.operators.split import train_test, with_split
from cardwatch.schema import (
    COMPROMISED_CUSTOMERS_PER_DAY,
    COMPROMISED_TERMINALS_PER_DAY,
    DELAY_DAYS,
    TRANSACTION_COLUMNS,
    TRANSACTION_SCHEMA,
    WINDOW_DAYS,
)
from cardwatch.session import scratch, stored, use_utc
from cardwatch.sources.readers import Paths, scan, scan_day_folders
from cardwatch.sources.writers import convert_csv, run_days, write_day_copies


def convert_job(spark: SparkSession, source: Paths, targets: Sequence[str]) -> None:
    """Raw CSV files to Parquet at every target."""
    use_utc(spark)
    with scratch(spark):
        convert_csv(spark, source, targets)


def features_for_days(
    transactions: DataFrame,
    first: Day,
    last: Day,
    *,
    lookback: int | None = None,
    windows: Sequence[int] = WINDOW_DAYS,
    delay: int = DELAY_DAYS,
    closed: bool = False,
    **rolling,
) -> DataFrame:
    """Feature rows of the output days.

    Only the output days travel through the shuffles as whole rows. The days before them take
    part as context: the columns a window needs, and only the days it can reach. ``lookback``
    shortens that history.
    """
    reach = lookback_days(windows, delay) if lookback is None else lookback
    rows = between_days(transactions, first, last, closed=closed)
    table = feature_table(
        rows,
        windows,
        delay,
        context=days_before(transactions, first, reach),
        customer_context=days_before(transactions, first, min(reach, max(windows))),
        **rolling,
    )
    return table.filter(F.col("tx_datetime") <= day_end("tx_datetime")) if closed else table


def feature_job(
    spark: SparkSession,
    inputs: Paths,
    outputs: Sequence[str],
    first: Day,
    last: Day,
    *,
    fmt: str = "parquet",
    day_folders: bool = False,
    **options,
) -> None:
    """Compute the features of the days and replace those days at every output.

    With ``day_folders`` the inputs are roots of ``YYYY-MM-DD.parquet`` folders: only those of the
    days and their history are listed, and missing ones are skipped.
    """
    use_utc(spark)
    if day_folders:
        reach = options.get("lookback")
        if reach is None:
            reach = lookback_days(options.get("windows", WINDOW_DAYS), options.get("delay", DELAY_DAYS))
        start = as_date(first) - dt.timedelta(days=reach)
        rows = scan_day_folders(spark, inputs, start, last, TRANSACTION_SCHEMA)
    else:
        rows = scan(spark, inputs, fmt, TRANSACTION_SCHEMA if fmt == "csv" else None)
    days = F.col(PARTITION_DAY).between(F.lit(as_date(first)), F.lit(as_date(last)))
    with scratch(spark):
        table = features_for_days(rows, first, last, **options)
        write_day_copies(table, outputs, days, order=["transaction_id"])


def label_job(
    spark: SparkSession,
    inputs: Paths,
    outputs: Sequence[str],
    *,
    by_lists: bool = False,
    seed: int = 0,
) -> None:
    """Label transactions and write them by day.

    By default the over-limit rule and a daily sample; ``by_lists`` draws compromised terminals
    and customers from those active on each day. Every output gets the days of the inputs; other
    days that it holds stay as they are.
    """
    use_utc(spark)
    rows = scan(spark, inputs, "parquet", None)
    rows = rows.select(*TRANSACTION_COLUMNS)
    with scratch(spark):
        days = run_days(rows) if len(outputs) > 1 else None
        if by_lists:
            terminals = active_entities(
                rows, "terminal_id", COMPROMISED_TERMINALS_PER_DAY, seed=seed + 1
            )
            customers = active_entities(
                rows, "customer_id", COMPROMISED_CUSTOMERS_PER_DAY, seed=seed + 2
            )
            labelled = label_by_lists(rows, terminals, customers, seed=seed + 3)
        else:
            labelled = label_by_daily_sample(rows, seed=seed)
        labelled = labelled.select(*TRANSACTION_COLUMNS)
        write_day_copies(labelled, outputs, days, order=["transaction_id"])


def training_job(
    spark: SparkSession,
    inputs: Paths,
    model_path: str,
    first: Day,
    last: Day,
    *,
    fraction: float = 0.8,
    draws: int = ml.DRAWS,
    folds: int = ml.FOLDS,
    parallelism: int = ml.PARALLELISM,
    seed: int = 42,
    **ranges,
) -> DataFrame:
    """Search, fit, save and evaluate the forest; one row with its parameters and test metrics.

    Every draw is validated on every train row.
    """
    use_utc(spark)
    with scratch(spark):
        record = _training_record(
            spark, inputs, model_path, first, last, fraction, draws, folds, parallelism, seed, ranges
        )
        # One row; kept, as the tables it comes from go.
        return spark.createDataFrame(record.collect(), record.schema)


def _training_record(
    spark, inputs, model_path, first, last, fraction, draws, folds, parallelism, seed, ranges
):
    rows = between_days(scan(spark, inputs, "parquet", None), first, last)
    train, test = train_test(rows, fraction, seed=seed)
    pipeline = ml.forest_pipeline(seed=seed)
    grid = ml.forest_grid(pipeline, draws, seed, **ranges)
    fitted = ml.search(train, pipeline, grid, folds=folds, parallelism=parallelism, seed=seed)
    ml.save_model(fitted, model_path)
    scored = ml.fraud_probability(ml.score(fitted, test))
    # The forest scores the test rows once; both metrics read what is written here.
    scored = stored(scored.select("tx_fraud", "prediction", "fraud_probability"), "scored")
    area = roc_auc(scored, "fraud_probability").select(F.bround("roc_auc", 4).alias("roc_auc"))
    parts = with_split(rows, fraction, seed=seed)
    sizes = parts.agg(
        F.count("*").alias("dataset_size"),
        F.count_if("is_train").alias("train_size"),
        F.count_if(~F.col("is_train")).alias("test_size"),
    )
    scores = quality(scored).select(F.struct("precision", "recall"))
    record = sizes.select(
        "*", area.scalar().alias("roc_auc"), scores.scalar().alias("_scores")
    ).select("dataset_size", "train_size", "test_size", "roc_auc", "_scores.*")
    chosen = {n: F.lit(v) for n, v in ml.best_parameters(fitted).items()}
    dates = {"date_from": F.lit(as_date(first)), "date_to": F.lit(as_date(last))}
    return record.select(
        *[c.alias(n) for n, c in (chosen | dates).items()],
        *record.columns,
    )
