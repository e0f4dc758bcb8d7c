"""Chronological order and ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.session import stored


def chronological(df: DataFrame, ts: str = "tx_datetime", *ties: str) -> DataFrame:
    """Global order by event time: a range shuffle, for final output only."""
    return df.orderBy(ts, *ties)


def add_chronological_id(
    df: DataFrame,
    *,
    ts: str = "tx_datetime",
    ties: Sequence[str] = (),
    name: str = "transaction_id",
) -> DataFrame:
    """Number the rows 0, 1, 2, ... in order of time, without gaps.

    ``ties`` should make the order complete. The rows are range-sorted and written once to the
    shared scratch folder with their place in the sorted partition; the id is that place plus the
    rows of all earlier partitions. Only the row counts of the partitions meet in one task, and
    no day or second has to fit one. Writing the sorted rows fixes the partitions, so a lost
    executor cannot renumber them.
    """
    others = [c for c in df.columns if c != name]
    ordered = df.select(*others).orderBy(ts, *ties)
    placed = stored(ordered.withColumn("_place", F.monotonically_increasing_id()), "sorted")
    # The upper bits of the place are the number of the sorted partition, the lower 33 the row.
    part, row = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .count()
        .select("_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset"))
    )
    # One row per sorted partition; written, so that Spark sees how small it is.
    numbered = placed.withColumn("_part", part).join(stored(offsets, "offsets"), "_part")
    return numbered.select((row + F.col("_offset")).alias(name), *others)
