"""Repeatable samples.

Draws are hashes of the seed and the row's keys: the same rows come out after a retry, with another
number of partitions, or in another engine. Rows without an id are told apart by other columns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.numeric import draw_below, draw_number, hash_draw, row_draw
from cardwatch.schema import DAILY_SAMPLE_ROWS, ID_SUBSTITUTES
from cardwatch.session import stored

# Hex digits of a draw that name its slice: 65 536 even slices per group.
_SLICE_DIGITS = 4
# Spark cuts groups before the shuffle for ranks up to this; larger ones are cut by slice counts.
_GROUP_LIMIT = 1000


def id_substitutes(df: DataFrame) -> list[str]:
    return [c for c in ID_SUBSTITUTES if c in df.columns]


def in_stratified_sample(
    fractions: Mapping,
    *,
    label: str = "tx_fraud",
    id_column: str = "transaction_id",
    substitutes: Sequence[str] = (),
    seed: int = 42,
) -> Column:
    """True for about ``fractions[label value]`` of the rows of each label; other labels: none."""
    draw = row_draw(seed, id_column, *substitutes)
    keep = F.lit(False)
    for value, fraction in fractions.items():
        keep |= (F.col(label) == F.lit(value)) & draw_below(draw, fraction)
    return F.coalesce(keep, F.lit(False))


def stratified_sample(df: DataFrame, fractions: Mapping, *, seed: int | None = 42, **keys):
    """The rows of :func:`in_stratified_sample`."""
    keys = {"substitutes": id_substitutes(df)} | keys
    return df.filter(in_stratified_sample(fractions, seed=seed, **keys))


def sample_rows_per_group(
    df: DataFrame,
    group: Sequence[str],
    rows: int = DAILY_SAMPLE_ROWS,
    *,
    id_column: str = "transaction_id",
    seed: int = 7,
) -> DataFrame:
    """Exactly ``rows`` random rows of each group, or all of a smaller group.

    A small sample is the first rows of a window: Spark keeps them per input partition before it
    shuffles (WindowGroupLimit), so a hot group sends little more than the others. A larger one is
    cut as in :func:`sample_share_per_group`, so that no window sees a whole group. Both give the
    same rows. Ids must be unique within a group.
    """
    return _first_of_group(df, group, rows, id_column, hash_draw(seed, id_column))


def _first_of_group(
    df: DataFrame, group: Sequence[str], rows: int, id_column: str, draw: Column
) -> DataFrame:
    if rows > _GROUP_LIMIT:
        cuts = _cutoffs(df, group, id_column, draw, lambda n: F.least(n, F.lit(rows)))
        return _up_to_cut(df, group, id_column, draw, cuts)
    order = Window.partitionBy(*group).orderBy(draw, id_column)
    return (
        df.withColumn("_position", F.row_number().over(order))
        .filter(F.col("_position") <= rows)
        .drop("_position")
    )


def share_cutoffs(
    df: DataFrame,
    group: Sequence[str],
    share: tuple[int, int],
    *,
    id_column: str = "transaction_id",
    seed: int = 11,
) -> DataFrame:
    """Per group of n rows, draw and id of the row number ``floor(n * a / b)`` in draw order.

    Columns ``cut_draw`` and ``cut_id`` beside the group; a group with nothing to take has no row.
    """
    keep_of, out_of = share
    draw = hash_draw(seed, *group, id_column)
    return _cutoffs(df, group, id_column, draw, lambda n: F.floor(n * keep_of / out_of))


def _cutoffs(
    df: DataFrame,
    group: Sequence[str],
    id_column: str,
    draw: Column,
    wanted: Callable[[Column], Column],
) -> DataFrame:
    """Draw and id of the last of the ``wanted`` rows of each group in draw order.

    Draws are cut into even slices. The slice counts tell in which slice the cut lies, and only
    the rows of that one slice are put in order, so no group has to fit one task.
    """
    drawn = df.select(*group, id_column, draw.alias("_draw")).withColumn(
        "_slice", F.substring("_draw", 1, _SLICE_DIGITS)
    )
    per_group = Window.partitionBy(*group)
    before = per_group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    cut_slices = (
        drawn.groupBy(*group, "_slice")
        .count()
        .select(
            *[F.col(g).alias(f"_{g}") for g in group],
            F.col("_slice").alias("_cut_slice"),
            "count",
            F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"),
            wanted(F.sum("count").over(per_group)).alias("_wanted"),
        )
        .filter(
            (F.col("_before") < F.col("_wanted"))
            & (F.col("_wanted") <= F.col("_before") + F.col("count"))
        )
    )
    # One row per group: written, so that Spark broadcasts it while it is small and shuffles only
    # the rows that match.
    cut_slices = stored(cut_slices, "cut-slices")
    match = drawn["_slice"] == cut_slices["_cut_slice"]
    for g in group:
        match &= drawn[g].eqNullSafe(cut_slices[f"_{g}"])
    order = Window.partitionBy(*[drawn[g] for g in group]).orderBy("_draw", id_column)
    return (
        drawn.join(cut_slices, match)
        .withColumn("_position", F.row_number().over(order))
        .filter(F.col("_before") + F.col("_position") == F.col("_wanted"))
        .select(
            *[drawn[g] for g in group],
            F.col("_draw").alias("cut_draw"),
            F.col(id_column).alias("cut_id"),
        )
    )


def within_cut(draw: Column, id_column: Column, cut_draw: Column, cut_id: Column) -> Column:
    return (draw < cut_draw) | (draw == cut_draw) & (id_column <= cut_id)


def _up_to_cut(
    df: DataFrame, group: Sequence[str], id_column: str, draw: Column, cuts: DataFrame
) -> DataFrame:
    """The rows up to their group's cut. The cuts, one row per group, are written first, so that
    Spark joins them by their true size; the rows themselves are only filtered."""
    cuts = stored(cuts.withColumnsRenamed({g: f"_{g}" for g in group}), "cuts")
    rows = df.withColumn("_draw", draw)
    match = F.lit(True)
    for g in group:
        match &= rows[g].eqNullSafe(cuts[f"_{g}"])
    # Without an id, which sorts first, equal draws are equal rows.
    no_later = F.coalesce(rows[id_column] <= F.col("cut_id"), F.lit(True))
    inside = (rows["_draw"] < F.col("cut_draw")) | (rows["_draw"] == F.col("cut_draw")) & no_later
    return rows.join(cuts, match & inside, "left_semi").drop("_draw")


def sample_share_per_group(
    df: DataFrame,
    group: Sequence[str],
    share: tuple[int, int],
    *,
    id_column: str = "transaction_id",
    seed: int = 11,
) -> DataFrame:
    """``floor(n * a / b)`` random rows without replacement of each group of n rows.

    The rows up to the group's cut are taken. Ids must be unique within a group.
    """
    cuts = share_cutoffs(df, group, share, id_column=id_column, seed=seed)
    return _up_to_cut(df, group, id_column, hash_draw(seed, *group, id_column), cuts)


def active_entities(
    df: DataFrame,
    entity: str,
    per_day: int | tuple[int, int],
    *,
    day: str = "tx_time_days",
    seed: int = 5,
) -> DataFrame:
    """Per day, up to ``per_day`` random entities among those with a transaction on that day.

    A pair stands for a number drawn anew for each day, both ends included.
    """
    least, most = (per_day, per_day) if isinstance(per_day, int) else per_day
    draw = hash_draw(seed, day, entity)
    chosen = _first_of_group(df.select(day, entity).distinct(), [day], most, entity, draw)
    if least == most:
        return chosen
    number = least + draw_number(hash_draw(seed, F.lit("count"), day), most - least + 1)
    # At most ``most`` rows a day are left to rank.
    order = Window.partitionBy(day).orderBy(draw, entity)
    return (
        chosen.withColumn("_position", F.row_number().over(order))
        .filter(F.col("_position") <= number)
        .drop("_position")
    )
