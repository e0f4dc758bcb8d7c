"""Sums over event-time frames that end at, or some time before, each row.

A moving frame recomputed per row costs rows times frame length. Here each frame is the difference
of two running totals, so a key costs one pass whatever the frame lengths are. Measures are whole
numbers, which keeps the difference exact.

Two plans give the same rows:

``direct``  one shuffle by key, one Window node over the rows themselves. For keys whose rows fit
            one task.
``split``   for hot keys. Rows are first added up per (key, second) with map-side combining. The
            cells are cut into time blocks, each with the history its frames can reach, so that
            one task holds at most ``(block_days + reach) * 86 400`` cells of a key however many
            rows the key has. The sums return to the rows by a join on (key, second), which
            adaptive execution can split further where one second alone is hot.

``split`` is used at every size unless the caller asks for ``direct``; nothing is sampled, and no
job runs while a plan is built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.calendar import event_seconds
from cardwatch.schema import SECONDS_PER_DAY

# Seconds before the row, (start, end), both included: (86400, 0) is the last day up to the row.
Frame = tuple[int, int]

BLOCK_DAYS = 30
_SECOND = "_second"


def add_frame_sums(
    df: DataFrame,
    key: str,
    measures: Mapping[str, Column],
    frames: Mapping[str, Frame],
    *,
    ts: str = "tx_datetime",
    plan: str = "split",
    block_days: int = BLOCK_DAYS,
    source: DataFrame | None = None,
    context: DataFrame | None = None,
) -> DataFrame:
    """Add one long column ``{measure}_{frame}`` per measure and frame; 0 for an empty frame.

    ``source`` holds the same rows as ``df`` but is cheaper to read the measures from, where
    ``df`` already carries the columns of another key. ``context`` holds further rows, such as
    earlier days, that count in the frames and are not in the result; only the key, the time and
    the measures of these rows are read and shuffled.

    Rows without an event time are in no frame and get 0; the interval filters drop them.
    """
    source = df if source is None else source
    if plan == "direct":
        return _direct(df, context, key, measures, frames, ts)
    if plan == "split":
        return _split(df, source, context, key, measures, frames, ts, block_days)
    raise ValueError(f"unknown plan {plan!r}: use split or direct")


def _bounds(frames: Mapping[str, Frame]) -> list[int]:
    return sorted({edge for start, end in frames.values() for edge in (end, start + 1)})


def _running_totals(
    df: DataFrame, keys: list[str], measures: Mapping[str, Column], frames: Mapping[str, Frame]
) -> DataFrame:
    """Running totals up to each frame edge: one Window node, one sort."""
    order = f"PARTITION BY {', '.join(f'`{k}`' for k in keys)} ORDER BY {_SECOND}"
    totals = []
    for edge in _bounds(frames):
        until = f"{edge} PRECEDING" if edge else "CURRENT ROW"
        over = f"({order} RANGE BETWEEN UNBOUNDED PRECEDING AND {until})"
        totals += [f"coalesce(sum(_{m}) OVER {over}, 0) AS _{m}_{edge}" for m in measures]
    return df.selectExpr("*", *totals)


def _differences(measures: Mapping[str, Column], frames: Mapping[str, Frame]) -> list[str]:
    return [
        f"_{m}_{end} - _{m}_{start + 1} AS {m}_{label}"
        for label, (start, end) in frames.items()
        for m in measures
    ]


def quoted(columns: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def _measured(df, columns, ts, measures):
    return df.select(
        *columns,
        event_seconds(ts).alias(_SECOND),
        *[m.cast("long").alias(f"_{name}") for name, m in measures.items()],
    )


def _direct(df, context, key, measures, frames, ts):
    rows = _measured(df, ["*"], ts, measures)
    if context is not None:
        earlier = _measured(context, [key], ts, measures).withColumn("_own", F.lit(False))
        rows = rows.withColumn("_own", F.lit(True)).unionByName(earlier, allowMissingColumns=True)
    rows = _running_totals(rows, [key], measures, frames)
    if context is not None:
        rows = rows.filter("_own")
    return rows.selectExpr(*quoted(df.columns), *_differences(measures, frames))


def _split(df, source, context, key, measures, frames, ts, block_days):
    parts = [source] if context is None else [source, context]
    narrow = [_measured(p, [F.col(key).alias("_key")], ts, measures) for p in parts]
    narrow = narrow[0] if context is None else narrow[0].unionByName(narrow[1])
    cells = narrow.groupBy("_key", _SECOND).agg(
        *[F.sum(f"_{name}").alias(f"_{name}") for name in measures]
    )
    length = block_days * SECONDS_PER_DAY
    reach = max(start for start, _ in frames.values())
    home = F.floor(F.col(_SECOND) / length)
    last = F.floor((F.col(_SECOND) + reach) / length)
    blocks = cells.select("*", home.alias("_home")).select(
        "*", F.explode(F.sequence("_home", last)).alias("_block")
    )
    sums = (
        _running_totals(blocks, ["_key", "_block"], measures, frames)
        .filter("_block = _home")
        .selectExpr("_key", f"{_SECOND} AS _cell_second", *_differences(measures, frames))
    )
    rows = df.select("*", event_seconds(ts).alias(_SECOND))
    matched = rows.join(
        sums,
        rows[key].eqNullSafe(sums["_key"]) & rows[_SECOND].eqNullSafe(sums["_cell_second"]),
        "left",
    )
    added = [
        f"coalesce({m}_{label}, 0) AS {m}_{label}" for label in frames for m in measures
    ]
    return matched.selectExpr(*quoted(df.columns), *added)
