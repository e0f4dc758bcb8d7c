"""Money, ratios, distance and hash draws."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPAN = 1 << 32
MONEY_PARTS = 10_000
NULL_KEY = "\\N"


def money_units(amount: Column | str, scale: int = 2) -> Column:
    """The amount as a whole number of its smallest unit (cents for two places), to the nearest.

    What an amount has beyond that is told by :func:`money_parts`. Both are whole numbers, which
    add up to the same total in any order, so results do not depend on partitioning. NaN and
    amounts of 2 ** 62 units and more count as missing.
    """
    return F.when(_is_money(amount, scale), F.rint(_scaled(amount, scale)).cast("long"))


def money_parts(amount: Column | str, scale: int = 2) -> Column:
    """What :func:`money_units` leaves of the amount, in units divided by ``MONEY_PARTS``.

    Together they hold the amount to ``scale`` + 4 places; anything finer is rounded.
    """
    scaled = _scaled(amount, scale)
    rest = F.rint((scaled - F.rint(scaled)) * float(MONEY_PARTS)).cast("long")
    return F.when(_is_money(amount, scale), rest)


def money_total(units: str, parts: str) -> str:
    """SQL for the total of summed units and parts, in units; exact where no parts are left."""
    return f"({units} + {parts} / {float(MONEY_PARTS)}D)"


def _scaled(amount: Column | str, scale: int) -> Column:
    value = F.col(amount) if isinstance(amount, str) else amount
    return value.cast("double") * float(10**scale)


def _is_money(amount: Column | str, scale: int) -> Column:
    return F.abs(_scaled(amount, scale)) < float(1 << 62)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """The quotient, or 0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(numerator, denominator).cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return ratio_or_zero(part * 100, whole)


def round_half_even(value: Column | str, places: int) -> Column:
    return F.bround(value, places)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x1 - x2, y1 - y2
    return F.sqrt(dx * dx + dy * dy)


def hash_draw(seed: int, *keys: Column | str) -> Column:
    """A repeatable pseudo-random text of 32 hex digits for the given keys; a NULL key is one more
    value."""
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    texts = [F.coalesce(c.cast("string"), F.lit(NULL_KEY)) for c in columns]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *texts))


def row_draw(seed: int, id_column: str, *substitutes: str) -> Column:
    """The draw of a row's id. Rows without an id are told apart by the substitute columns."""
    draw = hash_draw(seed, id_column)
    if not substitutes:
        return draw
    return F.when(F.col(id_column).isNull(), hash_draw(seed, id_column, *substitutes)).otherwise(draw)


def draw_below(draw: Column, fraction: float) -> Column:
    """True for the given share of draws; depends on the keys only, never on partitioning."""
    limit = math.ceil(fraction * HASH_SPAN)
    if limit >= HASH_SPAN:
        return F.lit(True)
    if limit <= 0:
        return F.lit(False)
    return F.substring(draw, 1, 8) < F.lit(format(limit, "08x"))


def draw_number(draw: Column, modulus: int) -> Column:
    """The draw as an integer in ``[0, modulus)``."""
    return (F.conv(F.substring(draw, 1, 8), 16, 10).cast("long") % modulus).cast("int")


def decoded(file_name: Column | str) -> Column:
    """A file name as ``_metadata`` gives it, without its percent codes; a plus stays one."""
    return F.url_decode(F.replace(file_name, F.lit("+"), F.lit("%2B")))


def file_stem(file_name: Column | str) -> Column:
    """File name without folder and last suffix."""
    base = F.regexp_extract(file_name, r"([^/]+)$", 1)
    return F.regexp_replace(base, r"(?<=.)\.[^.]*$", "")
