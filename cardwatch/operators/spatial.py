"""Terminals within reach of a customer."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.numeric import distance
from cardwatch.session import stored

DEFAULT_RADIUS = 5.0
# Cells of a wide radius, from its centre to its edge.
CELLS = 16
# Customers, and terminals, that are compared with one another in one go.
BLOCK_ROWS = 4_096
_CELL = ["_cell_x", "_cell_y"]


def terminals_within_radius(
    customers: DataFrame,
    terminals: DataFrame,
    radius: float = DEFAULT_RADIUS,
    *,
    form: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Customers with ``available_terminals`` (sorted ids) and ``nb_terminals``.

    A terminal is available at a distance strictly below ``radius``; a customer without any keeps
    an empty list. Customers at the same place share one list: it is made once, given its ``form``
    (text, for example) once, and joined to them. A place with many customers is dealt in blocks,
    and the number of tasks follows the rows to be compared.
    """
    others = [c for c in customers.columns if c != "customer_id"]
    place = F.struct(F.col("x_customer_id").alias("_x"), F.col("y_customer_id").alias("_y"))
    # Rows of one id are one customer, who may be at several places, or twice at one.
    placed = customers.groupBy("customer_id").agg(
        *[F.any_value(c).alias(c) for c in others],
        F.sort_array(F.collect_list(place)).alias("_places"),
    )
    # The key is text, as Spark deals rows anew for a join by fractions.
    placed = placed.withColumn("_spot", F.col("_places").cast("string"))
    shared = placed.groupBy("_spot").agg(
        F.any_value("_places").alias("_places"), F.count("*").alias("_weight")
    )
    shared = stored(shared, "places")
    met, tasks = _meetings(
        shared.select("_spot", "_weight", F.inline("_places")), ["_spot"], terminals, radius
    )
    lists = (
        met.select(F.inline("_customers"), "_terminals")
        .groupBy("_spot")
        .agg(
            F.sort_array(F.flatten(F.collect_list("_terminals"))).alias("available_terminals"),
            # Counted by itself, so that Spark can leave out lists nobody reads.
            F.sum(F.size("_terminals")).alias("nb_terminals"),
        )
    )
    listed = F.col("available_terminals")
    none = F.array().cast(lists.schema["available_terminals"].dataType)
    if form:
        lists, none = lists.withColumn("available_terminals", form(listed)), form(none)
    many = F.col("_weight") > BLOCK_ROWS
    blocks = stored(shared.filter(many).select("_spot", _blocks("_weight", "_blocks")), "blocks")
    number = F.coalesce("_blocks", F.lit(1))
    block = F.pmod(F.xxhash64("customer_id"), number).alias("_block")
    key = ["_spot", "_block"]
    lists = lists.join(blocks, "_spot", "left").select(
        "_spot", "available_terminals", "nb_terminals", _each(number, "_block")
    )
    placed = placed.join(blocks, "_spot", "left").select(*customers.columns, "_spot", block)
    return (
        placed.repartition(tasks, *key)
        .join(lists.repartition(tasks, *key), key, "left")
        .select(
            *customers.columns,
            F.coalesce(listed, none).alias("available_terminals"),
            F.coalesce("nb_terminals", F.lit(0)).cast("long").alias("nb_terminals"),
        )
    )


def customer_terminal_pairs(
    customers: DataFrame, terminals: DataFrame, radius: float = DEFAULT_RADIUS
) -> DataFrame:
    """The pairs themselves: ``(customer_id, terminal_id)``."""
    rows = customers.select(
        "customer_id",
        F.lit(1).alias("_weight"),
        F.col("x_customer_id").alias("_x"),
        F.col("y_customer_id").alias("_y"),
    )
    met, _ = _meetings(rows, ["customer_id"], terminals, radius)
    return met.select(F.inline("_customers"), "_terminals").select(
        "customer_id", F.explode("_terminals").alias("terminal_id")
    )


def terminal_counts_within_radius(
    customers: DataFrame, terminals: DataFrame, radius: float, cells: int = CELLS
) -> DataFrame:
    """Customers with ``nb_terminals`` alone, for a radius that reaches many terminals.

    The plane is cut into cells of a fraction of the radius. Of a cell wholly inside the circle the
    number of its terminals counts, of one wholly outside nothing; only in the cells that the edge
    crosses are customers compared with terminals.
    """
    inside, edge = _cell_parts(customers, terminals, radius, cells)
    found = inside.unionByName(_edge_pairs(edge, terminals, radius, cells).select("customer_id", "n"))
    counts = found.groupBy(F.col("customer_id").alias("_id")).agg(F.sum("n").alias("nb_terminals"))
    counted = customers.join(counts, F.col("customer_id") == F.col("_id"), "left")
    number = F.coalesce("nb_terminals", F.lit(0)).cast("long").alias("nb_terminals")
    return counted.select(*[customers[c] for c in customers.columns], number)


def _cell_parts(customers, terminals, radius, cells):
    """(customer, n) of the cells inside; (customer, place, cell) of those on the edge."""
    if radius <= 0:
        raise ValueError("radius must be positive")
    size = radius / cells
    places = customers.select(
        "customer_id", F.col("x_customer_id").alias("_x"), F.col("y_customer_id").alias("_y")
    ).withColumns({"_cx": F.floor(F.col("_x") / size), "_cy": F.floor(F.col("_y") / size)})
    totals = _terminal_cells(terminals, size).groupBy("_tx", "_ty").agg(F.count("*").alias("n"))
    # Cells apart from a customer's own in which anything can be in reach.
    steps = F.sequence(F.lit(-cells - 2), F.lit(cells + 2))
    gap_x, gap_y = (F.greatest(F.abs(c) - 1, F.lit(0)) for c in ("_dx", "_dy"))
    near = (
        places.select(F.col("_cx").alias("_own_x"), F.col("_cy").alias("_own_y"))
        .distinct()
        .withColumn("_dx", F.explode(steps))
        .withColumn("_dy", F.explode(steps))
        .filter(gap_x * gap_x + gap_y * gap_y <= (cells + 1) ** 2)
        .select(
            "_own_x",
            "_own_y",
            (F.col("_own_x") + F.col("_dx")).alias("_tx"),
            (F.col("_own_y") + F.col("_dy")).alias("_ty"),
        )
        .join(totals, ["_tx", "_ty"])
    )
    own = (F.col("_cx") == F.col("_own_x")) & (F.col("_cy") == F.col("_own_y"))
    met = places.join(near, own)

    def reach(pick):
        """The nearest or the farthest that a point of the cell can be."""
        parts = []
        for at, cell in (("_x", "_tx"), ("_y", "_ty")):
            low, high = F.col(cell) * size, (F.col(cell) + 1) * size
            parts.append(pick(F.col(at), low, high))
        return F.sqrt(parts[0] * parts[0] + parts[1] * parts[1])

    farthest = reach(lambda v, low, high: F.greatest(F.abs(v - low), F.abs(v - high)))
    nearest = reach(lambda v, low, high: F.greatest(low - v, v - high, F.lit(0.0)))
    # A little slack, so that rounding sends a doubtful cell to the comparison.
    slack = 1e-9 * (radius + F.abs("_x") + F.abs("_y"))
    met = met.withColumns({"_far": farthest + slack, "_near": nearest - slack})
    inside = met.filter(F.col("_far") < radius).select("customer_id", "n")
    edge = met.filter((F.col("_far") >= radius) & (F.col("_near") < radius))
    return inside, edge.select("customer_id", "_x", "_y", "_tx", "_ty")


def _terminal_cells(terminals, size):
    return terminals.select(
        F.col("x_terminal_id").alias("_at_x"),
        F.col("y_terminal_id").alias("_at_y"),
        F.floor(F.col("x_terminal_id") / size).alias("_tx"),
        F.floor(F.col("y_terminal_id") / size).alias("_ty"),
    )


def _edge_pairs(edge, terminals, radius, cells):
    pairs = edge.join(_terminal_cells(terminals, radius / cells), ["_tx", "_ty"])
    apart = distance(F.col("_x"), F.col("_y"), F.col("_at_x"), F.col("_at_y"))
    return pairs.filter(apart < radius).withColumn("n", F.lit(1).cast("long"))


def _cell(value: Column, radius: float) -> Column:
    # A little wider than the radius, so that rounding never puts a pair two cells apart.
    return F.floor(value / (radius * (1 + 1e-9)))


def _meetings(customers, ids, terminals, radius):
    """``_customers`` (structs of the columns ``ids``) at one place and ``_terminals`` (ids) at one
    place in reach of it; and the number of tasks that suits as many pairs as the ``_weight`` of the
    customers makes.

    Both sides are cut into square cells of the radius, each terminal stands in its own cell and the
    eight around it, and the join is an equi-join on the cell. Rows at one place are compared once.
    Where more than ``BLOCK_ROWS`` of a side meet in a cell, that side is dealt in blocks, every two
    blocks meet by themselves, and so no task has more than a few times the square of that to do.
    """
    if radius <= 0:
        raise ValueError("radius must be positive")
    left = customers.withColumns(
        {"_cell_x": _cell(F.col("_x"), radius), "_cell_y": _cell(F.col("_y"), radius)}
    ).dropna(subset=_CELL)
    step = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    right = (
        terminals.filter(F.col("terminal_id").isNotNull())
        .select(
            "terminal_id",
            F.col("x_terminal_id").alias("_at_x"),
            F.col("y_terminal_id").alias("_at_y"),
            F.explode(step).alias("_step_x"),
        )
        .select("*", F.explode(step).alias("_step_y"))
        .select(
            "terminal_id",
            "_at_x",
            "_at_y",
            (_cell(F.col("_at_x"), radius) + F.col("_step_x")).alias("_cell_x"),
            (_cell(F.col("_at_y"), radius) + F.col("_step_y")).alias("_cell_y"),
        )
        .dropna(subset=_CELL)
    )
    numbers = left.groupBy(*_CELL).agg(F.count("*").alias("_left"), F.sum("_weight").alias("_weight"))
    cells = stored(
        numbers.join(right.groupBy(*_CELL).agg(F.count("*").alias("_right")), _CELL), "cells"
    )
    many = (F.col("_left") > BLOCK_ROWS) | (F.col("_right") > BLOCK_ROWS)
    hot = cells.filter(many).select(*_CELL, _blocks("_left", "_lefts"), _blocks("_right", "_rights"))
    hot = stored(hot, "hot-cells")
    lefts, rights = F.coalesce("_lefts", F.lit(1)), F.coalesce("_rights", F.lit(1))
    own, near = F.xxhash64(*ids, "_x", "_y"), F.xxhash64("terminal_id", "_at_x", "_at_y")
    left = (
        left.join(hot, _CELL, "left")
        .withColumns({"_l": F.pmod(own, lefts), "_blocks": rights})
        .groupBy(*_CELL, "_l", "_blocks", "_x", "_y")
        .agg(F.collect_list(F.struct(*ids)).alias("_customers"))
        .select(*_CELL, "_l", _each(F.col("_blocks"), "_r"), "_x", "_y", "_customers")
    )
    right = (
        right.join(hot, _CELL, "left")
        .withColumns({"_r": F.pmod(near, rights), "_blocks": lefts})
        .groupBy(*_CELL, "_r", "_blocks", "_at_x", "_at_y")
        .agg(F.collect_list("terminal_id").alias("_terminals"))
        .select(*_CELL, "_r", _each(F.col("_blocks"), "_l"), "_at_x", "_at_y", "_terminals")
    )
    key = [*_CELL, "_l", "_r"]
    tasks = _tasks(cells, "_left")
    apart = distance(F.col("_x"), F.col("_y"), F.col("_at_x"), F.col("_at_y"))
    met = left.repartition(tasks, *key).join(right.repartition(tasks, *key), key)
    return met.filter(apart < radius).select("_customers", "_terminals"), _tasks(cells, "_weight")


def _blocks(rows: str, name: str) -> Column:
    return F.ceil(F.col(rows) / BLOCK_ROWS).alias(name)


def _each(number: Column, name: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), number - 1)).alias(name)


def _tasks(cells: DataFrame, rows: str) -> int:
    """One for every two full blocks that meet, and no fewer than a shuffle has."""
    work = F.sum(F.col(rows).cast("double") * F.col("_right"))
    full = (cells.agg(work).first()[0] or 0) / BLOCK_ROWS**2
    return max(math.ceil(full), int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")))
