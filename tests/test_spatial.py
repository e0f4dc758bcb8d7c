import math
import random

import pytest
from conftest import plan_of

from cardwatch.operators import spatial
from cardwatch.operators.spatial import (
    customer_terminal_pairs,
    terminal_counts_within_radius,
    terminals_within_radius,
)


def places(spark, kind, points):
    schema = f"{kind}_id long, x_{kind}_id double, y_{kind}_id double"
    return spark.createDataFrame([(i, *p) for i, p in enumerate(points)], schema)


def by_hand(customers, terminals, radius):
    return {
        c: [
            t
            for t, q in enumerate(terminals)
            if math.sqrt((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) < radius
        ]
        for c, p in enumerate(customers)
    }


@pytest.mark.parametrize("radius", [0.7, 5, 50, 200])
def test_grid_join_matches_all_pairs(spark, radius):
    chance = random.Random(int(radius * 10))

    def some(n):
        return [(chance.uniform(-20, 100), float(chance.randrange(100))) for _ in range(n)]

    customers, terminals = some(60), some(40)
    got = terminals_within_radius(
        places(spark, "customer", customers), places(spark, "terminal", terminals), radius
    )
    found = {r["customer_id"]: r["available_terminals"] for r in got.collect()}
    assert found == by_hand(customers, terminals, radius)
    assert got.filter("nb_terminals <> size(available_terminals)").count() == 0


def test_distance_equal_to_the_radius_is_too_far(spark):
    customers = places(spark, "customer", [(0.0, 0.0), (0.0, 0.1), (90.0, 90.0)])
    terminals = places(spark, "terminal", [(3.0, 4.0)])
    got = {
        r["customer_id"]: (r["available_terminals"], r["nb_terminals"])
        for r in terminals_within_radius(customers, terminals, 5).collect()
    }
    assert got == {0: ([], 0), 1: ([0], 1), 2: ([], 0)}


def test_join_is_by_cell(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(
            customer_terminal_pairs(
                places(spark, "customer", [(0.0, 0.0)]), places(spark, "terminal", [(1.0, 1.0)])
            )
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_radius_must_be_positive(spark):
    with pytest.raises(ValueError):
        terminals_within_radius(
            places(spark, "customer", [(0.0, 0.0)]), places(spark, "terminal", [(1.0, 1.0)]), 0
        )


@pytest.mark.parametrize("radius, cells", [(0.7, 4), (5, 16), (50, 2), (50, 16), (200, 16)])
def test_counts_match_all_pairs(spark, radius, cells):
    chance = random.Random(int(radius * 10) + cells)

    def some(n):
        # Whole numbers put many pairs at exactly the radius and many places on cell borders.
        return [(chance.uniform(-20, 100), float(chance.randrange(100))) for _ in range(n)] + [
            (float(chance.randrange(0, 100, 5)), float(chance.randrange(0, 100, 5))) for _ in range(n)
        ]

    customers, terminals = some(40), some(60)
    df = places(spark, "customer", customers).withColumn("n", spatial.F.lit(5))
    got = terminal_counts_within_radius(df, places(spark, "terminal", terminals), radius, cells)
    assert got.columns == ["customer_id", "x_customer_id", "y_customer_id", "n", "nb_terminals"]
    found = {r["customer_id"]: r["nb_terminals"] for r in got.collect()}
    assert found == {c: len(t) for c, t in by_hand(customers, terminals, radius).items()}


def test_counts_of_missing_places_and_no_terminals(spark):
    customers = places(spark, "customer", [(None, 1.0), (2.0, 2.0)])
    none = places(spark, "terminal", [])
    assert [r["nb_terminals"] for r in terminal_counts_within_radius(customers, none, 9).collect()] == [0, 0]
    some = places(spark, "terminal", [(2.0, 2.5), (None, None)])
    got = terminal_counts_within_radius(customers, some, 9).orderBy("customer_id").collect()
    assert [r["nb_terminals"] for r in got] == [0, 1]


def test_few_pairs_are_compared_at_a_wide_radius(spark):
    chance = random.Random(1)

    def some(n):
        return [(chance.uniform(0, 100), chance.uniform(0, 100)) for _ in range(n)]

    customers, terminals = places(spark, "customer", some(200)), places(spark, "terminal", some(2000))
    inside, edge = spatial._cell_parts(customers, terminals, 50, 32)
    compared = edge.join(spatial._terminal_cells(terminals, 50 / 32), ["_tx", "_ty"]).count()
    counted = inside.agg(spatial.F.sum("n")).first()[0]
    assert compared < 0.1 * 200 * 2000 and counted > 5 * compared


def crowd(monkeypatch):
    """Blocks of four rows; places that many share, and ids that are missing or repeated."""
    monkeypatch.setattr(spatial, "BLOCK_ROWS", 4, raising=False)
    customers = [(1.0, 1.0)] * 40 + [(float(i), 2.0) for i in range(20)] + [(90.0, 90.0), (None, 1.0)]
    terminals = [(2.0, 1.0)] * 30 + [(8.0, float(i)) for i in range(10)]
    return customers, terminals


def test_pairs_of_a_crowded_cell_are_dealt_in_blocks(spark, monkeypatch):
    customers, terminals = crowd(monkeypatch)
    left = places(spark, "customer", customers)
    left = left.unionByName(left.filter("customer_id = 3")).unionByName(
        left.filter("customer_id = 4").withColumn("customer_id", spatial.F.lit(None).cast("long"))
    )
    got = customer_terminal_pairs(left, places(spark, "terminal", terminals))
    near = by_hand([c for c in customers if c[0] is not None], terminals, 5)
    want = [(c, t) for c, found in near.items() for t in found]
    want += [p for p in want if p[0] == 3] + [(None, t) for c, t in want if c == 4]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    parts = got.groupBy(spatial.F.spark_partition_id()).count().collect()
    # Before, all pairs of a cell came out of one task.
    assert got.rdd.getNumPartitions() > 100 and max(r["count"] for r in parts) < len(want) / 5


def test_customers_at_one_place_share_a_list(spark, monkeypatch):
    customers, terminals = crowd(monkeypatch)
    left = places(spark, "customer", customers).unionByName(places(spark, "customer", customers[:3]))
    left = left.unionByName(places(spark, "customer", [(8.0, 9.0)]))
    got = terminals_within_radius(
        left, places(spark, "terminal", terminals), form=lambda ids: spatial.F.array_join(ids, ",")
    )
    near = by_hand([(0.0, -90.0) if c[0] is None else c for c in customers], terminals, 5)
    for c in range(3):  # rows of one id count each, also those at another place
        near[c] = sorted(near[c] * 2)
    near[0] = sorted(near[0] + by_hand([(8.0, 9.0)], terminals, 5)[0])
    found = {r["customer_id"]: (r["available_terminals"], r["nb_terminals"]) for r in got.collect()}
    assert found == {c: (",".join(map(str, t)), len(t)) for c, t in near.items()}
    # Before, all customers of a cell were listed by one task.
    parts = got.filter("nb_terminals > 0").groupBy(spatial.F.spark_partition_id()).count().collect()
    assert got.rdd.getNumPartitions() > 100 and max(r["count"] for r in parts) < len(customers) / 3
