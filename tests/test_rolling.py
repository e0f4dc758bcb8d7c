"""Both plans against a loop over all rows, on random tables."""

import random

import pytest
from conftest import plan_of, rows_by_id
from pyspark.sql import functions as F

from cardwatch.operators import features as ft
from cardwatch.operators.rolling import add_frame_sums

DAY = 86400
FRAMES = {"a": (DAY, 0), "b": (3 * DAY, DAY + 1), "c": (10, 0), "d": (20 * DAY, 5)}


def by_hand(rows, frames):
    out = {}
    for i, row in enumerate(rows):
        now = int(row["s"] // 1)
        out[i] = tuple(
            sum(
                other["tx_fraud"]
                for other in rows
                if other["customer_id"] == row["customer_id"]
                and now - start <= int(other["s"] // 1) <= now - end
            )
            for start, end in frames.values()
        )
    return out


def random_rows(seed, n=250):
    chance = random.Random(seed)
    hot = [0] * 3 + [1, 2, None]
    return [
        {
            "s": chance.choice([chance.randrange(40 * DAY), chance.randrange(60) * DAY, 7.5]),
            "customer_id": chance.choice(hot),
            "tx_fraud": chance.randrange(5),
        }
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("plan,block", [("direct", 30), ("split", 30), ("split", 1), ("split", 7)])
def test_sums_match_a_loop(make, seed, plan, block):
    rows = random_rows(seed)
    got = add_frame_sums(
        make(rows), "customer_id", {"f": F.col("tx_fraud")}, FRAMES, plan=plan, block_days=block
    )
    assert rows_by_id(got, *[f"f_{x}" for x in FRAMES]) == by_hand(rows, FRAMES)


@pytest.mark.parametrize("plan", ["direct", "split"])
def test_context_rows_count_and_stay_out(make, plan):
    rows = random_rows(9)
    df = make(rows)
    late, early = df.filter("transaction_id >= 100"), df.filter("transaction_id < 100")
    got = add_frame_sums(
        late, "customer_id", {"f": F.col("tx_fraud")}, FRAMES, plan=plan, context=early
    )
    expected = {i: v for i, v in by_hand(rows, FRAMES).items() if i >= 100}
    assert rows_by_id(got, *[f"f_{x}" for x in FRAMES]) == expected


def test_building_a_plan_runs_no_job(spark, make):
    df = make([{"customer_id": 1, "s": i} for i in range(5)])
    spark.sparkContext.setJobGroup("building", "feature table")
    try:
        ft.feature_table(df)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unknown_plan(make):
    with pytest.raises(ValueError, match="unknown plan"):
        ft.add_customer_spending(make([{}]), plan="fast")


def test_direct_plan_shuffles_once_per_key(spark, make):
    plan = plan_of(ft.feature_table(make([{}]), plan="direct"))
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("+- Window") == 2
    assert plan.count("+- Sort") == 2


def test_split_plan_combines_before_it_shuffles(spark, make):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(ft.add_customer_spending(make([{}]), plan="split"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "partial_sum" in plan
    assert "hashpartitioning(_key" in plan and "_block" in plan
    assert "SortMergeJoin" in plan and "BroadcastNestedLoopJoin" not in plan
    # No shuffle puts all rows of a key into one task.
    assert "hashpartitioning(customer_id#" not in plan.replace(" ", "")


def test_context_reads_only_what_the_window_needs(spark):
    from cardwatch.plans.jobs import features_for_days
    from cardwatch.plans.tables import transactions

    rows = transactions(spark, "/root/testdata/sf0.001")
    plan = plan_of(features_for_days(rows, "2024-01-20", "2024-01-20", plan="direct"))
    schemas = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line]
    assert len(schemas) == 3
    assert sum("event_id" in s for s in schemas) == 1
    assert plan.count("PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts") == 3
