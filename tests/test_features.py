"""Hand-written edges of the window columns."""

import pytest
from conftest import START, rows_by_id
from pyspark.sql import functions as F

from cardwatch.functions.calendar import night_flag, weekend_flag
from cardwatch.operators import features as ft
from cardwatch.plans.jobs import features_for_days

DAY = 86400
WEEK = 7 * DAY

both_plans = pytest.mark.parametrize("plan", ["direct", "split"])


def spending(df, *columns, **options):
    return rows_by_id(ft.add_customer_spending(df, **options), *columns)


def risk(df, *columns, **options):
    return rows_by_id(ft.add_terminal_risk(df, **options), *columns)


@both_plans
def test_frame_holds_the_exact_boundary(make, plan):
    df = make([{"s": 0}, {"s": DAY}])
    assert spending(df, "customer_id_nb_tx_1day_window", plan=plan) == {0: 1, 1: 2}


@both_plans
def test_frame_ends_one_second_later(make, plan):
    df = make([{"s": 0}, {"s": DAY + 1}])
    got = spending(df, "customer_id_nb_tx_1day_window", "customer_id_nb_tx_3day_window", plan=plan)
    assert got[1] == (1, 2)


@both_plans
def test_rows_of_one_second_see_each_other(make, plan):
    df = make([{"s": 5.1}, {"s": 5.9}])
    assert spending(df, "customer_id_nb_tx_1day_window", plan=plan) == {0: 2, 1: 2}


@both_plans
def test_missing_amount_counts_but_does_not_average(make, plan):
    df = make([{"s": 0, "tx_amount": None}, {"s": 1, "tx_amount": 4.5}])
    got = spending(
        df, "customer_id_nb_tx_1day_window", "customer_id_avg_amount_1day_window", plan=plan
    )
    assert got == {0: (1, 0.0), 1: (2, 4.5)}


@both_plans
def test_not_a_number_is_a_missing_amount(make, plan):
    df = make([{"s": 0, "tx_amount": float("nan")}, {"s": 1, "tx_amount": 4.5}])
    assert spending(df, "customer_id_avg_amount_1day_window", plan=plan)[1] == 4.5


def test_unfilled_average_is_null(make):
    df = make([{"tx_amount": None}])
    column = "customer_id_avg_amount_1day_window"
    assert spending(df, column, plan="direct", fill=False) == {0: None}


@both_plans
def test_finer_amounts_are_summed_whole(make, plan):
    """No amount is refused, and a mean does not depend on the order of its sum."""
    amounts = [0.125, 5.125, 1e-6, 33.333333, 1e9 + 0.5, -2.000001, 1e300, float("inf"), None]
    df = make([{"s": i, "tx_amount": a} for i, a in enumerate(amounts)])
    column = "customer_id_avg_amount_1day_window"
    got = spending(df, column, plan=plan)
    whole = amounts[:6]
    for i in range(len(amounts)):
        seen = [round(a * 1_000_000) for a in whole[: i + 1]]
        assert got[i] == pytest.approx(sum(seen) / len(seen) / 1e6, rel=1e-15)
    column = "customer_id_nb_tx_1day_window"
    assert spending(df, column, plan=plan)[8] == 9


@both_plans
def test_delayed_frame_starts_after_the_delay(make, plan):
    df = make([{"s": 0, "tx_fraud": 1}, {"s": WEEK}, {"s": WEEK + 1}])
    got = risk(df, "terminal_id_nb_tx_1day_window", "terminal_id_risk_1day_window", plan=plan)
    assert got[1] == (0, 0.0)
    assert got[2] == (1, 1.0)


@both_plans
def test_delayed_frame_lower_edge(make, plan):
    df = make([{"s": 0}, {"s": WEEK + DAY}, {"s": WEEK + DAY + 1}])
    got = risk(df, "terminal_id_nb_tx_1day_window", "terminal_id_nb_tx_3day_window", plan=plan)
    assert got[1] == (1, 1)
    assert got[2] == (0, 1)


@both_plans
def test_single_row_has_no_risk(make, plan):
    got = risk(make([{}]), "terminal_id_nb_tx_7day_window", "terminal_id_risk_7day_window", plan=plan)
    assert got == {0: (0, 0.0)}


@both_plans
def test_missing_label_is_not_counted(make, plan):
    df = make([{"s": 0, "tx_fraud": None}, {"s": 1, "tx_fraud": 1}, {"s": WEEK + 2}])
    got = risk(df, "terminal_id_nb_tx_1day_window", "terminal_id_risk_1day_window", plan=plan)
    assert got[2] == (1, 1.0)


@both_plans
def test_rows_without_a_key_form_one_group(make, plan):
    df = make([{"s": 0, "customer_id": None}, {"s": 1, "customer_id": None}, {"s": 2}])
    got = spending(df, "customer_id_nb_tx_1day_window", plan=plan)
    assert got == {0: 1, 1: 2, 2: 1}


def test_delayed_frame_is_the_difference_of_the_undelayed_sums(make):
    rows = [{"s": i * 7919 * 13 % (40 * DAY), "tx_fraud": i % 3 == 0 and 1 or 0} for i in range(400)]
    df = make(rows)
    both = ft.add_terminal_label_sums(ft.add_terminal_risk(df, plan="direct"), plan="direct")
    for d in (1, 3, 7):
        wrong = both.filter(
            F.col(f"terminal_id_nb_tx_{d}day_window")
            != F.col(f"nb_tx_delay_{d}day_window") - F.col("nb_tx_delay")
        )
        assert wrong.count() == 0


def test_flags(spark):
    times = ["2024-01-06 06:59:59", "2024-01-08 07:00:00", "2024-01-07 23:00:00", None]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(
        F.to_timestamp("t").alias("t")
    )
    got = [tuple(r) for r in df.select(weekend_flag("t"), night_flag("t")).collect()]
    assert got == [(1, 1), (0, 0), (1, 0), (0, 0)]


def test_features_do_not_depend_on_partitioning(make):
    rows = [
        {"s": i * 104729 % (30 * DAY), "customer_id": i % 5, "terminal_id": i % 3, "tx_fraud": i % 2}
        for i in range(300)
    ]
    one = sorted(map(tuple, ft.feature_table(make(rows, 1)).collect()))
    many = sorted(map(tuple, ft.feature_table(make(rows, 7)).collect()))
    assert one == many


@both_plans
def test_days_with_context_equal_the_whole_history(make, plan):
    rows = [
        {"s": i * 104729 % (30 * DAY), "customer_id": i % 5, "terminal_id": i % 3, "tx_fraud": i % 2}
        for i in range(500)
    ]
    df = make(rows)
    some = features_for_days(df, "2024-01-20", "2024-01-22", plan=plan)
    whole = ft.feature_table(df, plan="direct").filter(
        (F.col("tx_datetime") >= "2024-01-20") & (F.col("tx_datetime") < "2024-01-23")
    )
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.collect()))
    assert some.count() > 0


def test_a_day_alone_has_no_terminal_history(make):
    df = make([{"s": i * DAY / 2, "tx_fraud": 1} for i in range(60)])
    alone = features_for_days(df, "2024-01-20", "2024-01-20", lookback=0)
    assert alone.agg(F.max("terminal_id_nb_tx_7day_window")).first()[0] == 0


def test_closed_days_lose_the_last_fraction_of_a_second(make):
    df = make([{"s": DAY - 0.5}, {"s": DAY - 1}, {"s": 2 * DAY - 0.5}])
    assert features_for_days(df, "2024-01-01", "2024-01-02").count() == 3
    assert features_for_days(df, "2024-01-01", "2024-01-02", closed=True).count() == 1


def test_rows_without_a_time_are_dropped(make):
    df = make([{"s": None}, {"s": 3}])
    assert features_for_days(df, START.date(), START.date()).count() == 1
