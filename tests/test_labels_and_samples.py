import hashlib

import pytest
from conftest import plan_of, rows_by_id
from pyspark.sql import functions as F

from cardwatch.functions.numeric import draw_below, draw_number, hash_draw
from cardwatch.operators import labels as lb
from cardwatch.operators import profile as pf
from cardwatch.operators import sampling as sm
from cardwatch.operators import split as sp

DAY = 86400


def draw(*parts):
    return hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()


def ids(df):
    return sorted(r[0] for r in df.select("transaction_id").collect())


def listed(spark, rows, entity):
    return spark.createDataFrame(rows, f"tx_time_days long, {entity} long")


def test_over_limit_is_strict(make):
    df = lb.label_by_daily_sample(make([{"tx_amount": 160.0}, {"tx_amount": 160.01}]), rows=0)
    assert rows_by_id(df, "tx_fraud", "tx_fraud_scenario") == {0: (0, 0), 1: (1, 1)}


def test_daily_sample_of_a_short_day_is_the_whole_day(make):
    rows = [{"s": i} for i in range(4)] + [{"s": DAY + i} for i in range(30)]
    df = sm.sample_rows_per_group(make(rows), ["tx_time_days"])
    counts = {r[0]: r[1] for r in df.groupBy("tx_time_days").count().collect()}
    assert counts == {0: 4, 1: 10}
    expected = sorted(range(4, 34), key=lambda i: draw(7, i))[:10]
    assert ids(df.filter("tx_time_days = 1")) == sorted(expected)


def test_daily_sample_overrides_the_amount_label(make):
    df = lb.label_by_daily_sample(make([{"tx_amount": 500.0}] * 3), rows=2)
    scenarios = sorted(rows_by_id(df, "tx_fraud_scenario").values())
    assert scenarios == [1, 2, 2]


def test_daily_sample_cuts_each_group_before_the_shuffle(make):
    plan = plan_of(sm.sample_rows_per_group(make([{}]), ["tx_time_days"]))
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 100])
def test_share_takes_the_floor(make, n):
    df = make([{"s": i} for i in range(n)] + [{"s": DAY * 3 + i} for i in range(5)])
    got = sm.sample_share_per_group(df, ["tx_time_days"], (1, 3))
    expected = sorted(range(n), key=lambda i: draw(11, 0, i))[: n // 3]
    assert ids(got.filter("tx_time_days = 0")) == sorted(expected)
    assert got.filter("tx_time_days = 3").count() == 1


def test_share_only_filters_the_rows(make):
    df = make([{"s": i} for i in range(9)])
    plan = plan_of(sm.sample_share_per_group(df, ["tx_time_days"], (1, 3)))
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan


def test_samples_do_not_depend_on_partitioning(make):
    rows = [{"s": i * 977 % (5 * DAY), "tx_fraud": i % 2} for i in range(200)]
    for sample in (
        lambda d: sm.sample_rows_per_group(d, ["tx_time_days"]),
        lambda d: sm.sample_share_per_group(d, ["tx_time_days"], (1, 3)),
        lambda d: sm.stratified_sample(d, {0: 0.3, 1: 0.7}),
    ):
        assert ids(sample(make(rows, 1))) == ids(sample(make(rows, 9)))


def test_draws_have_the_right_share(spark):
    df = spark.range(20_000).select(hash_draw(1, "id").alias("d"))
    row = df.select(
        F.avg(draw_below(F.col("d"), 0.3).cast("int")),
        F.sum(draw_below(F.col("d"), 0).cast("int")),
        F.avg(draw_below(F.col("d"), 1).cast("int")),
        F.count_distinct(draw_number(F.col("d"), 10)),
    ).first()
    assert abs(row[0] - 0.3) < 0.02 and tuple(row[1:]) == (0, 1.0, 10)


def test_active_entities_come_from_their_day(make):
    df = make([{"s": DAY * (i % 3), "customer_id": i % 7} for i in range(60)])
    got = sm.active_entities(df, "customer_id", 2)
    assert got.groupBy("tx_time_days").count().filter("count <> 2").count() == 0
    assert got.join(df, ["tx_time_days", "customer_id"], "left_anti").count() == 0


def test_terminal_interval_is_half_open(spark, make):
    df = make([{"s": d * DAY, "terminal_id": t} for t in (1, 2) for d in range(6)])
    terminals = listed(spark, [(1, 1), (2, 1)], "terminal_id")
    got = lb.compromised_terminal_transactions(df, terminals)
    assert ids(got) == [1, 2, 3, 4]


def test_labels_by_lists_match_a_loop(spark, make):
    rows = [
        {
            "s": i * 7919 % (12 * DAY),
            "customer_id": i % 6,
            "terminal_id": i % 5,
            "tx_amount": float(i % 200),
        }
        for i in range(300)
    ]
    days = [r["s"] // DAY for r in rows]
    terminals, customers = [(0, 1), (2, 1), (5, 3)], [(1, 0), (1, 4), (3, 0), (9, 5)]
    scenario = [1 if r["tx_amount"] > 160 else 0 for r in rows]
    for day, terminal in terminals:
        for i, r in enumerate(rows):
            if r["terminal_id"] == terminal and day <= days[i] < day + 3:
                scenario[i] = 2
    for day in {d for d, _ in customers}:
        mine = [
            i
            for i, r in enumerate(rows)
            if (day, r["customer_id"]) in customers and day <= days[i] < day + 7
        ]
        for i in sorted(mine, key=lambda i: draw(11, day, i))[: len(mine) // 3]:
            scenario[i] = 3
    df = make(rows)
    lists = listed(spark, terminals, "terminal_id"), listed(spark, customers, "customer_id")
    labelled = lb.label_by_lists(df, *lists)
    expected = {i: (int(s > 0), s) for i, s in enumerate(scenario)}
    assert rows_by_id(labelled, "tx_fraud", "tx_fraud_scenario") == expected
    assert {1, 2, 3} <= set(scenario)

    drawn = lb.compromised_customer_transactions(df, lists[1])
    assert ids(drawn) == [i for i, s in enumerate(scenario) if s == 3]

    totals = {r["scenario"]: r["frauds"] for r in pf.scenario_totals(labelled).collect()}
    assert totals == {s: scenario.count(s) for s in (1, 2, 3)}
    earliest = {r["scenario"]: r["frauds"] for r in pf.first_scenario_totals(labelled).collect()}
    assert sum(earliest.values()) == sum(totals.values())
    assert earliest[1] == sum(r["tx_amount"] > 160 for r in rows)


def test_labels_by_lists_do_not_shuffle_the_transactions(spark, make):
    lists = listed(spark, [(0, 1)], "terminal_id"), listed(spark, [(0, 1)], "customer_id")
    plan = plan_of(lb.label_by_lists(make([{}] * 4), *lists))
    assert "Exchange hashpartitioning" not in plan


def test_split_parts_are_disjoint_and_complete(make):
    df = make([{"tx_fraud": i % 4 == 0 and 1 or 0} for i in range(500)])
    train, test = sp.train_test(df)
    assert sorted(ids(train) + ids(test)) == list(range(500))
    assert 350 < train.count() < 450


def test_fraction_may_differ_by_label(make):
    train, _ = sp.train_test(make([{"tx_fraud": i % 2} for i in range(100)]), {0: 0.0, 1: 1.0})
    assert ids(train) == list(range(1, 100, 2))


def test_subtract_drops_the_other_copies(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (2,), (3,)], "v int")
    train = spark.createDataFrame([(3,), (1,)], "v int")
    assert [r[0] for r in sp.test_by_subtract(rows, train).collect()] == [2]
    assert sorted(r[0] for r in sp.test_by_except_all(rows, train).collect()) == [1, 2, 2]


@pytest.mark.parametrize("rows", [1, 7, 40, 41, 500])
def test_large_daily_samples_are_cut_without_a_window_over_the_day(make, monkeypatch, rows):
    df = make([{"s": i % 3 * DAY + i} for i in range(120)])
    want = ids(sm.sample_rows_per_group(df, ["tx_time_days"], rows))
    monkeypatch.setattr(sm, "_GROUP_LIMIT", 0)
    got = sm.sample_rows_per_group(df, ["tx_time_days"], rows)
    assert ids(got) == want and len(want) == min(rows, 40) * 3
    plan = plan_of(got)
    assert "Window" not in plan and "Exchange hashpartitioning" not in plan


def test_entities_without_a_limit(make, monkeypatch):
    df = make([{"s": DAY * (i % 3), "customer_id": i % 50} for i in range(400)])

    def drawn(per_day):
        return sorted(map(tuple, sm.active_entities(df, "customer_id", per_day).collect()))

    want = {k: drawn(k) for k in (2, 30, (0, 1), (3, 9))}
    monkeypatch.setattr(sm, "_GROUP_LIMIT", 1)
    assert {k: drawn(k) for k in want} == want


def test_none_or_one_entity_a_day(make):
    df = make([{"s": DAY * (i % 40), "terminal_id": i % 11} for i in range(400)])
    got = sm.active_entities(df, "terminal_id", (0, 1), seed=1)
    counts = {r[0]: r[1] for r in got.groupBy("tx_time_days").count().collect()}
    assert set(counts.values()) == {1} and 10 <= len(counts) <= 30
    expected = {d for d in range(40) if int(draw(1, "count", d)[:8], 16) % 2}
    assert set(counts) == expected


def test_rows_without_an_id_fall_on_both_sides(make):
    df = make([{"s": i, "customer_id": i % 9, "transaction_id": None} for i in range(400)])
    train, test = sp.train_test(df)
    assert 280 < train.count() < 360 and train.count() + test.count() == 400
    train, _ = sp.train_test(df, {0: 0.5})
    assert 150 < train.count() < 250
    narrow = df.select("transaction_id", "tx_amount")
    assert sp.train_test(narrow)[0].count() in (0, 400)


def test_matches_of_a_list_are_read_once(spark, make, monkeypatch):
    """Cuts and days of the customer list come from one narrow table."""
    names = []
    stored = lb.stored
    monkeypatch.setattr(lb, "stored", lambda df, name: names.append(name) or stored(df, name))
    lists = listed(spark, [(0, 1)], "terminal_id"), listed(spark, [(0, 1)], "customer_id")
    lb.label_by_lists(make([{}] * 4), *lists)
    assert sorted(names) == ["customer-matches", "drawn-customer-days", "terminal-days"]
