import random

import pytest

from cardwatch.operators import metrics as mt
from cardwatch.operators.profile import profile


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "tx_fraud long, prediction double")


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "tx_fraud long, score double")


PAIRS = [(0, 0.0)] * 50 + [(0, 1.0)] * 4 + [(1, 0.0)] * 3 + [(1, 1.0)] * 9


def test_confusion(spark):
    df = frame(spark, PAIRS)
    cells = {(r["label"], r["prediction"]): r["rows"] for r in mt.confusion_cells(df).collect()}
    assert cells == {(0, 0): 50, (0, 1): 4, (1, 0): 3, (1, 1): 9}
    assert [tuple(r) for r in mt.confusion_matrix(df).collect()] == [(0, 50, 4), (1, 3, 9)]
    turned = mt.confusion_matrix(df, rows_are="prediction")
    assert [tuple(r) for r in turned.collect()] == [(0, 50, 3), (1, 4, 9)]
    with pytest.raises(ValueError):
        mt.confusion_matrix(df, rows_are="class")


def test_quality(spark):
    row = mt.quality(frame(spark, PAIRS)).first()
    assert row["precision"] == round(9 / 13, 4) and row["recall"] == round(9 / 12, 4)
    assert row["f1"] == round(18 / 25, 4) and row["accuracy"] == round(59 / 66, 4)
    assert mt.accuracy(frame(spark, PAIRS)).first()[0] == pytest.approx(59 / 66)


@pytest.mark.parametrize("pairs", [[(1, 0.0), (0, 0.0)], [(0, 0.0)], []])
def test_no_predicted_fraud(spark, pairs):
    row = mt.quality(frame(spark, pairs)).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0, 0, 0)


def test_empty_confusion_is_dense(spark):
    assert [r["rows"] for r in mt.confusion_cells(frame(spark, [])).collect()] == [0, 0, 0, 0]


def test_class_report(spark):
    lines = {r["class"]: r for r in mt.class_report(frame(spark, PAIRS)).collect()}
    assert list(lines) == ["non-fraud", "fraud", "accuracy", "macro avg", "weighted avg"]
    good, bad = lines["non-fraud"], lines["fraud"]
    assert good["precision"] == pytest.approx(50 / 53) and good["support"] == 54
    assert bad["recall"] == pytest.approx(9 / 12) and bad["support"] == 12
    assert lines["macro avg"]["f1"] == pytest.approx((good["f1"] + bad["f1"]) / 2)
    weighted = (good["f1"] * 54 + bad["f1"] * 12) / 66
    assert lines["weighted avg"]["f1"] == pytest.approx(weighted)
    assert lines["accuracy"]["f1"] == pytest.approx(59 / 66)


def area(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    won = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    return won / (len(pos) * len(neg))


@pytest.mark.parametrize("kind", ["fine", "tied", "skewed"])
def test_area_matches_all_pairs(spark, kind):
    chance = random.Random(kind)
    value = {
        "fine": lambda: chance.random(),
        "tied": lambda: float(chance.randrange(4)),
        "skewed": lambda: 0.5 if chance.random() < 0.4 else chance.lognormvariate(0, 3),
    }[kind]
    pairs = [(chance.randrange(2), value()) for _ in range(400)]
    row = mt.roc_auc(scored(spark, pairs), "score").first()
    assert row["roc_auc"] == pytest.approx(area(pairs), abs=1e-12)
    assert row["positives"] + row["negatives"] == 400


def test_area_over_many_partitions(spark, monkeypatch):
    """Every sorted partition holds a few scores only; areas come by group."""
    for name, value in {"coalescePartitions.enabled": "false", "enabled": "true"}.items():
        monkeypatch.setitem(KEPT, f"spark.sql.adaptive.{name}", value)
    chance = random.Random(8)
    rows = [(k, chance.randrange(2), chance.randrange(60) / 7) for k in "aab" * 200]
    df = spark.createDataFrame(rows, "k string, tx_fraud long, score double")
    before = {name: spark.conf.get(name) for name in KEPT}
    try:
        for name, value in KEPT.items():
            spark.conf.set(name, value)
        got = {r["k"]: r for r in mt.roc_auc(df, "score", by=["k"]).collect()}
        whole = mt.roc_auc(df, "score").first()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    for k in "ab":
        assert got[k]["roc_auc"] == pytest.approx(area([r[1:] for r in rows if r[0] == k]), abs=1e-12)
    assert whole["roc_auc"] == pytest.approx(area([r[1:] for r in rows]), abs=1e-12)


KEPT = {"spark.sql.shuffle.partitions": "23"}


def test_area_reads_its_input_once(spark):
    from conftest import plan_of

    plan = plan_of(mt.roc_auc(scored(spark, [(0, 1.0), (1, 2.0)]), "score"))
    assert plan.count("FileScan") == 1 and "score-points" in plan


def test_area_edges(spark):
    def one(pairs):
        return mt.roc_auc(scored(spark, pairs), "score").first()["roc_auc"]

    assert one([(0, 1.0), (1, 1.0), (1, 1.0)]) == 0.5
    assert one([(1, 1.0), (1, 2.0)]) is None
    assert one([]) is None
    assert one([(0, None), (0, float("-inf")), (1, float("inf")), (None, 3.0)]) == 1.0
    assert one([(0, 5.0), (1, float("nan"))]) == 1.0


def test_area_agrees_with_the_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    chance = random.Random(3)
    pairs = [(chance.randrange(2), chance.gauss(0, 1)) for _ in range(500)]
    df = scored(spark, pairs)
    evaluator = BinaryClassificationEvaluator(
        labelCol="tx_fraud", rawPredictionCol="score", numBins=0
    )
    assert mt.roc_auc(df, "score").first()["roc_auc"] == pytest.approx(evaluator.evaluate(df))


def test_monthly_goals(make):
    from pyspark.sql import functions as F

    day = 86400
    rows = [{"s": i * 60} for i in range(100)] + [{"s": 40 * day + i} for i in range(20)]
    rows[0] |= {"tx_fraud": 1, "tx_amount": 12.34}
    rows[50] |= {"tx_fraud": 1, "tx_amount": 0.125}
    rows[105] |= {"tx_fraud": 1}
    rows[3] |= {"terminal_id": 9}
    df = make(rows).withColumn("prediction", F.when(F.col("terminal_id") == 9, 1).otherwise(0))
    january, february = mt.meets_goals(mt.monthly_indicators(df)).orderBy("month").collect()
    assert january["executed_fraud_share"] == 0.02
    assert january["executed_fraud_amount"] == pytest.approx(12.465, abs=1e-12)
    assert january["rejected_good_share"] == pytest.approx(1 / 98)
    assert january["within_goals"] and not february["within_goals"]


def test_profile_of_nothing(make):
    row = profile(make([{}]).filter("false")).first()
    assert row["rows"] == 0 and row["rows_per_day"] == 0.0 and row["first_tx"] is None
