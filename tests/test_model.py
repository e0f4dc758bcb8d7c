import threading

import pytest
from conftest import SMALL
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from cardwatch.operators import model as ml
from cardwatch.operators.features import feature_table
from cardwatch.plans import model_queries
from cardwatch.plans.jobs import training_job
from cardwatch.schema import model_inputs

SHORT = {"maxDepth": lambda r: r.randrange(1, 4), "numTrees": lambda r: r.randrange(2, 5)}


@pytest.fixture(scope="module")
def data(spark):
    columns = [
        (F.rand(i) * 5).cast("int" if "_nb_" in name else "double").alias(name)
        for i, name in enumerate(model_inputs())
    ]
    df = spark.range(300).select(F.col("id").alias("transaction_id"), *columns)
    label = F.when(F.col("tx_amount") + F.col("terminal_id_risk_7day_window") > 5, 1).otherwise(0)
    return df.withColumn("tx_fraud", label.cast("long")).cache()


def test_inputs_are_the_feature_columns(make):
    inputs = model_inputs()
    assert len(inputs) == 15 and len(set(inputs)) == 15
    assert set(inputs) < set(feature_table(make([{}])).columns)


def test_grid_is_repeatable_and_in_range(spark):
    def draws(seed):
        pipeline = ml.forest_pipeline()
        return [{p.name: v for p, v in m.items()} for m in ml.forest_grid(pipeline, 40, seed)]

    assert draws(0) == draws(0) and draws(0) != draws(1)
    for d in draws(5):
        assert 1 <= d["maxDepth"] < 16 and 20 <= d["maxBins"] < 100
        assert 5 <= d["numTrees"] < 50 and d["impurity"] in ("gini", "entropy")
    assert len(ml.forest_grid(ml.forest_pipeline())) == 16


def test_grid_refuses_parameters_that_spark_would_ignore(spark):
    with pytest.raises(ValueError, match="belongs to a class"):
        ml.random_grid({RandomForestClassifier.maxDepth: lambda r: 3})
    with pytest.raises(TypeError):
        ml.random_grid({"maxDepth": lambda r: 3})


def test_folds_are_fixed_by_id(spark):
    df = spark.range(1000).withColumnRenamed("id", "transaction_id")
    one = ml.with_folds(df.repartition(3), 10).collect()
    two = ml.with_folds(df.repartition(8), 10).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))
    assert {r["fold"] for r in one} == set(range(10))


def test_missing_input_is_an_error(spark, data):
    broken = data.withColumn("tx_amount", F.lit(None).cast("double"))
    with pytest.raises(Exception):
        ml.assemble(broken).collect()


def test_search_applies_its_parameters(spark, data, tmp_path):
    pipeline = ml.forest_pipeline()
    grid = ml.forest_grid(pipeline, 2, seed=3, **SHORT)
    fitted = ml.search(data, pipeline, grid, folds=2)
    again = ml.search(data, pipeline, grid, folds=2)
    assert fitted.avgMetrics == again.avgMetrics
    best = max(range(2), key=lambda i: fitted.avgMetrics[i])
    assert ml.best_parameters(fitted) == {p.name: v for p, v in grid[best].items()}

    ml.save_model(fitted, str(tmp_path / "model"))
    ml.save_model(fitted, str(tmp_path / "model"))
    loaded = ml.load_model(str(tmp_path / "model"))
    assert ml.best_parameters(loaded) == ml.best_parameters(fitted)
    before = ml.fraud_probability(ml.score(fitted, data)).orderBy("transaction_id")
    after = ml.fraud_probability(ml.score(loaded, data)).orderBy("transaction_id")
    columns = ("prediction", "fraud_probability")
    assert before.select(*columns).collect() == after.select(*columns).collect()
    assert {"features", "rawPrediction", "probability"} <= set(before.columns)


def test_seedless_grid_draws_anew(spark):
    forest = ml.forest_pipeline().getStages()[-1]
    draws = [ml.random_grid({forest.maxBins: lambda r: r.random()}, 3) for _ in range(2)]
    assert draws[0] != draws[1]


def test_missing_inputs_count_as_zero(spark, tmp_path):
    rows = [(float(i), i % 2) for i in range(20)] + [(None, 0), (float("nan"), 1)]
    df = spark.createDataFrame(rows, "a double, tx_fraud int")
    model = ml.forest_pipeline(["a"], numTrees=2, maxDepth=2).fit(df)
    ml.save_model(model, str(tmp_path / "m"))
    scored = ml.score(ml.load_model(str(tmp_path / "m")), df)
    assert scored.columns == ["a", "tx_fraud", "features", "rawPrediction", "probability", "prediction"]
    assert [r["features"][0] for r in scored.collect()][-2:] == [0.0, 0.0]


class Asked(Exception):
    pass


def asked_of(monkeypatch, owner, name):
    """``name`` of ``owner`` keeps its arguments and ends the query there."""
    seen = []

    def stop(*args, **options):
        seen.append((args, options))
        raise Asked

    monkeypatch.setattr(owner, name, stop)
    return seen


def test_registered_search_is_the_full_one(spark, monkeypatch):
    seen = asked_of(monkeypatch, ml, "run_search")
    with pytest.raises(Asked):
        model_queries.parameter_search(spark, SMALL)
    (_, _, grid), options = seen[0]
    values = [{p.name: v for p, v in draw.items()} for draw in grid]
    assert [tuple(v[n] for n in model_queries.SEARCHED) for v in values] == list(model_queries.DRAWN)
    assert len(grid) == 16 and ml.FOLDS == 10 and options == {}


def test_search_compares_draws_on_rows_they_have_not_seen(spark, data):
    pipeline = ml.forest_pipeline()
    forest = pipeline.getStages()[-1]
    grid = ml.forest_grid(pipeline, 3, seed=3, **SHORT)
    vectors, _ = ml.assembled_rows(data, pipeline, folds=4)
    scores = ml.validation_scores(vectors, forest, grid, folds=4, parallelism=3)
    assert scores.count() == 3 * data.count()
    assert scores.select("draw", "transaction_id").distinct().count() == 3 * data.count()
    model = forest.fit(vectors.filter("fold <> 2"), grid[1])
    want = ml.fraud_probability(model.transform(vectors.filter("fold = 2")), "want")
    mine = scores.filter("draw = 1 and fold = 2").join(want.select("transaction_id", "want"), "transaction_id")
    assert mine.count() == vectors.filter("fold = 2").count()
    assert mine.filter("abs(score - want) > 1e-12").count() == 0


def test_mean_area_by_hand(spark):
    rows = [(0, 0, 1, 0.9), (0, 0, 0, 0.1), (0, 1, 1, 0.5), (0, 1, 0, 0.5), (0, 2, 1, 0.3), (1, 0, 0, 0.2)]
    df = spark.createDataFrame(rows, "draw int, fold int, tx_fraud int, score double")
    assert {r["draw"]: r["mean_auc"] for r in ml.mean_areas(df).collect()} == {0: 0.75, 1: 0.0}


def test_rows_of_a_search_are_bounded(spark, data):
    vectors, _ = ml.assembled_rows(data, ml.forest_pipeline())
    assert ml.search_rows(vectors, None).count() == ml.search_rows(vectors, 300).count() == 300
    few = ml.search_rows(vectors, 100)
    assert 60 <= few.count() <= 140 and few.rdd.getNumPartitions() == 1
    assert few.collect() == ml.search_rows(vectors.repartition(5), 100).collect()


def test_registered_training_is_the_full_one(spark, monkeypatch):
    seen = asked_of(monkeypatch, model_queries, "training_job")
    with pytest.raises(Asked):
        model_queries.training_record(spark, SMALL)
    (_, _, _, first, last), options = seen[0]
    days = spark.read.parquet(f"{SMALL}/events.parquet").agg(F.min("ts"), F.max("ts")).first()
    assert [first, last] == [str(d.date()) for d in days] and options == {}


@pytest.mark.parametrize("name", ["forest_predictions", "forest_quality", "reloaded_model_predictions"])
def test_registered_forests_have_the_default_size(spark, monkeypatch, name):
    seen = asked_of(monkeypatch, ml, "forest_pipeline")
    with pytest.raises(Asked):
        getattr(model_queries, name)(spark, SMALL)
    assert seen == [((), {})]


def test_rows_of_a_fit_are_dealt_by_their_number(spark, data, monkeypatch):
    monkeypatch.setattr(ml, "FIT_ROWS", 20, raising=False)
    sizes, real = [], RandomForestClassifier.fit

    def fit(self, rows, *args):
        held = rows.groupBy(F.spark_partition_id()).count().collect()
        sizes.append([r["count"] for r in held])
        return real(self, rows, *args)

    monkeypatch.setattr(RandomForestClassifier, "fit", fit)
    pipeline = ml.forest_pipeline(maxDepth=2, numTrees=2)
    grid = ml.forest_grid(pipeline, 1, seed=3, **SHORT)
    # Before, the partitions were those of the files, here one.
    ml.search(data.coalesce(1), pipeline, grid, folds=2)
    assert sum(sizes[-1]) == 300 and max(sizes[-1]) < 60
    model = ml.fit(pipeline, data.coalesce(1))
    assert sum(sizes[-1]) == 300 and max(sizes[-1]) < 60
    assert ml.score(model, data).count() == 300
    ml.fit(pipeline, data.withColumn("transaction_id", F.lit(None).cast("long")).coalesce(1))
    assert sum(sizes[-1]) == 300 and max(sizes[-1]) < 60


def test_training_compares_draws_on_all_train_rows(spark, tmp_path, monkeypatch):
    seen, real = [], ml.validation_scores

    def validation_scores(vectors, *args, **options):
        scores = real(vectors, *args, **options)
        seen.append((vectors.count(), scores.count(), scores.distinct().count()))
        return scores

    monkeypatch.setattr(ml, "validation_scores", validation_scores)
    columns = [(F.rand(i) * 5).alias(name) for i, name in enumerate(model_inputs())]
    at = F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, id % 3)").alias("tx_datetime")
    fraud = (F.rand(99) < 0.3).cast("long").alias("tx_fraud")
    # More train rows than the draws were compared on before.
    rows = spark.range(5000).select(F.col("id").alias("transaction_id"), at, fraud, *columns)
    rows.write.parquet(str(tmp_path / "features"))
    record = training_job(
        spark, str(tmp_path / "features"), str(tmp_path / "model"), "2024-01-01", "2024-01-03",
        draws=2, folds=2, **SHORT,
    ).first()
    n = record["train_size"]
    assert n > 3900 and seen == [(n, 2 * n, 2 * n)]


def test_large_fits_do_not_all_run_at_once(spark, data, monkeypatch):
    assert [ml.side_by_side(t, 8) for t in (1, 4, 8, 50, 5000)] == [9, 3, 2, 2, 2]
    assert ml.side_by_side(1, 100) == 16 and ml.side_by_side(50, 8, parallelism=1) == 1
    monkeypatch.setattr(ml, "FIT_ROWS", 20)
    running, most, lock, real = [0], [0], threading.Lock(), RandomForestClassifier.fit

    def fit(self, *args):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        try:
            return real(self, *args)
        finally:
            with lock:
                running[0] -= 1

    monkeypatch.setattr(RandomForestClassifier, "fit", fit)
    pipeline = ml.forest_pipeline()
    fitted = ml.search(data, pipeline, ml.forest_grid(pipeline, 3, seed=3, **SHORT), folds=3)
    assert most[0] == 2 and len(fitted.avgMetrics) == 3


def test_forests_with_kept_nodes_are_the_same(spark, data):
    forest = ml.forest_pipeline(maxDepth=6, numTrees=7).getStages()[-1]
    vectors, _ = ml.assembled_rows(data, ml.forest_pipeline())
    rows = ml.dealt(vectors, 3)
    plain, kept = forest.fit(rows), ml._with_kept_nodes(forest).fit(rows)
    trees = [[t.toDebugString.split("\n", 1)[1] for t in m.trees] for m in (plain, kept)]
    assert trees[0] == trees[1] and kept.getCacheNodeIds() and sum(t.depth for t in kept.trees) > 20
