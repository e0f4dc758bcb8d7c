"""Queries over model training. Forests have no SQL form; their inputs and what must hold of any
forest do."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardwatch.operators import metrics as mt
from cardwatch.operators import model as ml
from cardwatch.operators.features import feature_table
from cardwatch.operators.filters import PARTITION_DAY
from cardwatch.operators.split import train_test
from cardwatch.plans.jobs import training_job
from cardwatch.plans.registry import query
from cardwatch.plans.tables import TX_SQL, plain, transactions
from cardwatch.plans.window_queries import features_sql
from cardwatch.schema import model_inputs
from cardwatch.session import scratch_path
from cardwatch.sources.writers import overwrite, write_days

_INPUTS_SQL = ", ".join(f"round({c}, 6)::DOUBLE::VARCHAR" for c in model_inputs())


def _stored_features(spark, sf):
    """The feature table, written once: training reads it many times."""
    path = scratch_path(spark, "features")
    overwrite(feature_table(transactions(spark, sf)), path)
    return spark.read.parquet(path)


@query(
    "model_input_vector",
    f"SELECT transaction_id, tx_fraud, concat_ws(',', {_INPUTS_SQL}) AS inputs "
    f"FROM ({features_sql()})",
)
def model_input_vector(spark, sf):
    assembled = ml.assemble(feature_table(transactions(spark, sf)))
    values = vector_to_array("features")
    text = F.array_join(F.transform(values, lambda v: F.round(v, 6).cast("string")), ",")
    return assembled.select("transaction_id", "tx_fraud", text.alias("inputs"))


@query(
    "cross_validation_folds",
    f"""WITH {TX_SQL} SELECT transaction_id,
  CAST(CAST('0x' || substr(md5('42:fold:' || transaction_id), 1, 8) AS BIGINT) % 10 AS INTEGER)
    AS fold FROM tx""",
)
def cross_validation_folds(spark, sf):
    return ml.with_folds(transactions(spark, sf)).select("transaction_id", "fold")


def _scored_test(spark, sf):
    train, test = train_test(_stored_features(spark, sf))
    return ml.fraud_probability(ml.score(ml.fit(ml.forest_pipeline(), train), test))


# Forests differ between engines; what must hold for every row of any forest does not.
@query(
    "forest_predictions",
    f"""WITH {TX_SQL} SELECT transaction_id, tx_fraud, CAST(20 AS BIGINT) AS votes,
  true AS probability_is_vote_share, 15 AS inputs
FROM tx WHERE substr(md5('42:' || transaction_id), 1, 8) >= 'cccccccd'""",
)
def forest_predictions(spark, sf):
    """Test rows with the votes of their forest, one per tree, and the inputs it reads."""
    scored = _scored_test(spark, sf)
    votes = vector_to_array("rawPrediction")
    total = votes[0] + votes[1]
    return scored.select(
        "transaction_id",
        "tx_fraud",
        F.round(total).cast("long").alias("votes"),
        (F.abs(votes[1] / total - F.col("fraud_probability")) < 1e-9).alias(
            "probability_is_vote_share"
        ),
        F.size(vector_to_array("features")).alias("inputs"),
    )


@query(
    "forest_prediction_rules",
    f"""WITH {TX_SQL} SELECT transaction_id, tx_fraud, true AS is_probability, true AS is_majority
FROM tx WHERE substr(md5('42:' || transaction_id), 1, 8) >= 'cccccccd'""",
)
def forest_prediction_rules(spark, sf):
    """Each test row is scored once, by a probability, and predicted to be the likelier class."""
    scored = _scored_test(spark, sf)
    chance = F.col("fraud_probability")
    return scored.select(
        "transaction_id",
        "tx_fraud",
        chance.between(0, 1).alias("is_probability"),
        (F.col("prediction") == (chance > 0.5).cast("double")).alias("is_majority"),
    )


@query(
    "forest_quality",
    f"""WITH {TX_SQL} SELECT CASE WHEN substr(md5('42:' || transaction_id), 1, 8) < 'cccccccd'
    THEN 'train' ELSE 'test' END AS part, true AS in_range, true AS f1_between,
  count(*) AS rows, count(*) FILTER (tx_fraud = 1) AS frauds FROM tx GROUP BY 1""",
)
def forest_quality(spark, sf):
    """Precision, recall, F1 and accuracy of train and test rows keep to what their definitions
    say; the cells they come from hold every row once."""
    train, test = train_test(_stored_features(spark, sf))
    fitted = ml.fit(ml.forest_pipeline(), train)
    both = ml.score(fitted, train).select(F.lit("train").alias("part"), "tx_fraud", "prediction")
    both = both.unionByName(
        ml.score(fitted, test).select(F.lit("test").alias("part"), "tx_fraud", "prediction")
    )
    scores = mt.quality(both, by=["part"], places=None)
    cells = mt.confusion_counts(both, by=["part"])
    low, high = F.least("precision", "recall"), F.greatest("precision", "recall")
    named = [F.col(c) for c in ("precision", "recall", "f1", "accuracy")]
    ranges = F.forall(F.array(*named), lambda x: x.between(0, 1))
    return scores.join(cells, "part").select(
        "part",
        ranges.alias("in_range"),
        F.col("f1").between(low - 1e-9, high + 1e-9).alias("f1_between"),
        (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("rows"),
        (F.col("fn") + F.col("tp")).alias("frauds"),
    )


@query(
    "reloaded_model_predictions",
    f"""WITH {TX_SQL} SELECT true AS same, count(*) AS count FROM tx
WHERE substr(md5('42:' || transaction_id), 1, 8) >= 'cccccccd'""",
)
def reloaded_model_predictions(spark, sf):
    """The saved and reloaded model gives the predictions of the fitted one."""
    train, test = train_test(_stored_features(spark, sf))
    fitted = ml.fit(ml.forest_pipeline(), train)
    path = scratch_path(spark, "model")
    ml.save_model(fitted, path)
    before = ml.score(fitted, test).select("transaction_id", F.col("prediction").alias("_before"))
    after = ml.score(ml.load_model(path), test).select("transaction_id", "prediction")
    same = F.col("prediction") == F.col("_before")
    return after.join(before, "transaction_id").groupBy(same.alias("same")).count()


SEARCHED = ("maxDepth", "maxBins", "numTrees", "impurity")
# The draws of seed 0, in the order of SEARCHED.
DRAWN = (
    (14, 69, 31, "gini"),
    (5, 85, 36, "entropy"),
    (15, 58, 35, "entropy"),
    (10, 47, 37, "gini"),
    (5, 37, 11, "entropy"),
    (15, 88, 43, "gini"),
    (5, 32, 9, "entropy"),
    (8, 91, 11, "entropy"),
    (7, 60, 44, "gini"),
    (9, 81, 33, "entropy"),
    (1, 90, 5, "gini"),
    (12, 71, 47, "gini"),
    (10, 83, 26, "gini"),
    (12, 61, 9, "gini"),
    (15, 92, 19, "gini"),
    (13, 38, 39, "entropy"),
)
_IN_TRAIN_SQL = "substr(md5('42:' || transaction_id), 1, 8) < 'cccccccd'"
_VALUES_SQL = ", ".join(f"({i}, {d}, {b}, {t}, '{m}')" for i, (d, b, t, m) in enumerate(DRAWN))


@query(
    "parameter_search",
    f"""WITH {TX_SQL}, train AS (SELECT transaction_id, tx_fraud FROM tx WHERE {_IN_TRAIN_SQL}),
cut AS (SELECT ceil({ml.SEARCH_ROWS} / count(*) * 4294967296) AS cut FROM train),
seen AS (SELECT count(*) AS rows, count(*) FILTER (tx_fraud = 1) AS frauds FROM train, cut
  WHERE CAST('0x' || substr(md5('42:fit:' || transaction_id), 1, 8) AS BIGINT) < cut),
drawn(draw, "maxDepth", "maxBins", "numTrees", impurity) AS (VALUES {_VALUES_SQL})
SELECT drawn.*, rows, frauds, CAST({ml.FOLDS} AS BIGINT) AS folds, true AS is_area,
  true AS best_is_kept FROM drawn, seen""",
)
def parameter_search(spark, sf):
    """Every draw of the full search: its values, the rows and folds that validated it, whether its
    mean area is one, and whether the model kept is that of the best mean."""
    train, _ = train_test(_stored_features(spark, sf))
    pipeline = ml.forest_pipeline()
    grid = ml.forest_grid(pipeline, seed=0)
    result = ml.run_search(train, pipeline, grid)
    seen = result.scores.groupBy("draw").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("tx_fraud") == 1).alias("frauds"),
        F.count_distinct("fold").alias("folds"),
    )
    values = spark.createDataFrame(
        [(i, *({p.name: v for p, v in draw.items()}[n] for n in SEARCHED)) for i, draw in enumerate(grid)],
        "draw int, maxDepth int, maxBins int, numTrees int, impurity string",
    )
    means = ml.mean_areas(result.scores)
    best = means.select(F.max(F.struct("mean_auc", -F.col("draw"))).alias("best"))
    best = best.select((-F.col("best.col2")).alias("draw"))
    kept = F.lit(True)
    for name, value in ml.best_parameters(result.model).items():
        kept &= F.col(name) == F.lit(value)
    best_is_kept = values.join(best, "draw").select(kept.alias("kept"))
    return (
        values.join(seen, "draw")
        .join(means, "draw")
        .select(
            "draw",
            *SEARCHED,
            "rows",
            "frauds",
            "folds",
            F.col("mean_auc").between(0, 1).alias("is_area"),
            best_is_kept.scalar().alias("best_is_kept"),
        )
    )


@query(
    "training_job",
    f"""WITH {TX_SQL} SELECT CAST(CAST(min(tx_datetime) AS DATE) AS VARCHAR) AS date_from,
  CAST(CAST(max(tx_datetime) AS DATE) AS VARCHAR) AS date_to, count(*) AS dataset_size,
  count(*) FILTER ({_IN_TRAIN_SQL}) AS train_size,
  count(*) FILTER (NOT {_IN_TRAIN_SQL}) AS test_size,
  true AS values_in_range, true AS metrics_in_range FROM tx""",
)
def training_record(spark, sf):
    """The full search over all days of the table; values and metrics by what must hold of them."""
    features, model = scratch_path(spark, "features"), scratch_path(spark, "model")
    write_days(feature_table(transactions(spark, sf)), features)
    day = F.col(PARTITION_DAY)
    first, last = spark.read.parquet(features).agg(F.min(day), F.max(day)).first()
    record = training_job(spark, features, model, str(first), str(last))
    c = F.col
    in_range = c("maxDepth").between(1, 15) & c("maxBins").between(20, 99)
    in_range &= c("numTrees").between(5, 49) & c("impurity").isin("gini", "entropy")
    metrics = F.forall(F.array("roc_auc", "precision", "recall"), lambda x: x.between(0, 1))
    return plain(record).select(
        "date_from",
        "date_to",
        "dataset_size",
        "train_size",
        "test_size",
        in_range.alias("values_in_range"),
        metrics.alias("metrics_in_range"),
    )
