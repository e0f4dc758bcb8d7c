"""Random-forest training on Spark ML."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from cardwatch.functions.numeric import draw_below, draw_number, hash_draw
from cardwatch.operators.metrics import roc_auc
from cardwatch.schema import LABEL, model_inputs
from cardwatch.session import scratch_path, stored

# Size of the search.
DRAWS = 16
FOLDS = 10

# Fits that run side by side at most; a small one is a row of short jobs that leaves most of a
# cluster idle.
PARALLELISM = 16
# Labelled rows :func:`run_search` compares the draws on, about, unless it is told otherwise. The
# chosen draw is fitted on all rows. :func:`search`, and so the training job, compares on all.
SEARCH_ROWS = 3_000
# Passes over the rows of a fit after which the node each row is in is written to the checkpoint
# folder, if there is one; a fit of fewer passes writes nothing.
_NODE_PASSES = 20
_ROWS_PER_TASK = 25_000
# Rows that a task of a fit holds, at most about; a cluster with idle cores gets fewer a task.
FIT_ROWS = 100_000

# Ranges of the search, upper bounds excluded.
SEARCH_RANGES: dict[str, Callable[[random.Random], Any]] = {
    "maxDepth": lambda r: r.randrange(1, 16),
    "maxBins": lambda r: r.randrange(20, 100),
    "numTrees": lambda r: r.randrange(5, 50),
    "impurity": lambda r: r.choice(["gini", "entropy"]),
}


def forest_pipeline(
    inputs: Sequence[str] | None = None, label: str = LABEL, *, seed: int = 42, **params
) -> Pipeline:
    """Fill and assemble the inputs, then a random forest. ``params`` go to the forest.

    A missing or NaN input counts as 0. The fill is part of the pipeline, so a saved model has it
    too; the columns of the table itself stay as they are.
    """
    columns = list(inputs or model_inputs())
    filled = [f"_filled_{c}" for c in columns]
    values = ", ".join(
        f"coalesce(nanvl(CAST(`{c}` AS double), 0D), 0D) AS `{f}`" for c, f in zip(columns, filled)
    )
    names = ", ".join(f"`{f}`" for f in filled)
    fill = SQLTransformer(statement=f"SELECT *, {values} FROM __THIS__")
    assembler = VectorAssembler(inputCols=filled, outputCol="features")
    drop = SQLTransformer(statement=f"SELECT * EXCEPT ({names}) FROM __THIS__")
    forest = RandomForestClassifier(labelCol=label, featuresCol="features", seed=seed, **params)
    return Pipeline(stages=[fill, assembler, drop, forest])


def assemble(df: DataFrame, inputs: Sequence[str] | None = None) -> DataFrame:
    """Add the ``features`` vector; a missing input is an error, so fill first."""
    columns = list(inputs or model_inputs())
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df)


def random_grid(
    distributions: Mapping[Param, Callable[[random.Random], Any]],
    draws: int = DRAWS,
    seed: int | None = None,
) -> list[dict[Param, Any]]:
    """``draws`` parameter maps with values drawn from one function per parameter.

    Parameters must belong to an estimator instance: Spark ignores a class-level parameter without
    a word. Any seed, 0 included, makes the draws repeatable.
    """
    for param in distributions:
        if not isinstance(param, Param):
            raise TypeError("a search distribution needs a Param of an estimator")
        if param.parent == "undefined":
            raise ValueError(f"{param.name} belongs to a class, not to an estimator instance")
    chance = random.Random(seed)
    return [{p: draw(chance) for p, draw in distributions.items()} for _ in range(draws)]


def forest_grid(pipeline: Pipeline, draws: int = DRAWS, seed: int | None = None, **ranges):
    """The forest's search grid; ``ranges`` replaces or adds distributions by parameter name."""
    forest = pipeline.getStages()[-1]
    chosen = SEARCH_RANGES | ranges
    return random_grid({forest.getParam(n): d for n, d in chosen.items()}, draws, seed)


def with_folds(
    df: DataFrame, folds: int = FOLDS, *, id_column: str = "transaction_id", seed: int = 42
) -> DataFrame:
    """Add ``fold``, fixed by the row's id, so that every run validates on the same rows."""
    return df.withColumn("fold", draw_number(hash_draw(seed, F.lit("fold"), id_column), folds))


def assembled_rows(
    df: DataFrame,
    pipeline: Pipeline,
    *,
    label: str = LABEL,
    folds: int = FOLDS,
    id_column: str = "transaction_id",
    seed: int = 42,
) -> tuple[DataFrame, list]:
    """What every fit of a search reads, written once: ``features``, the label, ``fold`` and the id;
    and the fitted stages before the forest."""
    before = Pipeline(stages=pipeline.getStages()[:-1]).fit(df).stages
    rows = with_folds(df, folds, id_column=id_column, seed=seed)
    for stage in before:
        rows = stage.transform(rows)
    # The classes are named in the column, so that no fit has to look for them.
    classes = {"ml_attr": {"type": "nominal", "name": label, "vals": ["0.0", "1.0"]}}
    marked = F.col(label).cast("double").alias(label, metadata=classes)
    vectors = rows.select("features", marked, "fold", id_column)
    return stored(vectors, "assembled"), before


def dealt(vectors: DataFrame, tasks: int, id_column: str = "transaction_id") -> DataFrame:
    """The rows in so many partitions, sorted by id, so that a fit can be repeated. Rows without an
    id are dealt by their vectors."""
    return vectors.repartition(tasks, id_column, "features").sortWithinPartitions(id_column)


def fit_rows(vectors: DataFrame, id_column: str = "transaction_id") -> DataFrame:
    """All rows, in tasks whose number follows that of the rows.

    A forest keeps its rows in the partitions it is given, several times as large as in their files:
    dealt by the size of compressed files, a task would hold ever more of them.
    """
    n = vectors.count()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    tasks = max(math.ceil(n / FIT_ROWS), min(cores, math.ceil(n / _ROWS_PER_TASK)), 1)
    return dealt(vectors, tasks, id_column)


def fit(
    pipeline: Pipeline, df: DataFrame, *, label: str = LABEL, id_column: str = "transaction_id"
) -> PipelineModel:
    """``pipeline`` fitted on ``df``; only the vectors, the label and the id are dealt to the tasks."""
    before = Pipeline(stages=pipeline.getStages()[:-1]).fit(df).stages
    rows = df
    for stage in before:
        rows = stage.transform(rows)
    forest = pipeline.getStages()[-1]
    fitted = forest.fit(fit_rows(rows.select(id_column, "features", label), id_column))
    return PipelineModel([*before, fitted])


def search_rows(
    vectors: DataFrame,
    rows: int | None = None,
    *,
    id_column: str = "transaction_id",
    seed: int = 42,
) -> DataFrame:
    """About ``rows`` of the vectors, by a hash of the id; all with ``None`` or where there are no
    more. They come in as few partitions as suit the many fits, by their number alone, dealt and
    sorted by id, so that a search can be repeated."""
    n = vectors.count()
    if rows is not None and n > rows:
        draw = hash_draw(seed, F.lit("fit"), id_column)
        vectors, n = vectors.filter(draw_below(draw, rows / n)), rows
    return dealt(vectors, max(1, math.ceil(n / FIT_ROWS)), id_column)


def _with_kept_nodes(forest: RandomForestClassifier) -> RandomForestClassifier:
    """The same forest, grown with the node of each row kept beside it: no pass sends the trees so
    far to the tasks or takes each row down from their roots. The trees come out the same."""
    kept = {forest.cacheNodeIds: True, forest.checkpointInterval: _NODE_PASSES}
    return forest.copy(kept)


def side_by_side(tasks: int, cores: int, parallelism: int = PARALLELISM) -> int:
    """How many fits of so many tasks run at a time: as many as keep the cores busy, and one more.

    Every running fit keeps a copy of its rows on the executors and a forest on the driver, so large
    fits, which fill a cluster by themselves, do not all run at once.
    """
    return min(parallelism, math.ceil(cores / tasks) + 1)


def validation_scores(
    vectors: DataFrame,
    forest: RandomForestClassifier,
    grid: list[dict[Param, Any]],
    *,
    label: str = LABEL,
    folds: int = FOLDS,
    parallelism: int = PARALLELISM,
    id_column: str = "transaction_id",
) -> DataFrame:
    """``draw``, ``fold``, the id, the label and ``score`` of every row by the forest of each draw
    that has not seen the row's fold.

    The fits of all draws and folds are independent of one another and run side by side,
    ``parallelism`` at most, the largest forests first. Each writes the scores of its fold.
    """
    path = scratch_path(vectors.sparkSession, "validation")
    forest = _with_kept_nodes(forest)
    vectors = vectors.persist()
    tasks_of_fit = max(1, vectors.rdd.getNumPartitions())
    scoring = math.ceil(tasks_of_fit / folds)
    cores = vectors.sparkSession.sparkContext.defaultParallelism

    def size(draw: int) -> int:
        values = {p.name: v for p, v in grid[draw].items()}
        return values.get("numTrees", 20) * (1 + values.get("maxDepth", 5))

    def run(task: tuple[int, int]) -> None:
        draw, fold = task
        model = forest.fit(vectors.filter(F.col("fold") != fold), grid[draw])
        held = model.transform(vectors.filter(F.col("fold") == fold).coalesce(scoring))
        scores = held.select(id_column, label, vector_to_array("probability")[1].alias("score"))
        scores.write.parquet(f"{path}/draw={draw}/fold={fold}")

    tasks = [(d, f) for d in sorted(range(len(grid)), key=size, reverse=True) for f in range(folds)]
    try:
        with ThreadPoolExecutor(side_by_side(tasks_of_fit, cores, parallelism)) as pool:
            list(pool.map(inheritable_thread_target(vectors.sparkSession)(run), tasks))
    finally:
        vectors.unpersist()
    return vectors.sparkSession.read.parquet(path)


def mean_areas(scores: DataFrame, label: str = LABEL) -> DataFrame:
    """``draw`` and ``mean_auc``, the exact area averaged over the folds that hold both classes; 0
    without any."""
    areas = roc_auc(scores, "score", label, by=["draw", "fold"])
    mean = F.coalesce(F.avg("roc_auc"), F.lit(0.0))
    return areas.groupBy("draw").agg(mean.alias("mean_auc"))


@dataclass
class SearchResult:
    """The model with its draws' mean areas, and the scores these come from."""

    model: CrossValidatorModel
    scores: DataFrame


def run_search(
    df: DataFrame,
    pipeline: Pipeline,
    grid: list[dict[Param, Any]],
    *,
    label: str = LABEL,
    folds: int = FOLDS,
    parallelism: int = PARALLELISM,
    rows: int | None = SEARCH_ROWS,
    id_column: str = "transaction_id",
    seed: int = 42,
) -> SearchResult:
    """Cross-validated search for the highest exact area under the ROC curve; of equal draws the
    first.

    All rows are filled, assembled and written once. The draws are compared on about ``rows`` of
    them, on all with ``None``; the best draw is then fitted on all.
    """
    vectors, before = assembled_rows(
        df, pipeline, label=label, folds=folds, id_column=id_column, seed=seed
    )
    forest = pipeline.getStages()[-1]
    scores = validation_scores(
        search_rows(vectors, rows, id_column=id_column, seed=seed),
        forest,
        grid,
        label=label,
        folds=folds,
        parallelism=parallelism,
        id_column=id_column,
    )
    # One row per draw.
    areas = {r["draw"]: r["mean_auc"] for r in mean_areas(scores, label).collect()}
    means = [areas.get(draw, 0.0) for draw in range(len(grid))]
    best = max(range(len(grid)), key=lambda draw: means[draw])
    fitted = _with_kept_nodes(forest).fit(fit_rows(vectors, id_column), grid[best])
    return SearchResult(CrossValidatorModel(PipelineModel([*before, fitted]), means), scores)


def search(
    df: DataFrame,
    pipeline: Pipeline,
    grid: list[dict[Param, Any]],
    *,
    rows: int | None = None,
    **options,
) -> CrossValidatorModel:
    """The model of :func:`run_search`, its draws compared on all rows."""
    return run_search(df, pipeline, grid, rows=rows, **options).model


def best_parameters(model: CrossValidatorModel | PipelineModel) -> dict[str, Any]:
    best = model.bestModel if isinstance(model, CrossValidatorModel) else model
    forest = best.stages[-1]
    return {
        "maxDepth": forest.getMaxDepth(),
        "maxBins": forest.getMaxBins(),
        "numTrees": forest.getNumTrees,
        "impurity": forest.getImpurity(),
    }


def score(model: PipelineModel | CrossValidatorModel, df: DataFrame) -> DataFrame:
    """Add ``rawPrediction``, ``probability`` and ``prediction``."""
    return model.transform(df)


def fraud_probability(predictions: DataFrame, name: str = "fraud_probability") -> DataFrame:
    return predictions.withColumn(name, vector_to_array(F.col("probability"))[1])


def save_model(model: PipelineModel | CrossValidatorModel, path: str) -> None:
    """Save the fitted (best) pipeline, replacing what is there."""
    best = model.bestModel if isinstance(model, CrossValidatorModel) else model
    best.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
