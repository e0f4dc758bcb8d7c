"""From raw documents to packed training sequences, in stages that are written and reread."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardwatch.llm.common import read_table, scratch_path
from cardwatch.llm.packing import packing_stage
from cardwatch.llm.quality_rules import quality_stage
from cardwatch.llm.secret_scan import secret_stage
from cardwatch.llm.simhash import simhash_stage
from cardwatch.llm.suffix_dedup import suffix_stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", simhash_stage),
    ("suffix_array_dedup", suffix_stage),
    ("secret_scan", secret_stage),
    ("best_fit_packing", packing_stage),
]

# Fingerprints, suffixes, a network and bin packing have no SQL form; tests use plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``: each is written as Parquet to the shared folder and the next
    one reads it back, so a lost executor repeats no more than its stage.

    The result has a row for each piece of each document that is left, and none for an empty table.
    What a stage does with nulls, ties and repeated rows is said at its function.
    """
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
