"""Connected components of a graph given as pairs, by joins and minima alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import stored


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` has long columns ``a`` and ``b``; returns ``node`` and ``component``.

    ``component`` is the smallest node that can be reached. Nodes without an edge are not listed.
    Null ends, loops and repeated edges are ignored.

    Large-star and small-star steps alternate: a node hands the smallest of its neighbours to its
    larger neighbours, then to its smaller ones. Each step is a minimum per node (added up before
    the shuffle) and a join whose large keys adaptive execution can split. Each round is written to
    the shared folder, so the lineage stays short and a lost executor costs one round. No step
    gathers the neighbours of a node, and the driver sees two sums a round.
    """
    pairs = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(max_rounds):
        pairs = stored(_small_star(_large_star(pairs)), "edges")
        now = tuple(
            pairs.agg(F.count("a"), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("a", "b") % 1000003)).first()
        )
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """All pairs point from a larger to a smaller node."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    joined = pairs.join(least, "a")
    return (
        joined.where("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .distinct()
    )
