"""Hard-negative mining by Fagin's threshold algorithm.

Rows are dealt into blocks. A block keeps one list of its rows per dimension, sorted by component. For
an anchor the lists are read in step, from the end that the sign of the anchor's component favours. A
row met for the first time is scored whole (random access). The components at the depth reached give
a threshold that no row still unmet can exceed; the search ends once it lies strictly below the score
that a row needs, so that ties are met as well. The best rows of all blocks are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import ROW, columns_of, read_table, stored, with_row_key
from cardwatch.llm.registry import query

POSITIVES = 5
NEGATIVES = 5
MARGIN = (80, 100)  # a negative scores at least this share of the positive's score
SCALE = 256
BLOCK = 8192  # rows of a block on average
CHUNK = 1024  # anchors that meet a block in one group on average
_FIRST_DEPTH = 16  # doubled from round to round
_LONG = (-(1 << 63), (1 << 63) - 1)


def whole_numbers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of doubles: as doubles, or as Python integers where doubles are not exact."""
    if not vectors.size or np.abs(vectors).max() < 2**40:
        return np.floor(vectors * float(scale))
    big = [int(x) * scale if abs(x) >= 2**52 else math.floor(x * scale) for x in vectors.ravel().tolist()]
    return np.array(big, object).reshape(vectors.shape)


def exact_type(rows: np.ndarray, anchors: np.ndarray) -> type:
    """The cheapest type in which all inner products and their partial sums are exact."""
    if not rows.size or not anchors.size:
        return np.float64
    most = int(np.abs(rows).max()) * int(np.abs(anchors).max()) * rows.shape[1]
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else object


class SortedLists:
    """A block's rows and, per dimension, their numbers and components in ascending order."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        by_dim = np.ascontiguousarray(rows.T)
        self.order = np.argsort(by_dim, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(by_dim, self.order.astype(np.int64), axis=1)

    def access(self, anchor: np.ndarray):
        """Round by round the rows met for the first time, their scores, and the threshold. Rounds
        end when all rows are met; an anchor of zeros meets all rows at once."""
        m = len(self.rows)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) and not len(down):
            yield np.arange(m), self.rows @ anchor, 0
            return
        seen = np.zeros(m, bool)
        depth, step = 0, _FIRST_DEPTH
        while depth < m:
            to = min(m, depth + step)
            met = np.zeros(m, bool)
            met[self.order[up, m - to : m - depth]] = True
            met[self.order[down, depth:to]] = True
            met &= ~seen
            seen |= met
            new = np.flatnonzero(met)
            threshold = anchor[up] @ self.values[up, m - to] + anchor[down] @ self.values[down, to - 1]
            yield new, self.rows[new] @ anchor, threshold
            depth, step = to, 2 * step


class Best:
    """The first ``k`` rows met with a score from ``low`` to ``high``: by score, then place."""

    def __init__(self, k: int, low=None, high=None):
        self.k, self.low, self.high = k, low, high
        self.found: list[tuple] = []  # (-score, place), ascending

    def offer(self, rows: np.ndarray, scores: np.ndarray) -> None:
        least = self.low if len(self.found) < self.k else -self.found[-1][0]
        keep = np.ones(len(rows), bool)
        if least is not None:
            keep &= scores >= least
        if self.high is not None:
            keep &= scores <= self.high
        rows, scores = rows[keep], scores[keep]
        if len(rows) > 4 * self.k:
            cut = np.sort(scores)[-self.k]
            rows, scores = rows[scores >= cut], scores[scores >= cut]
            # Of equal scores the first places are enough; places ascend.
            rows, scores = _first_of_ties(rows, scores, self.k)
        new = [(-int(s), int(r)) for r, s in zip(rows, scores)]
        self.found = sorted(self.found + new)[: self.k]

    def closed(self, threshold) -> bool:
        """No row below the threshold can come in any more."""
        if len(self.found) == self.k:
            return threshold < -self.found[-1][0]
        return self.low is not None and threshold < self.low


def _first_of_ties(rows, scores, k):
    order = np.argsort(-scores, kind="stable")[:k]
    return rows[order], scores[order]


def best_rows(lists: SortedLists, anchor: np.ndarray, usable: np.ndarray, wanted: list[Best]) -> None:
    """Fill all ``wanted`` from the usable rows of a block; rows stand in order of preference."""
    for new, scores, threshold in lists.access(anchor):
        allowed = usable[new]
        for best in wanted:
            best.offer(new[allowed], scores[allowed])
        if all(best.closed(threshold) for best in wanted):
            return


def participants(df: DataFrame, anchors: Column, key: str, vector: str, label: str) -> DataFrame:
    """Rows that take part: ``row``, ``id``, ``v`` (doubles), ``dim``, ``label`` and ``anchor``."""
    rows = columns_of(df, *dict.fromkeys([key, vector, label])).withColumn("anchor", F.coalesce(anchors, F.lit(False)))
    rows = rows.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("v"), F.col(f"`{label}`").alias("label"), "anchor")
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("label").isNotNull() & F.coalesce(whole, F.lit(False)))
    rows = rows.select("id", F.col("v").cast("array<double>").alias("v"), F.size("v").alias("dim"), "label", "anchor")
    return with_row_key(stored(rows, "vectors")).withColumnRenamed(ROW, "row")


def _dealt(rows: DataFrame, anchors: DataFrame, group: list[str]):
    """Rows and anchors with ``block`` and ``chunk``: each row of a group stands in one block, each
    anchor in one chunk, and each block meets each chunk of its group once."""
    parts = rows.groupBy(*group).agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.count_if("anchor") / CHUNK).cast("int").alias("chunks"),
    )
    # One row per group; written, so that Spark sees how small it is.
    parts = stored(parts.where("chunks > 0"), "vector-groups")
    block = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    chunk = F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int")
    left = rows.join(parts, group).withColumn("block", block)
    left = left.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    right = anchors.join(parts, group).withColumn("chunk", chunk)
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = [*group, "block", "chunk"]
    # Columns of its own: both sides come from the same rows.
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    return left.groupBy(*keys), right.groupBy(*keys)


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(flat) else np.zeros((len(column), 0))


def _block(table):
    """A block's table in order of preference (id, null last, then row) and its whole components."""
    table = table.sort_by([("id", "ascending"), ("row", "ascending")])
    return table, whole_numbers(_matrix(table.column("v")))


def _found(key_type, out: list[tuple]) -> pa.Table:
    fields = [("anchor", pa.int64()), ("place", pa.int32()), ("id", key_type), ("row", pa.int64()), ("score", pa.int64())]
    columns = list(zip(*out)) if out else [[]] * len(fields)
    return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _search(table, anchors, wanted_of, usable_of) -> pa.Table:
    key_type = table.schema.field("id").type
    if not table.num_rows or not anchors.num_rows:
        return _found(key_type, [])
    table, rows = _block(table)
    points = whole_numbers(_matrix(anchors.column("v")))
    exact = exact_type(rows, points)
    lists, points = SortedLists(rows.astype(exact)), points.astype(exact)
    ids, numbers = table.column("id").to_pylist(), table.column("row").to_numpy()
    labels = table.column("label").to_numpy(zero_copy_only=False)
    out = []
    for point, anchor in zip(points, anchors.drop_columns("v").to_pylist()):
        wanted = wanted_of(anchor)
        best_rows(lists, point, usable_of(anchor, numbers, labels), [b for _, b in wanted])
        for place, best in wanted:
            for score, at in best.found:
                score = min(max(-score, _LONG[0]), _LONG[1])
                out.append((anchor["row"], place, ids[at], int(numbers[at]), score))
    return _found(key_type, out)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` per anchor and place over all blocks, with their ``rank``. Each task keeps
    ``k`` rows of a group before the shuffle."""
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    margin: tuple[int, int] = MARGIN,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and
    ``negative_score``.

    A score is the inner product of the vectors' components floor(256 x). The positives of an anchor
    are its first ``positives`` other rows of the same label; for each of them, its negatives are the
    first ``negatives`` rows of other labels that score at least ``margin`` (a share) of the
    positive's score and no more than it. First means a higher score, then a smaller key, null last.

    Rows with a null label, a null vector or a null or non-finite component take no part. Rows only
    meet rows of the same vector length. Every row stands for itself, also where keys are null or
    repeated, so a repeated anchor gives its rows as often. A positive with a negative score has no
    negatives. An empty table, or one without anchors, gives no rows. Scores beyond the range of a
    long are given as its nearest end.
    """
    rows = participants(df, anchors, key, vector, label)
    points = rows.where("anchor").select("row", "v", "dim", "label")
    key_kind = rows.schema["id"].dataType.simpleString()
    schema = f"anchor bigint, place int, id {key_kind}, row bigint, score bigint"
    low, high = margin

    def search_positives(table, anchors):
        return _search(
            table,
            anchors,
            lambda anchor: [(0, Best(positives))],
            lambda anchor, numbers, labels: numbers != anchor["row"],
        )

    def search_negatives(table, anchors):
        return _search(
            table,
            anchors,
            # From the ceiling of the share up to the positive's own score.
            lambda anchor: [
                (p["rank"], Best(negatives, -(-low * p["score"] // high), p["score"])) for p in anchor["positives"]
            ],
            lambda anchor, numbers, labels: labels != anchor["label"],
        )

    left, right = _dealt(rows, points, ["dim", "label"])
    near = _merged(stored(left.cogroup(right).applyInArrow(search_positives, schema), "positives"), positives)
    near = stored(near, "best-positives")
    # At most ``positives`` entries an anchor.
    windows = near.where("score >= 0").groupBy(F.col("anchor").alias("row")).agg(
        F.collect_list(F.struct("rank", "score")).alias("positives")
    )
    left, right = _dealt(rows, points.join(windows, "row"), ["dim"])
    far = _merged(stored(left.cogroup(right).applyInArrow(search_negatives, schema), "negatives"), negatives)
    pairs = far.select("anchor", F.col("place").alias("positive_rank"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = pairs.join(
        near.select("anchor", F.col("rank").alias("positive_rank"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
        ["anchor", "positive_rank"],
    )
    named = rows.where("anchor").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return pairs.join(named, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


ORACLE = """WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
    other_id AS negative_id, positive_score, score AS negative_score
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT * FROM ranked WHERE rank <= 5"""


@query("op12_hard_negatives", ORACLE)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "embeddings")
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = rows.select("vec_id", "embedding", shifted.alias("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)
