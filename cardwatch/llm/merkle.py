"""Merkle dataset manifest: hash trees kept as logs of nodes in the order of their completion.

A tree of ``n`` leaves has the nodes ``(k, b)``: level ``k``, number ``b``, over the leaves from
``b << k`` on. Every two consecutive nodes of a level have one parent; a last one alone has a parent
of its own. In completion order (postorder) the place of a node follows from the sizes of the
subtrees before it, so the log needs no index: see ``subtree_size`` and ``place``.

A tree is built in tiers. A builder takes an aligned run of ``1 << HEIGHT`` leaves, appends its nodes
to a segment and hands its last node on as a leaf of the next tier.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import ROW, columns_of, read_table, stored, with_row_key
from cardwatch.llm.registry import query

HEIGHT = 10  # levels of a builder: runs of 1 024 leaves
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_DIGEST = 32
_PLACE_BITS = 33  # of monotonically_increasing_id: the place of a row in its partition


def digest_of(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def subtree_size(level: int, leaves: int) -> int:
    """Nodes of a subtree of ``level`` levels above ``leaves`` leaves, of which there are at least
    one and at most ``1 << level``."""
    return level + 1 + 2 * (leaves - 1) - (leaves - 1).bit_count()


def place(level: int, number: int, n: int) -> int:
    """Place of the node in the log of a tree of ``n`` leaves."""
    first = number << level
    before = 2 * first - first.bit_count()
    return before + subtree_size(level, min(1 << level, n - first)) - 1


def run_height(n: int, height: int = HEIGHT) -> int:
    """Levels that a run gets of a tree that still has ``n`` leaves."""
    return min(height, (n - 1).bit_length())


def completion_log(leaves: Sequence[str], height: int) -> list[str]:
    """Digests of all nodes up to level ``height``, each written when its subtree is complete."""
    log: list[str] = []
    waiting: list[str | None] = [None] * (height + 1)

    def add(level: int, digest: str) -> None:
        log.append(digest)
        while level < height:
            if waiting[level] is None:
                waiting[level] = digest
                return
            digest = digest_of(waiting[level], digest)
            waiting[level] = None
            level += 1
            log.append(digest)

    for leaf in leaves:
        add(0, leaf)
    for level in range(height):
        left, waiting[level] = waiting[level], None
        if left is not None:
            add(level + 1, digest_of(left))
    return log


def steps_of(nodes: bytes, leaves: int, height: int) -> list[list[str]]:
    """Per leaf of a segment the steps to its top, level by level: ``L`` or ``R`` and the sibling on
    that side, or ``-`` where the node is alone. Siblings are read at their closed-form places."""
    text = nodes.hex()
    levels = []
    for k in range(height):
        width = (leaves + (1 << k) - 1) >> k
        at = [2 * _DIGEST * place(k, b, leaves) for b in range(width)]
        digests = [text[i : i + 2 * _DIGEST] for i in at]
        steps = []
        for b in range(width):
            if b % 2:
                steps.append("L" + digests[b - 1])
            else:
                steps.append("R" + digests[b + 1] if b + 1 < width else "-")
        levels.append(steps)
    return [[steps[j >> k] for k, steps in enumerate(levels)] for j in range(leaves)]


def field_text(column: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value as text."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field_text(c) for c in fields]), 256))


def numbered(leaves: DataFrame) -> DataFrame:
    """Add ``i``, the place of a leaf in its ``tree``, and ``n``, the leaves of the tree.

    Leaves, a written table, are range-sorted by tree, key (null first) and digest, equal rows by a key
    of their own, and written once with their place in the sorted partition. One row per partition and tree gives the leaves before it, so no tree has
    to fit one task.
    """
    ordered = with_row_key(leaves).orderBy("tree", "key", "digest", "other", ROW).drop(ROW)
    placed = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "merkle-sorted")
    placed = placed.withColumn("part", F.shiftright("at", _PLACE_BITS)).withColumn(
        "row", F.col("at").bitwiseAND((1 << _PLACE_BITS) - 1)
    )
    runs = placed.groupBy("part", "tree").agg(F.count("*").alias("rows"), F.min("row").alias("first"))
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "part",
        "tree",
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("n"),
    )
    joined = placed.join(stored(runs, "merkle-runs"), ["part", "tree"])
    return joined.select("tree", (F.col("row") + F.col("shift")).alias("i"), "n", "digest", "key", "other")


def segments(nodes: DataFrame, height: int) -> DataFrame:
    """One row per aligned run: its log ``nodes``, and ``keys`` and ``others`` of its leaves."""
    key = nodes.schema["key"].dataType.simpleString()

    def build(group, table):
        table = table.sort_by("i")
        n = table.column("n")[0].as_py()
        log = completion_log([d.hex() for d in table.column("digest").to_pylist()], run_height(n, height))
        columns = {
            "tree": [group[0].as_py()],
            "chunk": [group[1].as_py()],
            "n": [n],
            "nodes": [bytes.fromhex("".join(log))],
            "keys": [table.column("key").to_pylist()],
            "others": [table.column("other").to_pylist()],
        }
        fields = [("tree", pa.string()), ("chunk", pa.int64()), ("n", pa.int64()), ("nodes", pa.binary())]
        fields += [("keys", pa.list_(table.schema.field("key").type)), ("others", pa.list_(pa.binary()))]
        return pa.table(columns, pa.schema(fields))

    schema = f"tree string, chunk bigint, n bigint, nodes binary, keys array<{key}>, others array<binary>"
    return nodes.withColumn("chunk", F.shiftright("i", height)).groupBy("tree", "chunk").applyInArrow(build, schema)


def tops(tier: DataFrame, height: int) -> DataFrame:
    """The last nodes of a tier's segments as leaves of the next tier."""
    return tier.select(
        "tree",
        F.col("chunk").alias("i"),
        F.shiftright(F.col("n") + ((1 << height) - 1), height).alias("n"),
        F.expr(f"substring(nodes, -{_DIGEST})").alias("digest"),
        F.lit(None).cast("int").alias("key"),
        F.lit(None).cast("binary").alias("other"),
    )


def tree_tiers(leaves: DataFrame, height: int) -> list[DataFrame]:
    """Segments of all trees, from the leaves upwards; the last tier has one segment a tree."""
    tiers = [stored(segments(numbered(leaves), height), "merkle-tier")]
    while True:
        above = tops(tiers[-1], height)
        if (above.agg(F.max("n")).first()[0] or 1) == 1:
            return tiers
        tiers.append(stored(segments(above, height), "merkle-tier"))


@dataclass
class Manifest:
    """Logs of the groups' trees and of the tree over their roots, as written tables."""

    tiers: list[DataFrame]
    root_tiers: list[DataFrame]
    height: int = HEIGHT

    def roots(self) -> DataFrame:
        """``root`` of the whole; no row for an empty table."""
        return tops(self.root_tiers[-1], self.height).select(F.lower(F.hex("digest")).alias("root"))

    def subroots(self) -> DataFrame:
        """``tree`` (the group's name after ``=``, or ``-`` for null) and its ``subroot``."""
        return tops(self.tiers[-1], self.height).select("tree", F.lower(F.hex("digest")).alias("subroot"))


def build_manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "lang",
    columns: Sequence[str] = COLUMNS,
    claimed: dict[str, Column] | None = None,
    height: int = HEIGHT,
) -> Manifest:
    """Hash every row, build a tree per ``group`` and a tree over their roots.

    Leaves of a group ascend by ``key``, null first; rows with equal keys ascend by digest, so
    repeated rows are leaves of their own and the result does not depend on their order. Groups
    ascend by UTF-8 bytes, null first. A null counts as ``-`` in a leaf, an empty text as ``0:``.
    ``claimed`` gives columns of rows as someone else presents them: a leaf of these is kept beside
    the true one, to be verified. An empty table gives a manifest without rows.
    """
    data = columns_of(docs, *dict.fromkeys([key, group, *columns]))
    true = [F.col(f"`{c}`") for c in columns]
    said = [(claimed or {}).get(c, F.col(f"`{c}`")) for c in columns]
    changed = F.lit(False)
    for c in claimed or {}:
        changed |= ~claimed[c].eqNullSafe(F.col(f"`{c}`"))
    name = F.col(f"`{group}`").cast("string")
    leaves = data.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("-")).alias("tree"),
        F.col(f"`{key}`").alias("key"),
        leaf_digest(true).alias("digest"),
        F.when(changed, leaf_digest(said)).alias("other"),
    )
    # Written before the sort, which reads its input twice: texts are hashed once.
    tiers = tree_tiers(stored(leaves, "merkle-leaves"), height)
    groups = tops(tiers[-1], height).select(
        F.lit("").alias("tree"), F.col("tree").alias("key"), "digest", "other"
    )
    return Manifest(tiers, tree_tiers(stored(groups, "merkle-subroots"), height), height)


def _leaf_steps(tiers: list[DataFrame], start: DataFrame, height: int) -> DataFrame:
    """``key``, ``digest``, ``other``, ``steps``, ``subroot`` and ``root`` of all leaves. ``start``
    has a row per tree: the steps from the tree's top on, and the digests above it."""
    above = start.withColumn("chunk", F.lit(0).cast("long"))
    for t in range(len(tiers) - 1, -1, -1):
        key = tiers[t].schema["keys"].dataType.elementType.simpleString()
        above = tiers[t].join(above, ["tree", "chunk"])
        above = above.mapInArrow(
            partial(_steps_down, height),
            f"tree string, chunk bigint, key {key}, digest string, other binary,"
            " steps array<string>, subroot string, root string",
        )
        if t:
            above = above.select("tree", "chunk", "steps", "subroot", "root")
    return above


def _steps_down(height, batches):
    names = ["tree", "chunk", "key", "digest", "other", "steps", "subroot", "root"]
    for batch in batches:
        for row in range(batch.num_rows):
            tree, chunk, n, nodes, above, subroot, root = (
                batch.column(c)[row].as_py() for c in ("tree", "chunk", "n", "nodes", "steps", "subroot", "root")
            )
            keys, others = batch.column("keys")[row].values, batch.column("others")[row].values
            m = len(keys)
            steps = [own + above for own in steps_of(nodes, m, run_height(n, height))]
            text = nodes.hex()
            at = [2 * _DIGEST * place(0, j, m) for j in range(m)]
            columns = [
                pa.array([tree] * m, pa.string()),
                pa.array([(chunk << height) + j for j in range(m)], pa.int64()),
                keys,
                pa.array([text[i : i + 2 * _DIGEST] for i in at], pa.string()),
                others,
                pa.array(steps, pa.list_(pa.string())),
                pa.array([subroot] * m, pa.string()),
                pa.array([root] * m, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)


def proofs(manifest: Manifest) -> DataFrame:
    """Per row of the manifest: ``key``, ``leaf``, ``claimed`` (the leaf as presented, null where it
    is the true one), ``steps`` (see ``steps_of``) by way of its ``subroot`` to the ``root``."""
    whole = manifest.roots().select(
        F.lit("").alias("tree"),
        F.lit(None).cast("string").alias("subroot"),
        "root",
        F.array().cast("array<string>").alias("steps"),
    )
    groups = _leaf_steps(manifest.root_tiers, whole, manifest.height).select(
        F.col("key").alias("tree"), "steps", F.col("digest").alias("subroot"), "root"
    )
    found = _leaf_steps(manifest.tiers, stored(groups, "merkle-groups"), manifest.height)
    claimed = F.lower(F.hex("other")).alias("claimed")
    return found.select("key", F.col("digest").alias("leaf"), claimed, "steps", "subroot", "root")


def siblings(steps: Column | str = "steps") -> Column:
    """The digests of a proof in one text."""
    return F.array_join(F.transform(steps, lambda s: F.substring(s, 2, 2 * _DIGEST)), "")


def fold(leaf: Column, steps: Column | str = "steps") -> Column:
    """The root that follows from a leaf and the siblings of a proof."""

    def up(digest: Column, step: Column) -> Column:
        sibling = F.substring(step, 2, 2 * _DIGEST)
        pair = F.when(step.startswith("L"), F.concat(sibling, digest)).otherwise(F.concat(digest, sibling))
        return F.sha2(pair, 256)

    return F.aggregate(steps, leaf, up)


_SQL_FIELDS = {c: f"CAST({c} AS VARCHAR)" for c in COLUMNS}


def _sql_leaf(fields: dict[str, str]) -> str:
    parts = [f"coalesce(CAST(strlen({f}) AS VARCHAR) || ':' || {f}, '-')" for f in fields.values()]
    return f"sha256({' || '.join(parts)})"


_SQL_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(
    string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

_SQL_PARENTS = """list_transform(range((len(nodes) + 1) // 2),
    lambda x: sha256(nodes[2 * x + 1] || coalesce(nodes[2 * x + 2], '')))"""

_SQL_STEP = """CASE WHEN (i >> k) & 1 = 1 THEN 'L' || nodes[i >> k]
    WHEN nodes[(i >> k) + 2] IS NULL THEN '-' ELSE 'R' || nodes[(i >> k) + 2] END"""

ORACLE = f"""WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_sql_leaf(_SQL_FIELDS)} AS leaf,
    CASE WHEN {_SQL_CRC} % 7 = 0
      THEN {_sql_leaf(_SQL_FIELDS | {"n_chars": "CAST(n_chars + 1 AS VARCHAR)"})} END AS claimed
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM leaves),
levels AS (
  SELECT lang, 0 AS k, list(leaf ORDER BY i) AS nodes FROM placed GROUP BY lang
  UNION ALL SELECT lang, k + 1, {_SQL_PARENTS} FROM levels WHERE len(nodes) > 1),
subroots AS (SELECT lang, nodes[1] AS subroot,
    row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM levels WHERE len(nodes) = 1),
top AS (
  SELECT 0 AS k, list(subroot ORDER BY i) AS nodes FROM subroots HAVING count(*) > 0
  UNION ALL SELECT k + 1, {_SQL_PARENTS} FROM top WHERE len(nodes) > 1),
root AS (SELECT nodes[1] AS root FROM top WHERE len(nodes) = 1),
low AS (SELECT p.lang, i, list({_SQL_STEP} ORDER BY k) AS steps FROM placed p
  JOIN levels l ON p.lang IS NOT DISTINCT FROM l.lang AND len(nodes) > 1 GROUP BY p.lang, i),
high AS (SELECT lang, list({_SQL_STEP} ORDER BY k) AS steps FROM subroots JOIN top ON len(nodes) > 1
  GROUP BY lang),
found AS (SELECT doc_id, leaf, coalesce(claimed, leaf) AS said, subroot, root,
    list_concat(coalesce(low.steps, []), coalesce(high.steps, [])) AS steps
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang CROSS JOIN root
  LEFT JOIN low ON p.lang IS NOT DISTINCT FROM low.lang AND p.i = low.i
  LEFT JOIN high ON p.lang IS NOT DISTINCT FROM high.lang),
folded AS (SELECT *, list_reduce(list_prepend(said, steps), lambda d, s: sha256(
    CASE WHEN s[1] = 'L' THEN s[2:] || d ELSE d || s[2:] END)) AS folded_root FROM found)
SELECT doc_id, leaf, subroot, root,
  sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified FROM folded"""


@query("op11_merkle_manifest", ORACLE)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """A row without an id is never tampered with, as it has no decimal id to hash."""
    docs = read_table(spark, folder, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.when(hit, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars"))
    found = proofs(build_manifest(docs, claimed={"n_chars": more}))
    folded = found.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(), 256).alias("proof_sha256"),
        fold(F.coalesce("claimed", "leaf")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
