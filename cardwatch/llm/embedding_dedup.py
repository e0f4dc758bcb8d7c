"""Embedding near-duplicates: random-hyperplane sign hashing, exact cosine, connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.common import ROW, columns_of, read_table, stored, with_row_key
from cardwatch.llm.components import connected_components
from cardwatch.llm.registry import query

LEAST_COSINE = 0.93
# A pair at cosine 0.93 shares a bit with probability 0.880 and a table with 0.279; it is missed by
# all tables with probability 0.721 ** 24 = 4e-4, a closer pair with less.
TABLES = 24
BITS = 10
BLOCK = 2000  # vectors of a bucket compared in one go; larger buckets are cut into blocks
SEED = 20
_STEP = 256


def planes(dim: int, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim, tables * bits))


def signatures(vectors: np.ndarray, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    """One bucket number per vector and table."""
    signs = (vectors @ planes(vectors.shape[1], tables, bits) >= 0).reshape(-1, tables, bits)
    return (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def vector_classes(rows: DataFrame) -> DataFrame:
    """Rows with equal label and vector as one: ``cls``, ``label``, ``v``, ``n`` and the least id.

    Vectors that are null, empty, all zero or that hold null or non-finite parts are left out.
    """
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col("label").isNotNull() & F.coalesce(whole & F.exists("v", lambda x: x != 0), F.lit(False))
    grouped = rows.where(usable).groupBy("label", "v").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    return with_row_key(stored(grouped, "vectors")).withColumnRenamed(ROW, "cls")


def _matrix(column) -> np.ndarray:
    """Vectors of one length as doubles, each scaled by a power of two so that its largest
    component lies in [0.5, 1): directions stay exact and no square overflows or vanishes."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if not len(column):
        return flat.reshape(0, 0)
    rows = flat.reshape(len(column), -1)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def _entries(classes: DataFrame, tables: int, bits: int, wide: bool) -> DataFrame:
    """A row per class and table. The wide form carries the vector, all its bucket numbers and the
    block pair; ``hot`` tells into how many blocks the bucket of a table is cut."""
    kind = classes.schema["v"].dataType.simpleString()
    label = classes.schema["label"].dataType.simpleString()
    schema = f"label {label}, dim int, tbl int, bucket int, cls bigint"
    if wide:
        schema += f", i int, j int, own int, n bigint, v {kind}, sigs binary"

    def run(batches):
        for batch in batches:
            size = pa.compute.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            for dim in np.unique(size):
                part = batch.filter(pa.array(size == dim))
                sigs = signatures(_matrix(part.column("v")), tables, bits)
                m = part.num_rows
                for t in range(tables):
                    at = np.arange(m)
                    if wide:
                        at, i, j, own = _block_pairs(part, t)
                    rows = part.take(pa.array(at))
                    columns = [
                        rows.column("label"),
                        pa.array(np.full(len(at), dim, np.int32)),
                        pa.array(np.full(len(at), t, np.int32)),
                        pa.array(sigs[at, t]),
                        rows.column("cls"),
                    ]
                    names = ["label", "dim", "tbl", "bucket", "cls"]
                    if wide:
                        columns += [pa.array(i), pa.array(j), pa.array(own), rows.column("n"), rows.column("v")]
                        columns.append(pa.array([s.astype("<i2").tobytes() for s in sigs[at]], pa.binary()))
                        names += ["i", "j", "own", "n", "v", "sigs"]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return classes.mapInArrow(run, schema)


def _block_pairs(part, table: int):
    """Row numbers, the block pairs that each row takes part in, and the row's own block; an uncut
    bucket is the one pair (0, 0)."""
    out = []
    for k, (cls, hot) in enumerate(zip(part.column("cls").to_pylist(), part.column("hot").to_pylist())):
        blocks = next((h["blocks"] for h in hot or () if h["tbl"] == table), 1)
        own = (cls * 0x9E3779B97F4A7C15 >> 17) % blocks
        out += [(k, min(own, other), max(own, other), own) for other in range(blocks)]
    at, i, j, own = np.array(out, np.int64).reshape(-1, 4).T
    return at, i.astype(np.int32), j.astype(np.int32), own.astype(np.int32)


def _compare(table, blocks, same, cls, n, vectors, sigs, threshold):
    """Linked copies per vector and a spanning forest of the links of one bucket (or block pair).

    A pair counts in the first table whose buckets it shares, so no pair counts twice.
    """
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    m = len(cls)
    added = np.zeros(m, np.int64)
    root = np.arange(m)
    for s in range(0, m, _STEP):
        near = unit[s : s + _STEP] @ unit.T >= threshold
        a, b = np.nonzero(near)
        a += s
        keep = b > a
        if not same:
            keep &= blocks[a] != blocks[b]
        a, b = a[keep], b[keep]
        first = (sigs[a] == sigs[b]).argmax(axis=1) == table
        a, b = a[first], b[first]
        added += np.bincount(a, weights=n[b], minlength=m).astype(np.int64)
        added += np.bincount(b, weights=n[a], minlength=m).astype(np.int64)
        _join(root, a, b)
    hit = np.flatnonzero(added)
    return cls[hit], added[hit], cls[root[hit]]


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the members of all components that the links ``a``, ``b`` join the least root of them,
    by sweeps over whole arrays until nothing changes."""
    while True:
        p, q = root[a], root[b]
        apart = p != q
        if not apart.any():
            return
        low, high = np.minimum(p, q)[apart], np.maximum(p, q)[apart]
        np.minimum.at(root, high, low)
        # Every row follows its root to the end of the chain.
        while (root[root] != root).any():
            root[:] = root[root]


def bucket_links(classes: DataFrame, threshold: float, tables: int, bits: int) -> DataFrame:
    """``cls``, ``added`` (linked copies) and ``root`` (a class it is connected to), to be summed.

    Rows of a bucket are read as a stream in sorted order. Buckets over ``BLOCK`` classes are cut
    into blocks by class, and each pair of blocks is a group of its own, so no task holds more than
    two blocks and every pair is still compared.
    """
    narrow = _entries(classes, tables, bits, wide=False)
    keys = ["label", "dim", "tbl", "bucket"]
    large = (
        narrow.groupBy(*keys)
        .count()
        .where(F.col("count") > BLOCK)
        .select(*keys, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    )
    hot = stored(large, "large-buckets")
    cut = (
        narrow.join(hot, keys)
        .groupBy("cls")
        .agg(F.collect_list(F.struct("tbl", "blocks")).alias("hot"))  # at most one per table
    )
    full = classes.join(cut, "cls", "left")
    group = [*keys, "i", "j"]

    def run(batches):
        held_key, held = None, []

        def flush():
            if not held:
                return None
            part = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            if part.num_rows < 2:
                return None
            _, _, tbl, _, i, j = held_key
            cls = part.column("cls").to_numpy()
            n = part.column("n").to_numpy()
            sigs = np.frombuffer(b"".join(part.column("sigs").to_pylist()), "<i2").reshape(len(cls), -1)
            blocks = part.column("own").to_numpy()
            return _compare(tbl, blocks, i == j, cls, n, _matrix(part.column("v")), sigs, threshold)

        def out(found):
            found = found or (np.zeros(0, np.int64),) * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["cls", "added", "root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_pylist() for c in group]
            keys_here = list(zip(*columns))
            s = 0
            results = []
            for e in range(1, len(keys_here) + 1):
                if e == len(keys_here) or keys_here[e] != keys_here[s]:
                    if keys_here[s] != held_key:
                        results.append(flush())
                        held_key, held = keys_here[s], []
                    held.append(batch.slice(s, e - s))
                    s = e
            results = [r for r in results if r]
            yield out(tuple(np.concatenate(c) for c in zip(*results)) if results else None)
        yield out(flush())

    entries = _entries(full, tables, bits, wide=True)
    dealt = entries.repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(run, "cls bigint, added bigint, root bigint")


def near_duplicates(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = LEAST_COSINE,
    tables: int = TABLES,
    bits: int = BITS,
) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` for every row.

    Rows link when their labels are equal and not null and the cosine of their vectors, in double
    precision, is ``threshold`` or more; they are looked for among rows that share a bucket in any
    table. Equal vectors are one class, always linked, and cost no pairs. Unusable vectors (see
    ``vector_classes``) link with nothing and stay. Vectors of different lengths never link. A null
    key does not count as smallest id; where a component has no other, its id is null and its rows
    are kept. An empty table gives an empty result.
    """
    rows = columns_of(df, key, vector, label).toDF("id", "v", "label")
    classes = vector_classes(rows)
    found = stored(bucket_links(classes, threshold, tables, bits), "vector-links")
    counts = found.groupBy("cls").agg(F.sum("added").alias("added"))
    nodes = connected_components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    named = (
        classes.select("cls", "label", "v", "n", "least")
        .join(nodes, F.col("cls") == F.col("node"), "left")
        .join(counts, "cls", "left")
        .select("label", "v", "n", "least", F.coalesce("component", "cls").alias("component"), F.coalesce("added", F.lit(0)).alias("added"))
    )
    named = stored(named, "vector-classes")
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "component").select("label", "v", (F.col("added") + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.join(named, ["label", "v"], "left")
    usable = F.col("n_links").isNotNull()
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(usable, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    ).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


@query("op6_embedding_near_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "embeddings"))
