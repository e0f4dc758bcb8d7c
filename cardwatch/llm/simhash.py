"""SimHash near-duplicates by a byte-position inverted index with count filtering."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.common import (
    DOCUMENT_COLUMNS,
    ROW,
    columns_of,
    read_table,
    stored,
    with_row_key,
)
from cardwatch.llm.components import connected_components
from cardwatch.llm.registry import query

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BYTES = 8
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bit i is set when it is set in more than half of the shingle hashes; no words give 0."""
    words = (text or b"").lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    grams = zip(*(words[i:] for i in range(shingle)))
    hashes = np.fromiter(
        (digest(join(g), SEED) for g in grams), np.uint64, len(words) - shingle + 1
    )
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i : i + _CHUNK].view(np.uint8).reshape(-1, BYTES)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *keep: str, shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint as a signed long; one row per row."""
    data = columns_of(docs, *keep, "text") if "text" not in keep else columns_of(docs, *keep)
    fields = [f for f in data.schema.fields if f.name in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", fp bigint"

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            fps = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
            columns = [batch.column(f.name) for f in fields] + [pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields] + ["fp"])

    return data.mapInArrow(run, schema)


def postings(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp`` under each of its keys in the inverted index.

    Two fingerprints with at most ``max_bits`` differing bits share at least ``8 - max_bits`` of
    their eight positional bytes, the guaranteed number of matches. A posting list is kept for every
    choice of that many positions and the bytes there, so the pairs within a list are just those
    whose tally reaches that number: single-byte lists would hold 1/256 of all texts each, these
    hold next to nothing but true candidates.
    """
    need = BYTES - max_bits
    if need < 1:
        raise ValueError("max_bits must be below 8")
    masks = [
        sum(0xFF << (8 * p) for p in places) for places in combinations(range(BYTES), need)
    ]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("slot"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
            for i, m in enumerate(signed)
        ]
    )
    return fps.select("fp", F.explode(entries).alias("e")).select("e.slot", "e.key", "fp")


def _links_in_lists(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints of one posting list.

    A small list is compared pair by pair. In a large one the neighbours of a fingerprint are looked
    up: outside the shared bytes at most ``8 * max_bits`` bits can differ, and few masks of them
    have at most ``max_bits`` ones, so the work grows with the list and not with its square.
    """
    n = len(fps)
    parent = np.arange(n)

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []

    def link(i, j):
        a, b = find(i), find(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((int(fps[i]), int(fps[j])))

    if n <= 2048:
        diff = fps[:, None] ^ fps[None, :]
        bits = _POPCOUNT[diff.view(np.uint8).reshape(n, n, BYTES)].sum(axis=2, dtype=np.uint8)
        for i, j in zip(*np.nonzero(np.triu(bits <= max_bits, 1))):
            link(i, j)
        return out
    varying = int(np.bitwise_or.reduce(fps ^ fps[0]))
    places = [b for b in range(64) if varying >> b & 1]
    for size in range(1, max_bits + 1):
        for chosen in combinations(places, size):
            other = fps ^ np.uint64(sum(1 << b for b in chosen))
            at = np.searchsorted(fps, other)
            at[at == n] = 0
            for i in np.flatnonzero((fps[at] == other) & (fps < other)):
                link(i, at[i])
    return out


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints that link, enough of them to connect all that do.

    Rows with an equal key meet in one task in sorted order and are read as a stream, one posting
    list at a time. A list holds distinct fingerprints only, at most 2^24 of them at three bits,
    however many texts there are.
    """

    def run(batches):
        held_slot, held_key, held = None, None, []

        def flush():
            if sum(map(len, held)) < 2:
                return [], []
            fps = np.unique(np.concatenate(held).view(np.uint64))
            pairs = []
            for a, b in _links_in_lists(fps, max_bits):
                # The list's key is made of the bytes that two texts must share, so none is short of
                # the count; the bits remain to be verified.
                x = np.array([a ^ b], np.uint64).view(np.uint8)
                if int(_POPCOUNT[x].sum()) <= max_bits:
                    pairs.append((a, b))
            if not pairs:
                return [], []
            both = np.array(pairs, np.uint64).view(np.int64)
            return both[:, 0], both[:, 1]

        for batch in batches:
            slot, key, fp = (batch.column(i).to_numpy() for i in range(3))
            if not len(fp):
                continue
            cuts = np.flatnonzero((slot[1:] != slot[:-1]) | (key[1:] != key[:-1])) + 1
            bounds = [0, *cuts.tolist(), len(fp)]
            a, b = [], []
            for s, e in zip(bounds, bounds[1:]):
                if (slot[s], key[s]) != (held_slot, held_key):
                    x, y = flush()
                    a.extend(x), b.extend(y)
                    held_slot, held_key, held = slot[s], key[s], []
                held.append(fp[s:e].copy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
            )
        x, y = flush()
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"]
        )

    lists = postings(fps, max_bits).repartition("slot", "key").sortWithinPartitions("slot", "key")
    return lists.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """``key``, ``row_key``, ``fp`` and ``component_id`` for each row of ``docs``.

    ``component_id`` is the smallest key that is reached by links, the own one included. Equal
    fingerprints always link, also those of texts without words (null, empty, white space only).
    All steps after hashing work on distinct fingerprints, so copies cost no pairs. A null key does
    not count as smallest; where all keys of a component are null, so is its id. Repeated keys are
    rows of their own. An empty table gives an empty result.
    """
    hashed = stored(fingerprints(with_row_key(columns_of(docs, key, "text")), ROW, key, shingle=shingle), "fp")
    least = stored(hashed.groupBy("fp").agg(F.min(key).alias("least")), "fp-distinct")
    nodes = connected_components(links(least.select("fp"), max_bits))
    roots = least.join(nodes, least.fp == nodes.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")
    )
    roots = stored(roots, "fp-roots")
    ids = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(ids, "root").select("fp", "component_id")
    return hashed.join(named, "fp").select(ROW, key, "fp", "component_id")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, of equal ids the first row; of a
    group without ids the first row. Null and empty texts are one group. An empty table stays so."""
    found = near_duplicates(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)).alias("first")
    group = F.coalesce(F.col("component_id"), F.col("fp"))
    best = found.groupBy(group.alias("g"), F.col("component_id").isNull().alias("u")).agg(first)
    keep = stored(best.select(F.col(f"first.{ROW}").alias(ROW)), "kept-rows")
    rows = with_row_key(columns_of(docs, *DOCUMENT_COLUMNS))
    return rows.join(keep, ROW, "left_semi").select(*DOCUMENT_COLUMNS)


@query("op9_simhash_near_dedup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(read_table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
