"""Best-fit packing of token sequences into bins of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.common import ROW, columns_of, read_table, stored, with_row_key
from cardwatch.llm.registry import query

CAPACITIES = (2048, 4096, 8192, 16384)
PIECES_PER_SHARD = 2_000
BIN_COST = 64  # what a bin costs besides its tokens
ATTENTION = 1 << 16  # length at which attention costs as much a token as everything else


def byte_tokens(text: str = "text") -> Column:
    """Tokens of a byte-level vocabulary: the UTF-8 bytes and an end token; null counts as empty."""
    return (F.octet_length(F.coalesce(F.col(f"`{text}`"), F.lit(""))) + 1).cast("long")


def size_cost(size: int, bin_cost: int = BIN_COST, attention: int = ATTENTION) -> float:
    """What training on a bin of a size costs, in tokens: its places, a share that grows with the
    square of its length, and a constant. Small bins are cheap a place, large ones waste less."""
    return size + size * size / attention + bin_cost


def pack(
    lengths: np.ndarray,
    capacities: tuple[int, ...] = CAPACITIES,
    bin_cost: int = BIN_COST,
    attention: int = ATTENTION,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin number and offset of each piece, and the capacity of each bin.

    Pieces come in falling length, ties in the given order. A piece goes into the open bin that it
    leaves with the least room (of equals the oldest). Without such a bin, one is opened of the size
    that costs least per token it will hold, see ``size_cost`` and ``expected_fill``. When all
    pieces are in, each bin is cut down to the smallest permitted size that holds its contents.
    """
    sizes = sorted(capacities)
    n = len(lengths)
    order = np.argsort(-lengths, kind="stable")
    falling = lengths[order]
    rising = (-falling).tolist()
    costs = {size: size_cost(size, bin_cost, attention) for size in sizes}
    bins = np.empty(n, np.int64)
    offsets = np.empty(n, np.int64)
    filled: list[int] = []
    room: list[tuple[int, int]] = []  # (free tokens, bin), sorted
    opened: list[int] = []
    for k in range(n):
        length = int(falling[k])
        at = bisect_left(room, (length, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            b = len(opened)
            free = _least_cost_size(length, rising, k + 1, sizes, costs)
            opened.append(free)
            filled.append(0)
        bins[order[k]] = b
        offsets[order[k]] = filled[b]
        filled[b] += length
        if free > length:
            insort(room, (free - length, b))
    downsized = np.array([sizes[bisect_left(sizes, f)] for f in filled], np.int64)
    return bins, offsets, downsized


def expected_fill(room: int, rising: list[int], start: int) -> int:
    """How much of the room the pieces still to come fill, if the longest that fits goes in each
    time. They are the lengths from ``start`` on, negated, in rising order."""
    left, at = room, start
    while left > 0:
        at = bisect_left(rising, -left, at)
        if at == len(rising):
            break
        left += rising[at]
        at += 1
    return room - left


def _least_cost_size(
    length: int, rising: list[int], start: int, sizes: list[int], costs: dict[int, float]
) -> int:
    """The size whose cost per token that it will hold is least; of equals the smaller one."""
    best, best_cost = sizes[-1], float("inf")
    for size in sizes:
        if size >= length:
            held = length + expected_fill(size - length, rising, start)
            cost = costs[sizes[bisect_left(sizes, held)]] / held
            if cost < best_cost:
                best, best_cost = size, cost
    return best


def pieces(lengths: DataFrame, longest: int) -> DataFrame:
    """Rows of ``row_key``, ``key`` and ``n_tokens`` cut into pieces of at most ``longest`` tokens.

    A piece of just that length fills a bin by itself; nothing is dropped or cut off.
    """
    last = F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / F.lit(longest)) - 1).cast("int")
    return lengths.select("*", F.explode(F.sequence(F.lit(0), last)).alias("piece")).select(
        ROW,
        "key",
        "piece",
        (F.col("piece").cast("long") * longest).alias("piece_start"),
        F.least(F.lit(longest), F.col("n_tokens") - F.col("piece").cast("long") * longest).alias("length"),
    )


def best_fit(
    docs: DataFrame,
    key: str = "doc_id",
    n_tokens: Column | None = None,
    capacities: tuple[int, ...] = CAPACITIES,
    pieces_per_shard: int = PIECES_PER_SHARD,
    bin_cost: int = BIN_COST,
    attention: int = ATTENTION,
) -> DataFrame:
    """One row per piece: ``key``, ``piece``, ``piece_start``, ``length``, ``shard``, ``bin``,
    ``capacity`` and ``bin_offset``.

    ``n_tokens`` is the length of a document, by default its byte-level tokens; null or less than
    one counts as one token. Documents are dealt over shards by their place in the table, so
    neither repeated nor null keys gather, and a shard holds about ``pieces_per_shard`` of them
    whatever the size of the table. Each shard is packed on its own; the loss against one packing of
    everything is under one bin of each size a shard. An empty table gives an empty result.
    """
    tokens = byte_tokens() if n_tokens is None else n_tokens
    # Only the two columns that count are taken, so other columns may have any name.
    rows = with_row_key(docs.select(F.col(f"`{key}`").alias("key"), tokens.alias("n_tokens")))
    rows = rows.withColumn("n_tokens", F.greatest(F.lit(1), F.coalesce("n_tokens", F.lit(1))).cast("long"))
    full = max(capacities)
    cut = stored(pieces(rows, full), "pieces")
    # Whole pieces need no packing and do not count for the shards.
    shards = max(1, -(-cut.where(F.col("length") < full).count() // pieces_per_shard))

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values([ROW, "piece"], kind="stable").reset_index(drop=True)
        bins, offsets, sizes = pack(batch["length"].to_numpy(), capacities, bin_cost, attention)
        batch["bin"], batch["bin_offset"], batch["capacity"] = bins, offsets, sizes[bins]
        return batch[names]

    kind = cut.schema["key"].dataType.simpleString()
    schema = (
        f"key {kind}, piece int, piece_start bigint, length bigint, shard bigint, bin bigint,"
        " capacity bigint, bin_offset bigint"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    # Whole bins need no packing: shard and bin are named by the row (negative) and the piece.
    whole = cut.where(F.col("length") == full).select(
        "key",
        "piece",
        "piece_start",
        "length",
        (F.lit(-1) - F.col(ROW)).alias("shard"),
        F.col("piece").cast("long").alias("bin"),
        F.lit(full).cast("long").alias("capacity"),
        F.lit(0).cast("long").alias("bin_offset"),
    )
    parts = cut.where(F.col("length") < full).withColumn("shard", F.pmod(F.xxhash64(ROW), F.lit(shards)))
    packed = parts.groupBy("shard").applyInPandas(run, schema)
    return packed.unionByName(whole).withColumnRenamed("key", key)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the tokens of each document go: a row per piece. A token is a UTF-8 byte, and each
    document ends in one more; a null or empty text is that one token. Repeated rows and ids, also
    null ones, are documents of their own."""
    return best_fit(columns_of(docs, "doc_id", "text"))


@query("op10_best_fit_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return best_fit(columns_of(read_table(spark, folder, "documents"), "doc_id", "text"))
