"""Token ids in binary files, each shard compressed by a Re-Pair grammar."""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import ROW, columns_of, read_table, scratch_path, with_row_key
from cardwatch.llm.registry import query

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
SHARD_TOKENS = 1 << 18  # a shard is closed by the first document that reaches this
PAIRS_PER_ROUND = 512
FRAME = 1 << 12  # symbols that are compressed together, and unpacked to read a document
LEAST_COUNT = 4  # a rule costs three numbers, so rarer pairs stay
BUCKETS = 1 << 18
CACHED_CHUNKS = 900_000
JOINED_CHUNKS = 500
TEXTS_AT_ONCE = 64
MAGIC = b"RPG2"
BLANK = "Ġ"  # how a vocabulary of bytes writes a blank
_SPACES = re.compile(r" \s")
_ENCODERS: dict[str, "Encoder"] = {}
FILES_SCHEMA = "shard_key bigint, n_documents int, n_tokens bigint, payload binary"


class Encoder:
    """Ids of whole texts, by the tokenizers library.

    The vocabulary never joins a character and a blank after it, so a text is cut before each blank
    and every distinct chunk is encoded once and remembered; chunks that are new are encoded many at
    a time, joined to one text, and told apart by the tokens that begin with a blank, as the first of
    a chunk does and no other. Texts in which white space follows a blank, or that end in one, where
    a cut could fall inside a run of white space, are encoded in one piece.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        words = self._tokenizer.get_vocab()
        self._opens = np.zeros(max(words.values()) + 1, bool)
        self._opens[[i for word, i in words.items() if word.startswith(BLANK)]] = True
        self._ids: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    @classmethod
    def shared(cls, path: str) -> Encoder:
        """One encoder per worker process, so that later tasks know the chunks of earlier ones."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _remember(self, chunks: list[str]) -> None:
        for i in range(0, len(chunks), JOINED_CHUNKS):
            part = chunks[i : i + JOINED_CHUNKS]
            text = " " + " ".join(part)
            found = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
            ids = np.array(found.ids, np.uint32)
            starts = np.flatnonzero(self._opens[ids])
            ends = np.append(starts[1:], len(ids))
            if len(starts) != len(part):  # a vocabulary that writes blanks in another way
                whole = self._tokenizer.encode(text, add_special_tokens=False)
                starts = np.array(whole.offsets, np.int64).reshape(-1, 2)[:, 0]
                ends = np.searchsorted(starts, np.cumsum([len(c) + 1 for c in part]))
            ids, ends, at = ids.tobytes(), (4 * ends).tolist(), 0
            for chunk, end in zip(part, ends):
                self._ids[chunk] = ids[at:end]
                at = end

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        # Chunks are kept without the blank that all but the first of a text begin with.
        cut = [None if t.endswith(" ") or _SPACES.search(t) else t.split(" ") for t in texts]
        firsts = [parts.pop(0) if parts else "" for parts in cut]
        rest = [parts or [] for parts in cut]
        found = [list(map(self._ids.get, chunks)) for chunks in rest]
        missing = [[i for i, ids in enumerate(got) if ids is None] for got in found]
        new = {chunks[i] for chunks, places in zip(rest, missing) for i in places}
        if len(self._ids) + len(new) > CACHED_CHUNKS // 2:
            # What has not been used for half of the cache is forgotten.
            self._ids, self._older = {}, self._ids
        for chunk in new & self._older.keys():
            self._ids[chunk] = self._older[chunk]
        self._remember([c for c in new if c not in self._ids])
        out = []
        for text, parts, first, chunks, got, places in zip(texts, cut, firsts, rest, found, missing):
            if parts is None:
                ids = self._whole(text)
            else:
                for i in places:
                    got[i] = self._ids[chunks[i]]
                ids = (self._whole(first) if first else b"") + b"".join(got)
            out.append(np.frombuffer(ids, np.uint32))
        return out


def compress(ids: np.ndarray, ends: np.ndarray, first_symbol: int):
    """Re-Pair in rounds: (sequence, last-of-document flags, rules left, rules right).

    A round counts all pairs, gives the ``PAIRS_PER_ROUND`` most frequent ones a nonterminal each and
    replaces them from left to right; of two pairs that overlap the left one is replaced. No pair
    reaches over the end of a document, so each document is a run of symbols of its own. Rounds end
    when no pair is found ``LEAST_COUNT`` times.
    """
    seq, last = ids.astype(np.int64), ends.copy()
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    symbols = first_symbol
    while len(seq) > 1:
        a, b = seq[:-1], seq[1:]
        slot = (a * 40503 + b * 60493) & (BUCKETS - 1)
        slot[np.flatnonzero(last[:-1])] = BUCKETS  # pairs over an end have a slot of their own
        counts = np.bincount(slot, minlength=BUCKETS + 1)
        counts[BUCKETS] = 0
        maybe = np.flatnonzero((counts >= _top(counts[counts >= LEAST_COUNT]))[slot])
        if not len(maybe):
            break
        pairs, which, exact = np.unique(
            a[maybe] << 32 | b[maybe], return_inverse=True, return_counts=True
        )
        chosen = exact >= _top(exact[exact >= LEAST_COUNT])
        if not chosen.any():
            break
        number = np.cumsum(chosen) - 1 + symbols
        take = chosen[which]
        places, names = maybe[take], number[which[take]]
        # In a run of neighbouring places every second one is replaced.
        starts = np.concatenate([[True], places[1:] != places[:-1] + 1])
        run = np.maximum.accumulate(np.where(starts, np.arange(len(places)), 0))
        free = (np.arange(len(places)) - run) % 2 == 0
        places, names = places[free], names[free]
        seq[places] = names
        last[places] = last[places + 1]
        keep = np.ones(len(seq), bool)
        keep[places + 1] = False
        seq, last = seq[keep], last[keep]
        left.append(pairs[chosen] >> 32)
        right.append(pairs[chosen] & 0xFFFFFFFF)
        symbols += int(chosen.sum())
    none = np.zeros(0, np.int64)
    return seq, last, np.concatenate([none, *left]), np.concatenate([none, *right])


def _top(counts: np.ndarray) -> int:
    """The least count that is among the ``PAIRS_PER_ROUND`` largest."""
    if len(counts) <= PAIRS_PER_ROUND:
        return LEAST_COUNT
    return int(np.partition(counts, -PAIRS_PER_ROUND)[-PAIRS_PER_ROUND])


def expansion_lengths(left: np.ndarray, right: np.ndarray, first_symbol: int) -> np.ndarray:
    """Ids that each rule stands for; a rule refers to earlier ones only."""
    lengths = np.zeros(len(left), np.int64)
    todo = np.arange(len(left))
    while len(todo):
        l, r = left[todo] - first_symbol, right[todo] - first_symbol
        n = np.where(l < 0, 1, lengths[np.maximum(l, 0)])
        m = np.where(r < 0, 1, lengths[np.maximum(r, 0)])
        done = (n > 0) & (m > 0)
        lengths[todo[done]] = (n + m)[done]
        todo = todo[~done]
    return lengths


def pack_shard(documents: list[tuple[int | None, np.ndarray]], first_symbol: int) -> bytes:
    """The file format of a shard, little-endian:

    magic, first nonterminal, counts of documents, rules and symbols (unsigned 32 bits each); the
    ids of the documents (64 bits, and a byte each that is 1 where the id is null); for each
    document the number of symbols and of tokens (32 bits); the ends of all zstandard frames that
    follow, in bytes (32 bits). The first frame has for each rule its left symbol, right symbol and
    expansion length (32 bits); each further frame has ``FRAME`` symbols (32 bits).
    """
    ids = np.concatenate([d for _, d in documents])
    ends = np.zeros(len(ids), bool)
    tokens = np.array([len(d) for _, d in documents], np.int64)
    ends[np.cumsum(tokens) - 1] = True
    seq, last, left, right = compress(ids, ends, first_symbol)
    symbols = np.diff(np.concatenate([[-1], np.flatnonzero(last)]))
    lengths = expansion_lengths(left, right, first_symbol)
    keys = np.array([0 if k is None else k for k, _ in documents], "<i8")
    null = np.array([k is None for k, _ in documents], np.uint8)
    rules = np.stack([left, right, lengths]).astype("<u4")
    packer, flat = zstandard.ZstdCompressor(level=1), seq.astype("<u4")
    frames = [packer.compress(rules.tobytes())]
    frames += [packer.compress(flat[i : i + FRAME].tobytes()) for i in range(0, len(flat), FRAME)]
    frame_ends = np.cumsum([len(f) for f in frames]).astype("<u4")
    head = struct.pack("<4s4I", MAGIC, first_symbol, len(documents), len(left), len(seq))
    counts = [symbols.astype("<u4").tobytes(), tokens.astype("<u4").tobytes()]
    return b"".join([head, keys.tobytes(), null.tobytes(), *counts, frame_ends.tobytes(), *frames])


class Shard:
    """Reads one shard; ``document(i)`` decodes a single document without the others."""

    def __init__(self, payload: bytes):
        magic, self.first_symbol, docs, rules, symbols = struct.unpack_from("<4s4I", payload)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = 20
        keys = np.frombuffer(payload, "<i8", docs, at)
        null = np.frombuffer(payload, np.uint8, docs, at + 8 * docs)
        self.keys = [None if n else int(k) for k, n in zip(keys, null)]
        counts = np.frombuffer(payload, "<u4", 2 * docs, at + 9 * docs).astype(np.int64)
        self.tokens = counts[docs:]
        self._starts = np.concatenate([[0], np.cumsum(counts[:docs])])
        n_frames = 1 + -(-symbols // FRAME)
        ends = np.frombuffer(payload, "<u4", n_frames, at + 17 * docs).astype(np.int64)
        self._bounds = at + 17 * docs + 4 * n_frames + np.concatenate([[0], ends])
        self._payload, self._unpacker = payload, zstandard.ZstdDecompressor()
        self._rules = self._frame(0).reshape(3, rules)

    def _frame(self, k: int) -> np.ndarray:
        data = self._payload[self._bounds[k] : self._bounds[k + 1]]
        return np.frombuffer(self._unpacker.decompress(data), "<u4").astype(np.int64)

    def _symbols(self, start: int, end: int) -> np.ndarray:
        """Symbols ``start`` to ``end``, from the frames that hold them alone."""
        first = start // FRAME
        frames = [self._frame(1 + k) for k in range(first, -(-end // FRAME))]
        if not frames:
            return np.zeros(0, np.int64)
        return np.concatenate(frames)[start - first * FRAME : end - first * FRAME]

    def document(self, i: int) -> np.ndarray:
        """Ids of document ``i``: every symbol knows from its expansion length where it lands."""
        return self._expand(self._symbols(self._starts[i], self._starts[i + 1]))

    def all_tokens(self) -> np.ndarray:
        return self._expand(self._symbols(0, self._starts[-1]))

    def _expand(self, seq: np.ndarray) -> np.ndarray:
        left, right, lengths = self._rules
        size = np.where(seq < self.first_symbol, 1, lengths[np.maximum(seq - self.first_symbol, 0)]) if len(lengths) else np.ones(len(seq), np.int64)
        out = np.zeros(int(size.sum()), np.uint32)
        at = np.cumsum(size) - size
        while len(seq):
            plain = seq < self.first_symbol
            out[at[plain]] = seq[plain]
            seq, at = seq[~plain] - self.first_symbol, at[~plain]
            l, r = left[seq], right[seq]
            half = np.where(l < self.first_symbol, 1, lengths[np.maximum(l - self.first_symbol, 0)]) if len(seq) else l
            seq, at = np.concatenate([l, r]), np.concatenate([at, at + half])
        return out


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    key: str = "doc_id",
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
    first_symbol: int = 1 << 20,
) -> None:
    """Encodes every whole text, appends ``end_id`` and writes shards in ascending order of ``key``.

    Null texts are taken as empty, null keys come first, rows of equal key follow the order of the
    table. The table is dealt by ranges of key and place, so no key is too large for a task; a task
    reads its rows in order and holds one shard at a time. Shards are rows of a Parquet table whose
    ``shard_key`` tells their order, so Spark's committer takes care of lost tasks.
    """
    rows = with_row_key(columns_of(docs, key, "text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, F.col(f"`{key}`").asc_nulls_first(), ROW)
    rows = rows.sortWithinPartitions(F.col(f"`{key}`").asc_nulls_first(), ROW)
    rows = rows.select(F.spark_partition_id().alias("part"), key, "text")

    def run(batches):
        encoder = Encoder.shared(tokenizer_path)
        held, size, made, part = [], 0, 0, 0

        def shard():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part << 32 | made], pa.int64()),
                    pa.array([len(held)], pa.int32()),
                    pa.array([size], pa.int64()),
                    pa.array([pack_shard(held, first_symbol)], pa.binary()),
                ],
                ["shard_key", "n_documents", "n_tokens", "payload"],
            )

        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS_AT_ONCE):
                few = batch.slice(i, TEXTS_AT_ONCE)
                part = few.column(0)[0].as_py()
                texts = [t or "" for t in few.column(2).to_pylist()]
                for k, ids in zip(few.column(1).to_pylist(), encoder.encode_all(texts)):
                    held.append((k, np.append(ids, np.uint32(end_id))))
                    size += len(ids) + 1
                    if size >= shard_tokens:
                        yield shard()
                        held, size, made = [], 0, made + 1
        if held:
            yield shard()

    rows.mapInArrow(run, FILES_SCHEMA).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document in the files.

    ``start`` is the number of ids of all documents before it: the tokens of earlier shards, summed
    over one small row per shard, and those before it in its shard.
    """
    files = spark.read.schema(FILES_SCHEMA).parquet(path)
    # Sums per partition first: the window over a shard's own partition is as small as the partition.
    sizes = files.select("shard_key", "n_tokens").withColumn("part", F.shiftright("shard_key", 32))
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.withColumn("base", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
    inner = Window.partitionBy("part").orderBy("shard_key")
    starts = (
        sizes.withColumn("own", F.sum("n_tokens").over(inner) - F.col("n_tokens"))
        .join(before.select("part", "base"), "part")
        .select("shard_key", (F.col("base") + F.col("own")).alias("shard_start"))
    )

    def run(batches):
        for batch in batches:
            keys, starts, tokens, sums = [], [], [], []
            shards = zip(batch.column("shard_start").to_pylist(), batch.column("payload"))
            for shard_start, payload in shards:
                shard = Shard(payload.as_py())
                ids = shard.all_tokens().astype("<u4")
                ends = np.cumsum(shard.tokens)
                keys += shard.keys
                tokens += shard.tokens.tolist()
                starts += (shard_start + ends - shard.tokens).tolist()
                sums += [zlib.crc32(ids[e - n : e]) for e, n in zip(ends, shard.tokens)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int64()) for v in (keys, starts, tokens, sums)],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    joined = files.select("shard_key", "payload").join(starts, "shard_key").select("shard_start", "payload")
    return joined.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


@query("op3_token_files")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    write_token_files(read_table(spark, folder, "documents"), path, public_tokenizers.path(VOCABULARY))
    return read_token_files(spark, path)
