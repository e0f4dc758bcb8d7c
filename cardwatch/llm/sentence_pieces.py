"""SentencePiece encoding and decoding as a relational lattice."""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.common import columns_of, read_table
from cardwatch.llm.registry import query

MODEL = "piece_bpe_32k.model"
SPACE = "▁"  # fixed value: the mark that stands for a blank
BLOCK_BYTES = 16 << 20  # texts whose words are looked up together
_STEP_BYTES = 1 << 19  # texts whose word numbers are packed together
_WORDS_AT_ONCE = 1 << 19  # words whose ids are packed together
_ROWS_AT_ONCE = 128  # texts that are in Python or decoded at a time
BITS = 62  # words of more characters are folded outside of Spark's expressions
UNKNOWN_PENALTY = 10.0
_WORDS = re.compile(f"{SPACE}*[^{SPACE}\n\t]+|{SPACE}+|[\n\t]")
# Letters and other characters apart, for models without a piece that has both.
_RUNS = re.compile(f"{SPACE}*[^\\W\\d_¹²³¼-¾]+|{SPACE}*(?:[^\\w{SPACE}\n\t]|[\\d_¹²³¼-¾])+|{SPACE}+|[\n\t]")


class Pieces:
    """The piece table of a model file: piece, id and score; and the ids of the 256 bytes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [
            i
            for i in range(size)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.rows = [(model.id_to_piece(i), i, float(model.get_score(i))) for i in plain]
        self.longest = max(len(p) for p, _, _ in self.rows)
        self.least_score = min(s for _, _, s in self.rows)
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(SPACE in p.lstrip(SPACE) or len(p) > 1 and set(p) & set("\n\t") for p, _, _ in self.rows):
            raise ValueError("pieces of this model reach over words")
        # Both patterns end a word between two characters for what these two are, so one that leaves
        # all pieces whole cuts no piece anywhere.
        self.pattern = _RUNS if all(len(_RUNS.findall(p)) == 1 for p, _, _ in self.rows) else _WORDS
        ranks = {s: i for i, s in enumerate(sorted({s for _, _, s in self.rows}, reverse=True))}
        self.ranked = [(p, i, s, ranks[s]) for p, i, s in self.rows]
        if len(ranks) >= 1 << 20:
            raise ValueError("more scores than an edge has bits for")


def words_of(text: str | None, pattern: re.Pattern = _WORDS) -> list[str]:
    """Words of a text, no piece reaches from one into the next; null and empty texts have none."""
    return pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []


class _Block(dict):
    """The distinct words of a block of texts, numbered as they come.

    A text is split at blanks; the words of a chunk, which are looked up by chunk, never reach over
    the blank before it. Texts in which that blank is not the only one, or that have the mark
    itself, are chunks of their own.
    """

    def __init__(self, pattern: re.Pattern):
        self._pattern = pattern
        self.words: dict[str, int] = {}
        self._ends, self._numbers = array("i", [0]), array("i")
        self.size = 0

    def add(self, chunk: str) -> None:
        words = self.words
        for word in [SPACE + chunk] if chunk.isalpha() else self._pattern.findall(SPACE + chunk.replace(" ", SPACE)):
            self._numbers.append(words.setdefault(word, len(words)))

    def __missing__(self, chunk: str) -> int:
        self.add(chunk)
        self._ends.append(len(self._numbers))
        self[chunk] = number = len(self)
        return number

    def chunks(self, text: str | None) -> list[str]:
        if not text:
            return []
        self.size += len(text)
        if "  " in text or " " in (text[0], text[-1]) or SPACE in text:
            return [text]
        return text.split(" ")

    def numbers(self, texts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts one after the other, and how many each text has."""
        ends, numbers = np.array(self._ends), np.array(self._numbers)
        chunks = np.fromiter(chain.from_iterable(texts), np.int64)
        counts = ends[chunks + 1] - ends[chunks]
        total = np.append(0, np.cumsum(counts))
        places = np.arange(total[-1]) + np.repeat(ends[chunks] - total[:-1], counts)
        sizes = total[np.append(0, np.cumsum([len(t) for t in texts], dtype=np.int64))]
        return numbers[places], np.diff(sizes)

    def key(self, part: int, block: int) -> int:
        """Of the place of a block and of its words in their order, so that a table whose rows come
        in another order when it is read again is found out."""
        if part >= 1 << 20 or block >= 1 << 11:
            raise ValueError("more blocks than their key has bits for")
        return part << 43 | block << 32 | zlib.crc32("\0".join(self.words).encode())


def _packed(x: str) -> str:
    """An edge as one number, which sorts by rank, start and end."""
    return f"(shiftleft(CAST({x}rank AS bigint), 43) | shiftleft(CAST({x}s AS bigint), 37) | shiftleft(CAST({x}e AS bigint), 31) | {x}id)"


_S, _E, _ID = "CAST(shiftright(x, 37) & 63 AS int)", "CAST(shiftright(x, 31) & 63 AS int)", "CAST(x & 2147483647L AS int)"
UNKNOWN = (1 << 31) - 1  # id of an edge of a character that is no piece


def lattice(words: DataFrame, table: DataFrame, pieces: Pieces, scores: bool = False) -> DataFrame:
    """The columns of ``words`` and ``edges``: the substrings of ``word`` of up to the longest piece
    that are pieces, and every single character. An edge is packed (:func:`_packed`), or with
    ``scores`` a struct of s, e, rank, id and score.

    ``words`` holds distinct words, dealt by ``h``; the join keeps that, so grouping needs no
    shuffle. Words are grouped by two hashes of 64 bits, and one edge of each brings its columns
    along. The piece table is broadcast: its size is that of the model.
    """
    starts = F.expr("explode(sequence(0, char_length(word) - 1))").alias("s")
    ends = F.expr(f"explode(sequence(s + 1, least(s + {pieces.longest}, char_length(word))))").alias("e")
    cut = words.select("*", starts).select("*", ends)
    cut = cut.withColumn("piece", F.expr("substring(word, s + 1, e - s)"))
    found = cut.join(F.broadcast(table), "piece", "left").where("id IS NOT NULL OR e = s + 1")
    found = found.withColumns({"id": F.expr(f"coalesce(id, {UNKNOWN})"), "rank": F.expr("coalesce(rank, 0)")})
    score = F.coalesce("score", F.lit(pieces.least_score - UNKNOWN_PENALTY))
    edge = F.struct("s", "e", "rank", "id", score.alias("score")) if scores else F.expr(_packed(""))
    carried = [c for c in words.columns if c not in ("h", "g")]
    first = [F.expr(f"IF(s = 0 AND e = 1, `{c}`, NULL)").alias(c) for c in carried]
    grouped = found.select("h", "g", edge.alias("edge"), *first).groupBy("h", "g")
    return grouped.agg(F.collect_list("edge").alias("edges"), *[F.first(c, ignorenulls=True).alias(c) for c in carried])


def viterbi_fold() -> Column:
    """Boundaries, as bits, of the path with the largest sum of scores.

    Edges come by end; the state holds the best score and start for each place so far. Of equal
    sums the path found first stays, which is that of the longer last piece.
    """
    best = (
        "aggregate(array_sort(transform(edges, x -> struct(x.e AS e, x.s AS s, x.score AS score))),"
        " array(struct(0D AS score, 0 AS start)), (a, x) -> CASE"
        " WHEN size(a) = x.e THEN concat(a, array(struct(a[x.s].score + x.score AS score, x.s AS start)))"
        " WHEN a[x.s].score + x.score > a[x.e].score"
        " THEN concat(slice(a, 1, x.e), array(struct(a[x.s].score + x.score AS score, x.s AS start)))"
        " ELSE a END)"
    )
    back = (
        "aggregate(sequence(size(best) - 1, 1, -1), struct(size(best) - 1 AS at, shiftleft(1L, size(best) - 1) AS bits),"
        " (a, i) -> IF(i = a.at, struct(best[i].start AS at, a.bits | shiftleft(1L, best[i].start) AS bits), a),"
        " a -> a.bits)"
    )
    return F.expr(f"element_at(transform(array({best}), best -> {back}), 1)")


def merge_fold() -> Column:
    """Boundaries, as bits, after all merges of a model whose scores are merge ranks.

    Every character starts as a piece of its own. Edges come by falling score, equal ones from the
    left; an edge is taken when both its ends are boundaries and just one lies between them, that
    is, when it joins two neighbours. The second sweep takes what only a later merge made possible.
    """
    step = "(a, x) -> IF((a & x.ends) = x.ends AND bit_count(a & x.inner) = 1, a & ~x.inner, a)"
    ends = f"(shiftleft(1L, {_S}) | shiftleft(1L, {_E}))"
    ordered = (
        f"transform(sort_array(filter(edges, x -> {_E} > {_S} + 1)),"
        f" x -> struct({ends} AS ends, (shiftleft(1L, {_E}) - shiftleft(2L, {_S})) AS inner))"
    )
    return F.expr(
        "element_at(transform(array("
        + ordered
        + f"), m -> aggregate(concat(m, m), shiftleft(2L, char_length(word)) - 1L, {step})), 1)"
    )


def _taken(byte_ids: list[int]) -> Column:
    """Ids of the edges that span neighbouring boundaries, from left to right; those of the bytes of
    a character that is no piece."""
    known = ", ".join(map(str, byte_ids))
    bytes_ = (
        f"transform(sequence(1, octet_length(substring(word, {_S} + 1, 1))), i -> element_at(array("
        + known
        + f"), 1 + CAST(conv(substring(hex(encode(substring(word, {_S} + 1, 1), 'UTF-8')), 2 * i - 1, 2), 16, 10) AS int)))"
    )
    span = f"(shiftleft(2L, {_E}) - shiftleft(1L, {_S}))"
    spans = f"(b & {span}) = (shiftleft(1L, {_S}) | shiftleft(1L, {_E}))"
    path = f"sort_array(transform(filter(edges, x -> {spans}), x -> x & {(1 << 43) - 1}L))"
    # Bound by transform, as Spark else puts the whole fold in the place of the name, once an edge.
    path = f"element_at(transform(array(bits), b -> {path}), 1)"
    return F.expr(
        f"element_at(transform(array({path}), p -> IF(exists(p, x -> {_ID} = {UNKNOWN}),"
        f" flatten(transform(p, x -> IF({_ID} != {UNKNOWN}, array({_ID}), {bytes_}))), transform(p, x -> {_ID}))), 1)"
    )


def merge_long(word: str, scores: dict[str, tuple[int, float]], byte_ids: list[int]) -> list[int]:
    """The merges of one long word with a queue of neighbours, in n log n steps."""
    parts: list[str | None] = list(word)
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    queue: list[tuple[float, int, int, str]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(parts):
            joined = parts[i] + parts[j]
            if joined in scores:
                heapq.heappush(queue, (-scores[joined][1], i, j, joined))

    for i in range(len(parts) - 1):
        offer(i)
    while queue:
        _, i, j, joined = heapq.heappop(queue)
        if parts[i] is None or parts[j] is None or after[i] != j or parts[i] + parts[j] != joined:
            continue
        parts[i], parts[j] = joined, None
        after[i] = after[j]
        if after[i] < len(parts):
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out: list[int] = []
    for part in parts:
        if part is not None:
            known = scores.get(part)
            out += [known[0]] if known else [byte_ids[b] for b in part.encode()]
    return out


def viterbi_long(word: str, pieces: Pieces, scores: dict[str, tuple[int, float]]) -> list[int]:
    best: list[tuple[float, int]] = [(0.0, 0)]
    unknown = pieces.least_score - UNKNOWN_PENALTY
    for e in range(1, len(word) + 1):
        options = []
        for s in range(max(0, e - pieces.longest), e):
            known = scores.get(word[s:e])
            if known or s == e - 1:
                options.append((best[s][0] + (known[1] if known else unknown), -s))
        top = max(options)
        best.append((top[0], -top[1]))
    out: list[int] = []
    e = len(word)
    while e:
        s = best[e][1]
        known = scores.get(word[s:e])
        out = ([known[0]] if known else [pieces.byte_ids[b] for b in word[s:e].encode()]) + out
        e = s
    return out


def _few_rows(batches):
    """Batches of ``_ROWS_AT_ONCE`` rows, so that no more texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
            yield batch.slice(start, _ROWS_AT_ONCE)


def _planes(numbers: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones: most of the higher are zero."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def _pack_ids(batches):
    """(block, z): the word numbers of a block in their order and the ids of the words."""
    packer = zstandard.ZstdCompressor(level=3)

    def packed(held):
        table = pa.Table.from_batches(held)
        blocks, numbers = table.column("block").to_numpy(), table.column("number").to_numpy()
        order = np.lexsort((numbers, blocks))
        blocks, numbers = blocks[order], numbers[order].astype(np.int64)
        ids = table.column("ids").combine_chunks().take(pa.array(order))
        ends = np.append(0, np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False), dtype=np.int64))
        flat = ids.flatten().to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        out = []
        for a, b in zip(cuts, cuts[1:]):
            parts = [[b - a], np.diff(numbers[a:b], prepend=0), np.diff(ends[a : b + 1]), flat[ends[a] : ends[b]]]
            out.append(packer.compress(_planes(np.concatenate(parts))))
        return pa.RecordBatch.from_arrays([pa.array(blocks[cuts[:-1]], pa.int64()), pa.array(out, pa.binary())], ["block", "z"])

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= _WORDS_AT_ONCE:
            yield packed(held)
            held, size = [], 0
    if held:
        yield packed(held)


def _unpack_ids(data: bytes) -> tuple[np.ndarray, pa.Array]:
    values = _from_planes(data)
    n = values[0]
    numbers, lengths, flat = np.split(values[1:], [n, 2 * n])
    ends = pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32))
    return np.cumsum(numbers), pa.ListArray.from_arrays(ends, pa.array(flat.astype(np.int32)))


def _hashes() -> list[Column]:
    return [F.xxhash64("word").alias("h"), F.xxhash64(F.lit(1), F.reverse("word")).alias("g")]


def encode_words(words: DataFrame, pieces: Pieces, unigram: bool) -> DataFrame:
    """The columns of ``words`` and ``ids``, for distinct words of at most ``BITS`` characters."""
    spark = words.sparkSession
    table = spark.createDataFrame(pieces.ranked, "piece string, id int, score double, rank int")
    short = words.where(F.length("word") <= BITS)
    if "h" not in words.columns:
        short = short.select("*", *_hashes())
    short = lattice(short, table, pieces, scores=unigram)
    short = short.withColumn("bits", viterbi_fold() if unigram else merge_fold())
    if unigram:
        short = short.withColumn("edges", F.expr(f"transform(edges, x -> {_packed('x.')})"))
    return short.withColumn("ids", _taken(pieces.byte_ids)).drop("h", "g", "bits", "edges")


def encode(docs: DataFrame, model_path: str, *keep: str, unigram: bool = False) -> DataFrame:
    """``keep`` and ``ids`` for every row; null and empty texts have no ids.

    The words of a block of rows (about 16 MB of text) are made distinct and numbered; the distinct
    words of all blocks are cut into a lattice and folded once each; every block gets the ids of its
    word numbers back, and its texts, which are moved as numbers, are put together from them. A word
    is moved once per block and not once per occurrence, so a word that is in every text costs one
    row a block.

    ``docs`` is read twice and must give its rows in the same order, as tables read from files do;
    else an error is raised.

    ``unigram`` models take the path with the best sum of scores. The scores of other models are
    merge ranks: their sum means nothing, and the fold replays the merges.
    """
    pieces = Pieces(model_path)
    scores = {p: (i, s) for p, i, s in pieces.rows}
    rows = columns_of(docs, *dict.fromkeys([*keep, "text"])).withColumn("part", F.spark_partition_id())
    fields = [f for f in rows.schema.fields if f.name in keep]
    pattern = pieces.pattern

    def distinct(batches):
        part, number, block, seen = 0, 0, _Block(pattern), {}

        def emit():
            for chunk in seen:
                block.add(chunk)
            words = list(block.words)
            place = pa.array(np.arange(len(words)), pa.int32())
            key = pa.array([block.key(part, number)] * len(words), pa.int64())
            table = pa.RecordBatch.from_arrays([key, place, pa.array(words, pa.string())], ["block", "number", "word"])
            return table.filter(pa.array([len(w) <= BITS for w in words], pa.bool_()))

        for batch in _few_rows(batches):
            part = batch.column("part")[0].as_py()
            for text in batch.column("text").to_pylist():
                seen.update(dict.fromkeys(block.chunks(text)))
                if block.size >= BLOCK_BYTES:
                    yield emit()
                    number, block, seen = number + 1, _Block(pattern), {}
        if seen:
            yield emit()

    def numbered(batches):
        part, number, block = 0, 0, _Block(pattern)
        texts, kept, held, size = [], [], [], 0
        packer = zstandard.ZstdCompressor(level=3)

        def pack():
            numbers, counts = block.numbers(texts)
            columns = [pa.concat_arrays([k[i] for k in kept]) for i in range(len(fields))]
            held.append((packer.compress(_planes(numbers)), counts.tolist(), columns))

        def emit():
            key = block.key(part, number)
            long = [(n, w) for w, n in block.words.items() if len(w) > BITS]
            for i, (z, counts, columns) in enumerate(held):
                at, words = zip(*long) if long and not i else ((), ())
                lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
                made = [
                    pa.array([key], pa.int64()), pa.array([z], pa.binary()), pa.array([counts], pa.list_(pa.int64())),
                    pa.array([list(at)], pa.list_(pa.int32())), pa.array([list(words)], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(made + lists, names)

        for batch in _few_rows(batches):
            part = batch.column("part")[0].as_py()
            start = 0
            for i, text in enumerate(batch.column("text").to_pylist()):
                texts.append(list(map(block.__getitem__, block.chunks(text))))
                size += len(text or "")
                full = block.size >= BLOCK_BYTES
                if full or size >= _STEP_BYTES or len(texts) >= 4096 or i + 1 == batch.num_rows:
                    kept.append([batch.column(f.name).slice(start, i + 1 - start) for f in fields])
                    start = i + 1
                    if full or size >= _STEP_BYTES or len(texts) >= 4096:
                        pack()
                        texts, kept, size = [], [], 0
                if full:
                    yield from emit()
                    number, block, held = number + 1, _Block(pattern), []
        if texts:
            pack()
        yield from emit()

    names = ["block", "z", "counts", "long_at", "long", *(f"k{i}" for i in range(len(fields)))]
    by_word = rows.select("text", "part").mapInArrow(distinct, "block bigint, number int, word string")
    # Dealt by the hash, which is made again behind the shuffle instead of being moved.
    by_word = by_word.repartition(_hashes()[0]).select(*_hashes(), "word", F.struct("block", "number").alias("place"))
    words = by_word.groupBy("h", "g").agg(F.first("word").alias("word"), F.collect_list("place").alias("places"))
    known = encode_words(words, pieces, unigram)
    named = known.select(F.explode("places").alias("place"), "ids").select("place.block", "place.number", "ids")
    named = named.mapInArrow(_pack_ids, "block bigint, z binary")
    kept_types = "".join(f", k{i} array<{f.dataType.simpleString()}>" for i, f in enumerate(fields))
    texts = rows.mapInArrow(numbered, "block bigint, z binary, counts array<bigint>, long_at array<int>, long array<string>" + kept_types)

    def put_together(left: pa.Table, right: pa.Table) -> pa.Table:
        unpacker = zstandard.ZstdDecompressor()
        long = dict(zip(left.column("long_at").combine_chunks().flatten().to_pylist(), left.column("long").combine_chunks().flatten().to_pylist()))
        folded = [viterbi_long(w, pieces, scores) if unigram else merge_long(w, scores, pieces.byte_ids) for w in long.values()]
        numbers, ids = zip(*(_unpack_ids(unpacker.decompress(z.as_py())) for z in right.column("z"))) if right.num_rows else ((), ())
        ids = pa.concat_arrays([*ids, pa.array(folded, pa.list_(pa.int32()))])
        ids = ids.take(pa.array(np.argsort(np.concatenate([*numbers, np.array(list(long), np.int64)]))))
        lengths = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
        parts = []
        for z, counts in zip(left.column("z"), left.column("counts")):
            numbers = _from_planes(unpacker.decompress(z.as_py()))
            if len(numbers) and numbers.max() >= len(ids):
                raise ValueError("the rows of the table came in another order when it was read again")
            ends = np.append(0, np.cumsum(lengths[numbers]))[np.append(0, np.cumsum(counts.values.to_numpy()))]
            parts.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids.take(pa.array(numbers)).flatten()))
        columns = [pa.chunked_array([c.flatten() for c in left.column(f"k{i}").chunks]) for i in range(len(fields))]
        if not parts:
            raise ValueError("the rows of the table came in another order when it was read again")
        found = pa.chunked_array(parts, pa.list_(pa.int32()))
        return pa.Table.from_arrays([*columns, found], [*(f"k{i}" for i in range(len(fields))), "ids"])

    out_types = "".join(f"k{i} {f.dataType.simpleString()}, " for i, f in enumerate(fields))
    out = texts.groupBy("block").cogroup(named.groupBy("block")).applyInArrow(put_together, out_types + "ids array<int>")
    return out.toDF(*(f.name for f in fields), "ids")


def decode(encoded: DataFrame, model_path: str, *keep: str) -> DataFrame:
    """``keep`` and ``text`` from ``ids``: pieces side by side, runs of byte pieces as UTF-8 (what
    is not valid becomes the replacement character), blanks for marks, the leading one dropped. Null
    ids give a null text, ids outside the table are left out."""
    import sentencepiece

    pieces = Pieces(model_path)
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    data = [b""] * model.get_piece_size()
    for piece, i, _ in pieces.rows:
        data[i] = piece.replace(SPACE, " ").encode()
    for b, i in enumerate(pieces.byte_ids):
        data[i] = bytes([b])
    nothing = len(data)  # stands for ids outside the table
    rows = columns_of(encoded, *keep, "ids")
    fields = [f for f in rows.schema.fields if f.name in keep]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "text string"])

    def run(batches):
        table = pa.array([*data, b""], pa.binary())
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(start, _ROWS_AT_ONCE)
                lists = part.column("ids")
                ids = pc.fill_null(lists.flatten(), nothing).to_numpy()
                ids = np.where((ids < 0) | (ids > nothing), nothing, ids)
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
                offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                joined = pc.binary_join(pa.ListArray.from_arrays(offsets, table.take(pa.array(ids))), b"")
                texts = [
                    x.as_py().decode("utf-8", "replace").removeprefix(" ") if known else None
                    for x, known in zip(joined, lists.is_valid().to_pylist())
                ]
                columns = [part.column(f.name) for f in fields] + [pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields] + ["text"])

    return rows.mapInArrow(run, schema)


@query("op4_sentence_pieces")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and hashes of the ids of every text, and of the text that they decode to."""
    import public_tokenizers

    path = public_tokenizers.path(MODEL)
    encoded = encode(read_table(spark, folder, "documents"), path, "doc_id")
    ids = encoded.withColumn("ids_sha256", F.sha2(F.array_join("ids", ","), 256)).withColumn("n_tokens", F.size("ids").cast("long"))
    decoded = decode(ids, path, "doc_id", "n_tokens", "ids_sha256")
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))
