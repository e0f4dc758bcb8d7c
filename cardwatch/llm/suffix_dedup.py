"""Removal of repeated substrings, by sorting suffixes in range-partitioned buckets.

Sorting a suffix for every byte of a corpus would move each byte some two hundred times. Here a
suffix is written only where it can matter, and results stay exact:

1. Every window of ``length`` bytes is given an anchor, the gram of ``GRAM`` bytes in it with the
   least hash (the leftmost of equals). The anchor depends on the window's bytes alone. Neighbouring
   windows with one anchor form a run, about one run to 65 bytes. Equal runs are certain to repeat.
2. A run whose anchor gram is found in no other run cannot repeat. What is left are runs whose gram
   has several different runs, mostly the edges of copied passages.
3. The suffixes of those runs, from the anchor on, are dealt by sampled splitters into ranges of
   leading bytes. Each range is sorted by multikey quicksort, left contexts likewise, and windows
   that agree to the left and to the right of the anchor are found from the common prefix lengths.
4. Windows that agree with the first or last suffix of their range may have equals across its
   boundaries. Their runs are dealt once more, by left contexts; the few windows that lie at a
   boundary there too are compared as whole strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
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
from cardwatch.llm.registry import query

LENGTH = 200
GRAM = 32
SEGMENT = 1 << 20  # bytes worked on at a time
CLASSES_PER_TASK = 40_000
_BASE = 0x9E3779B97F4A7C15
_RNG = np.random.default_rng(8)
_CODE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _POWERS:
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size + 1, base, np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        _POWERS.clear()
        _POWERS[size] = (out[0], out[1])
    return _POWERS[size]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _sliding_least(key: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours, from running minima of blocks in both directions."""
    pad = (-len(key)) % w
    blocks = np.concatenate([key, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    m = len(key) - w + 1
    return np.minimum(back[:m], ahead[w - 1 : w - 1 + m])


def runs_of(pieces: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """Runs of windows with one anchor: piece, first window, windows, anchor offset, two hashes.

    ``gram`` hash and content hash are those of the anchor gram and of all bytes under the run's
    windows. Windows never reach over the end of a piece.
    """
    sizes = np.array([len(p) for p in pieces], np.int64)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none, none
    power, inverse = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[data] * power[:n], out=sums[1:])
    grams = _mix((sums[gram:] - sums[: n + 1 - gram]) * inverse[: n + 1 - gram])
    bits = np.uint64(max(1, int(n).bit_length()))
    key = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_sliding_least(key, length - gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    m = n - length + 1
    piece = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    inside = piece[:m] == piece[length - 1 :]
    change = np.ones(m, bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1]) | (piece[1:m] != piece[: m - 1])
    start = np.flatnonzero(change)
    end = np.append(start[1:], m)
    keep = inside[start]
    start, end = start[keep], end[keep]
    upto = end + length - 1
    content = _mix((sums[upto] - sums[start]) * inverse[start] + (upto - start).astype(np.uint64) * np.uint64(_BASE))
    at = piece[start]
    return (
        at,
        start - first[at],
        end - start,
        anchor[start] - start,
        grams[anchor[start]].view(np.int64),
        content.view(np.int64),
    )


_RUN_SCHEMA = "g bigint, c bigint, n int, row bigint, s bigint, wa int"


def anchor_runs(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Runs of all texts, ``n`` at once where they are equal in a segment of about 1 MB.

    Of runs that repeat in a segment one stands for all, with ``n`` = 2; all of them are certain to
    be removed and are given as rows with ``n`` = 0, ``s`` the first byte and ``c`` the bytes.
    Longer texts are cut into segments that overlap by a window less one byte.
    """

    def run(batches):
        def flush(pieces, rows_of, bases):
            at, s, w, a, g, c = runs_of(pieces, length, gram)
            if not len(at):
                return None
            row, s = np.array(rows_of)[at], s + np.array(bases)[at]
            order = np.lexsort((c, g))
            new = np.ones(len(order), bool)
            new[1:] = (g[order][1:] != g[order][:-1]) | (c[order][1:] != c[order][:-1])
            number = np.cumsum(new) - 1
            count = np.bincount(number)
            one = order[new]
            again = order[count[number] > 1]
            again = again[np.lexsort((s[again], row[again]))]
            ra, sa, ea = _merge(row[again], s[again], s[again] + w[again] + length - 1)
            columns = [
                np.concatenate([g[one], _mix((ra * 31 + sa).astype(np.uint64)).view(np.int64)]),
                np.concatenate([c[one], ea - sa]),
                np.concatenate([np.minimum(count, 2), np.zeros(len(ra), np.int64)]).astype(np.int32),
                np.concatenate([row[one], ra]),
                np.concatenate([s[one], sa]),
                np.concatenate([w[one] << 8 | a[one], np.zeros(len(ra), np.int64)]).astype(np.int32),
            ]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["g", "c", "n", "row", "s", "wa"])

        pieces, rows_of, bases, size = [], [], [], 0
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
                text = text.as_py() or b""
                for base in range(0, max(len(text) - length + 1, 0), SEGMENT):
                    piece = text[base : base + SEGMENT + length - 1]
                    pieces.append(piece), rows_of.append(row), bases.append(base)
                    size += len(piece)
                    if size >= SEGMENT:
                        out = flush(pieces, rows_of, bases)
                        if out:
                            yield out
                        pieces, rows_of, bases, size = [], [], [], 0
        if pieces and (out := flush(pieces, rows_of, bases)):
            yield out

    return rows.select(ROW, "text").mapInArrow(run, _RUN_SCHEMA)


def _merge(row: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Joins intervals, sorted by row and start, that touch or overlap."""
    if not len(row):
        return row, start, end
    far = end.copy()
    cut = np.ones(len(row), bool)
    cut[1:] = row[1:] != row[:-1]
    # Running maximum of the ends within a row: rows are told apart by a large step.
    rank = np.cumsum(cut)
    step = int(end.max()) + 1
    far = np.maximum.accumulate(end + rank * step) - rank * step
    cut[1:] |= start[1:] > far[:-1]
    first = np.flatnonzero(cut)
    return row[first], start[first], far[np.append(first[1:], len(row)) - 1]


def _equal_runs(runs: DataFrame, length: int) -> DataFrame:
    """Class rows (``n`` 1 or 2) and certain intervals (``n`` 0) from all runs.

    Equal runs meet in one task, at most one row for each segment of 1 MB, and are read as a
    stream: the first of a class waits until the next row shows whether it is alone.
    """

    def run(batches):
        held = None  # the first row of the class at hand, [g, c, n, row, s, wa]
        for batch in batches:
            g, c, n, row, s, wa = (batch.column(i).to_numpy() for i in range(6))
            m = len(g)
            if not m:
                continue
            if held is not None:
                g, c, n, row, s, wa = (np.append(x, y) for x, y in zip(held, (g, c, n, row, s, wa)))
                m += 1
            sure = n == 0
            new = np.ones(m, bool)
            new[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1]) | sure[1:] | sure[:-1]
            number = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            total = np.bincount(number, weights=n)
            # The last class may go on in the next batch; its first row is carried over.
            open_ = number == number[-1]
            emit = first[:-1] if not sure[-1] else first
            alone = n == 1
            certain = np.flatnonzero(alone & (total[number] > 1))
            carried = (g[first[-1]], c[first[-1]], n[first[-1]], row[first[-1]], s[first[-1]], wa[first[-1]])
            if sure[-1]:
                held = None
            else:
                # A carried first row that has met its equal is marked as certain once.
                count = 2 if total[-1] > 1 else int(n[first[-1]])
                held = tuple(np.array([v], x.dtype) for v, x in zip((*carried[:2], count, *carried[3:]), (g, c, n, row, s, wa)))
            kept = np.minimum(total, 2).astype(np.int32)[number[emit]]
            kept[sure[emit]] = 0
            yield out(
                np.append(g[emit], g[certain]),
                np.append(np.where(sure[emit], c[emit], 0), (wa[certain] >> 8) + length - 1),
                np.append(kept, np.zeros(len(certain), np.int32)),
                np.append(row[emit], row[certain]),
                np.append(s[emit], s[certain]),
                np.append(wa[emit], wa[certain]),
            )
        if held is not None:
            yield out(*held)

    def out(*columns):
        kinds = (np.int64, np.int64, np.int32, np.int64, np.int64, np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(x).astype(k)) for x, k in zip(columns, kinds)], ["g", "c", "n", "row", "s", "wa"]
        )

    return runs.repartition("g", "c").sortWithinPartitions("g", "c").mapInArrow(run, _RUN_SCHEMA)


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of byte strings of one width: sort by the first eight bytes, then sort only the groups
    that are still equal by the next eight, and so on."""
    m, width = rows.shape
    padded = np.zeros((m, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    tokens = padded.view(">u8").astype(np.uint64)
    order = np.argsort(tokens[:, 0], kind="stable") if m else np.zeros(0, np.int64)
    group = np.zeros(m, np.int64)
    sorted_first = tokens[order, 0]
    group[1:] = np.cumsum(sorted_first[1:] != sorted_first[:-1])
    for k in range(1, tokens.shape[1]):
        sizes = np.bincount(group, minlength=1)
        tied = np.flatnonzero(sizes[group] > 1)
        if not len(tied):
            break
        inner = np.lexsort((tokens[order[tied], k], group[tied]))
        order[tied] = order[tied][inner]
        values = tokens[order, k]
        split = group[1:] != group[:-1]
        split |= values[1:] != values[:-1]
        group = np.concatenate([[0], np.cumsum(split)])
    return order


def _common(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each string with the one before it in order; the first has -1."""
    out = np.full(len(order), -1, np.int64)
    for i in range(1, len(order), 8191):
        a, b = rows[order[i - 1 : i + 8191][:-1]], rows[order[i : i + 8191]]
        differ = a != b
        out[i : i + len(b)] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def _matrix(strings: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(strings), width), np.uint8)
    for i, s in enumerate(strings):
        out[i, : len(s)] = np.frombuffer(s, np.uint8)
    return out


def repeated_windows(
    right: list[bytes],
    back: list[bytes],
    member: np.ndarray,
    length: int,
    by_left: bool,
    gram: int = GRAM,
):
    """Windows of the runs of one bucket that are found in another run of it, and those to compare
    across the bucket's boundaries.

    ``right`` are the bytes from the anchor on, ``back`` those before it in reverse, and
    ``member[o]`` tells which runs have a window that starts ``o`` bytes before the anchor. Such a
    window is the first ``o`` bytes of ``back`` and the first ``length - o`` of ``right``. Strings
    with a common prefix lie together in sorted order, so a number per prefix length comes from the
    common prefixes of neighbours; two windows are equal when both numbers are. Left contexts are
    sorted behind their gram, as their ranges are, so only those of one gram are neighbours. Yields
    (o, runs that repeat, one run for each different window at a boundary).
    """
    m = len(right)
    r = _matrix(right, length)
    l = _matrix([x[:gram] + y for x, y in zip(right, back)], gram + len(member))
    r_order, l_order = multikey_order(r), multikey_order(l)
    r_common, l_common = _common(r, r_order), _common(l, l_order)
    ends = l_order[[0, -1]] if by_left else r_order[[0, -1]]
    r_group, l_group = np.empty(m, np.int64), np.empty(m, np.int64)
    for o in range(len(member)):
        at = np.flatnonzero(member[o])
        if not len(at):
            continue
        r_group[r_order] = np.cumsum(r_common < length - o)
        l_group[l_order] = np.cumsum(l_common < gram + o)
        key = r_group[at] * (m + 1) + l_group[at]
        _, first, which, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        side = l_group if by_left else r_group
        yield o, at[count[which] > 1], at[first[np.isin(side[at[first]], side[ends])]]


_CLASS_SCHEMA = "suffix binary, back binary, row bigint, s bigint, n int, w int, os array<int>"


def _bucket_results(runs: DataFrame, length: int, gram: int, parts: int, by_left: bool) -> DataFrame:
    """``row``, ``s``, ``e`` of windows that repeat in their bucket (``n`` is null), and the runs
    with windows that must be compared with those of other buckets, their offsets in ``os``.

    Buckets are ranges of the suffix, then of the place of the run, so that many equal suffixes may
    fall into several buckets. A window equal to one in another bucket agrees, in its right part,
    with the first or the last suffix of its own, since all suffixes between the two begin alike.
    ``by_left`` deals by the gram and the left context instead, and the same holds for the left
    part: passages with one right context and many left ones are told apart there. ``os`` null
    stands for all. What both passes leave open are the different windows that lie on a boundary of
    each, a number that goes with the boundaries and not with the runs.
    """
    names = [c.split()[0] for c in _CLASS_SCHEMA.split(", ")] + ["e", "edge"]

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        right, back = table.column("suffix").to_pylist(), table.column("back").to_pylist()
        row, s, n, w = (table.column(c).to_numpy() for c in ("row", "s", "n", "w"))
        anchor = np.array([len(x) for x in back], np.int64)
        offset = np.arange(length - gram + 1)[:, None]
        member = (offset <= anchor) & (offset > anchor - w)
        listed = table.column("os")
        if not listed.null_count:
            some = np.zeros_like(member)
            flat = listed.combine_chunks()
            sizes = pa.compute.list_value_length(flat).to_numpy(zero_copy_only=False)
            some[flat.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)] = True
            member &= some
        rows, starts, open_ = [], [], [[] for _ in right]
        edge_rows, edge_starts, edges = [], [], []
        for o, again, edge in repeated_windows(right, back, member, length, by_left, gram):
            at = again[n[again] == 1]
            rows.append(row[at])
            starts.append(s[at] + anchor[at] - o)
            for k in edge.tolist():
                if by_left:
                    edges.append(back[k][:o][::-1] + right[k][: length - o])
                    edge_rows.append(row[k])
                    edge_starts.append(s[k] + anchor[k] - o)
                else:
                    open_[k].append(o)
        none = np.zeros(0, np.int64)
        rows, starts = np.concatenate([none, *rows]), np.concatenate([none, *starts])
        order = np.lexsort((starts, rows))
        ra, sa, ea = _merge(rows[order], starts[order], starts[order] + length)
        yield batch(row=ra, s=sa, e=ea)
        if edges:
            start = np.array(edge_starts, np.int64)
            yield batch(row=np.array(edge_rows, np.int64), s=start, e=start + length, edge=edges)
        k = [i for i, x in enumerate(open_) if x]
        if k:
            yield batch(
                suffix=[right[i] for i in k],
                back=[back[i] for i in k],
                row=row[k],
                s=s[k],
                n=n[k],
                w=w[k],
                os=[open_[i] for i in k],
            )

    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.int64(), pa.binary()]

    def batch(**columns):
        m = len(columns["row"])
        arrays = [pa.array(columns[c], k) if c in columns else pa.nulls(m, k) for c, k in zip(names, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names)

    # Splitters are sampled from whole keys of up to ``length`` bytes: shorter ones cannot tell near
    # copies apart, whose runs would then all lie on boundaries.
    key = F.concat(F.substring("suffix", 1, gram), "back") if by_left else F.substring("suffix", 1, length)
    dealt = runs.repartitionByRange(parts, key, "row", "s")
    return dealt.mapInArrow(run, _CLASS_SCHEMA + ", e bigint, edge binary")


def _packed(rows: DataFrame, *carry: str) -> DataFrame:
    """``row``, the text as compressed bytes, which is what a shuffle of texts moves, and ``carry``."""
    fields = [f for f in rows.schema.fields if f.name in carry]
    schema = ", ".join(["row bigint, z binary", *(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)])

    def run(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            data = pa.array([packer.compress(t.as_py() or b"") for t in texts], pa.binary())
            rest = [batch.column(i + 2) for i in range(len(fields))]
            yield pa.RecordBatch.from_arrays([batch.column(0), data, *rest], ["row", "z", *(f.name for f in fields)])

    return rows.select(ROW, "text", *(F.col(f"`{f.name}`") for f in fields)).mapInArrow(run, schema)


def _contents(rows: DataFrame, unsure: DataFrame, length: int) -> DataFrame:
    """The bytes of the runs in ``unsure``: from the anchor on, and before it in reverse."""
    wanted = unsure.groupBy("row").agg(F.collect_list(F.struct("s", "wa", "n")).alias("runs"))
    joined = _packed(rows).join(wanted, "row").select("row", "z", "runs")

    def run(batches):
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for row, z, runs in zip(*(batch.column(i) for i in range(3))):
                text, row = unpacker.decompress(z.as_py()), row.as_py()
                for r in runs.as_py():
                    s, w, a = r["s"], r["wa"] >> 8, r["wa"] & 255
                    out.append((text[s + a : s + w + length - 1], text[s : s + a][::-1], row, s, r["n"], w, None))
            columns = list(zip(*out)) if out else [()] * 7
            kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()))
            names = [c.split()[0] for c in _CLASS_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return joined.mapInArrow(run, _CLASS_SCHEMA)


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``row`` and ``spans``, an array of (s, e) byte intervals that cover just the bytes under
    windows found more than once. ``rows`` has ``row_key`` and ``text``."""
    if not gram <= length <= gram + 255:
        raise ValueError("length must lie between the gram and 255 bytes more")
    classes = stored(_equal_runs(anchor_runs(rows, length, gram), length), "runs")
    alive = classes.where("n > 0")
    several = alive.groupBy("g").agg(F.count("*").alias("m"), F.min("n").alias("k")).where("m > 1 AND k = 1")
    unsure = stored(alive.join(several.select("g"), "g", "left_semi").select("row", "s", "wa", "n"), "unsure-runs")

    def parts(count: int) -> int:
        own = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return max(own, -(-count // CLASSES_PER_TASK))

    content = _contents(rows, unsure, length)
    right = stored(_bucket_results(content, length, gram, parts(unsure.count()), by_left=False), "windows")
    open_ = right.where("n IS NOT NULL").drop("e", "edge")
    left = stored(_bucket_results(open_, length, gram, parts(open_.count()), by_left=True), "windows")
    edges = left.where("edge IS NOT NULL")
    common = edges.groupBy("edge").count().where("count > 1").select("edge")
    spans = (
        classes.where("n = 0")
        .select("row", "s", (F.col("s") + F.col("c")).alias("e"))
        .unionByName(right.where("n IS NULL").select("row", "s", "e"))
        .unionByName(left.where("edge IS NULL").select("row", "s", "e"))
        .unionByName(edges.join(common, "edge", "left_semi").select("row", "s", "e"))
    )
    return spans.groupBy("row").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for s, e in spans:
        kept.append(text[at:s])
        at = e
    return b"".join(kept) + text[at:]


def whole_characters(text: bytes, spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The spans without bytes of characters that they cover only in part."""
    for s, e in spans:
        while s < e and text[s] & 0xC0 == 0x80:
            s += 1
        while s < e < len(text) and text[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            yield s, e


def remove_repeats(docs: DataFrame, *keep: str, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``keep``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept_text``.

    Texts are taken as UTF-8 bytes, null as empty. Each byte under a window of ``length`` bytes that
    also starts anywhere else, in the same or another row, is removed; windows are judged on the
    input. The counts and the hash are of the bytes that remain; ``kept_text`` leaves characters
    whole that are covered in part. Texts shorter than a window stay as they are. Equal rows, also
    with equal ids, are documents of their own: all their copies are removed.
    """
    rows = with_row_key(columns_of(docs, *dict.fromkeys([*keep, "text"])))
    spans = repeated_spans(rows.select(ROW, "text"), length, gram)
    others = [f for f in rows.schema.fields if f.name in keep and f.name != "text"]
    data = _packed(rows, *(f.name for f in others)).join(spans, "row", "left")
    data = data.select("z", "spans", *(F.col(f"`{f.name}`") for f in others))
    results = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), results])
    names = [f.name for f in others] + [c.split()[0] for c in results.split(", ")]

    def run(batches):
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for z, found in zip(batch.column(0), batch.column(1)):
                text, at = unpacker.decompress(z.as_py()), merged(found.as_py())
                kept = without(text, at) if at else text
                shown = without(text, list(whole_characters(text, at))) if at else text
                digest = hashlib.sha256(kept).hexdigest()
                out.append((len(text), len(text) - len(kept), len(at), digest, shown.decode("utf-8", "replace")))
            columns = list(zip(*out)) if out else [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            made = [pa.array(c, k) for c, k in zip(columns, kinds)]
            carried = [batch.column(i + 2) for i in range(len(others))]
            yield pa.RecordBatch.from_arrays([*carried, *made], names)

    return data.mapInArrow(run, schema)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their repeated passages; of some nothing but an empty text is left.

    A null text comes out empty; of repeated rows all copies lose what repeats.
    """
    found = remove_repeats(docs, *DOCUMENT_COLUMNS)
    changed = F.col("n_removed") > 0
    return found.select(
        "doc_id",
        F.col("kept_text").alias("text"),
        "lang",
        "source",
        F.when(changed, F.length("kept_text").cast(docs.schema["n_chars"].dataType))
        .otherwise(F.col("n_chars"))
        .alias("n_chars"),
    )


@query("op8_suffix_array_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(read_table(spark, folder, "documents"), "doc_id").drop("kept_text")
