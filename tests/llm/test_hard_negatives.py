"""Hard negatives against a scan of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import hard_negatives as hn


def plain(rows, anchor_of=lambda i: i is not None and i % 10 == 0, k=5):
    """Rows (vec_id, vector, label): every anchor scored against every row in Python integers."""
    kept = []
    for i, v, label in rows:
        if v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(x * 256) for x in v], label))

    def first(found):
        return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]

    out = []
    for a, (i, v, label) in enumerate(kept):
        if not anchor_of(i):
            continue
        same, other = [], []
        for b, (j, w, its) in enumerate(kept):
            if b != a and len(w) == len(v):
                (same if its == label else other).append((sum(x * y for x, y in zip(v, w)), j))
        for p, pid in first(same):
            window = [(s, j) for s, j in other if 80 * p <= 100 * s <= 100 * p]
            out += [(i, pid, r, j, p, s) for r, (s, j) in enumerate(first(window), 1)]
    return sorted(out, key=repr)


def mined(spark, rows, parts=3):
    schema = "vec_id bigint, embedding array<float>, label int, row bigint, anchor string, dim int, v int"
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], schema).repartition(parts)
    got = hn.hard_negatives(df, F.col("vec_id") % 10 == 0).collect()
    return sorted(map(tuple, got), key=repr)


def vectors(n, dim, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    out = []
    for i in range(n):
        v = centres[i % 6] + rng.standard_normal(dim) * 0.7
        v = (v / np.sqrt(v @ v)).astype(np.float32)
        out.append((i, v.tolist(), int(rng.integers(labels))))
    return out


@pytest.mark.parametrize("block, chunk", [(8192, 1024), (16, 3)])
def test_against_all_pairs(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "CHUNK", chunk)
    rows = vectors(240, 12, block)
    copies = [(1000 + i, rows[20][1], i % 3) for i in range(60)]  # ties over several blocks
    odd = [
        (2000, None, 1), (2010, [1.0] * 12, None), (2020, [None] * 12, 1), (2030, [float("nan")] * 12, 1),
        (2040, [float("inf")] * 12, 1), (2050, [], 1), (2060, [0.0] * 12, 2), (2061, [0.0] * 12, 1),
        (2070, [0.5] * 3, 1), (2071, [0.5, 0.4, 0.5], 2), (2072, [0.5, 0.5, 0.4], 1), (None, rows[30][1], 1),
        (None, rows[40][1], 2), (50, rows[7][1], 3), (50, rows[7][1], 3), (2080, [-x for x in rows[3][1]], 0),
        (2090, [], 1), (2091, [], 2),
    ]
    rows += copies + odd
    got = mined(spark, rows)
    assert got == plain(rows)
    assert len(got) > 300


def test_numbers_beyond_doubles(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.float32(rng.standard_normal(5) * 10.0 ** (5 + i % 2))], i % 3) for i in range(40)]
    want = plain(rows)
    assert mined(spark, rows) == want and max(abs(r[4]) for r in want) > 2**53
    assert hn.exact_type(np.full((1, 4), 1e9), np.full((1, 4), 1e9)) is object
    assert hn.whole_numbers(np.array([[2.0**60 + 2.0**40, -0.5]])).tolist() == [[(2**60 + 2**40) * 256, -128]]


def test_search_stops_before_all_rows_are_met():
    rng = np.random.default_rng(5)
    rows = np.floor(rng.standard_normal((4000, 3)) * 256)
    lists, anchor = hn.SortedLists(rows), np.floor(rng.standard_normal(3) * 256)
    best = hn.Best(5)
    met = 0
    for new, scores, threshold in lists.access(anchor):
        best.offer(new, scores)
        met += len(new)
        unmet = np.sort(rows @ anchor)[: len(rows) - met]
        if best.closed(threshold):
            break
        assert threshold >= unmet[-1]
    assert met < 2000
    assert [-s for s, _ in best.found] == np.sort(rows @ anchor)[::-1][:5].tolist()


def test_empty_table_and_no_anchors(spark):
    assert mined(spark, [(11, [1.0], 1), (12, [1.0], 2)]) == []
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert hn.hard_negatives(empty, F.col("vec_id") % 10 == 0).count() == 0
