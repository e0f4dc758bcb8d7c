import math

import numpy as np
import pytest

from cardwatch.llm import embedding_dedup
from cardwatch.llm.common import stored
from cardwatch.llm.components import connected_components


def plain(rows, threshold=0.93):
    n = len(rows)
    unit = []
    for _, v, label in rows:
        ok = v is not None and label is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)
        size = math.sqrt(sum(float(np.float32(x)) ** 2 for x in v)) if ok else 0
        unit.append(np.array([np.float32(x) for x in v], float) / size if size else None)
    links, parent = [0] * n, list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b) or a @ b < threshold:
                continue
            links[i] += 1
            links[j] += 1
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
    least = {}
    for i, (key, _, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((k, links[i], least.get(find(i))) for i, (k, _, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("block", [2000, 4])
def test_links_and_components(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(block)
    rows = []
    for g in range(12):
        centre = rng.standard_normal(16)
        for k in range(10):
            v = (centre + rng.standard_normal(16) * 0.12 * (k % 4)).astype(np.float32)
            rows.append((len(rows), v.tolist(), g % 3))
    rows += [(500, rows[0][1], 0), (500, rows[0][1], 0), (501, rows[0][1], 1), (502, rows[0][1], None)]
    rows += [(503, None, 1), (504, [0.0] * 16, 1), (505, [float("nan")] * 16, 1), (506, [None] * 16, 1)]
    rows += [(507, [], 1), (508, rows[0][1][:8], 0), (None, rows[5][1], 0), (None, [1.0] * 16, 2), (509, [float("inf")] * 16, 0)]
    df = spark.createDataFrame(
        [(*r, 1, 2.0) for r in rows], "vec_id bigint, embedding array<float>, label int, cls bigint, n double"
    ).repartition(4)
    got = embedding_dedup.near_duplicates(stored(df, "test-vectors")).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr) == plain(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_very_large_and_small_components(spark):
    """Finite components of any size link by their direction."""
    base = np.array([3.0, -1.0, 2.0, 0.5])
    rows = [(i, (base * 10.0**k).tolist(), 1) for i, k in enumerate((0, 200, -200, 307, -300))]
    rows += [(9, (base[::-1] * 1e200).tolist(), 1), (10, [5e-324, 0.0, 0.0, 0.0], 1), (11, [1e-310, 0.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r["vec_id"]: r["component_id"] for r in embedding_dedup.near_duplicates(stored(df, "test-vectors")).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 9: 9, 10: 10, 11: 10}


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(df).count() == 0


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(999, i) for i in range(200, 240)]
    edges = path + star + [(5, 5), (None, 3), (7, 8), (8, 7), (7, 8)]
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)
    found = {r["node"]: r["component"] for r in connected_components(df).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 200 for i in [*range(200, 240), 999]} | {7: 7, 8: 7}
    assert found == want
    assert connected_components(df.limit(0)).count() == 0


def test_joined_roots():
    rng = np.random.default_rng(3)
    for n, k in ((1, 0), (50, 20), (400, 380), (300, 3000)):
        root = np.arange(n)
        a, b = rng.integers(n, size=(2, k))
        for part in np.array_split(np.arange(k), 3):
            embedding_dedup._join(root, a[part], b[part])
        want = np.arange(n)
        for _ in range(n):
            for x, y in zip(a, b):
                want[want == max(want[x], want[y])] = min(want[x], want[y])
            if (want[a] == want[b]).all():
                break
        assert root.tolist() == want.tolist()


def test_recall_of_the_tables():
    """Pairs just above the threshold meet in a table as often as the docstring says."""
    rng = np.random.default_rng(4)
    found = 0
    for _ in range(20):
        u = rng.standard_normal((500, 64))
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        w = rng.standard_normal((500, 64))
        w -= (w * u).sum(axis=1, keepdims=True) * u
        w /= np.linalg.norm(w, axis=1, keepdims=True)
        v = 0.931 * u + math.sqrt(1 - 0.931**2) * w
        found += (embedding_dedup.signatures(u) == embedding_dedup.signatures(v)).any(axis=1).sum()
    assert found >= 0.998 * 10_000
