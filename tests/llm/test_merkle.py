"""The manifest against a plain tree, on odd and empty tables."""

import zlib
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from cardwatch.llm import merkle
from llm.conftest import ODD


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_steps(levels, i):
    out = []
    for nodes in levels[:-1]:
        pair = nodes[i // 2 * 2 : i // 2 * 2 + 2]
        out.append((i % 2, [x for k, x in enumerate(pair) if k != i % 2]))
        i //= 2
    return out


def plain(rows):
    """Rows (doc_id, source, lang, n_chars, text) by the words of the contract."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0], h(*map(field, row)), row))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in order:
        trees[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        built[lang] = plain_levels([x[1] for x in trees[lang]])
    top = plain_levels([built[x][-1][0] for x in order])
    out = []
    for g, lang in enumerate(order):
        for i, (key, leaf, row) in enumerate(trees[lang]):
            steps = plain_steps(built[lang], i) + plain_steps(top, g)
            digest = leaf
            if key is not None and zlib.crc32(str(key).encode()) % 7 == 0 and row[3] is not None:
                digest = h(*map(field, (*row[:3], row[3] + 1, row[4])))
            for right, others in steps:
                digest = h(*others, digest) if right else h(digest, *others)
            proof = h(*[x for _, others in steps for x in others])
            out.append((key, leaf, built[lang][-1][0], top[-1][0], proof, digest, digest == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [*range(1, 40), 63, 64, 65, 257])
def test_places_are_those_of_the_completion_order(n):
    levels = plain_levels([h(str(i)) for i in range(n)])
    log = merkle.completion_log(levels[0], len(levels) - 1)
    assert len(log) == merkle.subtree_size(len(levels) - 1, n) == sum(map(len, levels))
    for k, nodes in enumerate(levels):
        for b, digest in enumerate(nodes):
            assert log[merkle.place(k, b, n)] == digest


def table(spark, rows):
    full = [(*r, "x", 1, 2) for r in rows]
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, i int, n int"
    return spark.createDataFrame(full, schema).repartition(3)


def result(docs, height):
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    manifest = merkle.build_manifest(docs, claimed={"n_chars": more}, height=height)
    found = merkle.proofs(manifest).select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(), 256).alias("proof"),
        merkle.fold(F.coalesce("claimed", "leaf")).alias("folded"),
    )
    return manifest, sorted((tuple(r) + (r["folded"] == r["root"],) for r in found.collect()), key=repr)


@pytest.mark.parametrize("height", [1, 2, 10])
def test_proofs_against_a_plain_tree(spark, height):
    rows = [(i, "s", "en" if i % 3 else "fr", i, f"text {i}") for i in range(90)]
    rows += [(r[0], None, (*r, "en")[2], len(r[1] or ""), r[1]) for r in ODD]
    rows += [(300, "a", None, None, "x"), (301, "", "", 2**63 - 2, ""), (302, "-", "é", 0, "é"), (21, "t", "é", None, None)]
    rows += [rows[5]] * 3 + [(5, "other", "en", 5, "text 5")]
    manifest, got = result(table(spark, rows), height)
    want = plain(rows)
    assert got == want
    assert {r[-1] for r in want} == {True, False}
    assert [r["root"] for r in manifest.roots().collect()] == [want[0][3]]
    assert {r["subroot"] for r in manifest.subroots().collect()} == {r[2] for r in want}


def test_one_leaf_is_its_own_root(spark):
    manifest, got = result(table(spark, [(1, None, None, 3, "abc")]), 10)
    leaf = h("1:1", "-", "-", "1:3", "3:abc")
    assert got == [(1, leaf, leaf, leaf, h(), leaf, True)]


def test_empty_table(spark):
    manifest, got = result(table(spark, []), 10)
    assert got == [] and manifest.roots().count() == 0


def test_sql_of_the_query_on_odd_rows(spark):
    """The SQL gives the plain rows, too, where a level ends in a single node."""
    rows = [(i, "s", ("en", "de", None)[i % 3], i if i % 4 else None, f"é {i}") for i in range(50)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, lang VARCHAR, n_chars BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    assert sorted(con.execute(merkle.ORACLE).fetchall(), key=repr) == plain(rows)
