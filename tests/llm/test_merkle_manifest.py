"""Merkle manifest against trees kept whole in memory."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from giftlink.llm import merkle_manifest as mm
from giftlink.llm import registry

from conftest import SF0001


def h(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    parts = [b"-" if v is None else f"{len(str(v).encode())}:".encode() + str(v).encode()
             for v in (doc_id, source, lang, n_chars, text)]
    return h(b"".join(parts))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def way(tree, i):
    for below in tree[:-1]:
        yield i & 1, below[i ^ 1] if i ^ 1 < len(below) else ""
        i >>= 1


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of each row."""
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r, leaf(*r)))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in langs:
        by[x].sort(key=lambda p: (p[0][0] is not None, p[0][0] or 0, p[1]))
        trees[x] = levels([lf for _, lf in by[x]])
    top = levels([trees[x][-1][0] for x in langs])
    for k, x in enumerate(langs):
        for i, (r, lf) in enumerate(by[x]):
            path = [*way(trees[x], i), *way(top, k)]
            told = lf
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                told = leaf(r[0], r[1], r[2], r[3] + 1, r[4])
            for right, other in path:
                told = h(other + told if right else told + other)
            yield (r[0], lf, trees[x][-1][0], top[-1][0], h("".join(o for _, o in path)), told, told == top[-1][0])


EDGES = [(None, "s", None, 3, "abc"), (None, "s", None, 3, "abc"), (0, None, "é", None, "x" * 100_000),
         (1, "", "", 0, ""), (7, "s", "zz", 4, "tie"), (7, "s", "zz", 4, "tie"), (7, "s", "zz", 5, "tie"),
         *[(i, "s", "en", i, f"t{i}") for i in range(-5, 70)]]


@pytest.mark.parametrize("span", [1, 3, 8])
def test_edges_equal_whole_trees(spark, span):
    df = spark.createDataFrame([(*r, "x", 1) for r in EDGES],
                               "doc_id long, source string, lang string, n_chars long, text string, hash string, pos int")
    m = mm.Manifest(df.repartition(5), mm.tampered(df), span)
    got = [tuple(r) for r in m.check().collect()]
    assert sorted(got, key=str) == sorted(plain(EDGES), key=str)
    paths = {(r.tree, r.pos): r for r in m.proofs().collect()}
    assert len(paths) == len(EDGES)
    for n in m.trees[0].collect():
        p = paths[n.tree, n.pos]
        assert mm.fold(n.hash, p.path) == p.root and mm.fold(h("other"), p.path) != p.root


def test_only_every_third_level_is_written(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
                                 F.lit(1).alias("n_chars"), F.lit("t").alias("text"))
    m = mm.Manifest(df, span=3)  # 200 rows: levels 0, 3, 6 and the root
    assert [x.count() for x in m.trees] == [200, 25, 4, 1]
    assert {r.verified for r in m.check().collect()} == {True}


def test_empty_table_and_a_single_row(spark):
    one = spark.createDataFrame([EDGES[2]], "doc_id long, source string, lang string, n_chars long, text string")
    assert [tuple(r) for r in mm.Manifest(one).check().collect()] == list(plain([EDGES[2]]))
    none = mm.Manifest(one.limit(0))
    assert none.check().count() == 0 and none.proofs().count() == 0


def test_query_equals_whole_trees(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/documents.parquet")
            .select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = [tuple(r) for r in registry.op11_merkle_manifest(spark, SF0001).collect()]
    assert sorted(got) == sorted(plain(rows))
