"""Exact Hamming search and the permutation index against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from giftlink.llm import hamming_topk as H
from giftlink.llm import permutation_index as P
from giftlink.llm import registry

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, code long"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, 0, -1) for i, e in rows], SCHEMA)


# ---- Hamming -------------------------------------------------------------

def near(codes, q, k):
    rows = sorted(((bin((c ^ q) & (2 ** 64 - 1)).count("1"), i is None, i or 0, i) for i, c in codes))
    return [(d, i) for d, _, _, i in rows[:k]]


@pytest.mark.parametrize("seed,n,spread", [(1, 400, 64), (2, 300, 6), (3, 5, 64), (4, 250, 1)])
def test_search_is_exact(spark, seed, n, spread):
    rnd = random.Random(seed)
    start = rnd.getrandbits(64)
    codes = []
    for i in range(n):
        c = start ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, min(spread, 40))))
        codes.append((i, c - (1 << 64) if c >> 63 else c))
    codes += [(None, codes[0][1]), (3, codes[1][1]), (0, codes[0][1]), (n + 1, codes[2][1])]
    df = spark.createDataFrame(codes, "vec_id long, code long")
    queries = df.where("vec_id % 50 = 0")
    got = {}
    for r in H.search(df, queries, k=7).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.distance, r.vec_id))
    for i in {i for i, _ in codes if i is not None and i % 50 == 0}:
        mine = [c for j, c in codes if j == i]
        want = [(r + 1, *x) for r, x in enumerate(near(codes, mine[0], 7))]
        assert sorted(got[i]) == sorted(want * len(mine)), i


def test_codes_and_empty(spark):
    v = [1.0] + [-1.0] * 62 + [0.5]
    df = vectors(spark, [(0, v), (1, None), (2, []), (3, [NAN, 1.0]), (4, [INF]), (5, [None, 1.0]), (6, v + [-3.0]),
                         (7, [0.0, 2.0])])
    got = {r.vec_id: r.code for r in H.sign_codes(df).collect()}
    assert got == {0: 1 - (1 << 63), 2: 0, 6: -(1 << 63), 7: 2}
    none = H.sign_codes(df.limit(0))
    assert H.search(none, none).count() == 0


# ---- permutation index ---------------------------------------------------

def exact(rows, k, every):
    good = [(i, np.array(e, float)) for i, e in rows
            if i is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    most = max(sorted({len(e) for _, e in good}), key=lambda d: sum(len(e) == d for _, e in good), default=0)
    good = [(i, e / np.linalg.norm(e)) for i, e in good if len(e) == most]
    return {(n, i): sorted(((-float(e @ f), j) for m, (j, f) in enumerate(good) if m != n))[:k]
            for n, (i, e) in enumerate(good) if i % every == 0}


def test_small_tables_are_exact(spark):
    rnd = random.Random(7)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(60)]
    rows += [(50, rows[50][1]), (7, rows[3][1]), (70, [0.0] * 8), (71, None), (72, [NAN] * 8), (73, [1.0, None] * 4),
             (None, rows[1][1]), (100, [1.0, 2.0]), (74, [INF] + [1.0] * 7), (75, [])]
    rows = [(i, e and [None if x is None else float(np.float32(x)) for x in e]) for i, e in rows]
    got = {}
    for r in P.search(vectors(spark, rows), F.col("id") % 50 == 0, block=20, query_block=2).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = {}
    for (n, i), best in exact(rows, 5, 50).items():
        want.setdefault(i, []).extend((r + 1, j, -s) for r, (s, j) in enumerate(best))
    assert set(got) == set(want) == {0, 50}
    for i in want:
        assert [x[:2] for x in sorted(got[i])] == [x[:2] for x in sorted(want[i])]
        assert np.allclose([x[2] for x in sorted(got[i])], [x[2] for x in sorted(want[i])], atol=1e-12)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_fewer_rows_than_k(spark, n):
    rows = [(50 * i, [float(i + 1), 1.0]) for i in range(n)]
    got = P.search(vectors(spark, rows), F.col("id") % 50 == 0).collect()
    assert len(got) == n * max(0, n - 1)


@pytest.mark.parametrize("copies", [0, 1500])
def test_recall(spark, copies):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 32))
    if copies:  # a dense group of near-equal vectors
        x[:copies] = x[0] + rng.normal(size=(copies, 32)) * 1e-3
    x = x.astype(np.float32)
    rows = [(i, [float(y) for y in v]) for i, v in enumerate(x)]
    hit = total = 0
    want = exact(rows, 5, 50)
    got = {}
    for r in P.search(vectors(spark, rows), F.col("id") % 50 == 0, block=512).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    for (_, i), best in want.items():
        hit += len(got[i] & {j for _, j in best})
        total += 5
    assert hit / total >= 0.9, hit / total


def test_recall_on_the_given_table(spark):
    d = "/root/testdata/sf0.1"
    v = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()
    want = exact([(r.vec_id, r.embedding) for r in v], 5, 50)
    got = {}
    for r in registry.QUERIES["op7_permutation_index"](spark, d).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = sum(len(got[i] & {j for _, j in best}) for (_, i), best in want.items()) / (5 * len(want))
    assert recall >= 0.95, recall


@pytest.mark.parametrize("apart", [1.5, 3.0])
def test_recall_in_clusters(spark, apart):
    """Files of some hundred vectors of one cluster."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(20, 64))[rng.integers(0, 20, 20_000)] * apart + rng.normal(size=(20_000, 64))
    x = x.astype(np.float32)
    u = P.unit(x)
    score = u[::100] @ u.T
    score[np.arange(200), np.arange(0, 20_000, 100)] = -2
    want = np.argsort(-score, axis=1)[:, :5]
    got = {}
    df = vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    for r in P.search(df, F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = sum(len(got[100 * i] & set(w.tolist())) for i, w in enumerate(want))
    assert hit / 1000 >= 0.95, hit / 1000
