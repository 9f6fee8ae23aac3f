"""Co-training: held-out accuracy and edge rows."""

import random

import pytest

from giftlink.llm import cotraining as C

SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep string, p_text string"


def test_held_out_accuracy_on_the_given_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = labels.where("xxhash64(doc_id) % 4 = 0")
    got = C.classify(docs, labels.join(held, "doc_id", "left_anti"))
    assert got.count() == docs.count()
    rows = got.join(held, "doc_id").select("quality", "keep").collect()
    good = [r.keep for r in rows if r.quality == 1]
    bad = [r.keep for r in rows if r.quality == 0]
    assert len(bad) > 50 and sum(good) / len(good) >= 0.99
    assert sum(bad) / len(bad) <= 0.05


def test_pseudo_labels_help_a_view_with_few_labels():
    # the round exchange itself: a view learns from the other's rows
    rnd = random.Random(1)
    x = [[rnd.gauss(0, 1), rnd.gauss(0, 1)] for _ in range(400)]
    y = [float(a > 0) for a, _ in x]
    import numpy as np
    few = C.Logistic(np.array(x[:4]), np.array(y[:4]))
    many = C.Logistic(np.array(x[:300]), np.array(y[:300]))

    def hits(m):
        return sum((m.logit(np.array(x[300:])) > 0) == (np.array(y[300:]) > 0))

    assert hits(many) >= hits(few) and hits(many) >= 95


def frames(spark, texts, labels):
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 5}", None if i % 5 == 0 else 7,
             "clash", "clash") for i, t in enumerate(texts)]
    return (spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_edges(spark):
    rnd = random.Random(2)
    texts = [None, "", " ", "x" * 100_000, "a"]
    labels = [(None, 1, 0), (0, None, 0), (10_000, 1, 0)]
    for i in range(5, 125):
        w = ["".join(rnd.choice("abcdefg") for _ in range(5)) for _ in range(60)]
        bad = i % 3 == 0
        texts.append(" ".join(x + "$$$" for x in w) if bad else " ".join(w) + ".")
        if i < 95:
            labels.append((i, 0 if bad else 1, 0))
    labels += [(6, 1, 1), (7, 1, 0), (7, 0, 0)]  # repeated, and at odds: the lower one counts
    docs, lab = frames(spark, texts, labels)
    docs = docs.unionAll(docs.where("doc_id in (1, 6)"))
    got = C.classify(docs, lab, per_round=10).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        assert 0 <= r.p_text <= 1 and 0 <= r.p_meta <= 1 and 0 <= r.p_quality <= 1
    keep = {r.doc_id: r.keep for r in got}
    assert sum(keep[i] == (i % 3 != 0) for i in range(95, 125)) >= 29


@pytest.mark.parametrize("labels,want", [([], 1.0), ([(1, 0, 0), (2, 0, 0)], 0.0), ([(1, 1, 0)], 1.0)])
def test_labels_of_one_class(spark, labels, want):
    docs, lab = frames(spark, ["a", "b", "c"], labels)
    assert [r.p_quality for r in C.classify(docs, lab).collect()] == [want] * 3


def test_empty_table(spark):
    docs, lab = frames(spark, [], [(1, 1, 0)])
    assert C.classify(docs, lab).count() == 0


def test_feature_rows_are_not_shuffled(spark):
    """What the fit shuffles are ids and hashes; no exchange holds features,
    whatever the size of the labels."""
    from pyspark.sql import functions as F
    rnd = random.Random(4)
    texts = [" ".join("".join(rnd.choice("abcdefg") for _ in range(5)) for _ in range(40)) + ("$$$ " * 20 if i % 3 == 0 else ".")
             for i in range(300)]
    docs, labels = frames(spark, texts, [(i, int(i % 3 != 0), 0) for i in range(0, 300, 2)])
    features = C.common.written(C.featurize(docs), "features")
    plans = []
    real, keys = type(features).toArrow, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    before = {k: spark.conf.get(k) for k in keys}
    type(features).toArrow = spy
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        C.fit(features, labels, rounds=1, per_round=5)
    finally:
        type(features).toArrow = real
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plans
    for plan in plans:
        assert "SortMergeJoin [h" not in plan
        # the wide side of every join by id stays in place
        for line in plan.splitlines():
            assert not ("SortMergeJoin [doc_id" in line and "Inner" in line and "text_x" in plan.split(line)[1].split("Exchange")[1][:400]), plan
