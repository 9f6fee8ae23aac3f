"""The pipeline's stages, each on what the one before it kept."""

import numpy as np

import corpus_pipeline
from giftlink.llm import common, packing
from giftlink.llm import order_minhash as M
from test_suffix_dedup import brute as repeated_bytes

SF = "/root/testdata/sf0.001"


def near_classes(texts):
    """Classes by the alignment of all pairs of whole texts."""
    words = [M.word_hashes((t or "").lower().split(), {}) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            a, b = sorted((find(i), find(j)))
            if a != b and M.aligned(words[i], words[j]):
                root[b] = a
    return [find(i) for i in range(len(texts))]


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = common.written(corpus_pipeline.quality(spark, docs, SF), "t")
    assert kept.columns == columns and 0 < kept.count() < docs.count()
    rows = sorted(kept.collect(), key=lambda r: r.doc_id)
    assert set(rows) <= set(docs.collect())

    one = common.written(corpus_pipeline.near_dedup(spark, kept, SF), "t")
    assert one.columns == columns
    classes = near_classes([r.text for r in rows])
    assert sorted(r.doc_id for r in one.collect()) == sorted({rows[c].doc_id for c in classes})

    rows = sorted(one.collect(), key=lambda r: r.doc_id)
    cut = common.written(corpus_pipeline.suffix(spark, one, SF), "t")
    assert cut.schema == one.schema
    got = {r.doc_id: r for r in cut.collect()}
    for r, mask in zip(rows, repeated_bytes([r.text for r in rows], corpus_pipeline.PASSAGE_BYTES)):
        rest = bytes(b for b, m in zip(r.text.encode(), mask) if not m)
        assert got[r.doc_id].text == rest.decode("utf-8", "ignore")
        assert got[r.doc_id].n_chars == len(got[r.doc_id].text)

    words = packing.Words(common.file_bytes(common.vocabulary("word_bpe_49k.json")))
    pieces = {}
    for p in corpus_pipeline.pack(spark, cut, SF).collect():
        pieces.setdefault(p.doc_id, []).append((p.start, p.ids))
    for i, r in got.items():
        assert [x for _, ids in sorted(pieces[i]) for x in ids] == np.frombuffer(words.document(r.text)[0],
                                                                                 "<u4").tolist()


def test_run_is_the_chain_of_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len({r.doc_id for r in rows}) > 100
    assert len(corpus_pipeline.STAGES) == 4 and corpus_pipeline.ORACLE_SQL is None


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_suffix_keeps_the_texts_own_replacement_characters(spark, monkeypatch):
    import corpus_pipeline
    from pyspark.sql import functions as F
    kept = "a\ufffdb\ufdd01\ufdd00".encode() + "\u20ac".encode()[:2] + "c\ufffd".encode()
    docs = spark.createDataFrame([(1, "whole text", 10)], "doc_id long, text string, n_chars int")
    monkeypatch.setattr(corpus_pipeline.suffix_dedup, "judged", lambda d, keep, **_: d.select(
        F.struct(*keep).alias("row"), F.lit(kept).alias("kept"), F.lit(1).alias("n_removed")))
    row = corpus_pipeline.suffix(spark, docs, "").first()
    assert row.text == "a\ufffdb\ufdd01\ufdd00c\ufffd" and row.n_chars == len(row.text)


CLASHES = ["_th", "_k", "th", "kept", "w", "_b", "row", "n_removed", "spans", "n_bytes", "p_quality", "p_text", "h", "t", "m",
           "text_x", "keep", "rest", "best", "ids", "start", "a b"]


def test_columns_of_any_name_come_back_from_every_stage(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in CLASHES])
    docs = common.written(docs, "t")
    before = {r.doc_id: r for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, SF), "t")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASHES]
        rows = docs.collect()
        assert 0 < len(rows) <= len(before)
        assert all(r[c] == before[r.doc_id][c] for r in rows for c in CLASHES)
    assert "ids" in corpus_pipeline.pack(spark, docs, SF).columns


def test_passages_of_51_words_go(spark):
    import random
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8)))
    passage = " ".join(word() for _ in range(51))
    assert 271 <= len(passage) <= 394
    alone = [" ".join(word() for _ in range(120)) for _ in range(12)]
    texts = [t[:200] + " " + passage + " " + t[200:] if i % 3 == 0 else t for i, t in enumerate(alone)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for r in corpus_pipeline.suffix(spark, docs, "").collect():
        assert passage not in r.text
        if r.doc_id % 3:
            assert r.text == texts[r.doc_id]
        else:
            assert abs(len(r.text) - len(alone[r.doc_id])) < 6
