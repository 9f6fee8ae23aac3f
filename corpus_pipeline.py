"""Corpus pipeline: documents to packed training sequences, in stages.

Each stage works on all rows that the one before it kept. ``run`` writes
every stage's result to the shared folder and reads it back. All but the last
stage return the columns of ``documents`` and whatever further columns the
table has, under any names: they travel as one struct through the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from giftlink.llm import common, cotraining, order_minhash, packing, suffix_dedup


#: Passages of more than 50 words that repeat go; such a passage has 256 bytes
#: or more wherever its words have four letters on average. (The 400 bytes of
#: op5 belong to that query alone.)
PASSAGE_BYTES = 256
PASSAGE_GRAM = 64


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    scored = cotraining.scored_rows(docs, common.table(spark, sf_dir, "labels"), docs.columns)
    return scored.where(F.col("p_quality") >= cotraining.KEEP_FROM).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return order_minhash.deduplicate(docs)


def suffix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that repeat. A character that loses part
    of its bytes goes as a whole; a document that loses all its text stays,
    empty. ``n_chars`` follows the text."""
    out = suffix_dedup.judged(docs, keep=docs.columns, length=PASSAGE_BYTES, gram=PASSAGE_GRAM)
    cut = F.col("n_removed") > 0
    # the text's own U+FFFD are written as mark + 1 (and the mark as mark + 0)
    # while those that stand for broken bytes are deleted
    rest = F.col("kept").cast("string")
    for old, new in (("\ufdd0", "\ufdd00"), ("\ufffd", "\ufdd01")):
        rest = F.replace(rest, F.lit(old), F.lit(new))
    rest = F.make_valid_utf8(rest)
    for old, new in (("\ufffd", ""), ("\ufdd01", "\ufffd"), ("\ufdd00", "\ufdd0")):
        rest = F.replace(rest, F.lit(old), F.lit(new))
    out = out.withColumn("rest", F.when(cut, rest).otherwise(F.col("row.text")))
    length = F.when(cut, F.length("rest").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    changed = {"text": F.col("rest"), "n_chars": length}
    return out.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    return packing.pack(docs)


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_dedup), ("suffix-array dedup", suffix),
          ("packing", pack)]
#: No stage can be stated in SQL; tests/llm holds them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = common.written(docs, f"stage-{i}")
    return docs
