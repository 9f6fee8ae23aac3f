"""Acceptance queries q19–q28 on the ``people`` view (Spark side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LinkageSettings
from ..operators import blocking, candidates, params, scoring
from . import views
from .linkage import Linkage

R6 = 6


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.prepare_records(views.people(spark, sf_dir))


def q19_candidates(spark, sf_dir):
    return candidates.retrieve_candidates(_records(spark, sf_dir))


def q20_containment_pools(spark, sf_dir):
    recs = _records(spark, sf_dir)
    return candidates.name_pools(recs).join(recs.select("record_id", "side"), "record_id").select(
        "pool_id", "record_id", "side")


def q21_pool_sizes(spark, sf_dir):
    return (candidates.build_pools(_records(spark, sf_dir))
            .groupBy("pool_id", "via").agg(F.count(F.lit(1)).alias("n")))


def _linkage(spark, sf_dir, settings=None, collapse: bool = False) -> Linkage:
    return Linkage.build(views.people(spark, sf_dir), settings or LinkageSettings(), collapse=collapse)


def q22_comparison_vectors(spark, sf_dir):
    lk = _linkage(spark, sf_dir)
    return lk.compared(extra=()).select("record_id_l", "record_id_r", "match_key",
                                *[f"gamma_{c.column}" for c in lk.settings.comparisons])


def q23_global_blocking(spark, sf_dir):
    return (blocking.count_blocked_pairs(_records(spark, sf_dir), LinkageSettings())
            .where(F.col("pairs") > 0).select("match_key", "rule", "pairs"))


def q24_pool_anchor(spark, sf_dir):
    return candidates.pool_latest(_linkage(spark, sf_dir).members)


def q25_lambda(spark, sf_dir):
    lk = _linkage(spark, sf_dir)
    return params.estimate_lambda(lk.members, lk.settings, lk.cube()).select(
        "pool_id", "n", "pairs", "hit_pairs", F.round("lam", 9).alias("lam"))


def q26_u_tf(spark, sf_dir):
    lk = _linkage(spark, sf_dir)
    u = params.estimate_u(lk.members, lk.settings, lk.cube()).select(
        "pool_id", F.lit("u").alias("kind"), "column", F.col("level").cast("string").alias("item"),
        F.col("pairs").alias("n"), "total", F.round("u", 9).alias("share"))
    tf = params.term_frequencies(lk.members, params.tf_columns(lk.settings), lk.cube()).select(
        "pool_id", F.lit("tf").alias("kind"), "column", F.col("v").alias("item"),
        F.col("c").alias("n"), F.col("n_nn").alias("total"), F.round("tf", 9).alias("share"))
    return u.unionByName(tf)


def q27_scores(spark, sf_dir):
    lk = _linkage(spark, sf_dir)
    # rounded and flagged once a class pair
    s = scoring.agreement_flags(lk.class_scored(extra=())).withColumns(
        {c: F.round(c, R6) for c in ("match_weight", "match_probability")})
    return blocking.fan_out(s, lk.settings).select(
        "record_id_l", "record_id_r", "match_key", "match_weight", "match_probability", "name_ok", "email_ok")


def q28_best_match(spark, sf_dir):
    b = _linkage(spark, sf_dir, collapse=True).best()
    return b.select("record_id", F.round("match_probability", R6).alias("match_probability"),
                    F.round("match_weight", R6).alias("match_weight"), "constituent", "matched_record_id")


def q31_latest_anchor(spark, sf_dir):
    """Best match with one anchor per pool, its latest record."""
    b = _linkage(spark, sf_dir, LinkageSettings(anchor="latest")).best()
    return b.select("record_id", F.round("match_probability", R6).alias("match_probability"),
                    F.round("match_weight", R6).alias("match_weight"), "constituent", "matched_record_id")


def q34_pool_order(spark, sf_dir):
    return candidates.pool_order(_linkage(spark, sf_dir).members).select("pool_id", "record_id", "row_no")


QUERIES = {f.__name__: f for f in (
    q19_candidates, q20_containment_pools, q21_pool_sizes, q22_comparison_vectors, q23_global_blocking,
    q24_pool_anchor, q25_lambda, q26_u_tf, q27_scores, q28_best_match, q31_latest_anchor,
    q34_pool_order)}
