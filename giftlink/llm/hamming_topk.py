"""Exact top-k search over binary codes: incremental multi-index hashing.

A 64-bit code is cut into ``m`` segments and every segment is indexed by its
value; ``m`` is the number with the least expected work for as many codes. A round with radius ``s`` probes,
for each query that is still open, every segment value at Hamming distance
``s``; with the rounds before, all values up to ``s``. A code at distance
``m * (s + 1) - 1`` or less differs in ``s`` bits or fewer in some segment, so
it has then been seen and verified. A query is closed when its kth verified
distance is no more than that: nothing nearer, and no tie, can be missing.

Rows with equal codes are one entry with its ``k`` smallest ids (more cannot
be in a result), so a code that very many rows share costs one entry. Probes
are equi-joined with the index; a hit is verified inside the join and goes on
only if it is no farther than the query's kth distance so far. Each round's
hits are written to the shared folder; the driver reads one count per round.
Probes are made from few queries by an explode, so their small files say
nothing about their size: the join is asked for as a shuffle join.

Defined results: the codes of vectors are the signs of their components (64
of them; longer vectors are folded, shorter ones padded with zero bits);
vectors that are null, or hold a null or non-finite component, take no part;
a query's own row is one of the rows it is searched against; ties go to the
smaller id, null ids last; repeated rows each count; with fewer than k rows
all are returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from giftlink.llm import common

BITS = 64
K = 10


def sign_codes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, code long): bit i is set if the sum of the components i, i + 64,
    ... is above zero."""
    v = F.col("_v")
    usable = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    folded = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.aggregate(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(v) - 1 - i) / BITS).cast("int"), F.lit(-1))),
        F.lit(0.0), lambda a, t: a + F.coalesce(F.get(v, t * BITS + i), F.lit(0.0))))
    code = F.aggregate(folded, F.struct(F.lit(0).cast("long").alias("c"), F.lit(1).cast("long").alias("b")),
                       lambda a, x: F.struct(
                           F.when(x > 0, a["c"].bitwiseOR(a["b"])).otherwise(a["c"]).alias("c"),
                           F.shiftleft(a["b"], 1).alias("b")), lambda a: a["c"])
    return (vectors.select(F.col(id_col), F.col(vec_col).cast("array<double>").alias("_v")).where(usable)
            .select(id_col, code.alias("code")))


def segments(m: int) -> list:
    """(shift, width) of ``m`` nearly equal segments of a code."""
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def choose_segments(n: int, k: int) -> int:
    """The number of segments with the least expected probes and candidates
    per query, if ``n`` codes were random: the kth distance r is where the
    binomial count of nearer codes reaches k, radius s must cover it, and a
    probe of w bits meets n / 2**w codes. A probe, which is shuffled, counts
    as four candidates, which are compared in place."""
    near, r = 0.0, 0
    for r in range(BITS + 1):
        near += n * math.comb(BITS, r) / 2.0 ** BITS
        if near >= k:
            break

    def cost(m):
        s, w = (r + m) // m - 1, BITS / m
        probes = m * sum(math.comb(round(w), i) for i in range(min(s, round(w)) + 1))
        return probes * (4 + n / 2.0 ** w)

    return min(range(2, 17), key=cost)


def _value(code: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(code, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _masks(width: int, s: int) -> Column:
    """All masks of ``width`` bits with ``s`` of them set, as a constant."""
    masks = [sum(1 << b for b in bits) for bits in itertools.combinations(range(width), s)]
    return F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>")


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def search(codes: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id") -> DataFrame:
    """The ``k`` nearest rows of ``codes`` (id, code) to every row of
    ``queries`` (id, code): query_id, rank, id, distance."""
    ranked = (codes.withColumn("_n", F.row_number().over(
        W.partitionBy("code").orderBy(F.col(id_col).asc_nulls_last()))).where(F.col("_n") <= k))
    entries = common.written(ranked.groupBy("code").agg(F.sort_array(F.collect_list(
        F.struct(F.col(id_col).isNull().alias("u"), F.col(id_col).alias("id")))).alias("ids")), "codes")
    n = entries.count()
    m = choose_segments(n, k)
    parts = segments(m)
    index = common.written(entries.select("code", F.size("ids").alias("rows"), F.posexplode(F.array(
        *[_value(F.col("code"), a, w) for a, w in parts])).alias("seg", "val")), "index")
    queries = queries.select(F.col(id_col).alias("query_id"), F.col("code").alias("q"))
    open_ = common.written(queries.select("q").distinct().withColumn("bound", F.lit(BITS)), "open")
    found = None
    for s in range(max(w for _, w in parts) + 1):
        probes = None
        for i, (shift, width) in enumerate(parts):
            if s <= width:
                one = open_.select("q", "bound", F.lit(i).alias("seg"), F.explode(_masks(width, s) if s else F.array(
                    F.lit(0).cast("long"))).alias("mask"))
                one = one.select("q", "bound", "seg", _value(F.col("q"), shift, width).bitwiseXOR(F.col("mask"))
                                 .alias("val"))
                probes = one if probes is None else probes.unionAll(one)
        p, x = probes.hint("merge").alias("p"), index.alias("x")
        hits = (p.join(x, (F.col("p.seg") == F.col("x.seg")) & (F.col("p.val") == F.col("x.val"))
                       & (_distance("q", "code") <= F.col("bound")))
                .select("q", "code", "rows", _distance("q", "code").alias("distance")))
        hits = (hits if found is None else hits.unionAll(found)).distinct()
        # rows seen up to each distance; the kth one gives the bound
        upto = F.sum("rows").over(W.partitionBy("q").orderBy("distance")
                                  .rangeBetween(W.unboundedPreceding, W.currentRow))
        kth = F.min(F.when(F.col("upto") >= k, F.col("distance"))).over(W.partitionBy("q"))
        found = common.written(hits.withColumn("upto", upto)
                               .withColumn("bound", F.coalesce(kth, F.lit(BITS)))
                               .where(F.col("distance") <= F.col("bound")), f"found-{s}")
        proven = m * (s + 1) - 1
        bounds = found.groupBy("q").agg(F.max("bound").alias("b"))
        open_ = common.written(open_.join(bounds, "q", "left")
                               .select("q", F.coalesce("b", "bound").alias("bound"))
                               .where(F.col("bound") > proven), f"open-{s}")
        found = found.select("q", "code", "rows", "distance")
        if open_.isEmpty():
            break
    rows = found.join(entries, "code").select("q", "distance", F.explode("ids").alias("e"))
    best = (rows.withColumn("rank", F.row_number().over(
        W.partitionBy("q").orderBy("distance", "e.u", "e.id"))).where(F.col("rank") <= k))
    return queries.join(best, "q").select("query_id", "rank", F.col("e.id").alias(id_col), "distance")
