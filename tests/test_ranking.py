"""Row numbers without a window over a group."""

import random

from pyspark.sql import functions as F

from giftlink.operators import ranking


def test_numbers_equal_row_number_with_a_hot_group(spark):
    random.seed(3)
    rows = [(random.choice(["hot"] * 5 + ["a", "b", None]), random.choice([None, 1, 2, 3]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, d int, id long").repartition(7)
    got = {r["id"]: r["no"] for r in ranking.numbered(df, "g", [F.desc_nulls_last("d"), F.asc("id")], "no").collect()}
    by = {}
    for g, d, i in rows:
        by.setdefault(g, []).append((d is None, -(d or 0), i))
    assert got == {x[2]: k for v in by.values() for k, x in enumerate(sorted(v))}
    assert ranking.numbered(df.limit(0), "g", [F.asc("id")]).count() == 0


def test_no_window_over_the_rows(spark):
    """One group: every task of the numbering keeps its own range."""
    df = spark.range(20_000).select(F.lit("hot").alias("g"), F.col("id"))
    out = ranking.numbered(df, "g", [F.asc("id")], "no")
    assert out.where("id <> no").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Window")]
    assert "Join" in above and "HashAggregate" in plan[plan.index("Window"):]  # the window reads counts only
