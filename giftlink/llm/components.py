"""Connected components of a link table, as joins over small tables.

Every round each vertex takes the smallest label among its own and its
neighbours' (a partial aggregate, so a hub with very many links is reduced
before the shuffle), then each label is replaced by its label's label
(pointer jumping), which halves the remaining distance. A round's labels are
written to the shared folder; the driver reads one count per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from giftlink.llm import common
from giftlink.session import drop_table


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, root) for every vertex that has a link; root is the smallest
    vertex of its component. Repeated links and loops do no harm."""
    both = common.written(
        links.select(F.col(a).alias("v"), F.col(b).alias("w"))
        .unionByName(links.select(F.col(b).alias("v"), F.col(a).alias("w"))).distinct(), "links")
    labels = common.written(both.groupBy("v").agg(F.min("w").alias("m"))
                            .select("v", F.least("v", "m").alias("root")), "labels")
    while True:
        now = labels.select("v", "root")
        near = (both.join(now.withColumnRenamed("v", "w"), "w")
                .groupBy("v").agg(F.min("root").alias("m")))
        stepped = now.join(near, "v").select("v", "root", F.least("root", "m").alias("next"))
        jump = now.select(F.col("v").alias("next"), F.col("root").alias("beyond"))
        new = common.written(
            stepped.join(jump, "next")
            .select("v", F.least("next", "beyond").alias("root"), (F.least("next", "beyond") < F.col("root"))
                    .alias("moved")), "labels")
        drop_table(labels)
        if new.where("moved").isEmpty():
            drop_table(both)
            return new.select("v", "root")
        labels = new
