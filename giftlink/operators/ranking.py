"""Numbering rows inside groups of any size (G2).

``row_number`` over a group puts the whole group into one task. Here rows are
sorted by ranges of (group, order) instead: every range is a task's sorted run,
the rows of each group are counted per range, and a row's number is the count
of its group's rows in the ranges before plus its place in its own. Only the
counts, one for each group and range, are summed up over a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def numbered(rows: DataFrame, group: str, order: list, column: str = "row_no") -> DataFrame:
    """``rows`` with ``column``: the row's place, from 0, among those with its
    value of ``group`` (nulls are a group) by the sort expressions ``order``,
    which should leave no ties: rows that tie in all of them are numbered as
    they come."""
    inside = {c: f"_{c}_{column}" for c in ("range", "row", "first", "before")}
    sort = [F.col(group).asc_nulls_first(), *order]
    runs = materialize(
        rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
        .withColumns({inside["range"]: F.spark_partition_id(), inside["row"]: F.monotonically_increasing_id()}), "ranges")
    in_group = Window.partitionBy("_g").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    starts = (runs.groupBy(F.col(group).alias("_g"), F.col(inside["range"]).alias("_r"))
              .agg(F.count(F.lit(1)).alias("_n"), F.min(inside["row"]).alias(inside["first"]))
              .withColumn(inside["before"], F.coalesce(F.sum("_n").over(in_group), F.lit(0))).drop("_n"))
    at = F.col(inside["before"]) + F.col(inside["row"]) - F.col(inside["first"])
    return (runs.join(starts, F.col(group).eqNullSafe(F.col("_g")) & (F.col(inside["range"]) == F.col("_r")))
            .withColumn(column, at).select(*rows.columns, column))
