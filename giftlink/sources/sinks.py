"""Result sink (A7): CSV with a header row, no index column."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write the result table. Many part files by default (one per task);
    ``single_file`` sends the finished rows to one writing task and is meant
    for the monthly upload only; the work before it stays parallel."""
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
