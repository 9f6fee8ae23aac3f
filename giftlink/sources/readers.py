"""Feed and table readers (A1–A6).

Exports are read by their header names: a platform may add columns or change
their order. Every column is read as text and the declared ones are selected
and cast with ``try_cast``; a declared column that a header lacks is an error.
What cannot be read is kept for the job's reject report: a malformed line in
``_corrupt_record``, the names of columns whose text does not cast in
``_bad_values``.
"""

from __future__ import annotations

import csv
import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"
BAD = "_bad_values"


def _text_schema(names) -> StructType:
    return StructType([*[StructField(n, StringType(), True) for n in names], StructField(CORRUPT, StringType(), True)])


def typed(df: DataFrame, schema: StructType, *extra: str) -> DataFrame:
    """The declared columns of an all-text table, cast, then ``_corrupt_record``,
    ``_bad_values`` and the columns ``extra``."""
    missing = [f.name for f in schema.fields if f.name not in df.columns and f.name != CORRUPT]
    if missing:
        raise ValueError(f"the header lacks the columns {missing}; it has {[c for c in df.columns if c != CORRUPT]}")
    cols, bad = [], []
    for f in schema.fields:
        raw = F.col(f"`{f.name}`")
        if f.name == CORRUPT:
            continue
        if isinstance(f.dataType, StringType):
            cols.append(raw)
            continue
        value = raw.try_cast(f.dataType)
        cols.append(value.alias(f.name))
        bad.append(F.when(raw.isNotNull() & (F.trim(raw) != "") & value.isNull(), F.lit(f.name)))
    wrong = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return df.select(*cols, CORRUPT, wrong.alias(BAD), *extra)


def _by_header(spark: SparkSession, path) -> list:
    """(header, files) groups of the files under ``path``: the driver reads
    one line of each export file, of which a month has a few."""
    groups: dict = {}
    for f in spark.read.text(path).inputFiles():
        f = unquote(f)
        head = tuple(spark.read.option("header", True).option("encoding", "UTF-8").csv(f).columns)
        groups.setdefault(head, []).append(f)
    return list(groups.items())


def read_feed(spark: SparkSession, path, schema: StructType) -> DataFrame:
    """A1: delimited export with a header row, UTF-8; a path or several."""
    out = None
    for head, files in _by_header(spark, path):
        part = (spark.read.schema(_text_schema(head))
                .option("header", True).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", False)
                .option("columnPruning", False)  # else short lines pass unnoticed
                .csv(files).withColumn("source_file", F.col("_metadata.file_path")))
        # Spark refuses a scan of the corrupt column alone (a count of good
        # lines, say), so it is tied to a real column by an empty string
        part = part.withColumn(CORRUPT, F.concat(CORRUPT, F.substring(F.coalesce(F.col(f"`{head[0]}`"), F.lit("")), 1, 0)))
        part = typed(part, schema, "source_file")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise FileNotFoundError(f"no export files under {path}")
    return out


def read_report(spark: SparkSession, path, schema: StructType, skip_head: int,
                skip_foot: int) -> DataFrame:
    """A2: export with ``skip_head`` preamble lines before the header and
    ``skip_foot`` trailer lines.

    Lines are read split by split; a line's number is its place in its split
    plus the lines of the file's earlier splits, so a large report is not
    one task. Header lines (one per file) are read by the driver; files with
    equal headers are parsed together. Quoted fields holding a line break are
    not supported: such a line fails to parse and lands in
    ``_corrupt_record``."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"))
    splits = lines.groupBy("source_file", "split").agg(F.min("id").alias("lo"), F.count(F.lit(1)).alias("n"))
    file = W.partitionBy("source_file")
    splits = (splits.withColumn("before", F.coalesce(F.sum("n").over(
        file.orderBy("split").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("total", F.sum("n").over(file)))
    numbered = lines.join(splits, ["source_file", "split"]).withColumn(
        "no", F.col("before") + F.col("id") - F.col("lo"))
    groups: dict = {}
    for r in numbered.where(F.col("no") == skip_head).select("source_file", "value").collect():
        groups.setdefault(tuple(next(csv.reader([r["value"].rstrip("\r")]))), []).append(r["source_file"])
    data = numbered.where((F.col("no") > skip_head) & (F.col("no") < F.col("total") - skip_foot))
    out = None
    for head, files in groups.items():
        ddl = ", ".join(f"`{n}` string" for n in (*head, CORRUPT))
        part = (data.where(F.col("source_file").isin(files))
                .select("source_file", F.from_csv(F.regexp_replace("value", r"\r$", ""), ddl, {
                    "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
                .select("source_file", "r.*"))
        part = typed(part, schema, "source_file")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError(f"no header line {skip_head} under {path}")
    return out


def period_folder(period: dt.date) -> str:
    """Folder name of a monthly export: 'Month Year' (e.g. 'March 2024')."""
    return f"{period:%B %Y}"


def read_period(spark: SparkSession, root: str, feed: str, period: dt.date, schema: StructType,
                layout: str = "folders", skip_head: int = 0, skip_foot: int = 0) -> DataFrame:
    """A3: one feed's export for one month.

    ``folders``: root/feed/'Month Year'/ (the platforms' layout).
    ``partitioned``: root/feed=<feed>/period=<yyyy-MM>/. Either way only that
    month's folder is listed."""
    if layout == "partitioned":
        path = f"{root}/feed={feed}/period={period:%Y-%m}"
    else:
        path = f"{root}/{feed}/{period_folder(period)}"
    if skip_head or skip_foot:
        return read_report(spark, path, schema, skip_head, skip_foot)
    return read_feed(spark, path, schema)


def read_months(spark: SparkSession, root: str, feed: str, months: list, schema: StructType,
                layout: str = "folders", skip_head: int = 0, skip_foot: int = 0) -> DataFrame:
    """A3 for a backfill: one feed's exports of several months in one scan,
    each row with the month its file belongs to (``_period``, the first day).
    Only the folders of these months are listed; a month is found in the
    file's path, so exports need not carry it."""
    if layout == "partitioned":
        paths = [f"{root}/feed={feed}/period={m:%Y-%m}" for m in months]
        text, fmt = F.regexp_extract("_path", r"/period=(\d{4}-\d{2})/", 1), "yyyy-MM"
    else:
        paths = [f"{root}/{feed}/{period_folder(m)}" for m in months]
        text, fmt = F.element_at(F.split("_path", "/"), -2), "MMMM yyyy"
    df = (read_report(spark, paths, schema, skip_head, skip_foot) if skip_head or skip_foot
          else read_feed(spark, paths, schema))
    path = F.url_decode(F.replace("source_file", F.lit("+"), F.lit("%2B")))
    return df.withColumn("_path", path).withColumn("_period", F.to_date(text, fmt)).drop("_path")


def read_weekly(spark: SparkSession, folder: str, schema: StructType, fmt: str = "csv") -> DataFrame:
    """A4: every weekly file of the folder as one table, with its source
    file for lineage."""
    if fmt == "csv":
        return read_feed(spark, folder, schema)
    df = spark.read.parquet(folder).withColumn("source_file", F.col("_metadata.file_path"))
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields], "source_file")


def read_code_book(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A5: the campaign code book with an ``ordinal`` in file order, so
    ``feeds.code_book`` can keep the first row of a repeated campaign. The
    ordinal is taken right after the scan, where row ids follow the file's
    own order (partition by partition, offset by offset)."""
    return read_feed(spark, path, schema).withColumn("ordinal", F.monotonically_increasing_id())


def read_table(spark: SparkSession, source, columns: list | None = None, predicate=None,
               partition: tuple | None = None) -> DataFrame:
    """A5/A6: a reference or CRM table from a parquet path or JDBC options
    (dict with url, dbtable, ...). Column selection and the predicate are
    pushed to the scan by Catalyst in both cases. ``partition`` = (numeric or
    date column, lower bound, upper bound, partitions) reads a JDBC table in
    that many tasks; rows outside the bounds are read too."""
    if isinstance(source, dict):
        options = dict(source)
        if partition:
            column, low, high, n = partition
            options |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high),
                        "numPartitions": str(n)}
        df = spark.read.format("jdbc").options(**options).load()
    else:
        df = spark.read.parquet(source)
    if columns:
        df = df.select(*columns)
    if predicate is not None:
        df = df.where(predicate)
    return df
