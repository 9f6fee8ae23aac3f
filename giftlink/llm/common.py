"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from giftlink.session import materialize


def ship(module_name: str) -> None:
    """Send a module's functions inside the task, so that executors need no
    copy of the package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = 1000


def in_small_batches(docs: DataFrame) -> DataFrame:
    """``docs`` itself; its session hands rows to Python in record batches of
    at most ``BATCH_ROWS`` rows, unless the setting was changed from Spark's
    10,000. Rows are whole documents here, and a batch is held several times
    over (JVM vectors, the stream, Python)."""
    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", docs.sparkSession.conf
    if conf.get(key, "10000") == "10000":
        conf.set(key, str(BATCH_ROWS))
    return docs


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    return materialize(df, f"llm-{name}")


def file_bytes(path: str) -> bytes:
    """A vocabulary file (a few MB, not input data), read on the driver and
    broadcast, so executors need no copy of it."""
    with open(path, "rb") as f:
        return f.read()


def vocabulary(name: str) -> str:
    """Default place of the public vocabulary files; every operator takes
    the path as a parameter."""
    import public_tokenizers
    return public_tokenizers.path(name)


def schema_of(df: DataFrame, kept: str, rest: str) -> str:
    """Output schema: the columns ``kept`` (comma separated) as ``df`` has
    them, then ``rest``."""
    cols = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept.split(",")]
    return ", ".join([*cols, rest])

