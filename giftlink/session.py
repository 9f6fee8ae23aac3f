"""Spark session defaults and lineage cutting.

Everything the engine does is a DataFrame plan; this module only holds the
session settings those plans rely on (AQE for runtime broadcast and skew
splitting, Arrow for the one Python hop) and the helper that writes an
intermediate table to the shared checkpoint folder so that a lost executor
does not force a long recomputation.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list = []

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE turns a shuffle join into a broadcast join only after the stage has
    # run and the side's real size is known: this is the size check behind
    # every broadcast we do not force ourselves.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "giftlink", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if (master or "").startswith("local"):
        # local mode: the driver heap is the only executor memory there is;
        # nothing else differs from a cluster
        conf["spark.driver.memory"] = os.environ.get("GIFTLINK_DRIVER_MEMORY", "8g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    Taken from the session (``spark.checkpoint.dir`` or the context's
    checkpoint directory). Only a local-mode session without either gets a
    fresh folder of its own, as in tests; on a cluster the setting is
    required because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = tempfile.mkdtemp(prefix="giftlink-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Cuts the lineage of a table that several later stages reuse (pool
    membership is read by the λ, u, TF and pair stages) and gives AQE real
    file statistics for the next joins. ``partition_by``: one folder for each
    value of that column, for readers that want one of them.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    _WRITTEN.append(path)
    out = spark.read.parquet(path)
    out._materialized_at = path
    return out


def _delete(spark: SparkSession, path: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))


def drop_table(df: DataFrame) -> None:
    """Delete a table that ``materialize`` returned, once everything made from
    it has been written itself."""
    path = getattr(df, "_materialized_at")
    if path in _WRITTEN:
        _WRITTEN.remove(path)
        _delete(df.sparkSession, path)


def drop_materialized(spark: SparkSession) -> int:
    """Delete the tables that ``materialize`` has written in this process.
    Call it when a job's results are stored: plans that still read them fail
    afterwards. Returns how many were deleted."""
    n = 0
    while _WRITTEN:
        n += _delete(spark, _WRITTEN.pop())
    return n
