"""Spark session defaults for pluvio jobs.

All settings are the ones a Spark user sets on a cluster: UTC session time
zone (hour keys are UTC, local days are derived explicitly), ANSI mode kept on
(coercions use ``try_cast`` / ``try_to_timestamp``), AQE with partition
coalescing and skew-join splitting, and a shared checkpoint directory.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # partition discovery lists in chunky tasks instead of one per folder
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "pluvio",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with pluvio's defaults.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, named by the cluster in
    ``spark.checkpoint.dir``.

    Only when the setting is absent (tests, a laptop) a folder inside the SQL
    warehouse is used, which driver and executors share by definition; never a
    machine-local temporary folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_pluvio"
        spark.conf.set("spark.checkpoint.dir", d)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


_written: list[str] = []
_tables: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder, remembered for :func:`drop_tables`."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def persist_table(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage and lets several consumers share one computation
    (a lost executor then re-reads files instead of recomputing the plan)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def bucketed_table(df, name: str, keys, buckets: int):
    """Write ``df`` bucketed and sorted by ``keys`` under the shared folder, one file per
    bucket, and read it back as a table of the session: joins and groupings on the keys
    with a table of as many buckets need no shuffle, however often they run."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
       .option("compression", "zstd").option("path", path).saveAsTable(table))
    _tables.append(table)
    return spark.table(table)


def drop_tables(spark: SparkSession) -> int:
    """Delete what :func:`persist_table`, :func:`bucketed_table` and :func:`scratch_path` wrote so far.
    For the owner of the results, once they are collected or written: a lazy
    DataFrame over a dropped table can no longer be read. Returns the number of
    folders."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n
