"""Sinks: header CSV, ZSTD Parquet, one Parquet folder per station.

Outputs are directories written by the executors (no forced single file).
Scratch output goes under the shared checkpoint folder of the session, never
a machine-local folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio import session

STATION_FOLDER = "pasta"
BOM = "﻿"
# microsecond timestamps survive the text round trip (defaults keep milliseconds)
TS_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
              "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def scratch_path(df: DataFrame, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir`` (shared on a cluster)."""
    return session.scratch_path(df.sparkSession, name)


def csv_sink(df: DataFrame, path: str, sep: str = ",", bom: bool = False) -> str:
    """Header CSV with ``sep``; ``bom`` puts a UTF-8 byte-order mark in front
    of the header of every part file."""
    out = df
    if bom and df.columns:
        out = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    out.write.mode("overwrite").option("header", True).option("sep", sep).options(**TS_OPTIONS) \
       .csv(path)
    return path


def read_csv(spark, path: str, schema, sep: str = ",") -> DataFrame:
    """Header CSV with an explicit schema; a BOM in the first name is dropped."""
    df = (spark.read.option("header", True).option("sep", sep).options(**TS_OPTIONS)
          .schema(schema).csv(path))
    first = df.columns[0]
    return df.withColumnRenamed(first, first.lstrip(BOM)) if first.startswith(BOM) else df


def text_lines_sink(df: DataFrame, path: str, folder: str, order: str, line: str = "line",
                    encoding: str = "ISO-8859-1") -> str:
    """One folder of raw ``*.csv`` text per value of ``folder``, its lines in
    ``order``, written as they are (no quoting, no trimming)."""
    (df.repartition(folder).sortWithinPartitions(folder, order).select(folder, line)
       .write.mode("overwrite").option("header", False).option("quote", "").option("escapeQuotes", False)
       .option("sep", "\x02").option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False).option("encoding", encoding).partitionBy(folder).csv(path))
    return path


def parquet_zstd_sink(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def per_station_parquet(df: DataFrame, path: str, station: str, folders: int = 64,
                        row_group_bytes: int = 32 << 20, stations_per_file: int = 10_000) -> str:
    """Station files in a bounded number of folders: a folder holds the stations
    of one hash value, sorted by station, so readers of one station open one
    folder and few row groups, however many stations there are. The rebalance
    hint lets AQE split a heavy folder over several tasks. Row groups are small, with
    a bloom filter and page index on the station, so a reader of one station skips the
    row groups and pages of the others."""
    part = F.pmod(F.xxhash64(station), F.lit(folders)).cast("int")
    (df.withColumn(STATION_FOLDER, part).hint("rebalance", STATION_FOLDER)
       .sortWithinPartitions(STATION_FOLDER, station)
       .write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", row_group_bytes)
       .option(f"parquet.bloom.filter.enabled#{station}", "true")
       .option(f"parquet.bloom.filter.expected.ndv#{station}", stations_per_file)
       .partitionBy(STATION_FOLDER).parquet(path))
    return path


def read_station(spark, path: str, schema, station: str, value=None, folders: int = 64) -> DataFrame:
    """The station table with its schema pinned (no discovery of types); with
    ``value`` only the rows of that station, from its folder."""
    df = spark.read.schema(T.StructType([*schema.fields, T.StructField(STATION_FOLDER, T.IntegerType())])).parquet(path)
    if value is not None:
        key = F.pmod(F.xxhash64(F.lit(value).cast(schema[station].dataType)), F.lit(folders))
        df = df.where((F.col(STATION_FOLDER) == key) & (F.col(station) == value))
    return df.select(*schema.fieldNames())
