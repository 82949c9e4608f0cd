"""Shared plan helpers: table scans and result finishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.functions.scalars import utc_wall_clock


def read(spark: SparkSession, sf_dir: str, name: str, cols: list[str] | None = None) -> DataFrame:
    """Parquet scan of one shared table; the projection reaches the scan. The
    files are listed anew for every query, so appended files are seen."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns so results compare across engines (sums in a
    different order differ in the last bits)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # two-step rounding: values that differ by an ulp (another
            # summation order) meet at 9 digits before the final cut
            out.append(F.round(F.round(F.col(f.name), 9), digits).alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            # wall-clock UTC value, independent of the client's and the session's zone
            out.append(utc_wall_clock(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
