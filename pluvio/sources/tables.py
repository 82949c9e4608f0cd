"""Table scans: Parquet, named views for Spark SQL, partitioned warehouse
tables with partition pruning, disaster-register exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.operators.labels import normalize_columns


def named_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Register DataFrames as temporary views for ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def warehouse_scan(spark: SparkSession, path: str, year_lo: int, year_hi: int,
                   cols: Sequence[str] | None = None, year_col: str = "ano") -> DataFrame:
    """Hosted-table scan: a Parquet table partitioned by ``year_col``; the
    year range prunes partitions (only matching folders are listed/read)."""
    df = spark.read.parquet(path).filter(F.col(year_col).between(year_lo, year_hi))
    return df.select(*cols) if cols else df


def register_scan(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: str | None = None, sep: str = ",") -> DataFrame:
    """Disaster-register export (CSV or Parquet) with normalised names.
    CSV is read with an explicit schema when given (no inference pass)."""
    if fmt == "csv":
        r = spark.read.option("header", True).option("sep", sep)
        r = r.schema(schema) if schema else r.option("inferSchema", True)
        df = r.csv(path)
        first = df.columns[0]
        if first.startswith("﻿"):
            df = df.withColumnRenamed(first, first.lstrip("﻿"))
    else:
        df = spark.read.parquet(path)
    return normalize_columns(df)


def coercion_errors(raw: DataFrame, typed: Mapping[str, Column], key: str) -> DataFrame:
    """One row per text value that coercion turns into NULL: (key, coluna, motivo,
    valor). ``typed`` has the coerced form of each text column. ``motivo``: ``vazio`` for
    blanks, ``nao_inteiro`` for numbers that are not whole, else ``invalido``. A NULL
    text is no error."""
    def entry(name: str, value: Column) -> Column:
        text = F.col(f"`{name}`").cast("string")
        why = (F.when(F.trim(text) == "", "vazio").when(text.try_cast("double").isNotNull(), "nao_inteiro")
               .otherwise("invalido"))
        return F.when(text.isNotNull() & value.isNull(), F.struct(
            F.lit(name).alias("coluna"), why.alias("motivo"), text.alias("valor")))
    found = F.array_compact(F.array(*[entry(n, v) for n, v in typed.items()]))
    return raw.select(F.col(key), F.explode(found).alias("e")).select(key, "e.*")
