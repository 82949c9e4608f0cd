"""Export and consistency checks: schema contract, orphans, row
conservation, residual duplicates, constant columns, territory bounds."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _bare_name(name: str) -> str:
    """Name without accents, case, spaces and marks."""
    plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    return re.sub(r"[^a-z0-9]", "", plain.lower())


def schema_contract_check(spark: SparkSession, df: DataFrame, expected: Sequence[str],
                          aliases: dict[str, str] | None = None) -> DataFrame:
    """Expected vs found columns (names normalised by strip + lower): one row
    per name with status ``ok`` / ``renomeada`` / ``faltando`` / ``extra`` and
    the name ``encontrada``. A missing name is taken as renamed if a column not
    expected otherwise has the same letters and digits (accents, marks and
    spaces aside) or is its alias in ``aliases``.
    Compares schema metadata only; no data is read."""
    found = [c.strip().lower() for c in df.columns]
    exp = [c.strip().lower() for c in expected]
    alias = {k.strip().lower(): v.strip().lower() for k, v in (aliases or {}).items()}
    spare = [c for c in found if c not in exp]
    rows = []
    for c in exp:
        if c in found:
            rows.append((c, "ok", c))
            continue
        new = next((x for x in spare if x == alias.get(c) or _bare_name(x) == _bare_name(c)), None)
        if new is not None:
            spare.remove(new)
        rows.append((c, "renomeada" if new else "faltando", new))
    rows += [(c, "extra", c) for c in spare]
    return spark.createDataFrame(rows, "coluna string, status string, encontrada string")


def orphan_check(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None,
                 weight: str | None = None) -> DataFrame:
    """Rows whose key has no dimension row, and whether a left join keeps
    the row count (a duplicated dimension key would fan out). ``weight``: a row
    of ``df`` stands for that many rows."""
    dk = dim_key or key
    d = dim.groupBy(F.col(dk).alias("__dk")).agg(F.count(F.lit(1)).alias("__m"))
    j = df.select(key, (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("__w")).join(
        d, F.col(key) == F.col("__dk"), "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return j.agg(total(F.col("__w")).alias("n_linhas"),
                 total(F.when(F.col("__dk").isNull(), F.col("__w"))).alias("n_orfaos"),
                 total(F.col("__w") * F.coalesce(F.col("__m"), F.lit(1))).alias("n_apos_join")) \
            .withColumn("contagem_preservada", F.col("n_linhas") == F.col("n_apos_join"))


def part_fingerprints(df: DataFrame, part: str) -> DataFrame:
    """(p, n, f1, f2): rows per ``part`` and two sums of row hashes. The sums do not
    depend on the order of rows, and those of several files of a part add up, so they
    can be kept beside the files. NULL and its place in the row count too."""
    cols = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    row = [F.xxhash64(F.lit(seed), *cols).cast("decimal(38,0)") for seed in (1, 2)]
    return df.groupBy(F.col(part).alias("p")).agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(h).alias(f"f{i}") for i, h in enumerate(row, start=1)])


def merged_fingerprints(*tables: DataFrame) -> DataFrame:
    """Fingerprints of all files of each part together."""
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    return every.groupBy("p").agg(*[F.sum(c).alias(c) for c in ("n", "f1", "f2")])


def row_conservation(source: DataFrame, consolidated: DataFrame, part: str) -> DataFrame:
    """Rows per ``part`` in the source against the consolidated table: one scan
    and one partial aggregate each, no list of parts (any value counts, NULL
    too). ``partes_divergentes`` counts the parts whose rows differ in number,
    ``partes_alteradas`` those with as many rows but another content; conserved
    means neither occurs."""
    a, b = (part_fingerprints(t.select(*source.columns), part) for t in (source, consolidated))
    tagged = a.select("p", F.lit(1).alias("s"), "n", "f1", "f2").unionAll(b.select("p", F.lit(-1).alias("s"), "n", "f1", "f2"))
    side = lambda s: F.sum(F.when(F.col("s") == s, F.col("n")).otherwise(0))
    per = tagged.groupBy("p").agg(side(1).alias("a"), side(-1).alias("b"), F.sum(F.col("s") * F.col("f1")).alias("d1"),
                                  F.sum(F.col("s") * F.col("f2")).alias("d2"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    altered = (F.col("a") == F.col("b")) & ((F.col("d1") != 0) | (F.col("d2") != 0))
    return (per.agg(total("a").alias("n_partes"), F.count_if(F.col("a") > 0).cast("bigint").alias("n_arquivos"),
                    total("b").alias("n_consolidado"),
                    F.count_if(F.col("a") != F.col("b")).cast("bigint").alias("partes_divergentes"),
                    F.count_if(altered).cast("bigint").alias("partes_alteradas"))
               .withColumn("conservado", (F.col("partes_divergentes") == 0) & (F.col("partes_alteradas") == 0)))


def constant_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: distinct non-NULL values (exact), min, max and whether
    the column is constant (zero variance is no evidence)."""
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        aggs += [F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max"),
                 F.count(v).alias(f"{c}__n")]
    a = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("coluna"), F.col(f"{c}__min").alias("minimo"),
                     F.col(f"{c}__max").alias("maximo"),
                     ((F.col(f"{c}__n") > 0) & (F.col(f"{c}__min") == F.col(f"{c}__max")))
                     .alias("constante")) for c in cols]
    return a.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def out_of_territory(lat: str, lon: str, lat_range: tuple[float, float],
                     lon_range: tuple[float, float]) -> Column:
    """True when a point lies outside the bounding region (or has no
    coordinates)."""
    inside = F.col(lat).between(*lat_range) & F.col(lon).between(*lon_range)
    return ~F.coalesce(inside, F.lit(False))
