"""Comparison of two versions of a keyed table (e.g. feature table v3 vs v4).

One inner join on the key feeds every per-column statistic through a single
aggregate (the reference scans the pair once per column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keys_only_in(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``a`` absent from ``b`` (SQL ``EXCEPT``: NULLs equal)."""
    return a.select(*keys).subtract(b.select(*keys))


def _val(df: DataFrame, c: str, digits: int | None):
    """Column value, doubles rounded to ``digits`` when given (so that sums
    accumulated in another order do not count as changes)."""
    t = df.schema[c].dataType.typeName()
    if digits is not None and t in ("double", "float"):
        return F.round(F.col(c), digits)
    return F.col(c)


def version_join(a: DataFrame, b: DataFrame, keys: Sequence[str],
                 cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """Inner join on the key (NULL keys never match); columns ``a_c``/``b_c``."""
    aa = a.select(*keys, *[_val(a, c, digits).alias(f"a_{c}") for c in cols])
    bb = b.select(*keys, *[_val(b, c, digits).alias(f"b_{c}") for c in cols])
    return aa.join(bb, list(keys), "inner")


def changed_values(a: DataFrame, b: DataFrame, keys: Sequence[str],
                   cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """Per column: rows whose value differs (``IS DISTINCT FROM``) among
    the keys present in both versions. Long output (coluna, n_diferentes)."""
    j = version_join(a, b, keys, cols, digits)
    agg = j.agg(*[F.count_if(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))).cast("bigint")
                  .alias(c) for c in cols])
    return agg.select(F.explode(F.array(*[F.struct(F.lit(c).alias("coluna"),
                                                   F.col(c).alias("n_diferentes"))
                                          for c in cols])).alias("r")).select("r.*")


def transition_matrix(a: DataFrame, b: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Counts of (old value, new value) of one column."""
    j = version_join(a, b, keys, [flag])
    return (j.groupBy(F.col(f"a_{flag}").alias("antigo"), F.col(f"b_{flag}").alias("novo"))
             .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def change_direction(a: DataFrame, b: DataFrame, keys: Sequence[str],
                     cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """Per numeric column, over rows where both values exist and differ:
    count, min / max of (new - old), mean absolute difference, and whether
    the new value is never larger."""
    j = version_join(a, b, keys, cols, digits)
    aggs = []
    for c in cols:
        d = F.col(f"b_{c}") - F.col(f"a_{c}")
        d = F.when(d != 0, d)  # NULL where a side is NULL or nothing changed
        aggs.append(F.struct(F.lit(c).alias("coluna"), F.count(d).cast("bigint").alias("n_mudou"),
                             F.min(d).alias("dif_min"), F.max(d).alias("dif_max"),
                             F.avg(F.abs(d)).alias("dif_abs_media")))
    out = j.agg(F.array(*aggs).alias("r")).select(F.inline("r"))
    return out.withColumn("novo_sempre_menor_ou_igual",
                          F.coalesce(F.col("dif_max") <= 0, F.lit(True)))
