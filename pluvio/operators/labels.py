"""Event labels (Y) from a disaster register, and their join onto the
municipality-day feature table (X).

Scale notes
-----------
* ``first_by_key`` dedups with a grouped ``min(struct(tie, ...))``, planned as
  a sort aggregate with a map-side partial step: each map task sorts its rows
  and sends one row per key, so a key holding a third of all rows is one row
  per map task after it (a ``row_number`` window would sort the whole hot key
  in one task).
* Joins carry no broadcast hint: Y is deduplicated to one row per key, and
  AQE turns the join into a broadcast at run time when the measured Y side is
  under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; beyond it the plan
  stays a shuffled join. Neither side is ever collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.functions.scalars import (
    code_to_name, date_range_pred, norm_text, not_year_null_safe, to_long,
    to_ts_coerce,
)

# Hydrological disaster codes and their names.
HYDRO_CODES = (12100, 12200, 12300)
HYDRO_NAMES = {12100: "Inundacoes", 12200: "Enxurradas", 12300: "Alagamentos"}

# Canonical output columns of the label table, in order.
LABEL_COLS = ["protocolo", "municipio", "uf", "data", "cobrade", "ibge",
              "regiao", "descricao_tipologia", "grupo_de_desastre", "evento"]

# Register text columns renamed to canonical names.
TEXT_RENAMES = {"protocolo_s2id": "protocolo", "nome_municipio": "municipio",
                "sigla_uf": "uf"}


def normalize_columns(df: DataFrame) -> DataFrame:
    """Column names stripped and lower-cased."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def prepare_register(raw: DataFrame, event_date: str = "data_evento",
                     record_date: str = "data_registro",
                     drop_record_year: int | None = 2026,
                     code_col: str = "cod_cobrade",
                     mun_col: str = "cod_ibge_mun",
                     region_col: str = "regiao",
                     date_formats: tuple[str, ...] = ()) -> DataFrame:
    """Typed register: dates coerced (text in ``date_formats`` or ISO), future
    record year dropped (NULL dates kept), integer keys coerced (``12100.0``
    counts as 12100), normalised region text added."""
    df = normalize_columns(raw)
    df = (df.withColumn(event_date, to_ts_coerce(event_date, date_formats))
            .withColumn(record_date, to_ts_coerce(record_date, date_formats)))
    if drop_record_year is not None:
        df = df.filter(not_year_null_safe(record_date, drop_record_year))
    return (df.withColumn("cobrade", to_long(code_col))
              .withColumn("ibge", to_long(mun_col))
              .withColumn("regiao_l", norm_text(region_col)))


def label_scope(df: DataFrame, region_value: str | None = "sudeste",
                codes: Sequence[int] | None = HYDRO_CODES,
                region_norm_col: str = "regiao_l",
                code_col: str = "cobrade") -> Column:
    """Predicate of the region / code cut (no year filter)."""
    p = F.lit(True)
    if region_value is not None:
        p = p & (F.col(region_norm_col) == F.lit(region_value))
    if codes is not None:
        p = p & F.col(code_col).isin(list(codes))
    return p


def first_by_key(df: DataFrame, keys: Sequence[str],
                 order: Sequence[str]) -> DataFrame:
    """Keep one row per key: the one with the smallest ``order`` tuple.

    Grouped ``min(struct(order..., rest...))`` -> partial aggregation, skew
    safe. Rows with a NULL key are kept as their own groups; callers drop
    them first when the key must be complete.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("__r")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col("__r." + c).alias(c) for c in order + rest]) \
              .select(*df.columns)


def build_labels(df: DataFrame, date_col: str, lo: int, hi: int,
                 region_value: str | None = "sudeste",
                 codes: Sequence[int] | None = HYDRO_CODES,
                 key_col: str = "ibge", tie: Sequence[str] = ("protocolo_s2id",),
                 region_norm_col: str = "regiao_l",
                 code_col: str = "cobrade") -> DataFrame:
    """Region + code + year cut on ``date_col``, NULL keys dropped, first
    row per (key, day) kept; adds ``data`` (DATE) and ``evento = 1``."""
    scoped = df.filter(label_scope(df, region_value, codes, region_norm_col, code_col)
                       & date_range_pred(date_col, lo, hi))
    scoped = scoped.withColumn("data", F.to_date(F.col(date_col)))
    scoped = scoped.na.drop(subset=[key_col, "data"])
    return first_by_key(scoped, [key_col, "data"], list(tie)) \
        .withColumn("evento", F.lit(1))


def to_label_table(y: DataFrame, renames: dict | None = None,
                   names: dict | None = None) -> DataFrame:
    """Rename the text columns and project the canonical label columns.
    ``descricao_tipologia`` is filled from the code when absent."""
    renames = TEXT_RENAMES if renames is None else renames
    y = y.withColumnsRenamed({k: v for k, v in renames.items() if k in y.columns})
    if "descricao_tipologia" not in y.columns:
        y = y.withColumn("descricao_tipologia",
                         code_to_name("cobrade", names or HYDRO_NAMES))
    return y.select(*LABEL_COLS)


def label_join(x: DataFrame, y: DataFrame,
               x_keys: Sequence[str] = ("CODIGO_MUNICIPIO_IBGE", "data_local"),
               y_keys: Sequence[str] = ("ibge", "data"),
               carry: Sequence[str] = ("protocolo", "cobrade",
                                       "descricao_tipologia", "grupo_de_desastre"),
               ) -> DataFrame:
    """X LEFT JOIN Y on (municipality, day): every X row kept,
    ``evento = 1`` when a label matched else 0, Y columns carried.

    Y must be unique per key, else X would fan out: Y is grouped by its key on
    the way into the join (no extra pass over X) and a repeated key fails the
    query with a message that names it.
    """
    xk, yk = list(x_keys), list(y_keys)
    keyed = y.na.drop(subset=yk).groupBy(*yk).agg(
        F.count(F.lit(1)).alias("__n"), F.min(F.struct(*carry)).alias("__c"))
    named = F.concat_ws(", ", *[F.col(k).cast("string") for k in yk])
    ys = keyed.select(
        F.when(F.col("__n") == 1, F.col(yk[0])).otherwise(
            F.raise_error(F.concat(F.lit("repeated label key: "), named))).alias("__yk0"),
        *[F.col(k).alias(f"__yk{i}") for i, k in enumerate(yk) if i],
        *[F.col(f"__c.{c}").alias(c) for c in carry])
    cond = [F.col(xk[0]).cast("bigint") == F.col("__yk0")] + \
           [F.col(xk[i]) == F.col(f"__yk{i}") for i in range(1, len(xk))]
    j = x.join(ys, cond, "left")
    return j.select(*[x[c] for c in x.columns],
                    F.when(F.col("__yk0").isNotNull(), 1).otherwise(0).alias("evento"),
                    *[F.col(c) for c in carry])


def unmatched_events(y: DataFrame, x: DataFrame,
                     x_keys: Sequence[str] = ("CODIGO_MUNICIPIO_IBGE", "data_local"),
                     y_keys: Sequence[str] = ("ibge", "data"),
                     cols: Sequence[str] = ("protocolo", "data", "ibge", "cobrade",
                                            "descricao_tipologia")) -> DataFrame:
    """Labels with no feature row (anti join), ordered by date."""
    xk, yk = list(x_keys), list(y_keys)
    xs = x.select(*[F.col(k).alias(f"__xk{i}") for i, k in enumerate(xk)])
    xs = xs.withColumn("__xk0", F.col("__xk0").cast("bigint"))
    cond = [F.col(yk[i]) == F.col(f"__xk{i}") for i in range(len(yk))]
    return y.join(xs, cond, "left_anti").select(*cols).orderBy(yk[1], *cols)


def unique_key_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct key tuples (NULL tuples count, as DuckDB's
    ``count(DISTINCT (a, b))``), keys seen more than once, excess rows, ok.

    One grouped pass (partial aggregation), then a one-row aggregate.
    """
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(
        F.sum("__n").cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).cast("bigint").alias("n_distinct_keys"),
        F.count_if(F.col("__n") > 1).cast("bigint").alias("n_dup_keys"),
        F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n") - 1)), F.lit(0))
         .cast("bigint").alias("n_excess_rows"),
    ).withColumn("unique_ok", F.col("n_rows") == F.col("n_distinct_keys"))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key repeats (guards the label join against fan-out)."""
    r = unique_key_check(df, keys).first()
    if r is not None and r["n_rows"] and not r["unique_ok"]:
        raise ValueError(f"duplicate keys {list(keys)}: {r['n_rows']} rows, "
                         f"{r['n_distinct_keys']} distinct")


def duplicate_residual(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that still occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n")) \
             .filter(F.col("n") > 1)


def station_scope(y: DataFrame, bridge: DataFrame, y_key: str = "ibge",
                  bridge_key: str = "ibge") -> DataFrame:
    """Labels in municipalities that have a station (left semi join)."""
    b = bridge.select(F.col(bridge_key).cast("bigint").alias("__bk")).na.drop()
    return y.join(b, F.col(y_key) == F.col("__bk"), "left_semi")


def exclude_anti(df: DataFrame, excluded: DataFrame, key: str,
                 excl_key: str | None = None) -> DataFrame:
    """Rows whose key is not in the exclusion list (left anti join)."""
    e = excluded.select(F.col(excl_key or key).alias("__ek"))
    return df.join(e, F.col(key) == F.col("__ek"), "left_anti")


def station_status_filter(stations: DataFrame, excluded: DataFrame,
                          key: str = "CODIGO_WMO", status_col: str = "status_final",
                          keep_status: str = "incluida") -> DataFrame:
    """Stations with the kept status and not in the exclusion list."""
    return exclude_anti(stations.filter(F.col(status_col) == keep_status),
                        excluded, key)
