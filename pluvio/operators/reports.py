"""Report aggregates over the label table and the register.

Each report is one grouped pass (partial aggregation) producing a small
table; calendar completion joins a parameter-sized calendar
(``spark.range(lo, hi + 1)``), never a data-sized one. The reference's text
reports become tidy DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from pluvio.functions.scalars import code_to_name, date_range_pred, weekday_mon0


def calendar_years(spark: SparkSession, lo: int, hi: int, name: str = "ano") -> DataFrame:
    """Every year of ``lo..hi`` as a row (size fixed by the parameters)."""
    return spark.range(lo, hi + 1).select(F.col("id").cast("bigint").alias(name))


def flag_in_scope(y: DataFrame, scope_keys: DataFrame, key: str = "ibge",
                  scope_key: str = "ibge", name: str = "in_scope") -> DataFrame:
    """Boolean column: the row's key occurs in ``scope_keys`` (left join on
    the distinct keys; row count of ``y`` unchanged)."""
    k = scope_keys.select(F.col(scope_key).cast("bigint").alias("__sk")).na.drop().distinct()
    return y.join(k, F.col(key) == F.col("__sk"), "left") \
            .withColumn(name, F.col("__sk").isNotNull()).drop("__sk")


def count_by_year(y: DataFrame, scope_keys: DataFrame, lo: int, hi: int,
                  date: str = "data", key: str = "ibge") -> DataFrame:
    """Events per year for the whole table and for the scoped part, every
    year of ``lo..hi`` present (0 filled), with a zero-year alert flag."""
    spark = y.sparkSession
    f = flag_in_scope(y, scope_keys, key)
    c = (f.groupBy(F.year(date).cast("bigint").alias("ano"))
          .agg(F.count(F.lit(1)).cast("bigint").alias("sudeste"),
               F.count_if("in_scope").cast("bigint").alias("c_estacao")))
    cal = calendar_years(spark, lo, hi)
    out = cal.join(c, "ano", "left").select(
        "ano",
        F.coalesce("sudeste", F.lit(0)).cast("bigint").alias("sudeste"),
        F.coalesce("c_estacao", F.lit(0)).cast("bigint").alias("c_estacao"))
    return out.withColumn("ano_sem_evento", F.col("sudeste") == 0)


def zero_years(by_year: DataFrame) -> DataFrame:
    return by_year.filter("ano_sem_evento").select("ano")


def count_by_uf(y: DataFrame, scope_keys: DataFrame, uf: str = "uf",
                key: str = "ibge") -> DataFrame:
    """Events per state, both scopes side by side (missing -> 0)."""
    f = flag_in_scope(y, scope_keys, key)
    return (f.groupBy(uf).agg(F.count(F.lit(1)).cast("bigint").alias("sudeste"),
                              F.count_if("in_scope").cast("bigint").alias("c_estacao")))


def typology_counts(y: DataFrame, names: dict, code: str = "cobrade") -> DataFrame:
    """Code -> name, frequency, most frequent first."""
    return (y.groupBy(code_to_name(code, names).alias("tipologia"))
             .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
             .orderBy(F.desc("n"), "tipologia"))


def funnel(df: DataFrame, steps: Sequence[tuple[str, Column]],
           keys: Sequence[str]) -> DataFrame:
    """Row count after each cumulative filter step, then the deduplicated
    key count of the last step, rows removed by dedup (NULL-key rows
    included, as the reference counts them) and retention.

    One pass: rows grouped by the dedup keys with per-step counts, then a
    one-row aggregate - no self join, no second scan.
    """
    cum, preds = F.lit(True), []
    for name, p in steps:
        cum = cum & p
        preds.append((name, cum))
    g = df.groupBy(*keys).agg(*[F.count_if(p).alias(f"__{n}") for n, p in preds])
    last = preds[-1][0]
    key_ok = F.lit(True)
    for k in keys:
        key_ok = key_ok & F.col(k).isNotNull()
    first = preds[0][0]
    out = g.agg(*[F.sum(f"__{n}").cast("bigint").alias(f"n_{n}") for n, _ in preds],
                F.count_if((F.col(f"__{last}") > 0) & key_ok).cast("bigint").alias("n_labels"))
    return (out.withColumn("n_removed_dedup", F.col(f"n_{last}") - F.col("n_labels"))
               .withColumn("retention_pct",
                           F.round(100.0 * F.col("n_labels") / F.col(f"n_{first}"), 4)))


def weekday_bias(df: DataFrame, date_cols: Sequence[str], lo: int, hi: int) -> DataFrame:
    """Weekday counts (Mon = 0) per date column, the year filter applied on
    that column, weekend share vs. the expected 2/7 and the relative deficit
    ``100 * (2/7 - observed) / (2/7)``. One row per date column, all from a
    single pass (each row exploded into its date columns)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("date_col"),
                                         F.to_date(F.col(c)).alias("d")) for c in date_cols]))
    long = df.select(pairs.alias("__p")).select("__p.*")
    long = long.filter(date_range_pred(F.col("d"), lo, hi))
    wd = weekday_mon0("d")
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n")]
    aggs += [F.count_if(wd == i).cast("bigint").alias(f"d{i}") for i in range(7)]
    got = long.groupBy("date_col").agg(*aggs)
    # every requested column appears, with zero counts when no date is in range
    names = df.sparkSession.createDataFrame([(c,) for c in date_cols], "date_col string")
    out = names.join(got, "date_col", "left").select(
        "date_col", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                      for c in ["n"] + [f"d{i}" for i in range(7)]])
    expected = 100.0 * 2 / 7
    obs = F.when(F.col("n") > 0, 100.0 * (F.col("d5") + F.col("d6")) / F.col("n")).otherwise(0.0)
    return (out.withColumn("fds_observado_pct", F.round(obs, 4))
               .withColumn("fds_esperado_pct", F.round(F.lit(expected), 4))
               .withColumn("deficit_pct", F.round(100.0 * (F.lit(expected) - obs) / F.lit(expected), 4))
               .select("date_col", "n", *[f"d{i}" for i in range(7)],
                       "fds_observado_pct", "fds_esperado_pct", "deficit_pct"))


def year_on_year(by_year: DataFrame, col: str = "sudeste") -> DataFrame:
    """Change from the previous year (window over a calendar-sized table)."""
    w = Window.orderBy("ano")
    prev = F.lag(col).over(w)
    return by_year.select("ano", F.col(col).alias("n"),
                          (F.col(col) - prev).cast("bigint").alias("delta"),
                          F.round(F.when(prev != 0, 100.0 * (F.col(col) - prev) / prev), 4)
                           .alias("delta_pct"))


def structural_break(by_year: DataFrame, break_year: int, col: str = "sudeste",
                     min_drop_pct: float = 30.0, max_ratio: float = 0.6) -> DataFrame:
    """Mean before / after the break year over a zero-filled yearly series,
    percent drop, change into the break year and the persistence flag
    (drop > ``min_drop_pct`` and break-year count < ``max_ratio`` x prior mean)."""
    v = F.col(col)
    a = by_year.agg(
        F.avg(F.when(F.col("ano") < break_year, v)).alias("media_antes"),
        F.avg(F.when(F.col("ano") >= break_year, v)).alias("media_depois"),
        F.max(F.when(F.col("ano") == break_year - 1, v)).cast("bigint").alias("n_ano_anterior"),
        F.max(F.when(F.col("ano") == break_year, v)).cast("bigint").alias("n_ano_quebra"),
    )
    # a share of nothing is unknown: NULL when the base is 0
    before, prior = (F.nullif(F.col(c), F.lit(0)) for c in ("media_antes", "n_ano_anterior"))
    drop = 100.0 * (F.col("media_antes") - F.col("media_depois")) / before
    yoy = 100.0 * (F.col("n_ano_quebra") - F.col("n_ano_anterior")) / prior
    return a.select(
        F.lit(break_year).cast("bigint").alias("ano_quebra"),
        F.round("media_antes", 4).alias("media_antes"),
        F.round("media_depois", 4).alias("media_depois"),
        F.round(drop, 4).alias("queda_pct"),
        "n_ano_anterior", "n_ano_quebra",
        F.round(yoy, 4).alias("variacao_quebra_pct"),
        ((drop > min_drop_pct) & (F.col("n_ano_quebra") < max_ratio * F.col("media_antes")))
        .alias("quebra_persiste"))


def human_damage(reg: DataFrame, windows: Sequence[tuple[str, int, int]],
                 scopes: Sequence[tuple[str, DataFrame | None]],
                 damage: dict, date: str = "data_evento", key: str = "ibge") -> DataFrame:
    """Per window x scope: records (no dedup), distinct municipalities, sums
    of the damage columns with NULL forced to 0, and how many NULLs were
    forced. ``scopes`` are (name, keys DataFrame or None for all).

    One pass: each row is tagged with every (window, scope) it belongs to
    (membership flags from left joins on the distinct scope keys), exploded,
    and grouped once - no scan per window and scope."""
    df = reg
    flags = []
    for i, (sname, skeys) in enumerate(scopes):
        if skeys is None:
            flags.append((sname, F.lit(True)))
            continue
        k = skeys.select(F.col(key).cast("bigint").alias(f"__sk{i}")).na.drop().distinct()
        df = df.join(k, F.col(key) == F.col(f"__sk{i}"), "left")
        flags.append((sname, F.col(f"__sk{i}").isNotNull()))
    d = F.to_date(date)
    tags = []
    for wname, lo, hi in windows:
        for sname, flag in flags:
            tags.append(F.when(date_range_pred(d, lo, hi) & flag,
                               F.struct(F.lit(wname).alias("janela"), F.lit(sname).alias("recorte"))))
    tagged = df.withColumn("__t", F.explode(F.filter(F.array(*tags), lambda t: t.isNotNull())))
    nulls = sum((F.col(c).isNull().cast("int") for c in damage.values()), F.lit(0))
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n_registros"),
            F.count_distinct(key).cast("bigint").alias("n_municipios")]
    aggs += [F.coalesce(F.sum(F.coalesce(F.col(c), F.lit(0))), F.lit(0)).cast("bigint").alias(out)
             for out, c in damage.items()]
    aggs.append(F.coalesce(F.sum(nulls), F.lit(0)).cast("bigint").alias("nan_forcados_zero"))
    got = tagged.groupBy(F.col("__t.janela").alias("janela"),
                         F.col("__t.recorte").alias("recorte")).agg(*aggs)
    # every (window, scope) appears, with zeros when no record falls in it
    spark = reg.sparkSession
    combos = spark.createDataFrame([(w, s) for w, _, _ in windows for s, _ in scopes],
                                   "janela string, recorte string")
    out = combos.join(got, ["janela", "recorte"], "left")
    return out.select("janela", "recorte", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                                             for c in got.columns[2:]])


def old_new_compare(old: DataFrame, new: DataFrame, dims: dict) -> DataFrame:
    """Old and new counts side by side per dimension value, signed delta and
    a changed flag. ``dims`` maps a dimension name to a column expression.
    Counted in one pass over the tagged union (no join of two aggregates)."""
    tagged = old.select(F.lit(0).alias("__v"), *[e.alias(n) for n, e in dims.items()]) \
        .unionByName(new.select(F.lit(1).alias("__v"), *[e.alias(n) for n, e in dims.items()]))
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("dimensao"), F.col(n).cast("string").alias("chave"))
                                for n in dims])).alias("__p")
    out = (tagged.select("__v", pairs).groupBy("__p.dimensao", "__p.chave")
           .agg(F.count_if(F.col("__v") == 0).cast("bigint").alias("antigo"),
                F.count_if(F.col("__v") == 1).cast("bigint").alias("novo")))
    return (out.withColumn("delta", F.col("novo") - F.col("antigo"))
               .withColumn("mudou", F.col("delta") != 0))


def table_profile(df: DataFrame, key: str, date: str) -> DataFrame:
    """Rows, distinct keys, date span - one aggregate instead of three scans."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_linhas"),
                  F.count_distinct(key).cast("bigint").alias("n_municipios"),
                  F.min(date).alias("data_min"), F.max(date).alias("data_max"))


def metric_report(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of small (section, metric, key, value) tables."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def metric_rows(df: DataFrame, section: str, metrics: dict, key: Column | None = None) -> DataFrame:
    """Turn the columns of a small aggregate into (section, metric, key, value)."""
    k = (key.cast("string") if key is not None else F.lit(None).cast("string"))
    stacked = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"),
                                           F.col(c).cast("double").alias("value"))
                                  for m, c in metrics.items()]))
    return df.select(k.alias("key"), stacked.alias("__m")).select(
        F.lit(section).alias("section"), F.col("__m.metric").alias("metric"),
        "key", F.col("__m.value").alias("value"))


def describe_table(df: DataFrame, cols: Sequence[str], digits: int = 2) -> DataFrame:
    """count, mean, std (sample), min, quartiles, max per numeric column,
    rounded; long output (column, statistic, value). Moments come from one
    aggregate; quartiles from the distributed exact percentiles, so no task
    ever holds a whole column's values."""
    from pluvio.operators.stats import exact_percentiles, stack
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        aggs += [F.count(v).cast("double").alias(f"{c}__count"), F.avg(v).alias(f"{c}__mean"),
                 F.stddev_samp(v).alias(f"{c}__std"), F.min(v).alias(f"{c}__min"),
                 F.max(v).alias(f"{c}__max")]
    a = df.agg(*aggs)
    rows = []
    for c in cols:
        for s, e in [("count", f"{c}__count"), ("mean", f"{c}__mean"), ("std", f"{c}__std"),
                     ("min", f"{c}__min"), ("max", f"{c}__max")]:
            rows.append(F.struct(F.lit(c).alias("coluna"), F.lit(s).alias("estatistica"),
                                 F.round(F.col(e), digits).alias("valor")))
    moments = a.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    q = exact_percentiles(stack(df, cols, name="coluna"), ["coluna"], "valor", (0.25, 0.5, 0.75))
    qs = q.select("coluna", F.explode(F.array(*[
        F.struct(F.lit(lbl).alias("estatistica"), F.round(F.col(p), digits).alias("valor"))
        for lbl, p in (("25%", "p25"), ("50%", "p50"), ("75%", "p75"))])).alias("r")) \
          .select("coluna", "r.estatistica", "r.valor")
    return moments.unionByName(qs)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, one pass, long output (column, n_nulos)."""
    cols = list(cols or df.columns)
    a = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])
    return a.select(F.explode(F.array(*[F.struct(F.lit(c).alias("coluna"),
                                                 F.col(c).alias("n_nulos")) for c in cols]))
                    .alias("r")).select("r.*")


def top_k(df: DataFrame, k: int, by: str, tie: Sequence[str]) -> DataFrame:
    """The k largest rows by ``by`` with a deterministic key tie-break
    (TakeOrderedAndProject: each task keeps its own top k)."""
    return df.orderBy(F.desc(by), *tie).limit(k)


def head_preview(df: DataFrame, n: int = 5, order: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows for a look at a table (the limit is the feature).
    With ``order`` the preview is deterministic (TakeOrderedAndProject);
    without it, any ``n`` rows, read from as few partitions as needed."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)
