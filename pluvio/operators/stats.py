"""Statistics of the signal test: group percentiles, Mann-Whitney AUC,
boxplot numbers, run over both scenarios (all rows / valid windows).

Scale design
------------
Everything starts from a value histogram ``(group, value) -> counts`` (a
grouped aggregate with map-side combine; a value shared by a third of all
rows is one histogram row). Cumulative counts over the value order come from
``ordered.sums_before``: the histogram is dealt by range of (group, value), ranges
add up on their own, and range totals become offsets. No global sort in one task,
no cut points carried with the rows, and time in proportion to the rows whatever the
number of ranges.

Exact percentiles (linear interpolation, as ``quantile_cont``) are the values at
their ranks in the cumulative histogram; AUC sums
``p * (negatives below + n / 2)``, which equals the average-rank form. Both come from
one grouped pass over it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.operators.ordered import meets, sums_before

PCTS = (0.5, 0.75, 0.9, 0.99)


def stack(df: DataFrame, variables: Sequence[str], keep: Sequence[str] = (),
          name: str = "variavel", value: str = "valor") -> DataFrame:
    """Wide -> long: one row per (row, variable) with a non-NULL value."""
    s = F.explode(F.array(*[F.struct(F.lit(v).alias(name), F.col(v).cast("double").alias(value))
                            for v in variables])).alias("__s")
    return (df.select(*keep, s).select(*keep, f"__s.{name}", f"__s.{value}")
              .filter(F.col(value).isNotNull() & ~F.isnan(F.col(value))))


def cumulative_below(hist: DataFrame, groups: Sequence[str], value: str,
                     weights: Sequence[str], ranges: int | None = None,
                     totals: bool = False) -> DataFrame:
    """Adds ``below_<w>``: sum of ``w`` over the rows of the same group with
    a strictly smaller ``value`` (and ``total_<w>`` per group when
    ``totals``). ``hist`` has one row per group and value."""
    out = sums_before(hist, groups, [value], {f"below_{w}": w for w in weights}, totals, ranges)
    return out.withColumnsRenamed({f"total_below_{w}": f"total_{w}" for w in weights})


def _join_groups(left: DataFrame, right: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Left join on the group columns in which NULL groups meet too."""
    r = right.withColumnsRenamed({c: f"__j_{c}" for c in groups})
    return left.join(r, meets(groups, "__j_"), "left").drop(*[f"__j_{c}" for c in groups])


def exact_percentiles(long: DataFrame, groups: Sequence[str], value: str = "valor",
                      pcts: Sequence[float] = PCTS, ranges: int | None = None) -> DataFrame:
    """Per group: n and the exact percentiles (linear interpolation between
    closest ranks) named ``p50``, ``p75``, ...; groups with no value are absent."""
    hist = long.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("cnt"))
    return percentiles_from_hist(hist, groups, value, "cnt", pcts, ranges)


def percentile_at(value: str, cnt: str, below: str, total: str, q: float) -> Column:
    """Aggregate over a group's cumulative histogram: the exact percentile. NULL
    without rows."""
    place = (F.col(total) - 1) * F.lit(float(q))
    low = F.floor(place)

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col(below)) & (rank < F.col(below) + F.col(cnt)), F.col(value)))
    least = at(low)
    return least + (at(F.least(low + 1, F.col(total) - 1)) - least) * F.max(place - low)


def percentiles_from_hist(hist: DataFrame, groups: Sequence[str], value: str, cnt: str = "cnt",
                          pcts: Sequence[float] = PCTS, ranges: int | None = None) -> DataFrame:
    """``exact_percentiles`` on an existing (group, value, count) histogram,
    so several statistics can share one histogram pass."""
    g = list(groups)
    cum = cumulative_below(hist.select(*g, value, F.col(cnt).alias("cnt")), g, value, ["cnt"], ranges, totals=True)
    return cum.groupBy(*g).agg(
        F.max("total_cnt").cast("bigint").alias("n"),
        *[percentile_at(value, "cnt", "below_cnt", "total_cnt", q).alias(f"p{round(q * 100):d}") for q in pcts])


def group_percentiles(df: DataFrame, variables: Sequence[str], label: str = "evento",
                      pcts: Sequence[float] = PCTS, by: Sequence[str] = ()) -> DataFrame:
    """p50/p75/p90/p99 and n per (by..., variable, label), NULLs ignored."""
    long = stack(df, variables, [*by, label])
    return exact_percentiles(long, [*by, "variavel", label], "valor", pcts)


def _class_counts(df: DataFrame, variables: Sequence[str], label: str, by: Sequence[str],
                  ranges: int | None = None) -> DataFrame:
    """Cumulative value histogram per (by..., variable) with positives and negatives."""
    g = [*by, "variavel"]
    hist = stack(df, variables, [*by, label]).groupBy(*g, "valor").agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("nn"))
    return cumulative_below(hist, g, "valor", ["p", "nn"], ranges, totals=True)


def _auc() -> Column:
    pos, neg = F.sum("p"), F.sum("nn")
    return F.when((pos > 0) & (neg > 0), F.sum(F.col("p") * (F.col("below_nn") + F.col("nn") / 2.0)) / (pos * neg))


def rank_auc(df: DataFrame, variables: Sequence[str], label: str = "evento",
             ranges: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Mann-Whitney AUC per (by..., variable) (ties averaged); NULL when a
    class is empty; NULL values dropped per variable."""
    cum = _class_counts(df, variables, label, by, ranges)
    return cum.groupBy(*by, "variavel").agg(F.sum("p").cast("bigint").alias("n_pos"),
                                            F.sum("nn").cast("bigint").alias("n_neg"), _auc().alias("auc"))


def average_rank(df: DataFrame, value: str, partition: Sequence[str] = ()) -> Column:
    """Rank with ties averaged, as a column expression (window; use on
    bounded partitions - ``rank_auc`` uses the histogram instead)."""
    w = Window.partitionBy(*partition).orderBy(value)
    wt = Window.partitionBy(*partition, value)
    return F.rank().over(w) + (F.count(F.lit(1)).over(wt) - 1) / 2.0


def boxplot_stats(df: DataFrame, variables: Sequence[str], label: str = "evento",
                  whisker: float = 1.5) -> DataFrame:
    """Per (variable, label): quartiles, whiskers (most extreme values within
    ``whisker`` x IQR of the box) and the outlier count."""
    long = stack(df, variables, [label])
    g = ["variavel", label]
    q = exact_percentiles(long, g, "valor", (0.25, 0.5, 0.75))
    q = q.withColumn("iqr", F.col("p75") - F.col("p25")) \
         .withColumn("cerca_inf", F.col("p25") - whisker * F.col("iqr")) \
         .withColumn("cerca_sup", F.col("p75") + whisker * F.col("iqr"))
    j = _join_groups(long, q.select(*g, "cerca_inf", "cerca_sup"), g)
    inside = (F.col("valor") >= F.col("cerca_inf")) & (F.col("valor") <= F.col("cerca_sup"))
    w = j.groupBy(*g).agg(F.min(F.when(inside, F.col("valor"))).alias("bigode_inf"),
                          F.max(F.when(inside, F.col("valor"))).alias("bigode_sup"),
                          F.count_if(~inside).cast("bigint").alias("n_outliers"))
    return _join_groups(q, w, g).select(*g, "n", F.col("p25").alias("q1"), F.col("p50").alias("mediana"),
                               F.col("p75").alias("q3"), "iqr", "bigode_inf", "bigode_sup",
                               "n_outliers")


def with_scenarios(df: DataFrame, scope: str = "janela_valida",
                   name: str = "cenario") -> DataFrame:
    """Each row tagged ``todos``, and also ``scope`` when that flag is true
    (NULL counts as false): both scenarios then run as one grouped pass."""
    tags = F.when(F.col(scope), F.array(F.lit("todos"), F.lit(scope))) \
            .otherwise(F.array(F.lit("todos")))
    return df.withColumn(name, F.explode(tags))


def signal_scenarios(df: DataFrame, variables: Sequence[str], label: str = "evento",
                     scope: str = "janela_valida") -> DataFrame:
    """AUC and class medians per variable for all rows and for the rows with
    ``scope`` true, in one pass over the scenario-tagged rows."""
    cum = _class_counts(with_scenarios(df, scope), variables, label, ["cenario"])
    return cum.groupBy("cenario", "variavel").agg(
        F.sum("p").cast("bigint").alias("n_pos"), F.sum("nn").cast("bigint").alias("n_neg"), _auc().alias("auc"),
        percentile_at("valor", "p", "below_p", "total_p", 0.5).alias("mediana_evento"),
        percentile_at("valor", "nn", "below_nn", "total_nn", 0.5).alias("mediana_normal"))
