"""Model-evaluation data jobs recommended by the reference's docs:
expanding-window temporal folds, Brier score, reliability bins,
precision / recall / F1 and average precision, class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.operators.stats import cumulative_below


def temporal_folds(df: DataFrame, date: str, first_cut: str, period_days: int,
                   n_folds: int) -> DataFrame:
    """Expanding-window split: fold k (1..n) tests on
    [first_cut + (k-1) P, first_cut + k P) and trains on every earlier day.

    Membership is arithmetic - each row explodes into the folds it trains
    or tests - so there is no join with a fold table. Adds ``fold`` and
    ``papel`` (``treino`` / ``teste``)."""
    c1 = F.lit(first_cut).cast("date")
    off = F.datediff(F.col(date), c1)
    t = F.when(off >= 0, F.floor(off / period_days) + 1).otherwise(F.lit(0)).cast("int")
    train = F.transform(F.sequence(F.least(t + 1, F.lit(n_folds + 1)), F.lit(n_folds)),
                        lambda k: F.struct(k.alias("fold"), F.lit("treino").alias("papel")))
    # sequence(a, b) with a > b counts down: keep only valid fold numbers
    train = F.filter(train, lambda s: (s["fold"] > t) & (s["fold"] <= n_folds))
    test = F.when((t >= 1) & (t <= n_folds),
                  F.array(F.struct(t.alias("fold"), F.lit("teste").alias("papel"))))\
            .otherwise(F.array().cast("array<struct<fold:int,papel:string>>"))
    return df.withColumn("__m", F.explode(F.concat(train, test))) \
             .withColumns({"fold": F.col("__m.fold"), "papel": F.col("__m.papel")}).drop("__m")


def fold_summary(folded: DataFrame, date: str, label: str) -> DataFrame:
    return (folded.groupBy("fold", "papel")
                  .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                       F.sum(F.col(label)).cast("bigint").alias("positivos"),
                       F.min(date).alias("data_min"), F.max(date).alias("data_max")))


def brier_score(df: DataFrame, prob: str, label: str) -> DataFrame:
    """Mean squared error of the probability; one row."""
    return df.agg(F.count(F.col(prob)).cast("bigint").alias("n"),
                  F.avg((F.col(prob) - F.col(label)) ** 2).alias("brier"))


def reliability_bins(df: DataFrame, prob: str, label: str, bins: int = 10) -> DataFrame:
    """Predicted vs observed frequency per equal-width probability bin."""
    b = F.least(F.floor(F.col(prob) * bins), F.lit(bins - 1)).cast("int")
    return (df.filter(F.col(prob).isNotNull())
              .groupBy(b.alias("bin"))
              .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                   F.avg(prob).alias("prob_media"),
                   F.avg(F.col(label).cast("double")).alias("freq_observada")))


def precision_recall_f1(df: DataFrame, score: str, label: str, threshold: float,
                        ranges: int | None = None) -> DataFrame:
    """Confusion counts, precision, recall and F1 at ``threshold``, and the
    average precision (area under the step PR curve, ties grouped) from the
    score histogram with distributed cumulative sums."""
    s = df.filter(F.col(score).isNotNull())
    at = s.agg(F.count_if((F.col(score) >= threshold) & (F.col(label) == 1)).alias("tp"),
               F.count_if((F.col(score) >= threshold) & (F.col(label) == 0)).alias("fp"),
               F.count_if((F.col(score) < threshold) & (F.col(label) == 1)).alias("fn"))
    hist = s.groupBy(F.col(score).alias("__s")).agg(
        F.count_if(F.col(label) == 1).alias("pp"), F.count_if(F.col(label) == 0).alias("nn"))
    c = cumulative_below(hist, [], "__s", ["pp", "nn"], ranges, totals=True) \
        .withColumnsRenamed({"total_pp": "P", "total_nn": "N"})
    tp_ge = F.col("P") - F.col("below_pp")
    fp_ge = F.col("N") - F.col("below_nn")
    ap = c.agg(F.sum(F.when(F.col("P") > 0, F.col("pp") / F.col("P") * tp_ge / (tp_ge + fp_ge)))
               .alias("average_precision"))
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    rec = F.col("tp") / (F.col("tp") + F.col("fn"))
    out = at.select(F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
                    F.col("fn").cast("bigint").alias("fn"),
                    F.when(F.col("tp") + F.col("fp") > 0, prec).alias("precision"),
                    F.when(F.col("tp") + F.col("fn") > 0, rec).alias("recall"))
    out = out.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))))
    # both are one-row aggregates: stacked as (metrica, valor) rows, no join
    cols = ["tp", "fp", "fn", "precision", "recall", "f1"]
    a = out.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metrica"),
                                                F.col(m).cast("double").alias("valor"))
                                       for m in cols])).alias("r")).select("r.*")
    b = ap.select(F.lit("average_precision").alias("metrica"),
                  F.col("average_precision").alias("valor"))
    return a.unionByName(b)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Inverse-frequency weight per class: n_total / (n_classes * n_class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    # one row per class (bounded by the label domain): a global window is tiny
    w = Window.partitionBy()
    return counts.select(label, "n", (F.sum("n").over(w) / (F.count(F.lit(1)).over(w) * F.col("n")))
                         .alias("peso"))
