"""Hourly rainfall series per station: grid, gap runs, imputation, per-station
quality reports, clean-segment cut and exclusion.

Design
------
Gaps are found from the *observed* hours only: for every observed hour the
next observed hour (``next_observed``) bounds a run of missing hours. The
full hourly grid is then produced by ``sequence``-exploding each run, with its
imputed values computed from the run's two neighbours. There is no window over
the whole grid.

``next_observed`` is block-partitioned: ``lead`` runs per (station, month),
and only the last row of each block looks up the first observation of the
next non-empty block from a per-block summary (a few rows per station-month).
No window partition is larger than one station-month, whatever the volume of
one station.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.functions.scalars import utc_instant


def _utc(text: str) -> Column:
    return utc_instant(F.lit(text).cast("timestamp_ntz"))


def _hour():
    return F.expr("INTERVAL 1 HOUR")


def _hours_between(a, b) -> Column:
    """Whole hours from ``a`` to ``b`` (timestamps)."""
    return ((F.unix_seconds(b) - F.unix_seconds(a)) / 3600).cast("bigint")


def next_observed(obs: DataFrame, station: str, t: str, v: str,
                  block: str = "month") -> DataFrame:
    """Adds ``__nt`` / ``__nv``: time and value of the next observed hour of
    the same station (NULL for the last one)."""
    b = obs.withColumn("__blk", F.date_trunc(block, F.col(t)))
    w = Window.partitionBy(station, "__blk").orderBy(t)
    b = b.withColumns({"__nt": F.lead(t).over(w), "__nv": F.lead(v).over(w)})
    firsts = (obs.withColumn("__blk", F.date_trunc(block, F.col(t)))
              .groupBy(station, "__blk")
              .agg(F.min(t).alias("__ft"), F.min_by(v, t).alias("__fv")))  # hash aggregate
    wb = Window.partitionBy(station).orderBy("__blk")
    nxt = firsts.select(F.col(station).alias("__s"), F.col("__blk").alias("__b"),
                        F.lead("__ft").over(wb).alias("__nft"), F.lead("__fv").over(wb).alias("__nfv"))
    j = b.join(nxt, (F.col(station) == F.col("__s")) & (F.col("__blk") == F.col("__b")), "left")
    return (j.withColumns({"__nt": F.coalesce("__nt", "__nft"),
                           "__nv": F.when(F.col("__nt").isNotNull(), F.col("__nv"))
                                    .otherwise(F.col("__nfv"))})
             .drop("__blk", "__s", "__b", "__nft", "__nfv"))


def station_span(hourly: DataFrame, station: str = "CODIGO_WMO", t: str = "dt_utc",
                 v: str = "precip_mm", period: tuple[str, str] | None = None) -> DataFrame:
    """Grid span per station: first..last observed hour, or a fixed period
    (then every station has the same span and edge gaps appear)."""
    obs = hourly.filter(F.col(v).isNotNull())
    s = obs.groupBy(station).agg(F.min(t).alias("grid_inicio"), F.max(t).alias("grid_fim"))
    if period is not None:
        s = s.select(station, _utc(period[0]).alias("grid_inicio"),
                     _utc(period[1]).alias("grid_fim"))
    return s.withColumn("total_horas", _hours_between(F.col("grid_inicio"), F.col("grid_fim")) + 1)


def gap_runs(hourly: DataFrame, station: str = "CODIGO_WMO", t: str = "dt_utc",
             v: str = "precip_mm", period: tuple[str, str] | None = None) -> DataFrame:
    """One row per run of consecutive missing hours: start, end, length and
    the neighbouring observations (NULL at a grid edge)."""
    obs = hourly.filter(F.col(v).isNotNull()).select(station, t, v)
    if period is not None:
        lo, hi = (_utc(p) for p in period)
        obs = obs.filter((F.col(t) >= lo) & (F.col(t) <= hi))
    n = next_observed(obs, station, t, v)
    inner = (n.filter(F.col("__nt").isNotNull()
                      & (F.col("__nt") > F.col(t) + _hour()))
              .select(station,
                      (F.col(t) + _hour()).alias("inicio"),
                      (F.col("__nt") - _hour()).alias("fim"),
                      F.col(t).alias("t_anterior"), F.col(v).alias("v_anterior"),
                      F.col("__nt").alias("t_seguinte"), F.col("__nv").alias("v_seguinte")))
    runs = inner
    if period is not None:
        lo, hi = (_utc(p) for p in period)
        ends = obs.groupBy(station).agg(F.min(F.struct(t, v)).alias("f"),
                                        F.max(F.struct(t, v)).alias("l"))
        lead_runs = ends.filter(F.col("f." + t) > lo).select(
            station, lo.alias("inicio"), (F.col("f." + t) - _hour()).alias("fim"),
            F.lit(None).cast("timestamp").alias("t_anterior"),
            F.lit(None).cast("double").alias("v_anterior"),
            F.col("f." + t).alias("t_seguinte"), F.col("f." + v).alias("v_seguinte"))
        tail_runs = ends.filter(F.col("l." + t) < hi).select(
            station, (F.col("l." + t) + _hour()).alias("inicio"), hi.alias("fim"),
            F.col("l." + t).alias("t_anterior"), F.col("l." + v).alias("v_anterior"),
            F.lit(None).cast("timestamp").alias("t_seguinte"),
            F.lit(None).cast("double").alias("v_seguinte"))
        runs = runs.unionByName(lead_runs).unionByName(tail_runs)
    return runs.withColumn("gap_hours", _hours_between(F.col("inicio"), F.col("fim")) + 1)


def gap_class(hours, short: int = 6, medium: int = 48, long: int = 168) -> Column:
    """curto (<= short), medio (<= medium), longo (<= long), extremo;
    ``nao_aplicavel`` for observed hours (0)."""
    h = F.col(hours) if isinstance(hours, str) else hours
    return (F.when(h <= 0, "nao_aplicavel").when(h <= short, "curto")
             .when(h <= medium, "medio").when(h <= long, "longo").otherwise("extremo"))


GRID_COLS = ["CODIGO_WMO", "dt_utc", "precip_mm", "orig_missing", "gap_hours",
             "gap_classe", "imputed_flag", "imputation_method"]


def impute_hourly(hourly: DataFrame, station: str = "CODIGO_WMO", t: str = "dt_utc",
                  v: str = "precip_mm", short: int = 6, medium: int = 48, long: int = 168,
                  fill_all: bool = False, period: tuple[str, str] | None = None) -> DataFrame:
    """Full hourly grid with gap classes and imputation.

    * ``curto`` runs between two observations: straight line (``linear_6h``);
    * ``medio`` runs, and ``curto`` runs at a grid edge: previous value, else
      next value (``fb_48h``);
    * ``longo`` / ``extremo`` runs stay NULL (``fill_all=True`` reproduces
      the first round, which filled them too, by carrying).
    """
    runs = gap_runs(hourly, station, t, v, period)
    k = F.col("__k")
    both = F.col("v_anterior").isNotNull() & F.col("v_seguinte").isNotNull()
    L = F.col("gap_hours")
    linear = F.col("v_anterior") + (F.col("v_seguinte") - F.col("v_anterior")) * k / (L + 1)
    carry = F.coalesce(F.col("v_anterior"), F.col("v_seguinte"))
    is_short = L <= short
    fillable = L <= medium if not fill_all else F.lit(True)
    method = (F.when(is_short & both, "linear_6h")
               .when(fillable, "fb_48h"))
    value = (F.when(is_short & both, linear).when(fillable, carry))
    gaps = (runs.withColumn("__k", F.explode(F.sequence(F.lit(1), L.cast("int"))))
                .select(F.col(station).alias("CODIGO_WMO"),
                        F.timestamp_add("HOUR", k - 1, F.col("inicio")).alias("dt_utc"),
                        value.alias("precip_mm"),
                        F.lit(True).alias("orig_missing"),
                        L.alias("gap_hours"),
                        gap_class(L, short, medium, long).alias("gap_classe"),
                        value.isNotNull().alias("imputed_flag"),
                        F.when(value.isNotNull(), method).alias("imputation_method"),
                        F.col("inicio").alias("gap_inicio")))
    obs = hourly.filter(F.col(v).isNotNull())
    if period is not None:
        lo, hi = (_utc(p) for p in period)
        obs = obs.filter((F.col(t) >= lo) & (F.col(t) <= hi))
    observed = obs.select(F.col(station).alias("CODIGO_WMO"), F.col(t).alias("dt_utc"),
                          F.col(v).alias("precip_mm"), F.lit(False).alias("orig_missing"),
                          F.lit(0).cast("bigint").alias("gap_hours"),
                          F.lit("nao_aplicavel").alias("gap_classe"),
                          F.lit(False).alias("imputed_flag"),
                          F.lit(None).cast("string").alias("imputation_method"),
                          F.lit(None).cast("timestamp").alias("gap_inicio"))
    return observed.unionByName(gaps)


def runs_from_grid(grid: DataFrame, station: str = "CODIGO_WMO") -> DataFrame:
    """Gap runs read back from a stored grid (each missing hour carries its
    run's first hour): one grouped aggregate, no window."""
    return (grid.filter("orig_missing").groupBy(station, "gap_inicio")
                .agg(F.min("dt_utc").alias("inicio"), F.max("dt_utc").alias("fim"),
                     F.count(F.lit(1)).cast("bigint").alias("gap_hours"))
                .drop("gap_inicio"))


def span_from_grid(grid: DataFrame, station: str = "CODIGO_WMO") -> DataFrame:
    """Grid span per station read back from a stored grid."""
    return grid.groupBy(station).agg(F.min("dt_utc").alias("grid_inicio"),
                                     F.max("dt_utc").alias("grid_fim"),
                                     F.count(F.lit(1)).cast("bigint").alias("total_horas"))


def completeness_tier(pct_remaining, tier_a: float = 5.0, tier_c: float = 15.0) -> Column:
    p = F.col(pct_remaining) if isinstance(pct_remaining, str) else pct_remaining
    return F.when(p > tier_c, "C").when(p <= tier_a, "A").otherwise("B")


def imputation_report(grid: DataFrame, station: str = "CODIGO_WMO",
                      tier_a: float = 5.0, tier_c: float = 15.0) -> DataFrame:
    """Per station: total hours, originally missing, imputed, left NULL,
    percentages, the identity check and the completeness tier."""
    r = grid.groupBy(station).agg(
        F.count(F.lit(1)).cast("bigint").alias("total"),
        F.count_if("orig_missing").cast("bigint").alias("n_orig_missing"),
        F.count_if("imputed_flag").cast("bigint").alias("n_imputed"),
        F.count_if(F.col("precip_mm").isNull()).cast("bigint").alias("n_remaining_na"),
        F.count_if(F.col("gap_classe").isin("longo", "extremo")).cast("bigint")
         .alias("n_horas_longo_extremo"))
    return _with_shares(r, tier_a, tier_c)


def _with_shares(r: DataFrame, tier_a: float, tier_c: float) -> DataFrame:
    pi = 100.0 * F.col("n_imputed") / F.col("total")
    pr = 100.0 * F.col("n_remaining_na") / F.col("total")
    return (r.withColumn("pct_imputed", F.round(pi, 4))
             .withColumn("pct_remaining_na", F.round(pr, 4))
             .withColumn("checagem_consistente",
                         F.col("n_orig_missing") == F.col("n_imputed") + F.col("n_remaining_na"))
             .withColumn("tier", completeness_tier(pr, tier_a, tier_c)))


def imputation_report_from_runs(runs: DataFrame, span: DataFrame, station: str = "CODIGO_WMO",
                                short: int = 6, medium: int = 48, long: int = 168,
                                fill_all: bool = False, tier_a: float = 5.0,
                                tier_c: float = 15.0) -> DataFrame:
    """:func:`imputation_report` of the grid that ``runs`` and ``span`` imply,
    without making its hours: a run is filled as a whole or not at all, so the
    counts are sums of run lengths."""
    known = F.col("v_anterior").isNotNull() | F.col("v_seguinte").isNotNull()
    filled = known if fill_all else known & (F.col("gap_hours") <= medium)
    hours = lambda c: F.coalesce(F.sum(F.when(c, F.col("gap_hours"))), F.lit(0)).cast("bigint")
    g = runs.groupBy(station).agg(hours(F.lit(True)).alias("n_orig_missing"), hours(filled).alias("n_imputed"),
                                  hours(~filled).alias("n_remaining_na"),
                                  hours(F.col("gap_hours") > medium).alias("n_horas_longo_extremo"))
    j = span.select(station, F.col("total_horas").cast("bigint").alias("total")).join(g, station, "left")
    r = j.na.fill(0, ["n_orig_missing", "n_imputed", "n_remaining_na", "n_horas_longo_extremo"])
    return _with_shares(r, tier_a, tier_c)


def imputation_round_compare(first: DataFrame, final: DataFrame,
                             station: str = "CODIGO_WMO") -> DataFrame:
    """Two report rounds side by side per station."""
    a = first.select(station, F.col("n_imputed").alias("n_imputed_r1"),
                     F.col("n_remaining_na").alias("n_remaining_na_r1"))
    b = final.select(station, F.col("n_imputed").alias("n_imputed_final"),
                     F.col("n_remaining_na").alias("n_remaining_na_final"), "tier")
    return (a.join(b, station, "full")
             .withColumn("delta_imputed", F.col("n_imputed_final") - F.col("n_imputed_r1")))


def longest_gap_location(runs: DataFrame, span: DataFrame, station: str = "CODIGO_WMO",
                         end_pct: float = 95.0, start_pct: float = 5.0) -> DataFrame:
    """Longest missing run per station (ties -> earliest): hours, share of
    the total, start / end position in percent, advice (``fim`` when it
    reaches the last ``100 - end_pct`` %, ``inicio`` symmetric, else ``meio``)."""
    best = runs.groupBy(station).agg(
        F.min(F.struct((-F.col("gap_hours")).alias("neg"), F.col("inicio").alias("inicio")))
         .alias("b"))
    j = best.join(span, station)
    L = -F.col("b.neg")
    pos0 = _hours_between(F.col("grid_inicio"), F.col("b.inicio"))
    ini = 100.0 * pos0 / F.col("total_horas")
    fim = 100.0 * (pos0 + L) / F.col("total_horas")
    return j.select(
        station, F.col("total_horas"), L.alias("maior_bloco_horas"),
        F.round(100.0 * L / F.col("total_horas"), 4).alias("maior_bloco_pct_do_total"),
        F.round(ini, 4).alias("posicao_inicio_bloco_pct"),
        F.round(fim, 4).alias("posicao_fim_bloco_pct"),
        F.when(fim >= end_pct, "fim").when(ini <= start_pct, "inicio").otherwise("meio")
         .alias("recomendacao"))


def obstacle_count(runs: DataFrame, station: str = "CODIGO_WMO", medium: int = 48) -> DataFrame:
    """Number of long / extreme runs per station."""
    return runs.groupBy(station).agg(
        F.count_if(F.col("gap_hours") > medium).cast("bigint").alias("n_obstaculos"))


def longest_clean_segment(runs: DataFrame, span: DataFrame, station: str = "CODIGO_WMO",
                          medium: int = 48) -> DataFrame:
    """Longest stretch of the grid without a long / extreme run (ties ->
    earliest); hours removed when the series is cut to it."""
    obst = runs.filter(F.col("gap_hours") > medium).select(station, "inicio", "fim")
    # candidate segments: before each obstacle (from the previous obstacle's
    # end or the grid start), and after the last obstacle (to the grid end)
    w = Window.partitionBy(station).orderBy("inicio")
    o = obst.join(span.select(station, "grid_inicio", "grid_fim"), station)
    before = o.select(station,
                      F.coalesce(F.lag("fim").over(w) + _hour(), F.col("grid_inicio")).alias("s"),
                      (F.col("inicio") - _hour()).alias("e"))
    last = o.groupBy(station).agg(F.max("fim").alias("lf"), F.first("grid_fim").alias("gf")) \
            .select(station, (F.col("lf") + _hour()).alias("s"), F.col("gf").alias("e"))
    whole = span.join(obst.select(station).distinct(), station, "left_anti") \
                .select(station, F.col("grid_inicio").alias("s"), F.col("grid_fim").alias("e"))
    segs = before.unionByName(last).unionByName(whole).filter(F.col("e") >= F.col("s"))
    segs = segs.withColumn("len", _hours_between(F.col("s"), F.col("e")) + 1)
    best = segs.groupBy(station).agg(
        F.min(F.struct((-F.col("len")).alias("neg"), F.col("s").alias("s"), F.col("e").alias("e")))
         .alias("b"))
    oc = obstacle_count(runs, station, medium)
    j = (span.join(best, station, "left").join(oc, station, "left"))
    seg_len = F.coalesce(-F.col("b.neg"), F.lit(0))
    return j.select(
        station, "grid_inicio", "grid_fim", "total_horas",
        F.coalesce("n_obstaculos", F.lit(0)).cast("bigint").alias("n_obstaculos"),
        F.col("b.s").alias("segmento_inicio"), F.col("b.e").alias("segmento_fim"),
        seg_len.cast("bigint").alias("segmento_horas"),
        (F.col("total_horas") - seg_len).cast("bigint").alias("horas_removidas"))


def chronic_exclusion(seg: DataFrame, max_obstacles: int = 15,
                      min_segment_hours: int = 2 * 8760) -> DataFrame:
    """Exclude a station with too many obstacles or too short a clean
    segment; the reason as text."""
    many = F.col("n_obstaculos") > max_obstacles
    short = F.col("segmento_horas") < min_segment_hours
    reason = (F.when(many, F.format_string("obstaculos_cronicos (%d > %d)",
                                           F.col("n_obstaculos"), F.lit(max_obstacles)))
               .when(short, F.format_string("segmento_curto (%d h < %d h)",
                                            F.col("segmento_horas"), F.lit(min_segment_hours))))
    return seg.withColumn("excluida", many | short).withColumn("motivo_exclusao", reason)


def quality_class(excluded, segmented, pct_imputed, alta: float = 5.0,
                  media: float = 15.0) -> Column:
    """excluida; boa_com_ressalva (segmentada); else alta / media / baixa by
    percent imputed."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return (F.when(c(excluded), "excluida")
             .when(c(segmented), "boa_com_ressalva (segmentada)")
             .when(c(pct_imputed) < alta, "alta")
             .when(c(pct_imputed) < media, "media").otherwise("baixa"))


def cut_to_valid_period(grid: DataFrame, meta: DataFrame, station: str = "CODIGO_WMO",
                        t: str = "dt_utc") -> DataFrame:
    """Hourly modelling rows: included stations only, each cut to its valid
    period (the clean segment for segmented stations), with the station
    attributes attached. ``meta`` has one row per station."""
    m = meta.filter(F.col("status_final") == "incluida")
    # stations are hashed and the hours stream past them: no task sorts its share of the grid
    j = grid.join(m.hint("shuffle_hash"), station)
    return j.filter((F.col(t) >= F.col("periodo_valido_inicio"))
                    & (F.col(t) <= F.col("periodo_valido_fim")))
