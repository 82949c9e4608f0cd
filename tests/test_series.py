import datetime as dt

from pyspark.sql import functions as F

from pluvio.operators import series as ser

T0 = dt.datetime(2020, 1, 1)


def _hourly(spark, present, values=None):
    """Station 'S' observed at the given hour offsets."""
    rows = [("S", T0 + dt.timedelta(hours=h), float(values[i] if values else h))
            for i, h in enumerate(present)]
    return spark.createDataFrame(rows, "CODIGO_WMO string, dt_utc timestamp, precip_mm double")


def _grid(spark, present, **kw):
    return {r.dt_utc: r for r in ser.impute_hourly(_hourly(spark, present), **kw).collect()}


def test_gap_classes_at_boundaries(spark):
    # gaps of 6, 7, 48 and 49 hours between observations
    pts = [0, 7, 15, 64, 114]
    runs = {r.gap_hours for r in ser.gap_runs(_hourly(spark, pts)).collect()}
    assert runs == {6, 7, 48, 49}
    g = _grid(spark, pts)
    assert len(g) == 115
    cls = {h: g[T0 + dt.timedelta(hours=h)].gap_classe for h in (1, 8, 16, 65)}
    assert cls == {1: "curto", 8: "medio", 16: "medio", 65: "longo"}


def test_linear_carry_and_long_gaps(spark):
    pts = [0, 7, 15, 64, 114]
    g = _grid(spark, pts)
    # 6-hour gap between 0 (value 0) and 7 (value 7): straight line
    assert g[T0 + dt.timedelta(hours=3)].precip_mm == 3.0
    assert g[T0 + dt.timedelta(hours=3)].imputation_method == "linear_6h"
    # 7-hour gap: previous value carried
    assert g[T0 + dt.timedelta(hours=10)].precip_mm == 7.0
    assert g[T0 + dt.timedelta(hours=10)].imputation_method == "fb_48h"
    # 49-hour gap stays empty
    r = g[T0 + dt.timedelta(hours=80)]
    assert r.precip_mm is None and r.orig_missing and not r.imputed_flag
    rep = ser.imputation_report(ser.impute_hourly(_hourly(spark, pts))).first()
    assert rep.checagem_consistente and rep.n_remaining_na == 49


def test_edge_gaps_with_fixed_period(spark):
    h = _hourly(spark, [3, 5])
    grid = ser.impute_hourly(h, period=("2020-01-01 00:00:00", "2020-01-01 09:00:00"))
    g = {r.dt_utc.hour: r for r in grid.collect()}
    assert len(g) == 10
    # leading 3-hour run: nothing before, next value carried back
    assert g[0].precip_mm == 3.0 and g[0].imputation_method == "fb_48h"
    # interior 1-hour run: linear
    assert g[4].precip_mm == 4.0 and g[4].imputation_method == "linear_6h"
    # trailing run: previous value carried
    assert g[9].precip_mm == 5.0


def test_next_observed_crosses_month_blocks(spark):
    # observations on Jan 31 23:00 and Mar 1 00:00 (February empty)
    rows = [("S", dt.datetime(2020, 1, 31, 23), 1.0), ("S", dt.datetime(2020, 3, 1, 0), 2.0)]
    h = spark.createDataFrame(rows, "CODIGO_WMO string, dt_utc timestamp, precip_mm double")
    runs = ser.gap_runs(h).collect()
    assert len(runs) == 1 and runs[0].gap_hours == 29 * 24
    assert runs[0].v_anterior == 1.0 and runs[0].v_seguinte == 2.0


def test_segments_and_exclusion(spark):
    pts = [0, 10, 100, 200, 210]        # long gaps 11..99 and 101..199
    h = _hourly(spark, pts)
    seg = ser.longest_clean_segment(ser.gap_runs(h), ser.station_span(h)).first()
    assert seg.n_obstaculos == 2 and seg.segmento_horas == 11
    ex = ser.chronic_exclusion(ser.longest_clean_segment(ser.gap_runs(h), ser.station_span(h)),
                               max_obstacles=1, min_segment_hours=5).first()
    assert ex.excluida and ex.motivo_exclusao.startswith("obstaculos_cronicos")
    loc = ser.longest_gap_location(ser.gap_runs(h), ser.station_span(h)).first()
    assert loc.maior_bloco_horas == 99 and loc.recomendacao == "meio"


def test_quality_class(spark):
    df = spark.createDataFrame([(True, False, 1.0), (False, True, 1.0), (False, False, 4.9),
                                (False, False, 12.0), (False, False, 17.8)],
                               "e boolean, s boolean, p double")
    out = [r[0] for r in df.select(ser.quality_class("e", "s", "p")).collect()]
    assert out == ["excluida", "boa_com_ressalva (segmentada)", "alta", "media", "baixa"]


def test_cut_streams_the_hours_past_the_stations_unsorted(spark):
    h = _hourly(spark, [0, 1, 5, 9])
    span = ser.station_span(h)
    meta = span.select("CODIGO_WMO", F.lit("incluida").alias("status_final"), F.col("grid_inicio").alias("periodo_valido_inicio"),
                       F.expr("grid_inicio + INTERVAL 5 HOURS").alias("periodo_valido_fim"))
    cut = ser.cut_to_valid_period(ser.impute_hourly(h), meta)
    top = cut._jdf.queryExecution().sparkPlan().toString().splitlines()
    first = next(line for line in top if "Join" in line)
    assert "ShuffledHashJoin" in first and "BuildRight" in first
    assert sorted((r.dt_utc.hour, r.precip_mm) for r in cut.collect()) == [(i, float(i)) for i in range(6)]
