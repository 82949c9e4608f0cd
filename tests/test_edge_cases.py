"""Edge cases that random table data does not reach."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from small_tables import SF_SMALL
from pluvio.functions import scalars as S
from pluvio.operators import compare, labels, quality, reports, series, spatial, stats
from pluvio.plans.catalog import QUERIES
from pluvio.plans.common import read
from pluvio.sources import station_files as sf


def test_appended_files_are_seen(spark, tmp_path):
    d = str(tmp_path)
    spark.range(3).write.parquet(f"{d}/t.parquet")
    assert read(spark, d, "t").count() == 3
    spark.range(4).write.mode("append").parquet(f"{d}/t.parquet")
    assert read(spark, d, "t").count() == 7


def test_null_group_keeps_its_percentiles(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 7.0)], "g string, valor double")
    got = {r.g: (r.n, r.p50) for r in stats.exact_percentiles(df, ["g"], pcts=(0.5,)).collect()}
    assert got == {"a": (2, 2.0), None: (2, 6.0)}


@pytest.fixture
def tokyo(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


def test_local_day_does_not_depend_on_the_session(tokyo):
    t = tokyo.sql("SELECT timestamp'2020-01-01 01:00:00 UTC' AS t, timestamp_ntz'2020-01-01 01:00:00' AS n")
    r = t.select(S.utc_to_local_day("t", "-03:00").alias("a"),
                 S.utc_to_local_day(S.utc_instant("n"), "America/Sao_Paulo").alias("b"),
                 S.utc_wall_clock("t").alias("w")).first()
    assert r.a == r.b == dt.date(2019, 12, 31)
    assert r.w == dt.datetime(2020, 1, 1, 1)


def _rows(spark, name):
    return sorted(QUERIES[name](spark, SF_SMALL).collect(), key=repr)


@pytest.mark.parametrize("name", ["label_join", "gap_runs", "daily_features", "register_labels"])
def test_queries_do_not_depend_on_the_session(spark, name):
    want = _rows(spark, name)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert _rows(spark, name) == want
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_integer_and_date_coercion(spark):
    t = spark.createDataFrame([("12100.0",), ("3304557.0",), ("1.21e4",), ("3.7",), ("",), ("x",)], "c string")
    assert [r[0] for r in t.select(S.to_long("c")).collect()] == [12100, 3304557, 12100, None, None, None]
    n = spark.createDataFrame([(12100.0,), (3.7,), (None,)], "c double")
    assert [r[0] for r in n.select(S.to_long("c")).collect()] == [12100, None, None]
    d = spark.createDataFrame([("7/15/2020",), ("2020-07-15",), ("bad",)], "c string")
    assert [r[0] for r in d.select(F.to_date(S.to_ts_coerce("c", ("M/d/yyyy",)))).collect()] == [
        dt.date(2020, 7, 15), dt.date(2020, 7, 15), None]


def test_label_join_refuses_repeated_keys(spark):
    x = spark.createDataFrame([("3100", dt.date(2010, 5, 1))], "CODIGO_MUNICIPIO_IBGE string, data_local date")
    row = (3100, dt.date(2010, 5, 1), "p1", 1, "a", "b")
    cols = "ibge long, data date, protocolo string, cobrade long, descricao_tipologia string, grupo_de_desastre string"
    assert labels.label_join(x, spark.createDataFrame([row], cols)).first().evento == 1
    with pytest.raises(Exception, match="repeated label key: 3100, 2010-05-01"):
        labels.label_join(x, spark.createDataFrame([row, row], cols)).collect()


def test_divisions_by_nothing(spark):
    years = spark.createDataFrame([(y, 0) for y in range(1996, 2001)], "ano long, sudeste long")
    r = reports.structural_break(years, 1998).first()
    assert r.media_antes == 0 and r.queda_pct is None and r.variacao_quebra_pct is None
    empty = spark.createDataFrame([], "k long, a long")
    r = spatial.crosscheck(empty, empty, "k", "a", "a").first()
    assert r.n_total == 0 and r.pct_concordancia is None


def _ring(points):
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])


def _cells(spark, n=12):
    return spark.createDataFrame([(r, c, float(r * 100 + c)) for r in range(n) for c in range(n)],
                                 "row long, col long, value double")


@pytest.mark.parametrize("points", [
    [(1, 12), (19, 12), (19, 13), (1, 13)],                     # strip narrower than a cell
    [(1, 1.3), (2, 1.1), (41, 40.2), (40, 40.6)],               # diagonal sliver
    [(12, 12), (13, 12), (12.5, 39)],                           # spike
    [(0, 0), (10, 0), (10, 10), (0, 10)]])
def test_touched_cells_for_any_bucket(spark, points):
    poly = spark.range(1).select(F.lit(1).cast("bigint").alias("poly_id"), _ring(points).alias("ring"))

    def meets(x0, y0, s=5.0, steps=4000):
        """Sampled edges and the cell's own inside, no shared formula."""
        for (xa, ya), (xb, yb) in zip(points, points[1:] + points[:1]):
            for k in range(steps + 1):
                x, y = xa + (xb - xa) * k / steps, ya + (yb - ya) * k / steps
                if x0 - 1e-9 <= x <= x0 + s + 1e-9 and y0 - 1e-9 <= y <= y0 + s + 1e-9:
                    return True
        inside, px, py = False, x0 + s / 2, y0 + s / 2
        for (xa, ya), (xb, yb) in zip(points, points[1:] + points[:1]):
            if (ya > py) != (yb > py) and px < (xb - xa) * (py - ya) / (yb - ya) + xa:
                inside = not inside
        return inside

    want = [float(r * 100 + c) for r in range(12) for c in range(12) if meets(c * 5.0, r * 5.0)]
    for grid in (7.0, 8.0, 20.0, 100.0):
        z = spatial.zonal_stats(_cells(spark), poly, "v", cell_size=5.0, grid=grid).first()
        assert (z.v_min, z.v_max) == (min(want), max(want))
        assert z.v_mean == pytest.approx(sum(want) / len(want))


def test_holes_and_parts(spark):
    rings = F.array(_ring([(0, 0), (10, 0), (10, 10), (0, 10)]), _ring([(4, 4), (6, 4), (6, 6), (4, 6)]),
                    _ring([(20, 0), (25, 0), (25, 5), (20, 5)]))
    poly = spark.range(1).select(F.lit(1).cast("bigint").alias("poly_id"), rings.alias("ring"))
    pts = spark.createDataFrame([(1, 2.0, 2.0), (2, 5.0, 5.0), (3, 22.0, 2.0), (4, 15.0, 2.0), (5, 4.0, 5.0)],
                                "CODIGO_WMO long, x double, y double")
    w = {r.CODIGO_WMO: (r.poly_within, r.na_borda) for r in spatial.point_in_polygon(pts, poly, cell=3.0).collect()}
    assert w == {1: (1, False), 2: (None, False), 3: (1, False), 4: (None, False), 5: (None, True)}
    n = {r.CODIGO_WMO: r.distancia for r in spatial.nearest_within(pts, poly, 30.0, cell=3.0).collect()}
    assert n == {1: 0.0, 2: 1.0, 3: 0.0, 4: 5.0, 5: 0.0}
    coarse = {r.CODIGO_WMO: r.distancia for r in spatial.nearest_within(pts, poly, 30.0, cell=50.0).collect()}
    assert coarse == n


def test_distance_from_degrees(spark):
    from math import asin, cos, radians, sin, sqrt
    poly = spark.range(1).select(F.lit(1).cast("bigint").alias("poly_id"),
                                 _ring([(-44, -20), (-43, -20), (-43, -19), (-44, -19)]).alias("ring"))
    pts = spark.createDataFrame([(1, -42.5, -19.5), (2, -42.0, -18.5), (3, -43.5, -19.5), (4, -30.0, -19.5)],
                                "CODIGO_WMO long, x double, y double")
    got = {r.CODIGO_WMO: r.distancia for r in
           spatial.nearest_within(pts, poly, 150.0, cell=1.0, lonlat=True).collect()}

    def haversine(a, b):
        (x1, y1), (x2, y2) = a, b
        h = sin(radians(y2 - y1) / 2) ** 2 + cos(radians(y1)) * cos(radians(y2)) * sin(radians(x2 - x1) / 2) ** 2
        return 2 * 6371.0 * asin(sqrt(h))
    assert got[1] == pytest.approx(haversine((-42.5, -19.5), (-43, -19.5)), rel=2e-3)
    assert got[2] == pytest.approx(haversine((-42.0, -18.5), (-43, -19)), rel=5e-3)
    assert got[3] == 0.0 and 4 not in got


def test_schema_contract_knows_renamed_columns(spark):
    df = spark.createDataFrame([], "`Código_Município` int, ` Data ` int, extra int, novo int")
    rows = {r.coluna: (r.status, r.encontrada) for r in quality.schema_contract_check(
        spark, df, ["codigo municipio", "data", "uf", "antigo"], {"antigo": "novo"}).collect()}
    assert rows == {"codigo municipio": ("renomeada", "código_município"), "data": ("ok", "data"),
                    "uf": ("faltando", None), "antigo": ("renomeada", "novo"), "extra": ("extra", "extra")}


def test_lost_part_is_reported(spark):
    src = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "p string, v int")
    ok = quality.row_conservation(src, src, "p").first()
    assert (ok.n_partes, ok.n_arquivos, ok.n_consolidado, ok.conservado) == (4, 3, 4, True)
    lost = quality.row_conservation(src, src.where("p is not null"), "p").first()
    assert (lost.n_consolidado, lost.partes_divergentes, lost.conservado) == (3, 1, False)
    moved = src.withColumn("p", F.lit("a"))
    assert not quality.row_conservation(src, moved, "p").first().conservado  # same total, other parts


def test_report_from_runs_equals_report_from_hours(spark):
    t0 = dt.datetime(2020, 1, 1)
    hours = [(s, t0 + dt.timedelta(hours=h), 1.0) for s, hs in
             {1: [0, 1, 5, 12, 70, 300], 2: [0], 3: list(range(30))}.items() for h in hs]
    h = spark.createDataFrame(hours, "CODIGO_WMO long, dt_utc timestamp, precip_mm double")
    runs, span = series.gap_runs(h), series.station_span(h)
    for fill in (False, True):
        a = series.imputation_report(series.impute_hourly(h, fill_all=fill))
        b = series.imputation_report_from_runs(runs, span, fill_all=fill)
        assert sorted(a.select(b.columns).collect()) == sorted(b.collect())


def test_station_files_with_quotes_and_blanks(spark, tmp_path):
    meta = ["REGIAO:;\xa0SE\x85", "UF:;MG", "ESTACAO:;X", "CODIGO (WMO):;A1", "LATITUDE:;1", "LONGITUDE:;2",
            "ALTITUDE:;3", "DATA DE FUNDACAO:;4"]
    lines = meta + ["Data;Hora UTC;OBS", '2020-01-01;0000 UTC;"a;b"', '2020-01-01;0100 UTC;"say ""hi"""',
                    '"2020-01-01";0200 UTC;plain', '2020-01-01;"x;y;z";w;too many']
    for name, body in (("a.csv", lines), ("empty.csv", meta + ["Data;Hora UTC;OBS"])):
        with open(os.path.join(tmp_path, name), "w", encoding="latin-1", newline="") as f:
            f.write("\n".join(body) + "\n")
    files = sf.list_station_files(spark, str(tmp_path))
    long = sf.parse_lines(sf.read_station_lines(spark, str(tmp_path)))
    rows = sorted(long.collect(), key=lambda r: r.linha)
    assert [r.campos[2] for r in rows] == ["a;b", 'say "hi"', "plain"]
    assert rows[0]["REGIAO"] == "SE" and rows[2].campos[0] == "2020-01-01"
    n = {os.path.basename(r.path): (r.linhas, r.vazio) for r in sf.ingest_summary(files, long).collect()}
    assert n == {"a.csv": (3, False), "empty.csv": (0, True)}


def test_ambiguous_column_names_are_refused(spark, tmp_path):
    with open(os.path.join(tmp_path, "a.csv"), "w", encoding="latin-1") as f:
        f.write("\n".join(["x"] * 8 + ["Data;Hora;UF", "2020-01-01;01:00;MG"]))
    with pytest.raises(ValueError, match="UF"):
        sf.ingest_station_files(spark, str(tmp_path))


def test_change_direction_in_one_aggregate(spark):
    a = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, None), (3, 3.0, 1.0)], "k int, x double, y double")
    b = spark.createDataFrame([(1, 0.5, 5.0), (2, 2.0, 1.0), (3, 1.0, 2.0)], "k int, x double, y double")
    d = compare.change_direction(a, b, ["k"], ["x", "y"])
    got = {r.coluna: (r.n_mudou, r.dif_min, r.dif_max, r.dif_abs_media, r.novo_sempre_menor_ou_igual) for r in d.collect()}
    assert got == {"x": (2, -2.0, -0.5, 1.25, True), "y": (1, 1.0, 1.0, 1.0, False)}


def test_a_changed_value_with_equal_counts_is_reported(spark):
    rows = [("a", 1, None), ("a", 2, "x"), ("b", 3, "y"), (None, 4, "z")]
    src = spark.createDataFrame(rows, "p string, v int, t string")
    for changed in ([("a", 1, None), ("a", 5, "x")], [("a", 1, ""), ("a", 2, "x")], [("a", None, None), ("a", 2, "x")]):
        r = quality.row_conservation(src, spark.createDataFrame([*changed, *rows[2:]], "p string, v int, t string"), "p").first()
        assert (r.partes_divergentes, r.partes_alteradas, r.conservado) == (0, 1, False)
    assert quality.row_conservation(src, src.orderBy(F.desc("v")), "p").first().conservado


def test_fingerprints_of_files_add_up(spark):
    df = spark.createDataFrame([("a", i, str(i % 3)) for i in range(40)] + [(None, 1, None)], "p string, v int, t string")
    whole = quality.part_fingerprints(df, "p")
    parts = quality.merged_fingerprints(*[quality.part_fingerprints(df.where(f"v % 3 = {k}"), "p") for k in range(3)])
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))


def test_coercion_errors_name_row_column_and_reason(spark):
    from pluvio.functions.scalars import to_date_coerce, to_long
    from pluvio.sources.tables import coercion_errors
    df = spark.createDataFrame([(1, "12", "2020-01-01"), (2, "1.5", " "), (3, "x", None), (4, "", "31/31/2000")],
                               "k int, code string, day string")
    got = coercion_errors(df, {"code": to_long("code"), "day": to_date_coerce("day")}, "k")
    assert sorted(map(tuple, got.collect())) == [
        (2, "code", "nao_inteiro", "1.5"), (2, "day", "vazio", " "), (3, "code", "invalido", "x"),
        (4, "code", "vazio", ""), (4, "day", "invalido", "31/31/2000")]
