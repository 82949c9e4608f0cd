import math
import random

import pytest
from pyspark.sql import functions as F

from pluvio.operators import spatial as sp
from pluvio.plans.catalog import QUERIES
from small_tables import SF_SMALL


def _square(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
                     for x, y in [(0, 0), (10, 0), (10, 10), (0, 10)]])
    return spark.range(1).select(F.lit(1).cast("bigint").alias("poly_id"), ring.alias("ring"))


def test_within_border_and_nearest(spark):
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 10.0, 5.0), (3, 13.0, 14.0), (4, 500.0, 500.0)],
                                "CODIGO_WMO long, x double, y double")
    polys = _square(spark)
    w = {r.CODIGO_WMO: r for r in sp.point_in_polygon(pts, polys, cell=4.0).collect()}
    assert w[1].poly_within == 1 and not w[1].na_borda
    assert w[2].poly_within is None and w[2].na_borda          # border is not "within"
    assert w[4].poly_within is None
    g = {r.CODIGO_WMO: r for r in sp.station_to_municipality(pts, polys, 10.0, cell=4.0).collect()}
    assert g[1].metodo == "within"
    assert g[2].metodo == "nearest" and g[2].distancia == 0.0
    assert g[3].metodo == "nearest" and abs(g[3].distancia - 5.0) < 1e-12
    assert g[4].metodo is None


def test_mosaic_first_valid_tile_wins(spark):
    cells = spark.createDataFrame([(1, 0, 0, -9999.0), (2, 0, 0, 5.0), (3, 0, 0, 7.0),
                                   (1, 0, 1, 1.0), (2, 0, 1, 2.0), (2, 1, 1, -9999.0)],
                                  "tile long, row long, col long, value double")
    m = {(r.row, r.col): (r.tile, r.value) for r in sp.mosaic_cells(cells).collect()}
    assert m == {(0, 0): (2, 5.0), (0, 1): (1, 1.0), (1, 1): (2, -9999.0)}


def test_zonal_stats_all_touched(spark):
    # 4 x 4 cells of side 5 covering [0, 20]^2; square polygon [0, 10]^2
    cells = spark.createDataFrame([(r, c, float(r * 4 + c)) for r in range(4) for c in range(4)],
                                  "row long, col long, value double")
    z = sp.zonal_stats(cells, _square(spark), "alt", cell_size=5.0, grid=20.0).first()
    # touched: rows/cols 0..2 (cells sharing the border at 10 touch it)
    vals = [float(r * 4 + c) for r in range(3) for c in range(3)]
    assert z.alt_max == max(vals) and z.alt_min == min(vals)
    assert abs(z.alt_mean - sum(vals) / len(vals)) < 1e-12


def _rings(spark, gid_rings):
    rows = [(g, [[(float(x), float(y)) for x, y in r] for r in rings]) for g, rings in gid_rings]
    return spark.createDataFrame(rows, "poly_id long, ring array<array<struct<x: double, y: double>>>")


def _star(rnd, cx, cy, r, n, grain):
    """A simple ring around a centre; ``grain`` puts its corners on a lattice."""
    out = []
    for k in range(n):
        a, d = 2 * math.pi * (k + 0.8 * rnd.random()) / n, r * (0.3 + 0.7 * rnd.random())
        out.append((round((cx + d * math.cos(a)) / grain) * grain, round((cy + d * math.sin(a)) / grain) * grain))
    return [p for p, q in zip(out, out[1:] + out[:1]) if p != q]


def _brute(point, rings):
    px, py = point
    inside, near = False, math.inf
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                inside = not inside
            t = max(0.0, min(1.0, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)))
            near = min(near, math.hypot(x1 + t * (x2 - x1) - px, y1 + t * (y2 - y1) - py))
    return (inside and near > 0), near == 0, (0.0 if inside else near)


@pytest.mark.parametrize("seed,grain,cell", [(1, 1.0, 4.0), (2, 0.25, 7.0), (3, 1.0, 50.0), (4, 0.5, 1.5)])
def test_points_against_brute_force_on_random_rings(spark, seed, grain, cell):
    rnd = random.Random(seed)
    polys = []
    for g in range(6):
        cx, cy = rnd.uniform(-30, 30), rnd.uniform(-30, 30)
        rings = [_star(rnd, cx, cy, 14, 12, grain), _star(rnd, cx, cy, 3, 5, grain), _star(rnd, cx + 40, cy, 5, 7, grain)]
        polys.append((g, [r for r in rings if len(r) > 2]))
    pts = [(i, rnd.uniform(-50, 80), rnd.uniform(-50, 50)) for i in range(150)]
    pts += [(1000 + i, float(rnd.randrange(-40, 70)), float(rnd.randrange(-40, 40))) for i in range(150)]   # on the lattice
    corners = [p for _, rings in polys for r in rings for p in r]
    pts += [(2000 + i, float(x), float(y)) for i, (x, y) in enumerate(corners[:60])]                          # on borders
    got = {r.CODIGO_WMO: r for r in sp.station_to_municipality(
        spark.createDataFrame(pts, "CODIGO_WMO long, x double, y double"), _rings(spark, polys), 9.0, cell=cell).collect()}
    borders = {r.CODIGO_WMO: r.na_borda for r in sp.point_in_polygon(
        spark.createDataFrame(pts, "CODIGO_WMO long, x double, y double"), _rings(spark, polys), cell=cell).collect()}
    for i, x, y in pts:
        each = {g: _brute((x, y), rings) for g, rings in polys}
        within = min((g for g, (a, _, _) in each.items() if a), default=None)
        d, near = min((d, g) for g, (_, _, d) in each.items())
        r = got[i]
        if within is not None:
            assert (r.poly_id, r.metodo, r.distancia) == (within, "within", 0.0), (i, x, y)
        elif d <= 9.0:
            assert r.metodo == "nearest" and abs(r.distancia - d) < 1e-9 and abs(each[r.poly_id][2] - d) < 1e-9, (i, x, y)
        else:
            assert r.poly_id is None and r.metodo is None, (i, x, y)
        assert borders[i] == any(b for _, b, _ in each.values()), (i, x, y)


def test_a_long_ring_ships_each_edge_few_times(spark):
    n = 100_000
    k = 2 * math.pi / n
    point = "named_struct('x', 500 + (400 + 20 * sin(40 * i * {k})) * cos(i * {k}), 'y', 500 + (400 + 20 * sin(40 * i * {k})) * sin(i * {k}))"
    poly = spark.range(1).select(F.lit(1).cast("long").alias("poly_id"), F.expr(
        f"transform(sequence(0, {n - 1}), i -> {point.format(k=k)})").alias("ring"))
    cells = sp.clipped_cells(poly, 30.0).select("cy", "cx", "cx_last", "inside", F.size("edges").alias("n")).collect()
    assert sum(c.n for c in cells) < 1.1 * n                       # an edge is in one cell, or two at a cell's border
    assert max(c.n for c in cells) < n / 20
    covered = sum(c.cx_last - c.cx + 1 for c in cells)
    assert 600 < covered < 1000 and any(c.cx_last > c.cx and c.inside for c in cells)
    pts = spark.createDataFrame([(1, 500.0, 500.0), (2, 899.0, 500.0), (3, 950.0, 500.0)], "CODIGO_WMO long, x double, y double")
    got = {r.CODIGO_WMO: r.poly_within for r in sp.point_in_polygon(pts, poly, cell=30.0).collect()}
    assert got == {1: 1, 2: 1, 3: None}


def test_raster_side_runs_no_ring_test(spark):
    cells = spark.createDataFrame([(0, 0, 1.0)], "row long, col long, value double")
    z = sp.zonal_stats(cells, _square(spark), "alt", cell_size=5.0)
    plan = z._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan


def test_points_of_a_full_cell_are_the_work_of_many_tasks(spark):
    pts = spark.range(4000).select(F.col("id").alias("CODIGO_WMO"), (20.0 + F.col("id") % 50).alias("x"),
                                   (20.0 + F.col("id") % 7).alias("y"))          # all in one cell
    plans, meet = [], sp._meet

    def spy(*a):
        plans.append(meet(*a))
        return plans[-1]
    with pytest.MonkeyPatch.context() as mp:
        mp.setattr(sp, "_meet", spy)
        got = sp.nearest_within(pts, _square(spark), 100.0, cell=100.0)
    assert len(plans) == 2                                                    # containment, distances
    for met in plans:
        shares = [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
        assert len(shares) >= 6 and max(shares) < 2 * sum(shares) / len(shares)
    d = {r.CODIGO_WMO: (r.poly_nearest, r.distancia) for r in got.collect()}
    assert len(d) == 4000
    assert all(d[i] == (1, pytest.approx(math.hypot(10.0 + i % 50, 10.0 + i % 7))) for i in range(4000))


@pytest.mark.parametrize("lonlat", [False, True])
def test_distances_are_plain_columns_not_lambdas(spark, lonlat):
    pts = spark.createDataFrame([(1, 13.0, 14.0)], "CODIGO_WMO long, x double, y double")
    near = sp.nearest_within(pts, _square(spark), 1000.0, cell=4.0, lonlat=lonlat)
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan and "array_min(" not in plan
    want = math.hypot(3.0 * sp.KM_PER_DEGREE * math.cos(math.radians(14)), 4.0 * sp.KM_PER_DEGREE) if lonlat else 5.0
    assert near.first().distancia == pytest.approx(want)


def test_repeated_and_missing_station_keys_keep_their_results(spark):
    pts = spark.createDataFrame([(1, 5.0, 5.0), (1, 5.0, 5.0), (1, 13.0, 14.0), (None, 10.0, 5.0), (2, None, 5.0), (3, 12.0, 5.0)],
                                "CODIGO_WMO long, x double, y double")
    got = {r.CODIGO_WMO: tuple(r)[1:] for r in sp.locate(pts, _square(spark), 10.0, cell=4.0).collect()}
    assert got == {1: (1, False, 1, 0.0), None: (None, True, 1, 0.0), 3: (None, False, 1, 2.0)}


@pytest.mark.parametrize("name", ["name_divergence", "municipality_lonlat", "crosscheck_join"])
def test_bridge_queries_deal_their_points_to_all_tasks(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 4 and "array_min(" not in plan
