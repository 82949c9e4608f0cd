"""Spatial and raster operators as table jobs.

Geometry model: planar coordinates in a metric projection (x, y in km) or, for
distances, longitude / latitude in degrees (``lonlat=True``); polygons as one
ring ``array<struct<x double, y double>>`` or as several (parts and holes alike:
``array<array<struct>>``, even-odd over all edges), first vertex not repeated;
rasters as cell tables ``(tile, row, col, value)``.

Polygons are cut up once on a grid (``clipped_cells``). A cell that edges cross keeps
just those edges and whether one seed point of it lies inside; a scanline over the
seeds' row says so for every cell, and which cells between are wholly inside. So each
edge goes to the few cells that it crosses, whatever the ring's length, and a point is
decided by its own cell: the seed's flag, turned over by each edge between seed and
point. Rasters take the same cells as runs of columns per row, and distances come from
the edges in cells within reach that no nearer cell rules out, one row per point and
edge. The tests on a cell's edges are built-in higher-order functions written as SQL
expression text (one parse each, no Python UDF).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.operators.stats import percentiles_from_hist
from pluvio.session import persist_table

#: Kilometres per degree of latitude (and of longitude on the equator).
KM_PER_DEGREE = 111.195


def _one_list(polys: DataFrame, ring: str) -> DataFrame:
    """Polygons with the rings as a list, whether given as one ring or several."""
    if polys.schema[ring].dataType.elementType.typeName() == "array":
        return polys
    return polys.withColumn(ring, F.array(ring))


def _edge_rows(polys: DataFrame, gid: str, ring: str) -> DataFrame:
    """One row per edge: (gid, x1, y1, x2, y2), each ring closed."""
    rings = _one_list(polys, ring).select(gid, F.explode(ring).alias("__r"))
    edge = F.expr("explode(zip_with(__r, concat(slice(__r, 2, size(__r)), slice(__r, 1, 1)), "
                  "(a, b) -> named_struct('x1', a.x, 'y1', a.y, 'x2', b.x, 'y2', b.y)))")
    return rings.select(gid, edge.alias("e"))


#: Where a cell's seed point lies, as shares of its sides. Odd shares,
#: so that no edge between ordinary coordinates runs through a seed.
SEED_X, SEED_Y = 0.41421356237309503, 0.7320508075688772
#: Cells an edge only just misses are taken as well; an edge too many does no harm.
SLACK = 1e-9


def _on_edge_sql(px: str, py: str) -> str:
    return (f"((e.x2 - e.x1) * ({py} - e.y1) - (e.y2 - e.y1) * ({px} - e.x1) = 0 "
            f"AND {px} >= least(e.x1, e.x2) AND {px} <= greatest(e.x1, e.x2) "
            f"AND {py} >= least(e.y1, e.y2) AND {py} <= greatest(e.y1, e.y2))")


def _between_sql(sx: str, sy: str, px: str, py: str) -> str:
    """Edge ``e`` lies between the seed and the point: its ends are on two sides of the
    line through them (an end on it counts to the right), and they are on two sides of
    the edge's line."""
    def side(x, y):
        return f"(({px} - {sx}) * ({y} - {sy}) - ({py} - {sy}) * ({x} - {sx}) > 0)"

    def edge_side(x, y):
        return f"((e.x2 - e.x1) * ({y} - e.y1) - (e.y2 - e.y1) * ({x} - e.x1) > 0)"
    return (f"({side('e.x1', 'e.y1')} <> {side('e.x2', 'e.y2')} "
            f"AND {edge_side(sx, sy)} <> {edge_side(px, py)})")


def clipped_cells(polys: DataFrame, cell: float, gid: str = "poly_id", ring: str = "ring") -> DataFrame:
    """Polygons on a grid of side ``cell``: (gid, cx, cy, cx_last, edges, inside, met).

    A row with edges is one cell (``cx = cx_last``): the edges that cross it, whether
    its seed point is inside, and whether an edge meets its closed box. A row without
    edges is a run of cells wholly inside. Cells wholly outside have no row. Rows per
    polygon follow the length of its border and its rows, not its area."""
    e = _edge_rows(polys, gid, ring)
    low, high = "least(e.y1, e.y2)", "greatest(e.y1, e.y2)"
    rows = e.select(gid, "e", F.explode(F.expr(
        f"sequence(cast(floor({low} / {cell} - {SLACK}) as int), cast(floor({high} / {cell} + {SLACK}) as int))")).alias("cy"))

    def x_at(y: str) -> str:
        return f"e.x1 + (e.x2 - e.x1) * (({y} - e.y1) / (e.y2 - e.y1))"

    def clamp(y: str) -> str:
        return f"least(greatest({y}, {low}), {high})"
    bottom, top = (f"CASE WHEN e.y1 = e.y2 THEN e.x{i + 1} ELSE {x_at(clamp(f'(cy + {i}) * {cell}'))} END" for i in (0, 1))
    line = f"((cy + {SEED_Y}D) * {cell})"
    crossing = f"CASE WHEN (e.y1 > {line}) <> (e.y2 > {line}) THEN {x_at(line)} END"
    rows = rows.select(gid, "e", "cy", F.expr(bottom).alias("xa"), F.expr(top).alias("xb"), F.expr(crossing).alias("xs"))
    # the crossing lies between both ends, rounding aside: its column is always among the columns
    cols = rows.withColumn("cx", F.explode(F.expr(
        f"sequence(cast(floor(least(xa, xb, xs) / {cell} - {SLACK}) as int), "
        f"cast(floor(greatest(xa, xb, xs) / {cell} + {SLACK}) as int))")))
    here = F.expr(f"xs IS NOT NULL AND cast(floor(xs / {cell}) as int) = cx")
    seed_x, seed_y = f"((cx + {SEED_X}D) * {cell})", line
    met = F.expr(edge_box_sql(f"(cx * {cell})", f"(cy * {cell})", cell))
    held = cols.groupBy(gid, "cy", "cx").agg(
        F.collect_list("e").alias("edges"), F.bool_or(met).alias("met"),
        F.count_if(here).alias("n"), F.count_if(here & F.expr(f"xs < {seed_x}")).alias("left"),
        F.bool_or(F.expr(_on_edge_sql(seed_x, seed_y))).alias("on_seed"))
    along = Window.partitionBy(gid, "cy").orderBy("cx")
    line_up = held.select(
        "*", (F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
        F.lead("cx").over(along).alias("next"))
    inside = F.when(F.col("on_seed"), F.raise_error(F.lit("an edge runs through a cell's seed: choose another cell size"))) \
              .otherwise((F.col("before") + F.col("left")) % 2 == 1)
    own = F.struct(F.col("cx"), F.col("cx").alias("cx_last"), "edges", inside.alias("inside"), "met")
    run = F.when(((F.col("before") + F.col("n")) % 2 == 1) & (F.col("next") > F.col("cx") + 1), F.struct(
        (F.col("cx") + 1).alias("cx"), (F.col("next") - 1).alias("cx_last"), F.slice("edges", 1, 0).alias("edges"),
        F.lit(True).alias("inside"), F.lit(False).alias("met")))
    return line_up.select(gid, "cy", F.explode(F.array_compact(F.array(own, run))).alias("c")).select(gid, "cy", "c.*")


def distance_sql(edges: str, px: str, py: str, lonlat: bool = False) -> str:
    """Smallest point-segment distance from the point to the edges. With
    ``lonlat`` the coordinates are degrees and the distance is in km: edges are
    laid out on the plane that touches the sphere at the point, whose error is
    under 0.1 % at 100 km outside the polar regions."""
    if lonlat:
        kx = f"({KM_PER_DEGREE} * cos(radians({py})))"
        flat = (f"transform({edges}, e -> named_struct('x1', (e.x1 - {px}) * {kx}, 'y1', (e.y1 - {py}) * {KM_PER_DEGREE}, "
                f"'x2', (e.x2 - {px}) * {kx}, 'y2', (e.y2 - {py}) * {KM_PER_DEGREE}))")
        return distance_sql(flat, "0.0D", "0.0D")
    t = (f"CASE WHEN (e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1) = 0 THEN 0.0 "
         f"ELSE least(1.0, greatest(0.0, (({px} - e.x1) * (e.x2 - e.x1) + ({py} - e.y1) * (e.y2 - e.y1)) "
         f"/ ((e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1)))) END")
    return (f"array_min(transform({edges}, e -> sqrt("
            f"(e.x1 + ({t}) * (e.x2 - e.x1) - {px}) * (e.x1 + ({t}) * (e.x2 - e.x1) - {px}) + "
            f"(e.y1 + ({t}) * (e.y2 - e.y1) - {py}) * (e.y1 + ({t}) * (e.y2 - e.y1) - {py}))))")


def point_cells(points: DataFrame, x: str, y: str, cell: float) -> DataFrame:
    return points.withColumns({"__cx": F.floor(F.col(x) / cell).cast("int"),
                               "__cy": F.floor(F.col(y) / cell).cast("int")})


def _candidate_cells(cells: DataFrame, cell: float, reach: float, gid: str, lonlat: bool) -> DataFrame:
    """For the points of each grid cell (__cx, __cy): the cells (gid, bx, by) whose edges
    may be nearest to one of them. A cell is left out if even its nearest corner is
    farther than ``reach``, or than the farthest corner of some other cell with edges."""
    border = cells.where("size(edges) > 0").select(gid, F.col("cx").alias("bx"), F.col("cy").alias("by"))
    unit = KM_PER_DEGREE if lonlat else 1.0
    up = int(math.ceil(reach / unit / cell)) + 1
    near = border.withColumn("__cy", F.explode(F.expr(f"sequence(by - {up}, by + {up})")))
    if lonlat:  # cosine of the points' latitudes, at its least and greatest in the row
        south, north = f"radians(__cy * {cell})", f"radians((__cy + 1) * {cell})"
        least_cos = f"greatest(0.01, least(cos({south}), cos({north})))"
        most_cos = f"CASE WHEN __cy * {cell} <= 0 AND (__cy + 1) * {cell} >= 0 THEN 1.0 ELSE greatest(cos({south}), cos({north})) END"
    else:
        least_cos = most_cos = "1.0D"
    side = f"(cast(ceil({reach} / ({unit} * {least_cos}) / {cell}) as int) + 1)"
    near = near.withColumn("__cx", F.explode(F.expr(f"sequence(bx - {side}, bx + {side})")))

    def distance(gap_x: str, gap_y: str, cos: str) -> Column:
        return F.expr(f"sqrt(pow({gap_x} * {cell} * {unit} * {cos}, 2) + pow({gap_y} * {cell} * {unit}, 2))")
    gap = "greatest(abs({0} - {1}) - 1, 0)"
    least = distance(gap.format("__cx", "bx"), gap.format("__cy", "by"), f"({least_cos})")
    most = distance("(abs(__cx - bx) + 1)", "(abs(__cy - by) + 1)", f"({most_cos})")
    bounded = near.select(gid, "bx", "by", "__cx", "__cy", least.alias("least"), most.alias("most")) \
                  .where(F.col("least") <= reach * (1 + SLACK))
    bound = F.min("most").over(Window.partitionBy("__cx", "__cy"))
    return bounded.withColumn("bound", bound).where(F.col("least") <= F.col("bound") * (1 + SLACK)) \
                  .select(gid, "bx", "by", "__cx", "__cy")


#: Fixed value: the points of one grid cell are dealt to so many blocks, so that a full
#: cell is the work of many tasks.
BLOCKS = 64


def _edge_distance(rows: DataFrame, x: str, y: str, lonlat: bool, keep: Sequence[str]) -> DataFrame:
    """``distance_sql`` for rows with one edge (x1, y1, x2, y2) each, in plain columns."""
    at = rows
    px, py = (F.lit(0.0), F.lit(0.0)) if lonlat else (F.col(x), F.col(y))
    if lonlat:
        at = at.select(*keep, *[((F.col(f"x{i}") - F.col(x)) * F.col("__kx")).alias(f"x{i}") for i in (1, 2)],
                       *[((F.col(f"y{i}") - F.col(y)) * F.lit(KM_PER_DEGREE)).alias(f"y{i}") for i in (1, 2)])
    t = F.expr("CASE WHEN dx * dx + dy * dy = 0 THEN 0.0D ELSE "
               "least(1.0D, greatest(0.0D, (px * dx + py * dy) / (dx * dx + dy * dy))) END")
    at = at.select(*keep, "x1", "y1", px.alias("__px"), py.alias("__py"),
                   (F.col("x2") - F.col("x1")).alias("dx"), (F.col("y2") - F.col("y1")).alias("dy"),
                   (px - F.col("x1")).alias("px"), (py - F.col("y1")).alias("py"))
    at = at.select(*keep, (F.col("x1") + t * F.col("dx") - F.col("__px")).alias("gx"),
                   (F.col("y1") + t * F.col("dy") - F.col("__py")).alias("gy"))
    return at.select(*keep, F.expr("sqrt(gx * gx + gy * gy)").alias("dist"))


def _meet(points: DataFrame, entries: DataFrame, at: Sequence[str]) -> DataFrame:
    """Points with the entries of their grid cell. Both are dealt by cell and block to a
    fixed number of tasks: a point is a few bytes but many tests, so tasks merged or
    sides broadcast by their bytes would leave most of the work to a few of them."""
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = points.select(*at, "__block").distinct()
    dealt = entries.join(blocks, list(at)).repartition(n, *at, "__block")
    return points.repartition(n, *at, "__block").join(dealt.hint("merge"), [*at, "__block"])


def locate(points: DataFrame, polys: DataFrame, reach: float | None = None, pid: str = "CODIGO_WMO",
           x: str = "x", y: str = "y", gid: str = "poly_id", cell: float = 100.0, ring: str = "ring",
           lonlat: bool = False) -> DataFrame:
    """Per point that some polygon contains, borders or, with ``reach``, comes near:
    (pid, poly_within, na_borda, poly_nearest, distancia).

    ``poly_within``: the polygon that strictly contains the point (the smallest id if
    several); ``na_borda``: it lies on a border; ``poly_nearest`` / ``distancia``: the
    nearest polygon within ``reach`` (distance 0 inside and on the border; ties: the
    smallest id). ``lonlat``: coordinates and ``cell`` in degrees, ``reach`` in km. Each
    point meets the entries of its own grid cell: the clipped polygons, which say whether
    they contain it, and with ``reach`` the edges that may be nearest, a row for each."""
    cells = clipped_cells(polys.select(gid, ring), cell, gid, ring)
    if reach is not None:
        cells = persist_table(cells, "clipped")
    grid = ["__cx", "__cy"]
    pts = point_cells(points.select(pid, x, y), x, y, cell) \
        .withColumn("__block", F.pmod(F.xxhash64(pid, x, y), F.lit(BLOCKS)).cast("int"))
    each = F.explode(F.expr("sequence(cx, cx_last)"))
    entries = cells.select(gid, each.alias("__cx"), F.col("cy").alias("__cy"), "edges", "inside")
    px, py = f"`{x}`", f"`{y}`"
    seed = f"((__cx + {SEED_X}D) * {cell})", f"((__cy + {SEED_Y}D) * {cell})"
    turned = f"aggregate(edges, 0, (n, e) -> n + CASE WHEN {_between_sql(*seed, px, py)} THEN 1 ELSE 0 END) % 2 = 1"
    own = _meet(pts, entries, grid).select(
        pid, gid, F.expr(f"exists(edges, e -> {_on_edge_sql(px, py)})").alias("on"),
        F.expr(f"inside <> ({turned})").alias("in"))
    told = own.select(pid, gid, (F.col("in") & ~F.col("on")).alias("in"), "on",
                      F.when(F.col("in") | F.col("on"), F.lit(0.0)).alias("dist"))
    if reach is not None:
        # an edge may cross several cells: once is enough
        near = _candidate_cells(cells, cell, reach, gid, lonlat).join(
            cells.where("size(edges) > 0").select(gid, F.col("cx").alias("bx"), F.col("cy").alias("by"), "edges"),
            [gid, "bx", "by"]).select(gid, *grid, F.inline("edges")).distinct()
        kx = F.expr(f"{KM_PER_DEGREE} * cos(radians({py}))")
        met = _meet(pts.withColumn("__kx", kx) if lonlat else pts, near, grid)
        far = _edge_distance(met, x, y, lonlat, [pid, gid])
        no = F.lit(None).cast("boolean")
        told = told.unionByName(far.select(pid, gid, no.alias("in"), no.alias("on"), "dist"))
    hit = told.groupBy(pid).agg(
        F.min(F.when(F.col("in"), F.col(gid))).alias("poly_within"),
        F.coalesce(F.bool_or("on"), F.lit(False)).alias("na_borda"),
        F.min(F.when(F.col("dist") <= (0.0 if reach is None else reach), F.struct(F.col("dist"), F.col(gid)))).alias("__b"))
    return hit.select(pid, "poly_within", "na_borda", F.col(f"__b.{gid}").alias("poly_nearest"),
                      F.col("__b.dist").alias("distancia"))


def point_in_polygon(points: DataFrame, polys: DataFrame, pid: str = "CODIGO_WMO",
                     x: str = "x", y: str = "y", gid: str = "poly_id", cell: float = 100.0,
                     ring: str = "ring") -> DataFrame:
    """Every point with the polygon that strictly contains it (NULL when
    none; the smallest id if several) and whether it lies on a border."""
    hit = locate(points, polys, None, pid, x, y, gid, cell, ring).select(pid, "poly_within", "na_borda")
    return (points.select(pid, x, y).join(hit, pid, "left")
            .withColumn("na_borda", F.coalesce("na_borda", F.lit(False))))


def nearest_within(points: DataFrame, polys: DataFrame, max_dist: float = 100.0,
                   pid: str = "CODIGO_WMO", x: str = "x", y: str = "y", gid: str = "poly_id",
                   cell: float = 100.0, ring: str = "ring", lonlat: bool = False) -> DataFrame:
    """Nearest polygon within ``max_dist`` of each point (distance 0 when
    inside or on the border); ties -> smallest id. Points with no polygon in
    reach are absent. ``lonlat``: coordinates and ``cell`` in degrees,
    ``max_dist`` in km."""
    found = locate(points, polys, max_dist, pid, x, y, gid, cell, ring, lonlat)
    return found.where(F.col("poly_nearest").isNotNull()).select(pid, "poly_nearest", "distancia")


def station_to_municipality(points: DataFrame, polys: DataFrame, max_dist: float = 100.0,
                            pid: str = "CODIGO_WMO", x: str = "x", y: str = "y",
                            gid: str = "poly_id", cell: float = 100.0,
                            lonlat: bool = False) -> DataFrame:
    """Bridge by geometry: within-polygon first, nearest within ``max_dist``
    as fallback; ``metodo`` tells which (NULL: no municipality)."""
    found = locate(points, polys, max_dist, pid, x, y, gid, cell, lonlat=lonlat)
    j = points.select(pid, x, y).join(found, pid, "left")
    return j.select(pid, x, y, F.coalesce("poly_within", "poly_nearest").alias(gid),
                    F.when(F.col("poly_within").isNotNull(), "within")
                     .when(F.col("poly_nearest").isNotNull(), "nearest").alias("metodo"),
                    F.when(F.col("poly_within").isNotNull(), F.lit(0.0))
                     .otherwise(F.col("distancia")).alias("distancia"))


def crosscheck(a: DataFrame, b: DataFrame, key: str, col_a: str, col_b: str) -> DataFrame:
    """Agreement of two key -> value mappings (full outer join, NULL-safe)."""
    j = a.select(key, F.col(col_a).alias("__a")).join(
        b.select(key, F.col(col_b).alias("__b")), key, "full")
    return j.agg(F.count(F.lit(1)).cast("bigint").alias("n_total"),
                 F.count_if(F.col("__a").eqNullSafe(F.col("__b"))).cast("bigint").alias("n_concordam")) \
            .withColumn("pct_concordancia", F.round(100.0 * F.col("n_concordam")
                                                    / F.nullif(F.col("n_total"), F.lit(0)), 4))


def mosaic_cells(cells: DataFrame, tile: str = "tile", row: str = "row", col: str = "col",
                 value: str = "value", nodata: float = -9999.0) -> DataFrame:
    """Merge overlapping tiles: per cell the first tile (lowest order) with
    a valid value wins; NODATA when no tile has one."""
    # numbers only: a hash aggregate with a partial step, no sort of the cells
    valid = F.when(F.coalesce(F.col(value) != nodata, F.lit(False)), F.col(tile))
    best = cells.groupBy(row, col).agg(
        F.min(valid).alias("__t"), F.min_by(value, valid).alias("__v"),
        F.min(tile).alias("__t0"))
    return best.select(row, col, F.coalesce("__t", "__t0").alias(tile),
                       F.coalesce("__v", F.lit(nodata)).alias(value))


def edge_box_sql(x0: str, y0: str, size: float) -> str:
    """Edge ``e`` meets the box [x0, x0+size] x [y0, y0+size] (borders included):
    their extents overlap on both axes, and the box's corners do not all lie
    strictly on one side of the edge's line."""
    def side(dx, dy):
        return f"(e.x2 - e.x1) * ({y0} + {dy} - e.y1) - (e.y2 - e.y1) * ({x0} + {dx} - e.x1)"
    corners = ", ".join(side(dx, dy) for dx in (0.0, size) for dy in (0.0, size))
    return (f"least(e.x1, e.x2) <= {x0} + {size} AND greatest(e.x1, e.x2) >= {x0} "
            f"AND least(e.y1, e.y2) <= {y0} + {size} AND greatest(e.y1, e.y2) >= {y0} "
            f"AND least({corners}) <= 0 AND greatest({corners}) >= 0")


def touched_runs(polys: DataFrame, cell_size: float, gid: str = "poly_id", ring: str = "ring") -> DataFrame:
    """(gid, row, col, col_last): runs of the raster cells that a polygon touches, where
    an edge meets the closed cell or the cell lies inside. Runs of a polygon do not
    overlap."""
    cells = clipped_cells(polys.select(gid, ring), cell_size, gid, ring)
    return cells.where("met OR inside").select(gid, F.col("cy").alias("row"), F.col("cx").alias("col"),
                                               F.col("cx_last").alias("col_last"))


def zonal_stats(mosaic: DataFrame, polys: DataFrame, prefix: str, cell_size: float = 5.0,
                grid: float = 100.0, gid: str = "poly_id", nodata: float = -9999.0,
                row: str = "row", col: str = "col", value: str = "value",
                ring: str = "ring") -> DataFrame:
    """Per polygon: mean, max, min, std (population) and exact median of
    the valid cells touched by the polygon (``all_touched``)."""
    return zonal_stats_multi({prefix: mosaic}, polys, cell_size, grid, gid, nodata, row, col,
                             value, ring)


def zonal_stats_multi(mosaics: dict, polys: DataFrame, cell_size: float = 5.0,
                      grid: float = 100.0, gid: str = "poly_id", nodata: float = -9999.0,
                      row: str = "row", col: str = "col", value: str = "value",
                      ring: str = "ring") -> DataFrame:
    """``zonal_stats`` for several rasters on the same cell grid at once:
    the products are joined per cell (their mosaics are already partitioned
    by cell, so no shuffle), the geometry test runs once per (cell, polygon)
    and one histogram pass feeds all statistics of all products."""
    names = list(mosaics)
    cells = None
    for p_ in names:
        m = mosaics[p_].select(row, col, F.when(F.col(value) != nodata, F.col(value)).alias(p_))
        cells = m if cells is None else cells.join(m, [row, col], "full")
    any_valid = F.col(names[0]).isNotNull()
    for p_ in names[1:]:
        any_valid = any_valid | F.col(p_).isNotNull()
    cells = cells.filter(any_valid)
    # runs and cells meet by row and block of columns
    block = max(1, int(grid / cell_size))
    runs = touched_runs(polys, cell_size, gid, ring).select(
        gid, F.col("row").alias("__row"), F.col("col").alias("__from"), F.col("col_last").alias("__to"),
        F.explode(F.expr(f"sequence(cast(floor(col / {block}) as int), cast(floor(col_last / {block}) as int))")).alias("__cx"))
    c = cells.withColumn("__cx", F.floor(F.col(col) / block).cast("int"))
    hit = c.join(runs, (F.col(row) == F.col("__row")) & (c["__cx"] == runs["__cx"])).where(
        F.col(col).between(F.col("__from"), F.col("__to")))
    long = hit.select(gid, F.explode(F.array(*[F.struct(F.lit(p_).alias("produto"),
                                                          F.col(p_).alias("valor"))
                                                 for p_ in names])).alias("__v")) \
              .select(gid, "__v.produto", "__v.valor").filter(F.col("valor").isNotNull())
    g = [gid, "produto"]
    # one histogram pass feeds every statistic
    hist = long.groupBy(*g, "valor").agg(F.count(F.lit(1)).alias("cnt"))
    m = hist.groupBy(*g).agg((F.sum(F.col("valor") * F.col("cnt")) / F.sum("cnt")).alias("mean"),
                             F.max("valor").alias("max"), F.min("valor").alias("min"))
    # population variance, two-pass (numerically stable) over the histogram
    var = hist.join(m.select(*g, F.col("mean").alias("__mean")), g).groupBy(*g).agg(
        (F.sum(F.col("cnt") * (F.col("valor") - F.col("__mean")) ** 2) / F.sum("cnt")).alias("__var"))
    med = percentiles_from_hist(hist, g, "valor", "cnt", (0.5,)).select(
        *g, F.col("p50").alias("median"))
    per = m.join(var, g).join(med, g, "left").withColumn("std", F.sqrt("__var"))
    stats = ["mean", "max", "min", "std", "median"]
    wide = per.groupBy(gid).pivot("produto", names).agg(*[F.first(x).alias(x) for x in stats])
    return wide.select(gid, *[F.col(f"{p_}_{x}") for p_ in names for x in stats])


def region_filter(df: DataFrame, code: str, prefixes: Sequence[str], n: int = 2) -> DataFrame:
    """Keep rows whose code starts with one of the given prefixes."""
    return df.filter(F.substring(F.col(code).cast("string"), 1, n).isin(list(prefixes)))
