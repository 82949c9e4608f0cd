"""Stand-in inputs: the reference's roles (stations, hourly rain, register,
feature tables) derived by Spark from the shared test tables.

Mapping (see FIXTURES.md section 3):

* station -> ``events.user_id`` / ``customer.c_custkey``; municipality ->
  ``c_nationkey``; state/region -> nation / region names.
* hourly rain -> ``sum(events.value)`` per (user, UTC hour).
* disaster register -> ``orders``: event date ``o_orderdate``, record date
  ``min(l_shipdate)`` (NULL without line items), code from the priority digit
  (``12000 + 100 * digit``; digits 1-3 are the hydrological codes), region
  ``AMERICA`` in the role of the studied region, record year 2001 in the role of
  the discarded future year.
* label-join X / Y -> ``purchase`` events by (nation, local day) / ``error``
  events with ``value > 100``; unmatched rows are days without a reading.
* two versions of the features -> the older one from all events but ``signup``,
  the newer one from all but ``error``, so keys differ where the data do.

Every role is a lazy DataFrame over whole tables: nothing is sampled or capped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.functions.scalars import utc_instant, utc_to_local_day
from pluvio.operators import features as feat
from pluvio.operators import labels as lab
from pluvio.plans.common import read

# Fixed values of the stand-in plans.
#: First appended day and block length of the append query (parameters).
APPEND_FROM = dt.date(2024, 1, 16)
APPEND_BLOCK_DAYS = 8

LOCAL_TZ = "-03:00"           # fixed offset, so the oracle needs no zone data
REPORTED_AFTER = 1            # days from the reading to the day a label is dated
Y_MIN_VALUE = 100.0
REGION = "america"            # plays the studied region
YEAR_LO, YEAR_HI = 1996, 2000
FUTURE_LO, FUTURE_HI = 2001, 2003
CALENDAR_LO, CALENDAR_HI = 1995, 2002
DROP_RECORD_YEAR = 2001
EXCLUDE_ACCTBAL = 9000.0      # suppliers above this play the exclusion list


def geo(spark: SparkSession, d: str) -> DataFrame:
    """nation -> region names. Both tables have a fixed size (25 and 5 rows
    in every scale factor), so broadcasting them is bounded."""
    n = read(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read(spark, d, "region", ["r_regionkey", "r_name"])
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey) \
            .select("n_nationkey", "n_name", "r_name")


def bridge(spark: SparkSession, d: str) -> DataFrame:
    """Station -> municipality bridge (customer -> nation)."""
    c = read(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey"])
    g = geo(spark, d)
    return (c.join(F.broadcast(g), c.c_nationkey == g.n_nationkey)
             .select(F.col("c_custkey").alias("CODIGO_WMO"),
                     F.col("c_name").alias("ESTACAO"),
                     F.col("c_nationkey").cast("bigint").alias("ibge"),
                     F.col("n_name").alias("municipio_ibge"),
                     F.col("r_name").alias("uf")))


EXACT = "decimal(18,2)"       # event values have two decimals: sums without error


def events_hourly(spark: SparkSession, d: str, exact: bool = False) -> DataFrame:
    """Hourly series per station: ``sum(value)`` per (user, UTC hour) of all
    events; ``exact`` adds decimals, so equal amounts stay ties in rank statistics."""
    ev = read(spark, d, "events", ["user_id", "ts", "value"])
    return (ev.groupBy(F.col("user_id").alias("CODIGO_WMO"),
                       utc_instant(F.date_trunc("hour", F.col("ts"))).alias("dt_utc"))
              .agg(F.sum(F.col("value").cast(EXACT) if exact else "value").alias("precip_mm")))


def label_x(spark: SparkSession, d: str) -> DataFrame:
    """X of the label join: daily municipality features of all events."""
    hourly = events_hourly(spark, d)
    return feat.daily_features(hourly, bridge(spark, d), imputed=None,
                               tz=LOCAL_TZ, min_hours_complete=1)


def band_code(value) -> F.Column:
    """Stand-in hazard code of an event from its value band."""
    return (F.when(value > 300, F.lit(12100)).when(value > 200, F.lit(12200))
             .otherwise(F.lit(12300))).cast("bigint")


def events_register(spark: SparkSession, d: str) -> DataFrame:
    """Register rows from error events above the threshold, dated the day after the
    reading; those of a municipality's last day have no reading day to join."""
    ev = read(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    ev = ev.filter((F.col("event_type") == "error") & (F.col("value") > Y_MIN_VALUE))
    b = bridge(spark, d)
    j = ev.join(b, ev.user_id == b.CODIGO_WMO)
    return j.select(
        F.col("event_id").alias("protocolo_s2id"),
        F.col("municipio_ibge").alias("nome_municipio"),
        F.col("uf").alias("sigla_uf"),
        band_code(F.col("value")).alias("cobrade"),
        F.col("ibge"),
        F.date_add(utc_to_local_day(utc_instant("ts"), LOCAL_TZ), REPORTED_AFTER).alias("data_evento"),
        F.col("uf").alias("regiao"),
        F.lit("Hidrologico").alias("grupo_de_desastre"),
    ).withColumn("regiao_l", F.lower(F.trim("regiao")))


def label_y(spark: SparkSession, d: str) -> DataFrame:
    """Y of the label join, one row per (municipality, day)."""
    y = lab.build_labels(events_register(spark, d), "data_evento", 2024, 2024,
                         region_value=None, tie=("protocolo_s2id",))
    return lab.to_label_table(y)


# ----------------------------------------------------------------- register

def register_raw(spark: SparkSession, d: str) -> DataFrame:
    """Raw register: one row per order, text-typed keys as in a spreadsheet
    export, record date from the order's earliest line item."""
    o = read(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus",
                                   "o_orderdate", "o_orderpriority"])
    qty = F.col("l_quantity").cast("bigint")
    rec = (read(spark, d, "lineitem", ["l_orderkey", "l_shipdate", "l_returnflag",
                                       "l_linestatus", "l_discount", "l_quantity"])
           .groupBy("l_orderkey")
           .agg(F.min("l_shipdate").alias("data_registro"),
                # damage counts; NULL when no line qualifies (forced to 0 later)
                F.sum(F.when(F.col("l_returnflag") == "R", F.lit(1))).cast("bigint")
                 .alias("DH_MORTOS"),
                F.sum(F.when(F.col("l_linestatus") == "O", qty)).alias("DH_DESABRIGADOS"),
                F.sum(F.when(F.col("l_discount") >= 0.05, qty)).alias("DH_DESALOJADOS")))
    c = read(spark, d, "customer", ["c_custkey", "c_nationkey"])
    g = geo(spark, d)
    j = (o.join(rec, o.o_orderkey == rec.l_orderkey, "left")
          .join(c, o.o_custkey == c.c_custkey, "left")
          .join(F.broadcast(g), F.col("c_nationkey") == g.n_nationkey, "left"))
    digit = F.substring("o_orderpriority", 1, 1)
    return j.select(
        F.col("o_orderkey").alias("Protocolo_S2ID"),
        F.col("n_name").alias("Nome_Municipio"),
        F.col("n_name").alias("Sigla_UF"),
        F.concat(F.lit("12"), digit, F.lit("00")).alias("Cod_Cobrade"),
        F.col("c_nationkey").cast("string").alias("Cod_IBGE_Mun"),
        F.col("o_orderdate").alias("Data_Evento"),
        F.col("data_registro").alias("Data_Registro"),
        F.col("r_name").alias(" Regiao "),
        F.col("o_orderpriority").alias("Descricao_Tipologia"),
        F.col("o_orderstatus").alias("Grupo_De_Desastre"),
        "DH_MORTOS", "DH_DESABRIGADOS", "DH_DESALOJADOS",
    )


def register(spark: SparkSession, d: str) -> DataFrame:
    """Typed register (dates, keys, normalised region; record year dropped,
    NULL record dates kept)."""
    return lab.prepare_register(register_raw(spark, d), drop_record_year=DROP_RECORD_YEAR)


def register_labels(spark: SparkSession, d: str, lo: int = YEAR_LO,
                    hi: int = YEAR_HI, date_col: str = "data_evento") -> DataFrame:
    y = lab.build_labels(register(spark, d), date_col, lo, hi,
                         region_value=REGION, tie=("protocolo_s2id",))
    return lab.to_label_table(y)


def stations(spark: SparkSession, d: str) -> DataFrame:
    """Station list: suppliers; negative balance plays a failed status."""
    s = read(spark, d, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    return s.select(F.col("s_suppkey").alias("CODIGO_WMO"),
                    F.col("s_name").alias("ESTACAO"),
                    F.col("s_nationkey").cast("bigint").alias("ibge"),
                    F.when(F.col("s_acctbal") >= 0, "incluida").otherwise("excluida")
                     .alias("status_final"),
                    F.col("s_acctbal"))


def station_exclusions(spark: SparkSession, d: str) -> DataFrame:
    return stations(spark, d).filter(F.col("s_acctbal") > EXCLUDE_ACCTBAL) \
                             .select("CODIGO_WMO")


def kept_stations(spark: SparkSession, d: str) -> DataFrame:
    return lab.station_status_filter(stations(spark, d), station_exclusions(spark, d))


# ----------------------------------------------------------- hourly series

GRID_SHORT, GRID_MEDIUM, GRID_LONG = 6, 48, 168
MAX_OBSTACLES = 3             # stand-in thresholds for a 30-day series
MIN_SEGMENT_HOURS = 240
TERRITORY = {"lat": (-24.5, -14.0), "lon": (-49.5, -39.0)}


def imputed_grid(spark: SparkSession, d: str, fill_all: bool = False) -> DataFrame:
    from pluvio.operators import series as ser
    return ser.impute_hourly(events_hourly(spark, d), short=GRID_SHORT, medium=GRID_MEDIUM,
                             long=GRID_LONG, fill_all=fill_all)


def station_coords(spark: SparkSession, d: str) -> DataFrame:
    """Station identity and coordinates (integer arithmetic on the key)."""
    c = read(spark, d, "customer", ["c_custkey", "c_name", "c_nationkey"])
    return c.select(F.col("c_custkey").alias("CODIGO_WMO"), F.col("c_name").alias("ESTACAO"),
                    F.col("c_nationkey").cast("bigint").alias("ibge"),
                    (-25.0 + (F.col("c_custkey") * 37 % 1000) / 100.0).alias("latitude"),
                    (-50.0 + (F.col("c_custkey") * 53 % 1000) / 100.0).alias("longitude"))


# --------------------------------------------------------- feature versions

# Compared columns of the feature table (schema names).
VERSION_COLS = ["precip_dia", "precip_24h", "precip_48h", "precip_72h",
                "precip_max_horaria", "janela_valida", "n_estacoes"]
UTC = "+00:00"


def user_days(spark: SparkSession, d: str, tz: str = UTC, exact: bool = False) -> DataFrame:
    """Station-days of the hourly series, in the X layout."""
    sd = feat.station_day_agg(events_hourly(spark, d, exact=exact), imputed=None, tz=tz,
                              min_hours_complete=1)
    return sd.select(F.col("CODIGO_WMO").alias("CODIGO_MUNICIPIO_IBGE"), "data_local",
                     "precip_dia", "precip_max_horaria",
                     F.lit(1).cast("bigint").alias("n_estacoes"),
                     "horas_imputadas", "dia_completo")


def features_version(spark: SparkSession, d: str, frame: str, tz: str = UTC,
                     exact: bool = False) -> DataFrame:
    return feat.prior_window_features(user_days(spark, d, tz, exact), frame=frame)


def version_new(spark: SparkSession, d: str) -> DataFrame:
    """Newer version: calendar (RANGE) windows over local days."""
    return features_version(spark, d, "range", LOCAL_TZ)


def version_old(spark: SparkSession, d: str) -> DataFrame:
    """Older version: row (ROWS) windows over UTC days."""
    return features_version(spark, d, "rows", UTC)


def user_day_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels per (station, UTC day) from error events above the threshold."""
    ev = read(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    ev = ev.filter((F.col("event_type") == "error") & (F.col("value") > Y_MIN_VALUE))
    reg = ev.select(F.col("event_id").alias("protocolo_s2id"),
                    F.col("user_id").cast("string").alias("nome_municipio"),
                    F.lit(None).cast("string").alias("sigla_uf"),
                    band_code(F.col("value")).alias("cobrade"),
                    F.col("user_id").alias("ibge"),
                    F.to_date("ts").alias("data_evento"),
                    F.lit(None).cast("string").alias("regiao"),
                    F.lit("Hidrologico").alias("grupo_de_desastre"))
    y = lab.build_labels(reg, "data_evento", 2024, 2024, region_value=None,
                         tie=("protocolo_s2id",))
    return lab.to_label_table(y)


def modelling_table(spark: SparkSession, d: str) -> DataFrame:
    """Station-day features (calendar windows) LEFT JOIN labels."""
    x = features_version(spark, d, "range", exact=True)
    x = x.withColumns({c: F.col(c).cast("double") for c, t in x.dtypes if t.startswith("decimal")})
    return lab.label_join(x, user_day_labels(spark, d))


# ---------------------------------------------------------- spatial / raster

SPATIAL_CELL = 100.0     # km, grid bucket of the spatial joins
RASTER_CELL = 5.0        # km, raster cell side
DEGREE_CELL = 0.5        # degrees, grid bucket of the lon/lat joins
NEAREST_KM = 100.0
# State code prefix -> state abbreviation.
UF_NAMES = {"31": "MG", "32": "ES", "33": "RJ", "35": "SP"}


def station_points(spark: SparkSession, d: str) -> DataFrame:
    """Station coordinates (km) by integer arithmetic on the key."""
    c = read(spark, d, "customer", ["c_custkey"])
    return c.select(F.col("c_custkey").alias("CODIGO_WMO"),
                    (F.col("c_custkey") * 7919 % 1000).cast("double").alias("x"),
                    (F.col("c_custkey") * 104729 % 1000).cast("double").alias("y"))


def station_degrees(spark: SparkSession, d: str) -> DataFrame:
    """Station longitude and latitude: 128 km of the plane to a degree."""
    p = station_points(spark, d)
    return p.select("CODIGO_WMO", (F.col("x") / 128 - 50).alias("x"), (F.col("y") / 128 - 26).alias("y"))


def municipality_polygons(spark: SparkSession, d: str, degrees: bool = False) -> DataFrame:
    """One hexagon per nation on a 5 x 5 layout of 200 km cells: some only 2 km
    high (narrower than a raster cell), some with a square hole. ``degrees``: the same
    rings in longitude and latitude, 128 km of the plane to a degree."""
    n = read(spark, d, "nation", ["n_nationkey", "n_name"])
    k = F.col("n_nationkey")
    cx = (100 + 200 * (k % 5)).cast("double")
    cy = (100 + 200 * F.floor(k / 5)).cast("double")
    r = (56 + 8 * (k % 4)).cast("double")

    def v(dx, dy):
        if degrees:
            return F.struct(((cx + dx) / 128 - 50).alias("x"), ((cy + dy) / 128 - 26).alias("y"))
        return F.struct((cx + dx).alias("x"), (cy + dy).alias("y"))
    thin = k % 7 == 3
    h = F.when(thin, F.lit(1.0)).otherwise(7 * r / 8)
    q = r / 4
    outer = F.array(v(r, 0.0), v(r / 2, h), v(-r / 2, h), v(-r, 0.0), v(-r / 2, -h), v(r / 2, -h))
    hole = F.array(v(q, q), v(-q, q), v(-q, -q), v(q, -q))
    ring = F.when((k % 3 == 0) & ~thin, F.array(outer, hole)).otherwise(F.array(outer))
    return n.select(k.cast("bigint").alias("poly_id"), F.col("n_name").alias("NM_MUN"),
                    ((31 + k % 5) * 1000 + k).cast("bigint").alias("CD_MUN"),
                    ring.alias("ring"))


def raster_tiles(spark: SparkSession, d: str, product: str) -> DataFrame:
    """Tile cells of one product from line items: tile = line number, cell
    from key arithmetic, NODATA where the source value is zero."""
    li = read(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice",
                                     "l_discount", "l_tax", "l_quantity"])
    if product == "altitude":
        v = F.when(F.col("l_discount") == 0, F.lit(-9999.0)).otherwise(F.col("l_extendedprice") / 100.0)
    else:
        v = F.when(F.col("l_tax") == 0, F.lit(-9999.0)).otherwise(F.col("l_quantity"))
    return (li.groupBy(F.col("l_linenumber").cast("bigint").alias("tile"),
                       (F.col("l_orderkey") * 13 % 200).alias("row"),
                       (F.col("l_partkey") * 7 % 200).alias("col"))
              .agg(F.max(v).alias("value")))
