"""Scalar functions of the reference, as Spark column expressions.

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_", "norm_text", "to_long", "to_double_comma", "to_date_coerce",
    "to_ts_coerce", "not_year_null_safe", "date_range_pred",
    "weekday_mon0", "accent_fold", "code_to_name", "utc_instant", "utc_wall_clock",
    "utc_to_local_day", "hour_utc_parse", "state_prefix",
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_text(c) -> Column:
    """strip + lower, as the register's region comparison does."""
    return F.lower(F.trim(col_(c)))


def to_long(c) -> Column:
    """Integer coercion: ``'12100'``, ``'12100.0'`` and ``1.21e4`` give 12100;
    anything that is not a whole number (``'3.7'``, ``'x'``) gives NULL."""
    exact = _try_cast(col_(c), "decimal(38,12)")
    return F.when(exact == F.floor(exact), _try_cast(exact, "bigint"))


def _try_cast(c: Column, t: str) -> Column:
    return c.try_cast(t)


def to_double_comma(c) -> Column:
    """Text number with a decimal comma -> double, invalid -> NULL."""
    return _try_cast(F.regexp_replace(col_(c), ",", "."), "double")


def to_ts_coerce(c, fmts: tuple[str, ...] = ()) -> Column:
    """Text -> wall-clock timestamp, invalid -> NULL. Without formats the value
    is cast (ISO text, dates, timestamps); with formats (``M/d/yyyy`` for
    US-style exports) text is tried against each, then cast."""
    c = col_(c)
    cast = _try_cast(c, "timestamp_ntz")
    if not fmts:
        return cast
    text = c.cast("string")
    return F.coalesce(*[_try_cast(F.try_to_timestamp(text, F.lit(f)), "timestamp_ntz") for f in fmts], cast)


def to_date_coerce(c, fmts: tuple[str, ...] = ()) -> Column:
    """Text -> date, trying each format in order, invalid -> NULL.

    With no format the value is cast (ISO text, timestamps, dates).
    Mixed-format columns (``dd/MM/yy`` next to ISO) pass several formats.
    """
    c = col_(c)
    if not fmts:
        return _try_cast(c, "date")
    return F.coalesce(*[F.to_date(F.try_to_timestamp(c, F.lit(f))) for f in fmts])


def not_year_null_safe(c, year: int) -> Column:
    """``NOT (year(c) <=> year)``: rows with a NULL date are KEPT.

    Mirrors negating a pandas mask where ``NaT.year == y`` is False.
    """
    return ~F.year(col_(c)).eqNullSafe(F.lit(year))


def date_range_pred(c, lo_year: int, hi_year: int) -> Column:
    """Inclusive year range written as a half-open date range so that
    Parquet footers / partition values can prune; NULL -> excluded."""
    c = col_(c)
    return (c >= F.lit(f"{lo_year:04d}-01-01").cast("date")) & (
        c < F.lit(f"{hi_year + 1:04d}-01-01").cast("date"))


def weekday_mon0(c) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col_(c))


# Accented letters folded to their base letter (upper case).
ACCENTED = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
FOLDED = "AAAAAEEEEIIIIOOOOOUUUUCN"


def accent_fold(c) -> Column:
    """Upper case with accents removed, for name comparisons."""
    return F.translate(F.upper(F.trim(col_(c))), ACCENTED, FOLDED)


def code_to_name(c, mapping: dict) -> Column:
    """Dictionary lookup as a literal map (domain is a handful of codes)."""
    if not mapping:
        return F.lit(None).cast("string")
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*kv), col_(c))


DAY_MICROS = 86_400_000_000


def utc_instant(c) -> Column:
    """Instant of a UTC wall-clock value (``timestamp_ntz``); the session's time
    zone has no part in it."""
    c = col_(c)
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            F.date_part(F.lit("SECOND"), c), F.lit("UTC"))


def utc_wall_clock(ts) -> Column:
    """UTC wall clock (``timestamp_ntz``) of an instant, whatever the session's zone."""
    micros = F.unix_micros(col_(ts))
    seconds = (micros.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def utc_to_local_day(ts, tz: str = "America/Sao_Paulo") -> Column:
    """Local calendar day of an instant (``TIMESTAMP``). ``tz`` may be a region
    id or a fixed offset such as ``-03:00``; the session's zone has no part in
    it: the shifted clock is counted in days since the epoch."""
    shifted = F.unix_micros(F.from_utc_timestamp(col_(ts), tz))
    return F.date_from_unix_date(F.floor(shifted / DAY_MICROS).cast("int"))


def hour_utc_parse(date_str, hour_str) -> Column:
    """UTC hour from a date text and an hour text.

    Accepts ``HH:MM`` and ``HHMM UTC``; dates as ``yyyy-MM-dd`` or ``yyyy/MM/dd``.
    """
    d = to_date_coerce(F.regexp_replace(col_(date_str), "/", "-"), ("yyyy-MM-dd",))
    digits = F.regexp_replace(col_(hour_str), "[^0-9]", "")
    hh = _try_cast(F.substring(F.lpad(digits, 4, "0"), 1, 2), "int")
    return F.when(d.isNotNull() & hh.between(0, 23),
                  F.make_timestamp(F.year(d), F.month(d), F.dayofmonth(d),
                                   hh, F.lit(0), F.lit(0), F.lit("UTC")))


def state_prefix(c, n: int = 2) -> Column:
    """First ``n`` digits of a code (municipality code -> state code)."""
    return F.substring(col_(c).cast("string"), 1, n)
