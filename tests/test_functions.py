import datetime as dt

from pyspark.sql import functions as F

from pluvio.functions import scalars as S


def test_null_safe_exclude_keeps_null_dates(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 2),), (dt.datetime(2025, 5, 1),), (None,)],
                               "d timestamp")
    kept = df.filter(S.not_year_null_safe("d", 2026)).collect()
    assert len(kept) == 2 and any(r.d is None for r in kept)
    # the plain negated comparison would drop the NULL row
    assert df.filter(~(F.year("d") == 2026)).count() == 1


def test_coercions(spark):
    df = spark.createDataFrame([("12100",), ("3.7",), ("x",), (None,)], "c string")
    assert [r[0] for r in df.select(S.to_long("c")).collect()] == [12100, None, None, None]
    d = spark.createDataFrame([("1,5",), ("abc",)], "c string")
    assert [r[0] for r in d.select(S.to_double_comma("c")).collect()] == [1.5, None]


def test_mixed_date_formats(spark):
    df = spark.createDataFrame([("21/03/08",), ("2008-03-21",), ("bad",)], "c string")
    out = [r[0] for r in df.select(S.to_date_coerce("c", ("yyyy-MM-dd", "dd/MM/yy"))).collect()]
    assert out == [dt.date(2008, 3, 21), dt.date(2008, 3, 21), None]


def test_hour_utc_parse(spark):
    df = spark.createDataFrame([("2019/01/01", "0100 UTC"), ("2019-01-01", "13:00"),
                                ("2019-01-01", "99:00")], "d string, h string")
    out = [r[0] for r in df.select(S.hour_utc_parse("d", "h")).collect()]
    assert out[0] == dt.datetime(2019, 1, 1, 1) and out[1] == dt.datetime(2019, 1, 1, 13)
    assert out[2] is None


def test_accent_fold_and_local_day(spark):
    df = spark.createDataFrame([("São Gonçalo ",)], "n string")
    assert df.select(S.accent_fold("n")).first()[0] == "SAO GONCALO"
    t = spark.createDataFrame([(dt.datetime(2018, 12, 1, 2, 30),)], "t timestamp")
    assert t.select(S.utc_to_local_day("t", "-03:00")).first()[0] == dt.date(2018, 11, 30)


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)], "d date")
    assert [r[0] for r in df.select(S.weekday_mon0("d")).collect()] == [0, 6]
