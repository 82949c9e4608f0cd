import os
import tempfile

import pytest
from pyspark.sql import functions as F

from pluvio.sources import station_files as sf

META = ["REGIAO:;SE", "UF:;MG", "ESTACAO:;BELO HORIZONTE", "CODIGO (WMO):;A521",
        "LATITUDE:;-19,88", "LONGITUDE:;-43,96", "ALTITUDE:;869,6", "DATA DE FUNDACAO:;2006-09-21"]


def _write(folder, name, lines):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="latin-1", newline="") as f:
        f.write("\r\n".join(lines) + "\r\n")


@pytest.fixture(scope="module")
def folder():
    d = tempfile.mkdtemp(prefix="pluvio-files-")
    _write(d, "a/SE_MG_A521.CSV", META + [
        "Data;Hora UTC;PRECIPITAÇÃO TOTAL, HORÁRIO (mm);",
        "2019/01/01;0000 UTC;0;",
        "2019/01/01;0100 UTC;1,2;",
        "a;b;c;d;e",                      # too many fields: dropped
        "2019/01/01",                     # short: padded with NULL
        ";;;",                            # every field empty: dropped
        ""])
    _write(d, "b/comma.csv", ["REGIAO:,S", "UF:,SP", "FOO:,bar", "ESTACAO:,X", "CODIGO (WMO):,A7",
                              "LATITUDE:,-23,5", "LONGITUDE:,-46,6", "ALTITUDE:,760",
                              "Data,Hora,Chuva", "2020-01-01,01:00,NA", "2020-01-01,02:00,3"])
    _write(d, "c/noheader.csv", ["REGIAO:;N", "ESTACAO:;Y", "CODIGO (WMO):;B1", "x", "x", "x", "x", "x",
                                 "c1;c2", "1;2", "3;4"])
    _write(d, "notes.txt", ["Data;Hora", "1;2"])
    return d


def test_long_form_rules(spark, folder):
    long = sorted(sf.parse_lines(sf.read_station_lines(spark, folder)).collect(), key=lambda r: r.linha)
    by = {}
    for r in long:
        by.setdefault(os.path.basename(r.path), []).append(r)
    a = by["SE_MG_A521.CSV"]
    assert len(a) == 3
    assert a[0]["UF"] == "MG" and a[0]["CODIGO (WMO)"] == "A521" and a[0].sep == ";"
    assert a[0]["LATITUDE"] == "-19,88"
    assert [x.campos for x in a][2] == ["2019/01/01"]
    b = by["comma.csv"]
    assert b[0]["LATITUDE"] == "-23"          # comma file: the decimal part is cut
    assert b[0]["DATA DE FUNDACAO"] == "" and b[0].sep == ","
    assert b[0].campos[2] is None             # NA token
    c = by["noheader.csv"]
    assert c[0].inicio_dados == 8 and c[0].cabecalho == ["c1", "c2"] and c[0]["UF"] == ""
    assert "notes.txt" not in by


def test_wide_union_by_name(spark, folder):
    wide = sf.ingest_station_files(spark, folder)
    cols = wide.columns
    assert cols[:8] == sf.HEADER_FIELDS
    assert "Hora UTC" in cols and "Hora" in cols and "c1" in cols and "Unnamed: 3" in cols
    assert wide.count() == 3 + 2 + 2
    row = wide.filter("`CODIGO (WMO)` = 'A521' AND `Hora UTC` = '0100 UTC'").first()
    assert row["PRECIPITAÇÃO TOTAL, HORÁRIO (mm)"] == "1,2" and row["Hora"] is None


def test_empty_folder_fails(spark):
    d = tempfile.mkdtemp(prefix="pluvio-empty-")
    with pytest.raises(Exception):
        sf.read_station_lines(spark, d)


def test_column_names(spark):
    h = spark.range(1).select(F.array(*map(F.lit, ["a", "", "a", "a"])).alias("h"))
    assert h.select(sf.column_names(F.col("h")).alias("n")).first().n == ["a", "Unnamed: 1", "a.1", "a.2"]


def test_typing_step(spark):
    wide = spark.createDataFrame([("A1", "2019/01/01", "0100 UTC", "1,5"),
                                  ("A1", "2019-01-01", "13:00", "x")],
                                 "`CODIGO (WMO)` string, Data string, `Hora UTC` string, Chuva string")
    out = sf.type_station_rows(wide, numeric={"precip_mm": "Chuva"}).collect()
    assert out[0].dt_utc.hour == 1 and out[0].precip_mm == 1.5
    assert out[1].dt_utc.hour == 13 and out[1].precip_mm is None


def test_warehouse_scan_prunes_partitions(spark, tmp_path):
    from pluvio.sources.tables import warehouse_scan
    df = spark.range(100).selectExpr("id", "cast(2000 + id % 10 as int) as ano")
    p = str(tmp_path / "wh")
    df.write.partitionBy("ano").parquet(p)
    got = warehouse_scan(spark, p, 2003, 2004)
    assert got.count() == 20
    got.createOrReplaceTempView("wh_scan")
    plan = spark.sql("EXPLAIN SELECT * FROM wh_scan").first()[0]
    assert "PartitionFilters" in plan and "2003" in plan


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    """Splits of a few lines each: same rows as the file taken whole, also where the
    header comes late or the first lines lie in several splits."""
    body = [f"2020/01/{i % 28 + 1:02d};{i % 24:02d}00 UTC;{i},5" for i in range(3000)]
    _write(str(tmp_path), "late.csv", META + ["free text " * 30] * 5 + ["Data;Hora UTC;CHUVA"] + body + ["Data;UTC;again"])
    _write(str(tmp_path), "none.csv", [m + "x" * 300 for m in META] + ["a;b;c"] + body[:50])
    _write(str(tmp_path), "short.csv", META[:4])
    keys = {"spark.sql.files.maxPartitionBytes": "600", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        lines = sf.read_station_lines(spark, str(tmp_path))
        assert lines.select("path", "split").distinct().count() > 50
        got = sf.parse_lines(lines).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    texts = [(name, open(os.path.join(tmp_path, name), encoding="latin-1", newline="").read())
             for name in ("late.csv", "none.csv", "short.csv")]
    want = sf.parse_text_files(spark.createDataFrame(texts, "path string, text string")).collect()
    plain = lambda rows: sorted((os.path.basename(r.path), r.linha, *r[1:12], *map(str, r.campos)) for r in rows)
    assert len(got) == 3051 and plain(got) == plain(want)


def test_more_names_than_a_spreadsheet_has(spark):
    rows = [("f", 1, [f"c{i}" for i in range(700)], [str(i) for i in range(700)])]
    meta = {h: F.lit("") for h in sf.HEADER_FIELDS}
    long = spark.createDataFrame(rows, "path string, linha int, cabecalho array<string>, campos array<string>").withColumns(meta)
    wide = sf.to_wide(long)
    assert len(wide.columns) == 708 and wide.first()["c699"] == "699"
