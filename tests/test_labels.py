import datetime as dt

from pyspark.sql import functions as F

from pluvio.operators import labels as L


def _reg(spark):
    rows = [
        ("p3", "A", "MG", "12100", "3100", dt.datetime(2010, 5, 1, 10), dt.datetime(2010, 5, 2), " Sudeste "),
        ("p1", "A", "MG", "12200", "3100", dt.datetime(2010, 5, 1, 20), None, "sudeste"),
        ("p2", "B", "SP", "12300", "3500", dt.datetime(2011, 1, 1), dt.datetime(2026, 1, 1), "Sudeste"),
        ("p4", "C", "RJ", "99999", "3300", dt.datetime(2012, 1, 1), dt.datetime(2012, 1, 2), "Sudeste"),
        ("p5", "D", "ES", "12100", "x", dt.datetime(2012, 2, 1), dt.datetime(2012, 2, 2), "Sudeste"),
        ("p6", "E", "BA", "12100", "2900", dt.datetime(2012, 3, 1), dt.datetime(2012, 3, 2), "Nordeste"),
    ]
    cols = "Protocolo_S2ID string, Nome_Municipio string, Sigla_UF string, Cod_Cobrade string, " \
           "Cod_IBGE_Mun string, Data_Evento timestamp, Data_Registro timestamp, Regiao string"
    return L.prepare_register(spark.createDataFrame(rows, cols))


def test_register_build_labels(spark):
    reg = _reg(spark)
    assert reg.count() == 5                       # 2026 record dropped, NULL record date kept
    y = L.build_labels(reg, "data_evento", 2008, 2022)
    rows = {(r.ibge, r.data): r.protocolo_s2id for r in y.collect()}
    # p1 and p3 share (3100, 2010-05-01); the smallest protocol wins
    assert rows == {(3100, dt.date(2010, 5, 1)): "p1"}


def test_first_by_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "c", 1)], "k int, t string, v int")
    out = sorted(L.first_by_key(df, ["k"], ["t"]).collect())
    assert [(r.k, r.t, r.v) for r in out] == [(1, "a", 9), (2, "c", 1)]


def test_unique_key_check_counts_null_tuples(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (2, 3)], "a int, b int")
    r = L.unique_key_check(df, ["a", "b"]).first()
    assert (r.n_rows, r.n_distinct_keys, r.n_dup_keys, r.unique_ok) == (4, 3, 1, False)


def test_label_join_keeps_x_and_flags(spark):
    x = spark.createDataFrame([("3100", dt.date(2010, 5, 1), 1.0), ("3100", dt.date(2010, 5, 2), 2.0)],
                              "CODIGO_MUNICIPIO_IBGE string, data_local date, precip_dia double")
    y = spark.createDataFrame([(3100, dt.date(2010, 5, 1), "p1", 12100, "Inundacoes", "H"),
                               (3100, dt.date(2011, 1, 1), "p9", 12100, "Inundacoes", "H")],
                              "ibge long, data date, protocolo string, cobrade long, "
                              "descricao_tipologia string, grupo_de_desastre string")
    j = L.label_join(x, y)
    assert j.count() == 2 and j.agg(F.sum("evento")).first()[0] == 1
    lost = L.unmatched_events(y, x).collect()
    assert [r.protocolo for r in lost] == ["p9"]


def test_scope_semi_and_anti(spark):
    y = spark.createDataFrame([(1,), (2,), (3,)], "ibge long")
    b = spark.createDataFrame([(1,), (1,), (3,)], "ibge long")
    assert sorted(r.ibge for r in L.station_scope(y, b).collect()) == [1, 3]
    assert [r.ibge for r in L.exclude_anti(y, b, "ibge").collect()] == [2]


def test_register_scan_csv_with_bom(spark, tmp_path):
    from pluvio.sources.tables import register_scan
    p = tmp_path / "reg.csv"
    p.write_text("﻿Protocolo_S2ID;Cod_Cobrade;Cod_IBGE_Mun;Data_Evento;Data_Registro; Regiao \n"
                 "a1;12100;3100;2010-05-01 10:00:00;2010-05-02 00:00:00;Sudeste\n"
                 "a2;x;3100;2010-05-01 11:00:00;;Sudeste\n", encoding="utf-8")
    df = register_scan(spark, str(p), fmt="csv", sep=";",
                       schema="Protocolo_S2ID string, Cod_Cobrade string, Cod_IBGE_Mun string, "
                              "Data_Evento string, Data_Registro string, Regiao string")
    assert df.columns[0] == "protocolo_s2id"
    reg = L.prepare_register(df)
    rows = {r.protocolo_s2id: r for r in reg.collect()}
    assert rows["a1"].cobrade == 12100 and rows["a2"].cobrade is None
    assert rows["a2"].data_registro is None and rows["a1"].regiao_l == "sudeste"
