import datetime as dt

from pyspark.sql import functions as F

from pluvio.operators import reports as R


def test_count_by_year_zero_fill_and_alert(spark):
    y = spark.createDataFrame([(1, dt.date(2008, 1, 1)), (2, dt.date(2008, 5, 1)),
                               (1, dt.date(2010, 2, 2))], "ibge long, data date")
    scope = spark.createDataFrame([(1,)], "ibge long")
    out = {r.ano: r for r in R.count_by_year(y, scope, 2008, 2011).collect()}
    assert [out[a].sudeste for a in range(2008, 2012)] == [2, 0, 1, 0]
    assert [out[a].c_estacao for a in range(2008, 2012)] == [1, 0, 1, 0]
    assert sorted(r.ano for r in R.zero_years(R.count_by_year(y, scope, 2008, 2011)).collect()) \
        == [2009, 2011]


def test_funnel_counts_null_keys_as_removed(spark):
    df = spark.createDataFrame([(1, dt.date(2010, 1, 1), "a"), (1, dt.date(2010, 1, 1), "a"),
                                (None, dt.date(2010, 1, 2), "a"), (2, dt.date(2010, 1, 3), "b")],
                               "ibge long, data date, r string")
    out = R.funnel(df, [("total", F.lit(True)), ("regiao", F.col("r") == "a")],
                   ["ibge", "data"]).first()
    assert (out.n_total, out.n_regiao, out.n_labels, out.n_removed_dedup) == (4, 3, 1, 2)


def test_human_damage_every_window_scope(spark):
    reg = spark.createDataFrame([(1, dt.date(2010, 1, 1), 2, None), (2, dt.date(2010, 6, 1), None, 3)],
                                "ibge long, data_evento date, m long, d long")
    scope = spark.createDataFrame([(2,)], "ibge long")
    out = {(r.janela, r.recorte): r for r in R.human_damage(
        reg, [("w1", 2010, 2010), ("w2", 2011, 2012)], [("all", None), ("st", scope)],
        {"obitos": "m", "desalojados": "d"}).collect()}
    assert len(out) == 4
    a = out[("w1", "all")]
    assert (a.n_registros, a.n_municipios, a.obitos, a.desalojados, a.nan_forcados_zero) == (2, 2, 2, 3, 2)
    assert out[("w1", "st")].n_registros == 1 and out[("w2", "all")].n_registros == 0


def test_weekday_bias_and_break(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 15)]           # two full weeks
    df = spark.createDataFrame([(d, d) for d in days], "a date, b date")
    w = {r.date_col: r for r in R.weekday_bias(df, ["a", "b"], 2024, 2024).collect()}
    assert w["a"].n == 14 and w["a"].d5 == 2 and abs(w["a"].deficit_pct) < 1e-9
    yearly = spark.createDataFrame([(2012, 100), (2013, 100), (2014, 20), (2015, 30)],
                                   "ano long, sudeste long")
    b = R.structural_break(yearly, 2014).first()
    assert b.media_antes == 100 and b.media_depois == 25 and b.quebra_persiste
    yoy = {r.ano: r.delta for r in R.year_on_year(yearly).collect()}
    assert yoy[2014] == -80 and yoy[2012] is None


def test_old_new_compare(spark):
    old = spark.createDataFrame([(2010,), (2010,), (2011,)], "ano long")
    new = spark.createDataFrame([(2010,), (2011,), (2011,), (2012,)], "ano long")
    out = {r.chave: r for r in R.old_new_compare(old, new, {"ano": F.col("ano")}).collect()}
    assert (out["2010"].antigo, out["2010"].novo, out["2010"].delta) == (2, 1, -1)
    assert out["2012"].antigo == 0 and out["2012"].mudou


def test_head_preview(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert [r.k for r in R.head_preview(df, 3, ["k"]).collect()] == [0, 1, 2]
    assert R.head_preview(df, 4).count() == 4
