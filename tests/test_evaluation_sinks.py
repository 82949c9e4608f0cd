import datetime as dt
import os

import numpy as np

from pluvio.operators import evaluation as ev
from pluvio.sources import sinks as snk


def test_temporal_folds_membership(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(30)]
    df = spark.createDataFrame([(d, i % 2) for i, d in enumerate(days)], "d date, y int")
    got = {(r.d, r.fold, r.papel) for r in ev.temporal_folds(df, "d", "2024-01-11", 5, 4).collect()}
    want = set()
    for d in days:
        off = (d - dt.date(2024, 1, 11)).days
        t = off // 5 + 1 if off >= 0 else 0
        for k in range(1, 5):
            if k > t:
                want.add((d, k, "treino"))
        if 1 <= t <= 4:
            want.add((d, t, "teste"))
    assert got == want


def test_average_precision_with_ties(spark):
    rng = np.random.default_rng(11)
    s = np.round(rng.random(400), 1)
    y = (rng.random(400) < s).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "p double, y int")
    got = {r.metrica: r.valor for r in ev.precision_recall_f1(df, "p", "y", 0.5, ranges=3).collect()}
    # step PR curve over distinct thresholds, highest first
    ap, P = 0.0, y.sum()
    for t in sorted(set(s), reverse=True):
        sel = s >= t
        tp, fp = (y[sel] == 1).sum(), (y[sel] == 0).sum()
        ap += ((y[s == t] == 1).sum() / P) * tp / (tp + fp)
    assert abs(got["average_precision"] - ap) < 1e-12
    tp = ((s >= 0.5) & (y == 1)).sum()
    assert got["tp"] == tp and abs(got["recall"] - tp / P) < 1e-12


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "y int")
    w = {r.y: r.peso for r in ev.class_weights(df, "y").collect()}
    assert abs(w[0] - 10 / 18) < 1e-12 and abs(w[1] - 5.0) < 1e-12


def test_csv_bom_round_trip_and_station_folders(spark, tmp_path):
    df = spark.createDataFrame([(1, "a;b", dt.datetime(2024, 1, 1, 0, 0, 0, 123456)),
                                (2, None, None)], "st long, txt string, ts timestamp_ntz")
    p = snk.csv_sink(df, str(tmp_path / "csv"), sep=";", bom=True)
    raw = [f for f in os.listdir(p) if f.endswith(".csv")]
    first = open(os.path.join(p, raw[0]), encoding="utf-8").read(1)
    assert first == snk.BOM
    back = snk.read_csv(spark, p, df.schema, sep=";")
    assert back.columns == df.columns
    assert sorted(back.collect()) == sorted(df.collect())
    q = snk.per_station_parquet(df, str(tmp_path / "st"), "st")
    folders = [f for f in os.listdir(q) if f.startswith(snk.STATION_FOLDER)]
    assert len(folders) <= 2
    assert sorted(snk.read_station(spark, q, df.schema, "st").collect()) == sorted(df.collect())
    one = snk.read_station(spark, q, df.schema, "st", 1)
    assert sorted(one.collect()) == sorted(df.where("st = 1").collect())
