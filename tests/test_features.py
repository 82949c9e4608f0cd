import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pluvio.operators import features as feat


def test_range_frame_does_not_bridge_missing_days(spark):
    d = [dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(2020, 1, 4), dt.date(2020, 1, 5)]
    md = spark.createDataFrame([(1, x, float(i + 1), 0, True) for i, x in enumerate(d)],
                               "CODIGO_MUNICIPIO_IBGE long, data_local date, precip_dia double, "
                               "horas_imputadas long, dia_completo boolean")
    rng = {r.data_local: r for r in feat.window_validity(feat.rolling_prior_sum(md)).collect()}
    rows = {r.data_local: r for r in
            feat.window_validity(feat.rolling_prior_sum(md, frame="rows"), frame="rows").collect()}
    # Jan 4: previous calendar day (Jan 3) is missing -> 24h NULL with RANGE
    assert rng[dt.date(2020, 1, 4)].precip_24h is None
    assert rows[dt.date(2020, 1, 4)].precip_24h == 2.0
    assert rng[dt.date(2020, 1, 4)].precip_72h == 3.0          # Jan 1 + Jan 2
    assert rng[dt.date(2020, 1, 5)].precip_24h == 3.0
    assert not rng[dt.date(2020, 1, 4)].janela_valida
    assert rows[dt.date(2020, 1, 4)].janela_valida is False     # only 2 prior rows


def test_daily_features_excludes_same_day(spark):
    hours = [("A", dt.datetime(2020, 1, d, h), 1.0) for d in (1, 2, 3, 4) for h in range(24)]
    hours += [("B", dt.datetime(2020, 1, 4, 0), 10.0)]
    hourly = spark.createDataFrame(hours, "CODIGO_WMO string, dt_utc timestamp, precip_mm double")
    bridge = spark.createDataFrame([("A", 7), ("B", 7)], "CODIGO_WMO string, ibge long")
    hourly = hourly.withColumn("imputed_flag", hourly.precip_mm < 0)
    x = {r.data_local: r for r in feat.daily_features(hourly, bridge, tz="+00:00").collect()}
    d4 = x[dt.date(2020, 1, 4)]
    assert d4.n_estacoes == 2 and d4.precip_dia == (24.0 + 10.0) / 2
    assert d4.precip_72h == 72.0 and d4.janela_valida
    assert d4.precip_max_horaria == 10.0


def _random_days(seed, n_keys=4, span=60):
    rnd = random.Random(seed)
    return [(k, dt.date(2020, 1, 1) + dt.timedelta(days=i), rnd.choice([None, float(rnd.randrange(9))]),
             rnd.randrange(3), rnd.choice([True, False, None]))
            for k in range(n_keys) for i in range(span) if rnd.random() < 0.8]


MD = ("CODIGO_MUNICIPIO_IBGE long, data_local date, precip_dia double, "
      "horas_imputadas long, dia_completo boolean")


def test_blocks_with_a_halo_equal_whole_windows(spark):
    md = spark.createDataFrame(_random_days(1), MD)
    want = sorted(feat.prior_window_features(md).collect())
    for size in (3, 8, 1000):
        got = feat.prior_features_by_block(md, size).drop("bloco").collect()
        assert sorted(got, key=repr) == sorted(want, key=repr)
    with pytest.raises(ValueError):
        feat.prior_features_by_block(md, 2)


def test_appended_days_touch_only_their_blocks(spark):
    rows = _random_days(2)
    rnd = random.Random(3)
    late = [r for r in rows if r[1] >= dt.date(2020, 2, 20) or rnd.random() < 0.03]
    old, new = (spark.createDataFrame(x, MD) for x in ([r for r in rows if r not in late], late))
    stored = feat.prior_features_by_block(old, 8).withColumn("horas_imputadas", F.lit(-1).cast("long"))
    got = feat.append_days(stored, old, new, 8)
    want = {(r.CODIGO_MUNICIPIO_IBGE, r.data_local): r
            for r in feat.prior_window_features(spark.createDataFrame(rows, MD)).collect()}
    day = lambda x: (x - dt.date(1970, 1, 1)).days
    touched = {(r[0], (day(r[1]) + h) // 8) for r in late for h in (0, 3)}
    result = got.collect()
    assert len(result) == len(want) and {(r.CODIGO_MUNICIPIO_IBGE, r.bloco) for r in result} - touched
    for r in result:
        w = want[(r.CODIGO_MUNICIPIO_IBGE, r.data_local)]
        assert all(r[c] == w[c] for c in ("precip_24h", "precip_48h", "precip_72h", "janela_valida", "horas_imputadas_72h"))
        # the mark on stored rows tells which were computed again
        assert (r.horas_imputadas == -1) == ((r.CODIGO_MUNICIPIO_IBGE, r.bloco) not in touched)
