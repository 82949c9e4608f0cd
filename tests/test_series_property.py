"""Hourly imputation against a direct brute-force reading of the rules."""
import datetime as dt

from hypothesis import given, settings, strategies as st

from pluvio.operators import series as ser

T0 = dt.datetime(2021, 3, 1)


def brute(obs: dict[int, float], short=6, medium=48, long=168):
    hours = sorted(obs)
    out = {}
    for h in range(hours[0], hours[-1] + 1):
        if h in obs:
            out[h] = (obs[h], "nao_aplicavel", 0)
            continue
        a = max(x for x in hours if x < h)
        b = min(x for x in hours if x > h)
        L, k = b - a - 1, h - a
        cls = "curto" if L <= short else "medio" if L <= medium else "longo" if L <= long else "extremo"
        if L <= short:
            v = obs[a] + (obs[b] - obs[a]) * k / (L + 1)
        elif L <= medium:
            v = obs[a]
        else:
            v = None
        out[h] = (v, cls, L)
    return out


series = st.dictionaries(st.integers(0, 400), st.integers(0, 5000).map(lambda x: x / 100),
                         min_size=2, max_size=40)


@settings(max_examples=12, deadline=None)
@given(a=series, b=series)
def test_impute_matches_brute_force(spark, a, b):
    rows = [(s, T0 + dt.timedelta(hours=h), v) for s, obs in (("A", a), ("B", b))
            for h, v in obs.items()]
    df = spark.createDataFrame(rows, "CODIGO_WMO string, dt_utc timestamp, precip_mm double")
    got = {(r.CODIGO_WMO, int((r.dt_utc - T0).total_seconds() // 3600)):
           (r.precip_mm, r.gap_classe, r.gap_hours) for r in ser.impute_hourly(df).collect()}
    want = {(s, h): v for s, obs in (("A", a), ("B", b)) for h, v in brute(obs).items()}
    assert got.keys() == want.keys()
    for k, (v, cls, L) in want.items():
        gv, gcls, gL = got[k]
        assert (gcls, gL) == (cls, L)
        assert (gv is None and v is None) or abs(gv - v) < 1e-9
