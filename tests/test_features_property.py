"""Daily features and first-row dedup against direct brute force."""
import datetime as dt

from hypothesis import given, settings, strategies as st

from pluvio.operators import features as feat
from pluvio.operators import labels as L

D0 = dt.date(2022, 1, 1)

day_rows = st.dictionaries(st.integers(0, 40), st.tuples(st.integers(0, 9000).map(lambda x: x / 100),
                                                          st.booleans(), st.integers(0, 5)),
                           min_size=1, max_size=25)


@settings(max_examples=10, deadline=None)
@given(a=day_rows, b=day_rows)
def test_prior_windows_match_brute_force(spark, a, b):
    rows = [(m, D0 + dt.timedelta(days=k), v, imp, comp)
            for m, days in ((1, a), (2, b)) for k, (v, comp, imp) in days.items()]
    md = spark.createDataFrame(rows, "CODIGO_MUNICIPIO_IBGE long, data_local date, precip_dia double, "
                                     "horas_imputadas long, dia_completo boolean")
    got = {(r.CODIGO_MUNICIPIO_IBGE, (r.data_local - D0).days): r
           for r in feat.prior_window_features(md).collect()}
    for m, days in ((1, a), (2, b)):
        for k in days:
            r = got[(m, k)]
            for name, span in (("precip_24h", 1), ("precip_48h", 2), ("precip_72h", 3)):
                prior = [days[j][0] for j in range(k - span, k) if j in days]
                want = sum(prior) if prior else None
                val = getattr(r, name)
                assert (val is None and want is None) or abs(val - want) < 1e-9
            prior3 = [j for j in range(k - 3, k) if j in days]
            assert r.janela_valida == (len(prior3) == 3 and all(days[j][1] for j in prior3))
            assert r.horas_imputadas_72h == sum(days[j][2] for j in prior3)


regs = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.text("abc", min_size=1, max_size=3)),
                min_size=1, max_size=30)


@settings(max_examples=15, deadline=None)
@given(rows=regs)
def test_first_by_key_matches_sorted_dedup(spark, rows):
    df = spark.createDataFrame([(k1, k2, p, i) for i, (k1, k2, p) in enumerate(rows)],
                               "k1 long, k2 long, p string, i long")
    got = {(r.k1, r.k2): (r.p, r.i) for r in L.first_by_key(df, ["k1", "k2"], ["p", "i"]).collect()}
    want = {}
    for i, (k1, k2, p) in sorted(enumerate(rows), key=lambda x: (x[1][2], x[0])):
        want.setdefault((k1, k2), (p, i))
    assert got == want
