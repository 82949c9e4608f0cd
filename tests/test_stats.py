import numpy as np
import pandas as pd

from pluvio.operators import stats as st


def _rank_auc(pos, neg):
    r = pd.concat([pd.Series(pos), pd.Series(neg)]).rank(method="average")
    n1, n2 = len(pos), len(neg)
    return (r.iloc[:n1].sum() - n1 * (n1 + 1) / 2) / (n1 * n2)


def test_auc_matches_rank_form_with_ties(spark):
    rng = np.random.default_rng(7)
    v = np.round(rng.gamma(1.0, 5.0, 3000), 1)       # many ties
    y = (rng.random(3000) < 0.1 + v / 200).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"x": v, "evento": y}))
    got = st.rank_auc(df, ["x"], ranges=7).first().auc
    assert abs(got - _rank_auc(v[y == 1], v[y == 0])) < 1e-12


def test_auc_empty_class_is_null(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0)], "x double, evento int")
    assert st.rank_auc(df, ["x"]).first().auc is None


def test_exact_percentiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    v = np.round(rng.normal(10, 3, 2001), 2)
    g = rng.integers(0, 3, 2001)
    df = spark.createDataFrame(pd.DataFrame({"valor": v, "g": g}))
    out = {r.g: r for r in st.exact_percentiles(df, ["g"], "valor", (0.5, 0.75, 0.9, 0.99),
                                                ranges=5).collect()}
    for k in range(3):
        q = np.percentile(v[g == k], [50, 75, 90, 99])
        r = out[k]
        assert np.allclose([r.p50, r.p75, r.p90, r.p99], q, rtol=0, atol=1e-9)
        assert r.n == (g == k).sum()


def test_boxplot_whiskers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([(v, 0) for v in vals], "x double, evento int")
    r = st.boxplot_stats(df, ["x"]).first()
    q1, q3 = np.percentile(vals, [25, 75])
    assert r.q1 == q1 and r.q3 == q3
    assert r.bigode_sup == 5.0 and r.n_outliers == 1


def test_average_rank_column(spark):
    v = [3.0, 1.0, 3.0, 2.0, 3.0]
    df = spark.createDataFrame([(x,) for x in v], "x double")
    got = sorted(r[0] for r in df.select(st.average_rank(df, "x")).collect())
    assert got == sorted(pd.Series(v).rank(method="average").tolist())
