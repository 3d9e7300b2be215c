"""Statistical tests vs NumPy re-derivations of the same definitions."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourcast.functions import special as SP
from hourcast.operators import stats as D


def _df(spark, **cols):
    return spark.createDataFrame(pd.DataFrame(cols))


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(42)
    return rng.normal(10, 2, 500), rng.normal(10.6, 2, 400)


def test_ks_statistic(spark, samples):
    a, b = samples
    a = np.round(a, 1)  # ties
    r = D.ks_2samp(_df(spark, x=a), _df(spark, x=b), ["x"], rows_per_block=40).first()  # multi-block path
    grid = np.union1d(a, b)
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    d = np.abs(fa - fb).max()
    assert r["ks_statistic"] == pytest.approx(d, abs=1e-12)
    en = math.sqrt(len(a) * len(b) / (len(a) + len(b)))
    assert r["ks_pvalue"] == pytest.approx(SP.kolmogorov_sf_py(en * d), abs=1e-9)


def test_psi_numpy(spark, samples):
    a, b = samples
    b = np.concatenate([b, [100.0, -100.0]])  # out of the reference range (F12)
    r = D.psi(_df(spark, x=a), _df(spark, x=b), ["x"]).first()
    _, edges = np.histogram(a, bins=10)
    ra = np.histogram(a, bins=edges)[0] / len(a)
    rb = np.histogram(b, bins=edges)[0] / len(b)
    ra, rb = np.where(ra == 0, 1e-10, ra), np.where(rb == 0, 1e-10, rb)
    assert r["psi"] == pytest.approx(np.sum((rb - ra) * np.log(rb / ra)), rel=1e-9)
    assert r["out_of_range_frac"] == pytest.approx(((b < a.min()) | (b > a.max())).mean())


def test_chi2_pvalues(spark):
    xs = [(0.5, 1), (3.84, 1), (7.81, 3), (5.99, 2), (20.0, 10), (33.0, 30), (12.5, 7)]
    df = spark.createDataFrame(xs, "x double, k int")
    from hourcast.functions.exprs import chi2_sf
    got = [r[0] for r in df.select(chi2_sf("x", "k")).collect()]
    for (x, k), g in zip(xs, got):
        assert g == pytest.approx(SP.chi2_sf_py(x, k), abs=2e-7)
    assert SP.chi2_sf_py(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)


def test_chi2_drift(spark):
    ref = _df(spark, c=["A"] * 200 + ["B"] * 150 + ["C"] * 150)
    cur = _df(spark, c=["A"] * 300 + ["B"] * 100 + ["C"] * 100)
    r = D.chi2_drift(ref, cur, ["c"]).first()
    exp = np.array([200, 150, 150]) / 500 * 500
    obs = np.array([300, 100, 100])
    assert r["chi2_statistic"] == pytest.approx(((obs - exp) ** 2 / exp).sum())
    assert r["dof"] == 2 and r["chi2_pvalue"] < 0.05


def test_levene(spark):
    rng = np.random.default_rng(0)
    groups = [rng.normal(0, s, 120) for s in (1, 1, 2, 3)]
    df = spark.createDataFrame(pd.DataFrame({"g": np.repeat(range(4), 120), "x": np.concatenate(groups)}))
    r = D.levene(df, "x", "g", with_pvalue=True).first()
    z = [np.abs(g - np.median(g)) for g in groups]
    zbar = np.concatenate(z).mean()
    N, k = 480, 4
    num = sum(len(zi) * (zi.mean() - zbar) ** 2 for zi in z)
    den = sum(((zi - zi.mean()) ** 2).sum() for zi in z)
    w = (N - k) / (k - 1) * num / den
    assert r["levene_statistic"] == pytest.approx(w)
    assert r["levene_pvalue"] == pytest.approx(SP.f_sf(w, 3, 476)) and r["levene_pvalue"] < 1e-6


def test_anderson_darling(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.exponential(3, 400), 2)
    r = D.anderson_darling(_df(spark, cnt=x), "cnt").first()
    y = np.sort((x - x.mean()) / x.std(ddof=1))
    z = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in y])
    n = len(y)
    i = np.arange(1, n + 1)
    a2 = -n - np.sum((2 * i - 1) * (np.log(z) + np.log1p(-z[::-1]))) / n
    assert r["ad_statistic"] == pytest.approx(a2, rel=1e-9)
    assert r["critical_5_0"] == pytest.approx(round(0.787 / (1 + 4 / n - 25 / n / n), 3))


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(7)
    e = rng.normal(size=600)
    x = np.zeros(600)
    for t in range(1, 600):
        x[t] = 0.6 * x[t - 1] + e[t] + 3 * np.sin(2 * np.pi * t / 24)
    ts = pd.date_range("2024-01-01", periods=600, freq="h")
    df = spark.createDataFrame(pd.DataFrame({"series_id": "s", "row_id": np.arange(600), "timestamp": ts, "cnt": x}),
                               "series_id string, row_id long, timestamp timestamp_ntz, cnt double")
    return df, x


def _acf(x, k):
    d = x - x.mean()
    return np.array([np.sum(d[j:] * d[:len(d) - j]) / np.sum(d * d) for j in range(k + 1)])


def test_acf_pacf(series):
    df, x = series
    a = D.acf(df, "cnt", 48).toPandas().sort_values("lag")
    np.testing.assert_allclose(a["acf"], _acf(x, 48), atol=1e-12)
    p = D.pacf(D.acf(df, "cnt", 10)).toPandas().sort_values("lag")["pacf"].to_numpy()
    r = _acf(x, 10)
    for k in range(1, 11):
        R = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        phi = np.linalg.solve(R, r[1:k + 1])
        assert p[k] == pytest.approx(phi[-1], abs=1e-10)


def test_ljung_box(series):
    df, x = series
    lb = D.ljung_box(D.acf(df, "cnt", 14), (1, 7, 14)).toPandas().set_index("lag")
    r = _acf(x, 14)
    n = len(x)
    for h in (1, 7, 14):
        q = n * (n + 2) * sum(r[k] ** 2 / (n - k) for k in range(1, h + 1))
        assert lb.loc[h, "lb_stat"] == pytest.approx(q)
        assert lb.loc[h, "lb_pvalue"] == pytest.approx(SP.chi2_sf_py(q, h), abs=1e-6)


def test_kpss(series):
    df, x = series
    r = D.kpss(df, "cnt").first()
    n = len(x)
    res = x - x.mean()
    cov = int(n ** (2.0 / 9.0))
    s0 = np.sum(res ** 2) / n
    s1 = 0.0
    for i in range(1, cov + 1):
        p = np.dot(res[i:], res[:n - i]) / (n / 2.0)
        s0 += p
        s1 += i * p
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    s_hat = np.sum(res ** 2) + sum(2 * np.dot(res[i:], res[:n - i]) * (1 - i / (lags + 1.0)) for i in range(1, lags + 1))
    stat = np.sum(np.cumsum(res) ** 2) / n ** 2 / (s_hat / n)
    assert r["nlags"] == lags and r["kpss_stat"] == pytest.approx(stat, rel=1e-9)


def test_adf_fixed_lag(series):
    df, x = series
    p = 3
    r = D.adf(df, "cnt", maxlag=p, autolag=None).first()
    dx = np.diff(x)
    rows = range(p, len(dx))
    Z = np.array([[1.0, x[t]] + [dx[t - j] for j in range(1, p + 1)] for t in rows])
    y = np.array([dx[t] for t in rows])
    b, *_ = np.linalg.lstsq(Z, y, rcond=None)
    resid = y - Z @ b
    s2 = resid @ resid / (len(y) - Z.shape[1])
    t = b[1] / math.sqrt(s2 * np.linalg.inv(Z.T @ Z)[1, 1])
    assert r["usedlag"] == p and r["nobs"] == len(y) and r["adf_stat"] == pytest.approx(t, rel=1e-8)


def test_fit_lambda_boxcox(spark, samples):
    a, _ = samples
    x = np.abs(a) + 1
    out = D.fit_lambda(_df(spark, cnt=x), "cnt", "boxcox", grid=[-1.0, 0.0, 0.5, 1.0, 2.0]).toPandas().set_index("lambda")
    x = x + 1  # Box-Cox is fitted on y + 1

    def llf(l):
        y = np.log(x) if l == 0 else (x ** l - 1) / l
        return (l - 1) * np.log(x).sum() - len(x) / 2 * np.log(y.var())
    for l in out.index:
        assert out.loc[l, "llf"] == pytest.approx(llf(l), rel=1e-9)
    assert out["is_best"].sum() == 1


def _series(spark, values, name="a"):
    rows = [(name, i, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id string, row_id long, cnt double").withColumn(
        "timestamp", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(row_id as int))"))


def test_tails_are_exact(spark):
    import math
    from hourcast.functions.exprs import erfc, kolmogorov_sf, log_erfc
    zs = [-30.0, -6.0, -3.0, -1.0, -1e-9, 0.0, 1e-9, 0.3, 1.0, 2.9999, 3.0, 5.0, 10.0, 26.0]
    d = spark.createDataFrame([(z,) for z in zs], "z double")
    for r in d.select("z", erfc("z").alias("e"), log_erfc("z").alias("l")).collect():
        assert r.e == pytest.approx(math.erfc(r.z), rel=1e-10)
        assert r.l == pytest.approx(math.log(math.erfc(r.z)), rel=1e-10, abs=1e-15)
    far = d.limit(1).select(log_erfc(F.lit(100.0)).alias("l")).first().l
    assert far == pytest.approx(-1e4 - math.log(100 * math.sqrt(math.pi)) + math.log1p(-1 / 2e4), abs=1e-6)
    ks = [0.005, 0.2, 0.5, 1.0, 1.1799, 1.1801, 2.0]
    got = [r.p for r in spark.createDataFrame([(k,) for k in ks], "k double").select(kolmogorov_sf("k").alias("p")).collect()]
    want = [1.0] + [2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * k * k) for j in range(1, 2000)) for k in ks[1:]]
    assert got == pytest.approx(want, abs=1e-9)


def test_anderson_darling_keeps_outliers(spark):
    import math
    rng = np.random.default_rng(3)
    x = np.append(rng.normal(size=800), 15.0)
    z = np.sort((x - x.mean()) / x.std(ddof=1))
    n = len(z)
    log_cdf = np.array([math.log(0.5 * math.erfc(-v / math.sqrt(2))) for v in z])
    log_sf = np.array([math.log(0.5 * math.erfc(v / math.sqrt(2))) for v in z])
    i = np.arange(1, n + 1)
    want = -n - np.sum((2 * i - 1) * (log_cdf + log_sf[::-1])) / n
    got = D.anderson_darling(_series(spark, x), "cnt").first()["ad_statistic"]
    assert got == pytest.approx(want, rel=1e-9)


def test_acf_keeps_the_places_of_nulls(spark):
    rng = np.random.default_rng(4)
    x = np.cumsum(rng.normal(size=300))
    values = [None if i in (5, 50, 51, 200) else v for i, v in enumerate(x)]
    got = {r.lag: r.acf for r in D.acf(_series(spark, values), "cnt", 10).collect()}
    y = np.array([np.nan if v is None else v for v in values])
    d = y - np.nanmean(y)
    for k in range(1, 11):
        assert got[k] == pytest.approx(np.nansum(d[k:] * d[:-k]) / np.nansum(d * d), rel=1e-9)


def _adf_reference(x, lags):
    """AIC over 0..lags on the common sample, then the t statistic on its own."""
    import math
    dx = np.diff(x)

    def fit(p, start):
        t = np.arange(start, len(dx))
        z = np.column_stack([np.ones(len(t)), x[t], *[dx[t - j] for j in range(1, p + 1)]])
        b, *_ = np.linalg.lstsq(z, dx[t], rcond=None)
        ssr = float(np.sum((dx[t] - z @ b) ** 2))
        return z, b, ssr, len(t)
    aic = []
    for p in range(lags + 1):
        _, b, ssr, n = fit(p, lags)
        aic.append(n * (math.log(2 * math.pi) + math.log(ssr / n) + 1) + 2 * len(b))
    p = int(np.argmin(aic))
    z, b, ssr, n = fit(p, p)
    cov = np.linalg.inv(z.T @ z) * ssr / (n - len(b))
    return b[1] / math.sqrt(cov[1, 1]), p, min(aic)


def test_adf_of_a_series_does_not_depend_on_others(spark):
    import math
    rng = np.random.default_rng(6)
    long, short = np.cumsum(rng.normal(size=300)) * 0.4 + rng.normal(size=300), rng.normal(size=30)
    both = {r.series_id: r for r in D.adf(_series(spark, long, "long").union(_series(spark, short, "short")), "cnt").collect()}
    for name, x in (("long", long), ("short", short)):
        lags = max(0, min(len(x) // 2 - 2, math.ceil(12 * (len(x) / 100) ** 0.25)))
        stat, p, best = _adf_reference(x, lags)
        r = both[name]
        assert r.usedlag == p and r.adf_stat == pytest.approx(stat, rel=1e-6) and r.icbest == pytest.approx(best, rel=1e-6)


def test_lambda_of_large_values_and_zeros(spark):
    import math
    rng = np.random.default_rng(8)
    x = 1e6 + rng.normal(size=500)
    got = {r["lambda"]: r.llf for r in D.fit_lambda(_series(spark, x), "cnt", "boxcox", [1.0, 2.0]).collect()}
    for lam in (1.0, 2.0):
        y = ((x + 1) ** lam - 1) / lam
        want = (lam - 1) * np.log(x + 1).sum() - 250 * math.log(y.var())
        assert got[lam] == pytest.approx(want, rel=1e-6)
    zeros = _series(spark, [0, 0, 1, 2, 3, 10, 4, 1])
    y = np.log1p([0, 0, 1, 2, 3, 10, 4, 1])
    llf = D.fit_lambda(zeros, "cnt", "boxcox", [0.0]).first().llf
    assert llf == pytest.approx(-y.sum() - 4 * math.log(y.var()), rel=1e-9)


def test_ewma_with_nulls_equals_pandas(spark):
    import pandas as pd
    from hourcast.operators import features as FT
    values = [None, 3.0, 5.0, None, None, 7.0, 2.0, None, 9.0] + [float(k % 7) for k in range(40)]
    got = [r.cnt_ewm_24h for r in FT.ewma_shifted(_series(spark, values), "cnt").orderBy("row_id").collect()]
    want = pd.Series(values, dtype=float).shift(1).ewm(span=24, adjust=False).mean().tolist()
    assert [g is None for g in got] == [w != w for w in want]
    assert [g for g in got if g is not None] == pytest.approx([w for w in want if w == w], rel=1e-12)
