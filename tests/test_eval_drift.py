"""Evaluation and drift: the reference's metric vectors and drift scenarios."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourcast.operators import drift as V
from hourcast.operators import evaluate as M


def _pred(spark, y, p):
    return spark.createDataFrame(pd.DataFrame({"y": np.asarray(y, float), "prediction": np.asarray(p, float)}))


def test_metric_vectors(spark):
    m = M.evaluate(_pred(spark, [1, 2, 3, 4, 5], [1.1, 2.2, 2.9, 4.1, 4.8])).first()
    assert m["mae"] == pytest.approx(0.14) and m["r2"] > 0.5
    p = M.evaluate(_pred(spark, [1, 2, 3, 4, 5], [1, 2, 3, 4, 5])).first()
    assert (p["mae"], p["rmse"], p["r2"], p["residuals_mean"]) == (0.0, 0.0, 1.0, 0.0)
    y, yh = [100, 200, 300, 400, 500], [110, 190, 310, 390, 510]
    q = M.evaluate(_pred(spark, y, yh)).first()
    r = np.array(y) - np.array(yh)
    assert q["rmse"] == pytest.approx(np.sqrt(np.mean(r ** 2)))
    assert q["residuals_std"] == pytest.approx(r.std(ddof=1))
    assert M.evaluate(_pred(spark, y, yh), ddof=0).first()["residuals_std"] == pytest.approx(r.std())
    c = M.evaluate(_pred(spark, [3, 3, 3], [3, 3, 4])).first()
    assert c["r2"] == 0.0  # constant target, imperfect prediction


def test_meets_targets(spark):
    m = spark.createDataFrame([(80.0, 120.0, 0.85, 10.0)], "mae double, rmse double, r2 double, mape double")
    t = {r["metric"]: r["meets"] for r in M.meets_targets(m).collect()}
    assert t == {"mae": True, "rmse": True, "r2": True, "mape": True}


@pytest.fixture(scope="module")
def ref(spark):
    rng = np.random.default_rng(42)
    pdf = pd.DataFrame({"feature1": rng.normal(10, 2, 500), "feature2": rng.normal(5, 1, 500),
                        "feature3": rng.uniform(0, 100, 500), "categorical": rng.choice(["A", "B", "C"], 500)})
    return spark.createDataFrame(pdf), pdf


def _summary(ref_df, cur_df):
    per = V.detect_drift(ref_df, cur_df, ["feature1", "feature2", "feature3"], ["categorical"])
    return per, V.drift_summary(per, 4).first()


def test_no_drift_on_same_data(spark, ref):
    df, _ = ref
    per, s = _summary(df, df)
    assert s["drift_score"] < 0.25 and not s["has_drift"]
    assert per.where("type = 'categorical'").first()["chi2_statistic"] == pytest.approx(0.0, abs=1e-9)


def test_mean_and_spread_shift_detected(spark, ref):
    df, pdf = ref
    shifted = spark.createDataFrame(pdf.assign(feature1=pdf.feature1 + 5))
    per, s = _summary(df, shifted)
    assert s["has_drift"] and per.where("feature = 'feature1'").first()["has_drift"]
    spread = spark.createDataFrame(pdf.assign(feature2=(pdf.feature2 - pdf.feature2.mean()) * 3 + pdf.feature2.mean()))
    per2, _ = _summary(df, spread)
    assert per2.where("feature = 'feature2'").first()["has_drift"]
    rng = np.random.default_rng(1)
    cat = spark.createDataFrame(pdf.assign(categorical=rng.choice(["A", "A", "A", "B", "C"], 500)))
    per3, _ = _summary(df, cat)
    assert per3.where("feature = 'categorical'").first()["chi2_pvalue"] < 0.05


def test_synthetic_drift(spark, ref):
    df, pdf = ref
    ms = V.inject_drift(df, "mean_shift", 2.0, ["feature1"]).agg(F.avg("feature1")).first()[0]
    assert ms == pytest.approx(pdf.feature1.mean() + 2 * pdf.feature1.std(), rel=1e-9)
    vs = V.inject_drift(df, "variance_shift", 1.5, ["feature2"]).agg(F.stddev_samp("feature2")).first()[0]
    assert vs == pytest.approx(pdf.feature2.std() * np.sqrt(2.5), rel=1e-9)
    ds = V.inject_drift(df, "distribution_shift", 1.0, ["feature3"]).agg(F.avg("feature3")).first()[0]
    assert ds > pdf.feature3.mean() + 0.5 * pdf.feature3.std()


def test_performance_decay(spark):
    base = {"mae": 100.0, "rmse": 150.0, "r2": 0.85}
    perfect = _pred(spark, [1, 2, 3], [1, 2, 3])
    r = V.check_performance(perfect, base).first()
    assert r["degradation_score"] < 0 and not r["has_degradation"] and not r["alert"]
    worse = _pred(spark, [0, 0, 0, 0], [125, -125, 125, -125])
    r2 = V.check_performance(worse, base).first()
    assert r2["degradation_score"] == pytest.approx(0.25) and r2["has_degradation"] and not r2["alert"]
    r3 = V.check_performance(_pred(spark, [0, 0], [140, -140]), base).first()
    assert r3["alert"]
    assert not V.check_performance(worse, {}).first()["has_degradation"]
    with pytest.raises(ValueError):
        V.check_performance(worse, base, metric="mape")
    rr = V.check_performance(worse, base, metric="r2").first()
    assert rr["degradation_score"] > 0


def test_monitor_recommendation(spark, ref):
    df, pdf = ref
    shifted = spark.createDataFrame(pdf.assign(feature1=pdf.feature1 + 5))
    pred = _pred(spark, [0, 0], [200, -200])
    r = V.monitor(df, shifted, pred, {"mae": 100.0}, continuous=["feature1"]).first()
    assert r["drift_detected"] and r["alert"] and r["recommendation"] == V.ADVICE[0]
    ok = V.monitor(df, df, _pred(spark, [1, 2], [1, 2]), {"mae": 100.0}, continuous=["feature1"]).first()
    assert ok["recommendation"] == V.ADVICE[3]
