"""Split and scaling (reference assertions + NumPy parity)."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.operators import scale as P
from hourcast.operators import split as S


def test_split_sizes_and_order(spark, hourly_fixture):
    df, _ = hourly_fixture
    s = S.split(df)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": int(1000 * 0.7), "val": int(1000 * 0.15), "test": 1000 - 700 - 150}
    t = {r["split"]: (r["lo"], r["hi"]) for r in s.groupBy("split").agg(F.min("timestamp").alias("lo"),
                                                                       F.max("timestamp").alias("hi")).collect()}
    assert t["train"][1] <= t["val"][0] and t["val"][1] <= t["test"][0]


def test_split_fraction_error():
    with pytest.raises(ValueError):
        S.check_fractions((0.5, 0.3, 0.1))


def test_scalers_match_numpy(spark, hourly_fixture):
    df, pdf = hourly_fixture
    cols = ["temp", "hum", "hr"]
    for kind in ("standard", "robust", "minmax"):
        m = P.Scaler(kind, exclude=()).fit(df, cols)
        out = m.transform(df).toPandas()
        for c in cols:
            x = pdf[c].astype(float).to_numpy()
            if kind == "standard":
                exp = (x - x.mean()) / x.std()
            elif kind == "robust":
                q1, q2, q3 = np.percentile(x, [25, 50, 75])
                exp = (x - q2) / (q3 - q1)
            else:
                exp = (x - x.min()) / (x.max() - x.min())
            np.testing.assert_allclose(out[c], exp, rtol=1e-9, atol=1e-12)


def test_scaler_errors_and_exclusions(spark, hourly_fixture):
    df, _ = hourly_fixture
    with pytest.raises(ValueError):
        P.Scaler("bogus")
    m = P.Scaler("robust").fit(df, ["temp", "holiday", "workingday", "hr"])
    assert m.scale_cols == ("temp", "hr") and m.keep_cols == ("holiday", "workingday")
    out = m.transform(df)
    assert out.columns == ["temp", "hr", "holiday", "workingday"]
    assert P.split_scale_columns(["hr_workingday", "temp_season"])[0] == ["temp_season"]  # F10 substring


def test_quantile_scaler_uniform(spark, hourly_fixture):
    df, _ = hourly_fixture
    out = P.Scaler("quantile", exclude=()).fit(df, ["temp"]).transform(df).toPandas()["temp"]
    assert out.between(0, 1).all() and abs(out.mean() - 0.5) < 0.02


def test_sampling_deterministic(spark, hourly_fixture):
    df, _ = hourly_fixture
    a = [r["row_id"] for r in P.sample_rows(df, 25, 7).collect()]
    b = [r["row_id"] for r in P.sample_rows(df.repartition(5), 25, 7).collect()]
    assert sorted(a) == sorted(b) and len(a) == 25


def test_fraction_sample_independent_of_partitioning(spark, hourly_fixture):
    df, _ = hourly_fixture
    a = sorted(r["row_id"] for r in P.sample_fraction(df, 0.2, 11).collect())
    b = sorted(r["row_id"] for r in P.sample_fraction(df.repartition(7), 0.2, 11).collect())
    assert a == b and 120 < len(a) < 280
