"""Features: the reference's assertions (sqrt target, lag nulls, sin/cos
range) and the F4 / F6 decisions."""
import math

import pandas as pd

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.operators import clean as C
from hourcast.operators import features as FT
from hourcast.operators import windows as W


@pytest.fixture(scope="module")
def engineered(spark, hourly_fixture):
    df, _ = hourly_fixture
    return FT.engineer(C.enforce_sum(df)).cache()


def test_target_and_lags(engineered):
    pdf = engineered.orderBy("timestamp").toPandas()
    np.testing.assert_allclose(pdf["cnt_transformed"] ** 2, pdf["cnt"], rtol=1e-9)
    for k in (1, 24, 48, 72, 168):
        col = f"cnt_transformed_lag_{k}h"
        assert pdf[col].iloc[:k].isna().all() and pdf[col].iloc[k:].notna().all()
        np.testing.assert_allclose(pdf[col].iloc[k:].to_numpy(), pdf["cnt_transformed"].iloc[:-k].to_numpy())
    for c in ("hr_sin", "hr_cos", "mnth_sin", "weekday_cos"):
        assert pdf[c].between(-1, 1).all()


def test_leak_safe_vs_library(spark, hourly_fixture):
    df, pdf = hourly_fixture
    d = FT.transform_target(C.enforce_sum(df))
    safe = W.rolling(d, windows=(3,), include_current=False).orderBy("timestamp").toPandas()
    lib = W.rolling(d, windows=(3,), include_current=True).orderBy("timestamp").toPandas()
    y = safe["cnt_transformed"]
    np.testing.assert_allclose(lib["cnt_transformed_roll_mean_3h"], y.rolling(3, min_periods=1).mean())
    np.testing.assert_allclose(safe["cnt_transformed_roll_mean_3h"].iloc[1:], y.shift(1).rolling(3, min_periods=1).mean().iloc[1:])
    np.testing.assert_allclose(lib["cnt_transformed_roll_std_3h"], y.rolling(3, min_periods=1).std().fillna(0))


def test_pct_change_and_infinite_cleaning(spark):
    rows = [("s", i, float(v)) for i, v in enumerate([0, 0, 3, 0, 5, 5, 2])]
    df = spark.createDataFrame(rows, "series_id string, row_id long, x double").withColumn(
        "timestamp", F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.col("row_id").cast("int"), F.lit(0), F.lit(0)))
    p = W.pct_change(df, "x", (1,)).orderBy("row_id").toPandas()["cnt_pct_change_1h"].tolist()
    assert p[:3] == [0.0, 0.0, math.inf] and p[4] == math.inf and p[5] == 0.0
    cleaned = FT.clean_infinite(W.pct_change(df, "x", (1,)), mode="compat").orderBy("row_id").toPandas()
    finite = [v for v in p if math.isfinite(v)]
    assert cleaned["cnt_pct_change_1h"].tolist()[2] == pytest.approx(np.median(finite))
    # compat: no inf in the frame -> NULLs are kept
    none_inf = FT.clean_infinite(df.withColumn("y", F.lit(None).cast("double")), mode="compat")
    assert none_inf.where("y IS NULL").count() == 7


def test_cyclical_presets(spark, hourly_fixture):
    df, _ = hourly_fixture
    obs = FT.cyclical(df.select("hr"), ("hr",)).toPandas()
    nb = FT.cyclical(df.select("hr"), ("hr",), period="notebook").toPandas()
    np.testing.assert_allclose(obs["hr_sin"], np.sin(2 * np.pi * obs["hr"] / 23))
    np.testing.assert_allclose(nb["hr_sin"], np.sin(2 * np.pi * nb["hr"] / 24))


def test_transforms_invert(spark, hourly_fixture):
    df, _ = hourly_fixture
    x = F.col("cnt").cast("double") + 1
    for m, lam in (("sqrt", None), ("log1p", None), ("boxcox", 0.27), ("yeojohnson", 0.273), ("boxcox", 0.0)):
        r = df.select(x.alias("x"), FT.inverse_expr(FT.forward_expr(x, m, lam), m, lam).alias("y")).toPandas()
        np.testing.assert_allclose(r["y"], r["x"], rtol=1e-9)


def test_ewma_matches_recursion(spark, hourly_fixture):
    df, pdf = hourly_fixture
    d = FT.ewma_shifted(FT.transform_target(df)).orderBy("timestamp").toPandas()
    y = np.sqrt(pdf["cnt"].astype(float))
    exp = y.shift(1).ewm(span=24, adjust=False).mean()
    np.testing.assert_allclose(d["cnt_transformed_ewm_24h"].iloc[1:], exp.iloc[1:], rtol=1e-9)
    assert math.isnan(d["cnt_transformed_ewm_24h"].iloc[0]) or d["cnt_transformed_ewm_24h"].iloc[0] is None


def test_safe_variant_reads_no_current_target(spark, hourly_fixture):
    """Changing the target of one row must not change that row's safe features."""
    df, _ = hourly_fixture
    base = C.enforce_sum(df)
    bumped = base.withColumn("cnt", F.when(F.col("row_id") == 500, F.col("cnt") + 1000).otherwise(F.col("cnt")))
    feats = [c for c in FT.engineer(base).columns if c.startswith("cnt_") and c != "cnt_transformed"]
    a = FT.engineer(base).where("row_id = 500").select(*feats).first().asDict()
    b = FT.engineer(bumped).where("row_id = 500").select(*feats).first().asDict()
    assert a == b
    lib_a = FT.engineer(base, variant="library").where("row_id = 500").first()
    lib_b = FT.engineer(bumped, variant="library").where("row_id = 500").first()
    assert lib_a["cnt_pct_change_1h"] != lib_b["cnt_pct_change_1h"]   # the library form reads row t (F4)


def test_build_timestamp_fallbacks(spark, hourly_fixture):
    df, pdf = hourly_fixture
    a = FT.build_timestamp(df.drop("timestamp")).orderBy("row_id").toPandas()
    exp = pd.to_datetime(pdf["dteday"]) + pd.to_timedelta(pdf["hr"], unit="h")
    assert (a["timestamp"].values == exp.values).all()
    b = FT.build_timestamp(df.drop("timestamp", "dteday")).orderBy("row_id").first()
    assert b["timestamp"].year == 2011 + b["yr"] and b["timestamp"].month == b["mnth"] and b["timestamp"].hour == b["hr"]
    c = FT.build_timestamp(df.select("series_id", "row_id", "cnt")).orderBy("row_id").toPandas()
    assert (c["timestamp"].diff().dropna() == pd.Timedelta(hours=1)).all() and str(c["timestamp"].iloc[0]) == "2011-01-01 00:00:00"


def test_one_hot_fit_and_drop_first(spark, hourly_fixture):
    df, pdf = hourly_fixture
    cats = FT.fit_categories(df, ["season"])
    assert cats["season"] == [1, 2, 3, 4]
    oh = FT.one_hot(df, cats, drop_first=True).toPandas()
    assert [c for c in oh.columns if c.startswith("season_")] == ["season_2", "season_3", "season_4"]
    assert (oh["season_2"] == (pdf["season"] == 2).astype(int)).all()


def test_time_mode_lags_with_gaps(spark):
    from hourcast.sources import adapters as A
    h = A.hourly(spark, "/root/testdata/sf0.001").select("series_id", "row_id", "timestamp", "cnt")
    t = W.lags(h, "cnt", (1, 24), mode="time", name="{c}_t{k}").toPandas().set_index("timestamp").sort_index()
    r = W.lags(h, "cnt", (1,), name="{c}_r{k}").toPandas().set_index("timestamp").sort_index()
    s = t["cnt"]
    for ts, row in t.iterrows():
        prev = ts - pd.Timedelta(hours=1)
        exp = s.get(prev)
        assert (row["cnt_t1"] == exp) or (pd.isna(row["cnt_t1"]) and exp is None)
    # with gaps, row lags and time lags differ somewhere
    assert (r["cnt_r1"].fillna(-1) != t["cnt_t1"].fillna(-1)).any()


def test_time_mode_lags_keep_the_row_count(spark):
    from hourcast.operators import windows as W
    rows = [("a", i, h, float(v)) for i, (h, v) in enumerate([(0, 1), (1, 2), (1, 3), (2, 4), (4, 5), (5, 6)])]
    d = (spark.createDataFrame(rows, "series_id string, row_id long, h int, cnt double")
         .withColumn("timestamp", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, h)")))
    got = {r.row_id: (r.cnt_lag_1h, r.cnt_lag_2h) for r in W.lags(d, "cnt", (1, 2), mode="time").collect()}
    assert got == {0: (None, None), 1: (1.0, None), 2: (1.0, None), 3: (3.0, 1.0), 4: (None, 4.0), 5: (5.0, None)}
