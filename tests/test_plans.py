"""Scale primitives vs brute force (row index, halo windows, blocked frames,
exact quantiles, top-k)."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hourcast.plans.blocked import blocked_cumsum, blocked_fill
from hourcast.plans.halo import series_select
from hourcast.plans.ordering import with_row_index
from hourcast.plans.quantiles import exact_quantiles
from hourcast.plans.topk import group_top_k
from hourcast.sources import adapters as A


@pytest.fixture(scope="module")
def gappy(spark):
    # sf0.001 hourly has gaps (531 of 720 hours) -> rows != hours
    return A.hourly_by_type(spark, "/root/testdata/sf0.001").cache()


def test_row_index_matches_row_number(gappy):
    a = with_row_index(gappy, "series_id", ("timestamp", "row_id"), span=24).select("series_id", "row_id", "row_idx")
    b = gappy.select("series_id", "row_id", (F.row_number().over(
        Window.partitionBy("series_id").orderBy("timestamp", "row_id")) - 1).alias("row_idx"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("block_rows", [50, 200])
def test_halo_equals_partition_window(gappy, block_rows):
    def build(w):
        return {"l1": F.lag("cnt", 1).over(w), "l168": F.lag("cnt", 168).over(w),
                "m72": F.avg("cnt").over(w.rowsBetween(-71, 0)), "s24": F.stddev_samp("cnt").over(w.rowsBetween(-24, -1))}
    h = series_select(gappy, build, 168, block_rows=max(block_rows, 169)).select("series_id", "row_id", "l1", "l168", "m72", "s24")
    p = series_select(gappy, build, 168, strategy="partition").select("series_id", "row_id", "l1", "l168", "m72", "s24")
    ph = h.toPandas().sort_values(["series_id", "row_id"]).reset_index(drop=True)
    pp = p.toPandas().sort_values(["series_id", "row_id"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(ph, pp, check_exact=False, rtol=1e-12)


def test_blocked_fill_matches_pandas(spark):
    rng = np.random.default_rng(1)
    n = 500
    v = rng.normal(size=n)
    v[rng.random(n) < 0.6] = np.nan
    v[:7] = np.nan
    v[-5:] = np.nan
    pdf = pd.DataFrame({"series_id": "s", "row_id": np.arange(n), "x": v})
    df = spark.createDataFrame(pdf.astype({"x": object}).where(pdf.notna(), None), "series_id string, row_id long, x double")
    f = blocked_fill(df, ["x"], order=("row_id",), span=37)
    b = blocked_fill(f, ["x"], order=("row_id",), span=37, backward=True)
    got = b.orderBy("row_id").toPandas()["x"].to_numpy()
    exp = pd.Series(v).ffill().bfill().to_numpy()
    np.testing.assert_allclose(got, exp)


def test_blocked_cumsum(spark):
    pdf = pd.DataFrame({"g": np.repeat(["a", "b"], 300), "o": np.tile(np.arange(300), 2), "v": np.arange(600) % 7})
    df = spark.createDataFrame(pdf)
    out = blocked_cumsum(df, ["v"], partition=["g"], order=["o"], block=F.floor(F.col("o") / 13)).toPandas()
    out = out.sort_values(["g", "o"])
    exp = pdf.sort_values(["g", "o"]).groupby("g")["v"].cumsum()
    np.testing.assert_array_equal(out["cum_v"].to_numpy(), exp.to_numpy())


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.integers(0, 20, 800).astype(float), rng.normal(size=300)])  # ties + continuous
    grp = np.where(np.arange(len(vals)) % 3 == 0, "x", "y")
    df = spark.createDataFrame(pd.DataFrame({"g": grp, "v": vals}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    q = exact_quantiles(df, ["v"], probs, by=["g"]).toPandas()
    for g in ("x", "y"):
        for p in probs:
            got = q[(q.g == g) & (q.p == p)]["q"].iloc[0]
            assert got == pytest.approx(np.percentile(vals[grp == g], p * 100), abs=1e-12)


def test_group_top_k(spark):
    pdf = pd.DataFrame({"k": np.arange(1000) % 3, "v": (np.arange(1000) * 7919) % 1009, "id": np.arange(1000)})
    df = spark.createDataFrame(pdf)
    got = group_top_k(df, ["k"], [F.col("v").desc(), F.col("id")], 4).toPandas().sort_values(["k", "rank"])
    exp = pdf.sort_values(["k", "v", "id"], ascending=[True, False, True]).groupby("k").head(4)
    assert got["id"].tolist() == exp["id"].tolist()


def test_blocked_fill_both_matches_pandas(spark):
    from hourcast.plans.blocked import blocked_fill_both
    rng = np.random.default_rng(2)
    n = 400
    v = rng.normal(size=n)
    v[rng.random(n) < 0.7] = np.nan
    v[:11] = np.nan
    v[-9:] = np.nan
    pdf = pd.DataFrame({"series_id": "s", "row_id": np.arange(n), "x": v})
    df = spark.createDataFrame(pdf.astype({"x": object}).where(pdf.notna(), None), "series_id string, row_id long, x double")
    got = blocked_fill_both(df, ["x"], order=("row_id",), span=23).orderBy("row_id").toPandas()["x"].to_numpy()
    np.testing.assert_allclose(got, pd.Series(v).ffill().bfill().to_numpy())


@pytest.mark.parametrize("kind", ["continuous", "ties", "tiny", "constant", "heavy"])
def test_exact_quantiles_of_any_shape(spark, kind):
    rng = np.random.default_rng(11)
    vals = {"continuous": rng.normal(size=60_000), "ties": rng.integers(0, 7, 30_000).astype(float), "tiny": np.array([3.0, 1.0]),
            "constant": np.full(5000, 2.5), "heavy": np.concatenate([np.zeros(20_000), rng.exponential(size=5000)])}[kind]
    probs = [0.0, 0.001, 0.25, 0.4999, 0.5, 0.75, 0.999, 1.0]
    df = spark.createDataFrame(pd.DataFrame({"v": vals})).repartition(6)
    got = {r.p: r.q for r in exact_quantiles(df, ["v"], probs).collect()}
    assert [got[p] for p in probs] == pytest.approx([np.percentile(vals, p * 100) for p in probs], abs=1e-12)


def test_a_thousand_quantiles_per_group(spark):
    """Edges are searched by halves: the slot takes log2 of them steps, and no
    target is compared with every value."""
    rng = np.random.default_rng(13)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 20_000), "v": np.round(rng.normal(size=20_000), 3)})
    probs = np.linspace(0, 1, 1000).tolist()
    got = exact_quantiles(spark.createDataFrame(pdf), ["v"], probs, by=("g",)).toPandas().sort_values(["g", "p"])
    for g, own in pdf.groupby("g"):
        assert got[got.g == g].q.to_numpy() == pytest.approx(np.quantile(own.v, probs), abs=1e-12)


def test_quantiles_exchange_only_rows_near_the_targets(spark):
    from hourcast.plans import quantiles as Q
    seen = []
    df = spark.range(200_000).select(F.lit("a").alias("g"), F.hash("id").cast("double").alias("v"))
    import hourcast.session as S
    old = S.cut_lineage
    try:
        S.cut_lineage = lambda d, eager=True: seen.append(old(d, eager)) or seen[-1]
        Q.group_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75])
    finally:
        S.cut_lineage = old
    assert len(seen) == 2 and seen[1].count() < 2000


def test_value_cumulative_in_many_blocks(spark):
    from hourcast.plans.quantiles import value_cumulative
    rng = np.random.default_rng(12)
    vals = np.round(rng.normal(size=3000), 2)
    long = spark.createDataFrame(pd.DataFrame({"feature": "v", "value": vals}))
    out = value_cumulative(long, ["feature"], rows_per_block=20).toPandas().sort_values("value")
    uniq, count = np.unique(vals, return_counts=True)
    assert out["_blk"].nunique() > 10 and (out["cum__c"].to_numpy() == np.cumsum(count)).all() and (out["tot__c"] == 3000).all()
