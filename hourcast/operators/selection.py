"""Feature selection found in the reference's documents."""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..plans.quantiles import quantiles_long, unpivot
from .eda import corr_matrix


def variance_filter(df: DataFrame, cols, threshold: float = 0.01) -> DataFrame:
    """Population variance per column; kept when variance > threshold."""
    long = unpivot(df, [], list(cols))
    v = long.groupBy("feature").agg(F.var_pop("value").alias("variance"))
    return v.withColumn("keep", F.col("variance") > threshold)


def correlation_filter(df: DataFrame, cols, threshold: float = 0.95) -> DataFrame:
    """A column is dropped when its |r| with any EARLIER column (input
    order, upper-triangle rule) exceeds the threshold."""
    cols = list(cols)
    pos = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    cm = corr_matrix(df, cols).where(pos[F.col("a")] < pos[F.col("b")])
    m = cm.groupBy(F.col("b").alias("feature")).agg(F.max(F.abs("corr")).alias("max_abs_corr_earlier"))
    return m.withColumn("drop", F.coalesce(F.col("max_abs_corr_earlier") > threshold, F.lit(False)))


def vif(df: DataFrame, cols) -> DataFrame:
    """VIF_j = j-th diagonal element of the inverse correlation matrix
    (centred regressions; statsmodels' helper regresses without a constant,
    which differs for non-centred data). The k x k matrix comes from one
    aggregation; inverting it is driver work on k^2 numbers."""
    cols = list(cols)
    rows = corr_matrix(df, cols).collect()
    idx = {c: i for i, c in enumerate(cols)}
    m = np.eye(len(cols))
    for r in rows:
        m[idx[r["a"]], idx[r["b"]]] = r["corr"] if r["corr"] is not None else 0.0
    inv = np.linalg.pinv(m)
    return df.sparkSession.createDataFrame([(c, float(inv[i, i])) for i, c in enumerate(cols)], "feature string, vif double")


def vif_filter(df: DataFrame, cols, limit: float = 10.0, drop: int = 3) -> DataFrame:
    """X4 rule: of the columns whose VIF exceeds ``limit`` the ``drop`` largest
    go. One row per column: feature, vif, dropped (one row per column, so the
    ranking window is small)."""
    table = vif(df, cols)
    place = F.row_number().over(Window.orderBy(F.desc("vif"), "feature"))
    return table.withColumn("dropped", (place <= drop) & (F.col("vif") > limit))


def f_scores(df: DataFrame, cols, target: str = "cnt", k: int = 50) -> DataFrame:
    """Univariate F statistic r^2 / (1 - r^2) * (n - 2) (f_regression);
    the top ``k`` are selected."""
    cols = list(cols)
    w = df.agg(F.count(F.lit(1)).alias("_n"), *[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c)
                                               for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = w.selectExpr("_n", f"stack({len(cols)}, {stack}) AS (feature, r)")
    f = long.select("feature", (F.col("r") * F.col("r") / (1 - F.col("r") * F.col("r")) * (F.col("_n") - 2)).alias("f_score"))
    return f.withColumn("selected", F.rank().over(Window.orderBy(F.desc_nulls_last("f_score"))) <= k)


def mutual_info_binned(df: DataFrame, cols, target: str = "cnt", bins: int = 10) -> DataFrame:
    """Mutual information of each column with the target on equal-
    frequency bins (exact deciles): sum p(x,y) ln(p(x,y) / (p(x) p(y)))."""
    cols = list(cols)
    probs = [i / bins for i in range(1, bins)]
    allc = cols + [target]
    q = quantiles_long(unpivot(df, [], allc), probs).groupBy("feature").agg(
        F.sort_array(F.collect_list(F.struct("p", "q"))).alias("_qs"))
    bounds = {r["feature"]: [s["q"] for s in r["_qs"]] for r in q.collect()}

    def bin_of(c):
        arr = F.array(*[F.lit(float(b)) for b in bounds.get(c, [])])
        return F.size(F.filter(arr, lambda b: b < F.col(c).cast("double")))
    d = df.select(*[bin_of(c).alias(c) for c in allc])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = d.selectExpr(f"`{target}` AS _y", f"stack({len(cols)}, {stack}) AS (feature, _x)")
    jc = long.groupBy("feature", "_x", "_y").agg(F.count(F.lit(1)).alias("_c"))
    n = df.count()
    px = jc.groupBy("feature", "_x").agg(F.sum("_c").alias("_cx"))
    py = jc.groupBy("feature", "_y").agg(F.sum("_c").alias("_cy"))
    j = jc.join(px, ["feature", "_x"]).join(py, ["feature", "_y"])
    pxy = F.col("_c") / n
    return j.groupBy("feature").agg(F.sum(pxy * F.log(pxy / ((F.col("_cx") / n) * (F.col("_cy") / n)))).alias("mutual_info"))


def rfe(df: DataFrame, cols, *, target="cnt", n_select: int = 30, step: int = 1, num_trees: int = 50,
        max_depth: int = 10) -> DataFrame:
    """Recursive elimination with a forest: refit, drop the least important
    ``step`` columns, until ``n_select`` remain. Returns (feature, rank)."""
    from .models import fit_pipeline, importance
    current = list(cols)
    ranks = {}
    r = len(current)
    while len(current) > n_select:
        dm = fit_pipeline(df, current, label=target, model="random_forest", scaler="none", numTrees=num_trees,
                          maxDepth=max_depth)
        imp = {row["feature"]: row["importance"] for row in importance(dm, df.sparkSession).collect()}
        drop = sorted(current, key=lambda c: (imp.get(c, 0.0), c))[:min(step, len(current) - n_select)]
        for c in drop:
            ranks[c] = r
            r -= 1
        current = [c for c in current if c not in drop]
    rows = [(c, 1) for c in current] + [(c, rk - n_select + 1) for c, rk in ranks.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, rank int")


def leak_test(train: DataFrame, val: DataFrame, cols, *, target="cnt", seed: int = DEFAULT.seed,
              threshold: float = 0.05, order=("timestamp", "row_id")) -> DataFrame:
    """Permute the training target (seeded hash order joined to the time
    order -- a distributed permutation), fit a forest (50 trees, depth 10) and
    score validation; R^2 above ``threshold`` flags leakage."""
    from ..plans.ordering import with_row_index
    from .models import evaluate_model, fit_pipeline
    t = train if "series_id" in train.columns else train.withColumn("series_id", F.lit("all"))
    a = with_row_index(t, "series_id", order, name="_i")
    n = t.count()
    nblocks = max(1, n // 200_000)                 # ~200k rows per hash block
    span = min(-(-(1 << 64) // nblocks), 1 << 62)  # hash values cover 2^64; keep the literal a long
    b = with_row_index(t.withColumn("_h", F.xxhash64(*[F.col(c) for c in order], F.lit(seed))),
                       "series_id", ("_h",) + tuple(order), name="_i", span=span).select(
        "series_id", "_i", F.col(target).alias("_yperm"))
    shuffled = a.join(b, ["series_id", "_i"]).drop(target).withColumnRenamed("_yperm", target)
    dm = fit_pipeline(shuffled, cols, label=target, model="random_forest", scaler="none", numTrees=50, maxDepth=10)
    m = evaluate_model(dm, val, target)
    return m.select("r2", "mae", (F.col("r2") > threshold).alias("leak_suspected"))


# FIXED VALUES: the reference's leakage denylist (target components and their lags)
LEAK_DENYLIST = (
    "casual_share", "ratio_registered_casual", "casual_share_hr",
    "cnt_lag_1h", "cnt_lag_24h", "cnt_lag_168h", "cnt_roll_mean_3h", "cnt_roll_mean_24h",
    "cnt_pct_change_1h", "cnt_pct_change_24h", "cnt_acceleration", "cnt_volatility_24h", "cnt_diff_168h",
    "registered_lag_1h", "registered_lag_24h", "registered_lag_168h", "registered_roll_mean_3h",
    "registered_roll_mean_24h", "registered_vs_avg_24h",
    "casual_lag_1h", "casual_lag_24h", "casual_lag_168h", "casual_roll_mean_3h", "casual_roll_mean_24h",
    "casual_vs_avg_24h",
)


def drop_leaky(df: DataFrame, denylist=LEAK_DENYLIST, targets=("cnt", "casual", "registered")) -> DataFrame:
    """X11: drop denylisted and target columns (plan-time column filter)."""
    return df.drop(*[c for c in df.columns if c in set(denylist) | set(targets)])
