"""Model and drift-report queries (rows / property checks: model fits and
approximate p-values have no SQL oracle)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as V
from ..operators import features as FT
from ..operators import models as MD
from ..operators import profile as J
from ..operators import split as S
from ..operators import scale as P
from ..sources import adapters as A
from .common import hourly_clean
from ..session import cut_lineage
from .core import query
from .q_stats import detect_sql
from .sqlviews import cte

BASIC = ["season", "hr", "weekday", "holiday", "workingday", "weathersit", "temp", "atemp", "hum", "windspeed", "yr"]


def model_frame(spark, sf_dir):
    """Leak-safe feature table with split and train-only profile (the
    library's dataset build: clean -> features -> split -> profile)."""
    d = FT.engineer(hourly_clean(spark, sf_dir))
    d = S.split(d)
    d = J.historical_profile(d.where(F.col("split") == "train"), d)
    # many model fits follow: cut the feature lineage once (checkpoint dir)
    return cut_lineage(J.vs_profile(d))


def feature_list(df):
    cols = [c for c in P.feature_columns(df) if c != "dteday"]
    return [c for c in cols if c not in ("timestamp",)]


@query("models_train_compare")
def q_compare(spark, sf_dir):
    """Ridge (alpha 10), forest (200 x depth 15) and
    boosted trees (300 x depth 4) fit on train; metrics on train / val / test;
    the best model has the lowest validation RMSE."""
    d = model_frame(spark, sf_dir).withColumn("is_val", F.col("split") == "val")
    feats = feature_list(d.drop("is_val"))
    table, _ = MD.train_all(d, feats, model_kw={"boosted": {"validation_col": "is_val"}})
    return table


@query("models_importance")
def q_importance(spark, sf_dir):
    """M6: top-20 forest importances and ridge |coefficients| with names."""
    d = model_frame(spark, sf_dir)
    feats = feature_list(d)
    tr = d.where(F.col("split") == "train")
    rf = MD.fit_pipeline(tr, feats, model="random_forest")
    rg = MD.fit_pipeline(tr, feats, model="ridge")
    return (MD.importance(rf, spark, 20).withColumn("model", F.lit("random_forest"))
            .unionByName(MD.importance(rg, spark, 20).withColumn("model", F.lit("ridge"))))


@query("models_linear_basic")
def q_linear(spark, sf_dir):
    """M4: plain linear model on the 11 basic columns (standard-scaled), 70/30."""
    h = S.split(hourly_clean(spark, sf_dir), (0.7, 0.3, 0.0))
    dm = MD.fit_pipeline(h.where(F.col("split") == "train"), BASIC, model="linear", scaler="standard", exclude=())
    return MD.evaluate_model(dm, h, by=("split",))


@query("models_time_series_cv")
def q_cv(spark, sf_dir):
    """5-fold expanding-window CV of ridge, forest and boosted trees; per
    fold and mean / std rows."""
    d = model_frame(spark, sf_dir)
    return MD.time_series_cv(d, feature_list(d), k=5, models=("ridge", "random_forest", "boosted"))


def _sizes_sql(view):
    return cte(view) + f""",
n AS (SELECT series_id, count(*) AS n FROM {view} GROUP BY 1),
f AS (SELECT n.*, unnest(range(5)) AS fold FROM n)
SELECT series_id, CAST(fold AS INTEGER) AS fold, CAST(n - (5 - fold) * (n // 6) AS BIGINT) AS train_size,
  CAST(n // 6 AS BIGINT) AS test_size FROM f"""


@query("models_cv_sizes", _sizes_sql("hourly"))
def q_cv_sizes(spark, sf_dir):
    """M11 folds of one long series: rows trained on and tested on per fold."""
    return MD.cv_sizes(A.hourly(spark, sf_dir))


@query("models_cv_sizes_keyed", _sizes_sql("hourly_by_type"))
def q_cv_sizes_keyed(spark, sf_dir):
    """M11 folds of five keyed series: every fold holds its part of each series."""
    return MD.cv_sizes(A.hourly_by_type(spark, sf_dir))


_CV_SQL = cte("hourly") + """,
o AS (SELECT CAST(cnt AS DOUBLE) AS y, coalesce(temp, 0) AS a, coalesce(hum, 0) AS b,
        row_number() OVER (ORDER BY "timestamp", row_id) - 1 AS i, count(*) OVER () AS n FROM hourly),
g AS (SELECT o.*, CASE WHEN i < n - 5 * (n // 6) THEN -1 ELSE least((i - (n - 5 * (n // 6))) // (n // 6), 4) END AS blk FROM o),
f AS (SELECT CAST(fold AS INTEGER) AS fold, count(*) AS train_size, avg(y) AS my, avg(a) AS ma, avg(b) AS mb,
        var_pop(a) AS saa, var_pop(b) AS sbb, covar_pop(a, b) AS sab, covar_pop(a, y) AS say, covar_pop(b, y) AS sby
      FROM g JOIN (SELECT unnest(range(5)) AS fold) k ON g.blk < k.fold GROUP BY fold),
w AS (SELECT f.*, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS wa, (sby * saa - say * sab) / (saa * sbb - sab * sab) AS wb FROM f),
p AS (SELECT w.fold, w.train_size, g.y, greatest(my + wa * (g.a - ma) + wb * (g.b - mb), 0) AS p FROM w JOIN g ON g.blk = w.fold),
m AS (SELECT fold, train_size, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
        1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM p GROUP BY 1, 2)
SELECT 'linear' AS model, fold, CAST(train_size AS BIGINT) AS train_size, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2 FROM m
UNION ALL SELECT 'linear', -1, NULL, round(avg(rmse), 6), round(avg(mae), 6), round(avg(r2), 6) FROM m
UNION ALL SELECT 'linear', -2, NULL, round(stddev_pop(rmse), 6), round(stddev_pop(mae), 6), round(stddev_pop(r2), 6) FROM m"""


@query("models_cv_linear", _CV_SQL)
def q_cv_linear(spark, sf_dir):
    """M11 on two columns, all folds from one table of sums per block; the
    oracle solves the same normal equations in SQL, fold by fold."""
    return MD.time_series_cv(A.hourly(spark, sf_dir), ["temp", "hum"], models=("linear",), scaler="none")


@query("models_grid_search")
def q_grid(spark, sf_dir):
    """The whole forest grid with 3 contiguous folds (CrossValidator,
    foldCol), best by MSE."""
    d = model_frame(spark, sf_dir)
    res, best = MD.grid_search(d, feature_list(d))
    return res.withColumn("is_best", F.col("mse") == res.agg(F.min("mse")).first()[0])


@query("models_learning_curve")
def q_lc(spark, sf_dir):
    """Ridge learning curve, 10 sizes x 3 folds, train / test RMSE and gap."""
    d = model_frame(spark, sf_dir)
    return MD.learning_curve(d, feature_list(d), model="ridge")


@query("models_select")
def q_select(spark, sf_dir):
    """Model choice from a registry table built from a fitted comparison:
    explicit name -> best marker -> first available."""
    d = model_frame(spark, sf_dir)
    table, _ = MD.train_all(d, feature_list(d), models=("ridge", "linear"))
    reg = (table.where(F.col("split") == "val").select("model", F.lit(True).alias("available"), "is_best",
                                                     F.when(F.col("model") == "ridge", 1).otherwise(2).alias("rank")))
    return MD.select_model(reg, "linear").withColumn("asked", F.lit("linear")).unionByName(
        MD.select_model(reg, None).withColumn("asked", F.lit(None).cast("string")))


@query("models_compare_transforms")
def q_transforms(spark, sf_dir):
    """Linear model per target transform (none / log1p / sqrt / Box-Cox /
    Yeo-Johnson with grid-fit lambda), inverted, clipped, ranked by RMSE."""
    return MD.compare_transforms(hourly_clean(spark, sf_dir), BASIC)


@query("models_save_load_roundtrip")
def q_saveload(spark, sf_dir):
    """Save the fitted ridge pipeline (Spark ML writer + scaler Parquet)
    to the checkpoint folder, load it back and score: predictions must match."""
    from ..session import checkpoint_dir
    import uuid
    d = model_frame(spark, sf_dir)
    feats = feature_list(d)
    dm = MD.fit_pipeline(d.where(F.col("split") == "train"), feats, model="ridge", transform="sqrt")
    path = f"{checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    dm.save(path, spark)
    dm2 = MD.DemandModel.load(path, spark)
    a = dm.predict(d, keep=("row_id",)).withColumnRenamed("prediction", "p1")
    b = dm2.predict(d, keep=("row_id",)).withColumnRenamed("prediction", "p2")
    return a.join(b, "row_id").withColumn("same", F.abs(F.col("p1") - F.col("p2")) < 1e-9)


def _detect_summary_sql():
    none = "CAST(NULL AS DOUBLE)"
    return f"""WITH per AS ({detect_sql(digits=15)})
SELECT feature, type, has_drift, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue, round(psi, 6) AS psi,
  round(chi2_statistic, 6) AS chi2_statistic, round(chi2_pvalue, 6) AS chi2_pvalue FROM per
UNION ALL SELECT '__summary__', 'summary', coalesce(bool_or(has_drift), false), {none}, {none},
  round(coalesce(avg(psi), count(*) FILTER (WHERE has_drift) / CAST(nullif(count(*), 0) AS DOUBLE), 0), 6), {none}, {none}
FROM per"""


@query("drift_detect_report", _detect_summary_sql())
def q_drift(spark, sf_dir):
    """V1: per-feature drift (KS + PSI for value / k, chi-square for
    event_type) between the two halves of the table, plus the summary row."""
    ref, cur = A.drift_pair(spark, sf_dir)
    per = V.detect_drift(ref, cur, ["value", "k"], ["event_type"])
    s = V.drift_summary(per, 3)
    return per.select("feature", "type", "has_drift", "ks_statistic", "ks_pvalue", "psi", "chi2_statistic",
                      "chi2_pvalue").unionByName(
        s.select(F.lit("__summary__").alias("feature"), F.lit("summary").alias("type"), "has_drift",
                 F.lit(None).cast("double").alias("ks_statistic"), F.lit(None).cast("double").alias("ks_pvalue"),
                 F.col("drift_score").alias("psi"), F.lit(None).cast("double").alias("chi2_statistic"),
                 F.lit(None).cast("double").alias("chi2_pvalue")))


@query("drift_between_weeks")
def q_between(spark, sf_dir):
    """V6: drift of cnt / temp / hum / windspeed between the first and the
    fourth week of hourly data with the mean change in percent."""
    h = hourly_clean(spark, sf_dir).withColumn("week", F.floor((F.dayofmonth("dteday") - 1) / 7))
    return V.drift_between(h, "week", 0, 3, ["cnt", "temp", "hum", "windspeed"])


@query("drift_monitor_combined")
def q_monitor(spark, sf_dir):
    """V7: drift (train vs test features) + MAE decay of a ridge model vs its
    validation baseline, one row with the four-way recommendation."""
    d = model_frame(spark, sf_dir)
    feats = feature_list(d)
    dm = MD.fit_pipeline(d.where(F.col("split") == "train"), feats, model="ridge")
    base = MD.evaluate_model(dm, d.where(F.col("split") == "val")).first().asDict()
    te = d.where(F.col("split") == "test")
    pred = dm.predict(te, keep=("series_id", "row_id")).join(
        te.select("series_id", "row_id", F.col("cnt").cast("double").alias("y")), ["series_id", "row_id"])
    cont = ["temp", "hum", "windspeed", "cnt_transformed_lag_24h"]
    return V.monitor(d.where(F.col("split") == "train"), te, pred, base, continuous=cont,
                     categorical=["weathersit"])


@query("models_ml_stages")
def q_stages(spark, sf_dir):
    """M5: the chain as a ``pyspark.ml`` pipeline (square root, robust scaler,
    ridge, inverse), fitted on train, written and read with Spark ML's own
    writer; metrics by split. Equal to the models of ``fit_pipeline``."""
    from pyspark.ml import PipelineModel
    import uuid
    from ..operators.evaluate import evaluate
    from ..operators.stages import demand_pipeline
    from ..session import checkpoint_dir
    d = model_frame(spark, sf_dir)
    path = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    demand_pipeline(feature_list(d), transform="sqrt").fit(d.where(F.col("split") == "train")).save(path)
    scored = PipelineModel.load(path).transform(d)
    return evaluate(scored.select("split", F.col("cnt").cast("double").alias("y"), "prediction"), "y", "prediction", by=("split",))
