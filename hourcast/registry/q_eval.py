"""Evaluation and monitoring queries with oracles.

Predictions come from a naive seasonal forecast (the value 24 hours earlier),
so every metric is checkable in SQL; model fits are in ``q_models``.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as V
from ..operators import evaluate as M
from ..operators import features as FT
from ..operators import windows as W
from ..sources import adapters as A
from .common import hourly_split
from .core import query
from .sqlgen import stack_union
from .sqlviews import cte


def naive_pred(spark, sf_dir):
    hs = hourly_split(spark, sf_dir)
    return W.lags(hs, "cnt", (24,), name="prediction").where(F.col("prediction").isNotNull())


def _metrics_sql(src, by, rnd=True):
    r = "(CAST(cnt AS DOUBLE) - prediction)"
    if not rnd:
        return (f"SELECT {by}, avg(abs({r})) AS mae, sqrt(avg({r} * {r})) AS rmse, "
                f"CASE WHEN var_pop(cnt) * count(cnt) > 0 THEN 1 - sum({r} * {r}) / (var_pop(cnt) * count(cnt)) "
                f"WHEN sum({r} * {r}) = 0 THEN 1.0 ELSE 0.0 END AS r2, "
                f"avg(abs({r}) / greatest(abs(cnt), 2.220446049250313e-16)) * 100 AS mape FROM {src} GROUP BY {by}")
    g = f"{by}, " if by else ""
    return (f"SELECT {g}count(*) AS n, round(avg(abs({r})), 6) AS mae, round(sqrt(avg({r} * {r})), 6) AS rmse, "
            f"round(CASE WHEN var_pop(cnt) * count(cnt) > 0 THEN 1 - sum({r} * {r}) / (var_pop(cnt) * count(cnt)) "
            f"WHEN sum({r} * {r}) = 0 THEN 1.0 ELSE 0.0 END, 6) AS r2, "
            f"round(avg(abs({r}) / greatest(abs(cnt), 2.220446049250313e-16)) * 100, 6) AS mape, "
            f"round(avg({r}), 6) AS residuals_mean, round(stddev_samp({r}), 6) AS residuals_std FROM {src}"
            + (f" GROUP BY {by}" if by else ""))


@query("eval_metrics_by_split", cte("npred") + "\n" + _metrics_sql("npred", "split"))
def q_metrics(spark, sf_dir):
    """M8: MAE, RMSE, R^2, MAPE, residual mean / std per split (seasonal-naive forecast)."""
    return M.evaluate(naive_pred(spark, sf_dir), "cnt", "prediction", by=["split"])


def _targets_sql():
    t = {"mae": 100.0, "rmse": 140.0, "r2": 0.65, "mape": 35.0}
    parts = [f"SELECT split, '{m}' AS metric, round({m}, 6) AS value, CAST({v} AS DOUBLE) AS target, "
             f"{m} {'>=' if m == 'r2' else '<='} {v} AS meets FROM mt" for m, v in t.items()]
    return cte("npred") + ",\nmt AS (" + _metrics_sql("npred", "split", rnd=False) + ")\n" + stack_union(parts)


@query("eval_meets_targets", _targets_sql())
def q_targets(spark, sf_dir):
    """M9: each metric vs the configured target (r2 >=, others <=)."""
    m = M.evaluate(naive_pred(spark, sf_dir), "cnt", "prediction", by=["split"])
    return M.meets_targets(m, keys=["split"])


@query("eval_segment_errors", cte("npred") + """
SELECT hr, weathersit, weekday, round(sqrt(avg(pow(cnt - prediction, 2))), 6) AS rmse,
  round(avg(abs(cnt - prediction)), 6) AS mae, count(*) AS n, CAST(GROUPING(hr, weathersit, weekday) AS INTEGER) AS gid
FROM npred GROUP BY GROUPING SETS ((hr), (weekday), (weathersit))""")
def q_segments(spark, sf_dir):
    """RMSE / MAE by hour, weekday and weather in one GROUPING SETS scan."""
    return M.segment_errors(naive_pred(spark, sf_dir), y="cnt")


@query("eval_worst_hour", cte("npred") + """,
s AS (SELECT hr, sqrt(avg(pow(cnt - prediction, 2))) AS rmse FROM npred GROUP BY hr)
SELECT arg_max(hr, rmse) AS worst_hr, round(max(rmse), 6) AS worst_rmse FROM s""")
def q_worst(spark, sf_dir):
    """Hour with the highest RMSE."""
    return M.worst_segment(naive_pred(spark, sf_dir), "hr", y="cnt")


@query("eval_abs_residual_peak", cte("npred") + """
SELECT CASE WHEN hr IN (8, 17, 18) THEN 'peak' ELSE 'off_peak' END AS segment,
  round(quantile_cont(abs(cnt - prediction), 0.25), 6) AS q25, round(quantile_cont(abs(cnt - prediction), 0.5), 6) AS median,
  round(quantile_cont(abs(cnt - prediction), 0.75), 6) AS q75 FROM npred GROUP BY 1""")
def q_absres(spark, sf_dir):
    """|residual| quartiles, peak hours (8, 17, 18) vs the rest."""
    return M.abs_residual_quartiles(naive_pred(spark, sf_dir), F.col("hr").isin(8, 17, 18), y="cnt")


@query("eval_postprocess", cte("npred") + """
SELECT series_id, row_id, round(greatest(CAST(prediction AS DOUBLE) - 10, 0.0), 6) AS pred_none,
  round(greatest(exp(ln(1 + prediction) - 1) - 1, 0.0), 6) AS pred_log1p,
  round(greatest(pow(sqrt(prediction) - 2, 2), 0.0), 6) AS pred_sqrt FROM npred""")
def q_post(spark, sf_dir):
    """M7: predictions made in a transformed space, inverted and clipped at 0."""
    p = naive_pred(spark, sf_dir)
    x = F.col("prediction").cast("double")
    return p.select("series_id", "row_id",
                    F.greatest(FT.inverse_expr(x - 10, "none"), F.lit(0.0)).alias("pred_none"),
                    F.greatest(FT.inverse_expr(F.log1p(x) - 1, "log1p"), F.lit(0.0)).alias("pred_log1p"),
                    F.greatest(FT.inverse_expr(F.sqrt(x) - 2, "sqrt"), F.lit(0.0)).alias("pred_sqrt"))


@query("eval_decision_value", cte("npred") + """
SELECT split, CAST(sum(CASE WHEN prediction > 20 AND cnt > 20 THEN 4500.0 WHEN NOT prediction > 20 AND NOT cnt > 20 THEN 800.0
  WHEN prediction > 20 AND NOT cnt > 20 THEN -1200.0 ELSE -600.0 END) AS DOUBLE) AS decision_value,
  round(avg(abs(cnt - prediction)), 6) AS mae, count(*) AS n,
  CASE WHEN avg(abs(cnt - prediction)) > 600 THEN 'critical' WHEN avg(abs(cnt - prediction)) > 500 THEN 'warning' ELSE 'ok' END AS alert_band
FROM npred GROUP BY split""")
def q_decision(spark, sf_dir):
    """Decision value from the cost matrix (high demand = more than 20
    per hour at this scale) and the MAE alert band, per split."""
    return M.decision_value(naive_pred(spark, sf_dir), "cnt", high=20.0, by=["split"])


@query("eval_metrics_by_band", cte("npred") + ",\nb AS (SELECT *, CASE WHEN cnt < 10 THEN 'low' WHEN cnt <= 20 THEN 'medium' "
       "ELSE 'high' END AS demand_band FROM npred)\n" + _metrics_sql("b", "demand_band"))
def q_band(spark, sf_dir):
    """All metrics per demand band (thresholds 10 / 20 at this scale)."""
    p = FT.demand_band(naive_pred(spark, sf_dir), lo=10, hi=20)
    return M.evaluate(p, "cnt", "prediction", by=["demand_band"])


@query("eval_rmse_month_quarter", cte("npred") + """
SELECT mnth, CAST(quarter(dteday) AS INTEGER) AS quarter, round(sqrt(avg(pow(cnt - prediction, 2))), 6) AS rmse,
  round(avg(abs(cnt - prediction)), 6) AS mae, count(*) AS n, CAST(GROUPING(mnth, quarter(dteday)) AS INTEGER) AS gid
FROM npred GROUP BY GROUPING SETS ((mnth), (quarter(dteday)))""")
def q_mq(spark, sf_dir):
    """RMSE by month and by quarter."""
    p = naive_pred(spark, sf_dir).withColumn("quarter", F.quarter("dteday"))
    return M.segment_errors(p, sets=(("mnth",), ("quarter",)), y="cnt")


@query("drift_performance_check", cte("npred") + """,
b AS (SELECT avg(abs(cnt - prediction)) AS bm FROM npred WHERE split = 'val'),
c AS (SELECT avg(abs(cnt - prediction)) AS mae, sqrt(avg(pow(cnt - prediction, 2))) AS rmse,
        CASE WHEN var_pop(cnt) > 0 THEN 1 - sum(pow(cnt - prediction, 2)) / (var_pop(cnt) * count(cnt)) ELSE 0 END AS r2
      FROM npred WHERE split = 'test')
SELECT round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2, round((mae - bm) / bm, 6) AS degradation_score,
  (mae - bm) / bm > 0.2 AS has_degradation, (mae - bm) / bm > 0.2 * 1.5 AS alert, round(bm, 6) AS baseline_value FROM b, c""")
def q_perf(spark, sf_dir):
    """V2: test-period MAE vs the validation baseline; degradation, flag and alert."""
    p = naive_pred(spark, sf_dir)
    base = M.evaluate(p.where(F.col("split") == "val"), "cnt", "prediction").first().asDict()
    return V.check_performance(p.where(F.col("split") == "test"), base, y="cnt")


def _classify_sql():
    ints = ["yr", "mnth", "hr", "weekday", "season", "holiday", "workingday", "weathersit", "row_id", "casual",
            "registered", "cnt"]
    parts = [f"SELECT '{c}' AS feature, CASE WHEN count(DISTINCT {c}) < 20 THEN 'categorical' ELSE 'continuous' END AS kind FROM hourly"
             for c in ints]
    parts += [f"SELECT '{c}' AS feature, 'continuous' AS kind" for c in ("temp", "atemp", "hum", "windspeed")]
    parts.append("SELECT 'series_id' AS feature, 'categorical' AS kind")
    return cte("hourly") + "\n" + stack_union(parts)


@query("drift_classify_columns", _classify_sql())
def q_classify(spark, sf_dir):
    """V3: strings and low-cardinality integers (< 20 values) are categorical."""
    cont, cat = V.classify_columns(A.hourly(spark, sf_dir))
    rows = [(c, "continuous") for c in cont] + [(c, "categorical") for c in cat]
    return spark.createDataFrame(rows, "feature string, kind string")


@query("drift_inject_shift", cte("drift_ref") + """,
s AS (SELECT avg(value) AS mv, stddev_samp(value) AS sv, avg(k) AS mk, stddev_samp(k) AS sk FROM drift_ref)
SELECT event_type, round(value + 1.0 * sv, 6) AS value_mean_shift, round(k + 1.0 * sk, 6) AS k_mean_shift,
  round(mv + (value - mv) * sqrt(1.0 + 1.0), 6) AS value_variance_shift, round(mk + (k - mk) * sqrt(1.0 + 1.0), 6) AS k_variance_shift
FROM drift_ref, s""")
def q_inject(spark, sf_dir):
    """V5: synthetic mean shift (+1 std) and variance shift (x sqrt 2) of the
    reference period (the noisy distribution shift is in the unit tests)."""
    ref, _ = A.drift_pair(spark, sf_dir)
    row = ref.agg(F.avg("value"), F.stddev_samp("value"), F.avg("k"), F.stddev_samp("k")).first()
    st = {"value": (row[0], row[1]), "k": (row[2], row[3])}
    d = ref.select("event_type", F.col("value").alias("value_mean_shift"), F.col("k").alias("k_mean_shift"),
                   F.col("value").alias("value_variance_shift"), F.col("k").alias("k_variance_shift"))
    d = V.inject_drift(d, "mean_shift", 1.0, ["value_mean_shift", "k_mean_shift"],
                       stats={"value_mean_shift": st["value"], "k_mean_shift": st["k"]})
    return V.inject_drift(d, "variance_shift", 1.0, ["value_variance_shift", "k_variance_shift"],
                          stats={"value_variance_shift": st["value"], "k_variance_shift": st["k"]})


@query("drift_reference_stats", cte("drift_ref") + "\n" + stack_union(
    [f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
     f"round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(quantile_cont({c}, 0.25), 6) AS q25, "
     f"round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q75 FROM drift_ref" for c in ("value", "k")]))
def q_refstats(spark, sf_dir):
    """V4: reference statistics (mean, std, min, quartiles, max) of the drift reference period."""
    ref, _ = A.drift_pair(spark, sf_dir)
    return V.reference_stats(ref, ["value", "k"])


@query("drift_reference_frequencies", cte("drift_ref") + """
SELECT 'event_type' AS feature, event_type AS value, count(*) AS count, round(count(*) / (SELECT count(*) FROM drift_ref), 6) AS share
FROM drift_ref GROUP BY event_type""")
def q_reffreq(spark, sf_dir):
    """V4: value frequencies of the categorical columns of the reference period."""
    ref, _ = A.drift_pair(spark, sf_dir)
    return V.reference_frequencies(ref, ["event_type"])
