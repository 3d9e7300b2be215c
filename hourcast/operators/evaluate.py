"""Evaluation (M8-M10, X12, X15, X16): metrics as one aggregation."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..plans.quantiles import exact_quantiles

EPS = 2.220446049250313e-16  # machine epsilon (MAPE denominator floor)


def metric_aggs(y: str = "y", yhat: str = "prediction", ddof: int = 1) -> list[Column]:
    yc, pc = F.col(y).cast("double"), F.col(yhat).cast("double")
    r = yc - pc
    ss_res = F.sum(r * r)
    ss_tot = F.var_pop(yc) * F.count(yc)
    r2 = (F.when(ss_tot > 0, F.lit(1.0) - ss_res / ss_tot)
          .otherwise(F.when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0))))
    std = F.stddev_samp(r) if ddof == 1 else F.stddev_pop(r)
    return [F.count(F.lit(1)).alias("n"), F.avg(F.abs(r)).alias("mae"), F.sqrt(F.avg(r * r)).alias("rmse"),
            r2.alias("r2"), (F.avg(F.abs(r) / F.greatest(F.abs(yc), F.lit(EPS))) * 100).alias("mape"),
            F.avg(r).alias("residuals_mean"), std.alias("residuals_std")]


def evaluate(df: DataFrame, y: str = "y", yhat: str = "prediction", *, by=(), ddof: int = 1) -> DataFrame:
    """M8: MAE, RMSE, R^2 (1 if perfect / 0 if constant target), MAPE x 100
    (|y| floored at machine epsilon), residual mean / std (ddof 1 or 0, F11)."""
    aggs = metric_aggs(y, yhat, ddof)
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def meets_targets(metrics: DataFrame, targets: dict = DEFAULT.target_metrics, *, keys=()) -> DataFrame:
    """M9: one row per (keys, metric): value, target, meets (r2 >=, others <=)."""
    names = [m for m in targets if m in metrics.columns]
    stack = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE), CAST({float(targets[m])} AS DOUBLE)" for m in names)
    long = metrics.selectExpr(*[f"`{k}`" for k in keys], f"stack({len(names)}, {stack}) AS (metric, value, target)")
    return long.withColumn("meets", F.when(F.col("metric") == "r2", F.col("value") >= F.col("target"))
                           .otherwise(F.col("value") <= F.col("target")))


def segment_errors(df: DataFrame, sets=(("hr",), ("weekday",), ("weathersit",)), y="y", yhat="prediction") -> DataFrame:
    """RMSE, MAE and count per segment for several key sets in one
    GROUPING SETS scan; ``gid`` identifies the set."""
    keys = sorted({k for s in sets for k in s})
    r = F.col(y).cast("double") - F.col(yhat).cast("double")
    return df.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys]).agg(
        F.sqrt(F.avg(r * r)).alias("rmse"), F.avg(F.abs(r)).alias("mae"), F.count(F.lit(1)).alias("n"),
        F.grouping_id().cast("int").alias("gid"))


def worst_segment(df: DataFrame, key: str, y="y", yhat="prediction") -> DataFrame:
    """The segment value with the highest RMSE (max_by) and that RMSE."""
    r = F.col(y).cast("double") - F.col(yhat).cast("double")
    seg = df.groupBy(key).agg(F.sqrt(F.avg(r * r)).alias("rmse"))
    return seg.agg(F.max_by(key, "rmse").alias(f"worst_{key}"), F.max("rmse").alias("worst_rmse"))


def abs_residual_quartiles(df: DataFrame, flag: Column, y="y", yhat="prediction", name="segment") -> DataFrame:
    """Quartiles of |residual| for the two groups of ``flag`` (e.g. peak
    hours 8/17/18 vs the rest), exact distributed quantiles."""
    d = df.select(F.when(flag, "peak").otherwise("off_peak").alias(name),
                  F.abs(F.col(y).cast("double") - F.col(yhat).cast("double")).alias("abs_residual"))
    q = exact_quantiles(d, ["abs_residual"], [0.25, 0.5, 0.75], by=[name])
    return q.groupBy(name).agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n)
                                 for p, n in ((0.25, "q25"), (0.5, "median"), (0.75, "q75"))])


# FIXED VALUES: decision-cost matrix and alert bands of the reference's canvas
GAIN_HIGH_CORRECT = 4500.0    # high demand predicted and observed
GAIN_LOW_CORRECT = 800.0      # low demand predicted and observed
COST_HIGH_WRONG = -1200.0     # high predicted, low observed
COST_LOW_WRONG = -600.0       # low predicted, high observed
ALERT_MAE = (500.0, 600.0)    # warning / critical MAE bands


def decision_value(df: DataFrame, y="y", yhat="prediction", high: float = 7000.0, by=()) -> DataFrame:
    """Value of the high / low demand decisions (demand > ``high``)
    summed over scored rows with the cost matrix, plus the MAE alert band."""
    ah, ph = F.col(y).cast("double") > high, F.col(yhat).cast("double") > high
    v = (F.when(ph & ah, GAIN_HIGH_CORRECT).when(~ph & ~ah, GAIN_LOW_CORRECT)
         .when(ph & ~ah, COST_HIGH_WRONG).otherwise(COST_LOW_WRONG))
    r = F.col(y).cast("double") - F.col(yhat).cast("double")
    ag = [F.sum(v).alias("decision_value"), F.avg(F.abs(r)).alias("mae"), F.count(F.lit(1)).alias("n")]
    g = df.groupBy(*by).agg(*ag) if by else df.agg(*ag)
    return g.withColumn("alert_band", F.when(F.col("mae") > ALERT_MAE[1], "critical")
                        .when(F.col("mae") > ALERT_MAE[0], "warning").otherwise("ok"))
