"""Drift and performance monitoring (V1-V7)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT
from ..plans.quantiles import exact_quantiles, unpivot
from .evaluate import evaluate
from .stats import chi2_drift, ks_2samp, psi

# FIXED VALUES: the reference's four recommendations (Spanish, as emitted)
ADVICE = ("Retrenar modelo inmediatamente",
          "Monitorear de cerca, considerar retrenamiento",
          "Drift detectado pero sin impacto en performance aún",
          "Sistema funcionando normalmente")


def classify_columns(df: DataFrame, max_card: int = 20) -> tuple[list, list]:
    """V3: strings -> categorical; integers with < ``max_card`` distinct values
    -> categorical; other numerics -> continuous. Distinct values are counted
    as (column, value) rows, see ``clean.distinct_report``."""
    from .clean import distinct_report
    cat = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    ints = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.IntegerType, T.LongType))]
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if ints:
        found = {r["feature"]: r["n_distinct"] for r in distinct_report(df, ints).collect()}  # one row per column
        cat += [c for c in ints if found.get(c, 0) < max_card]
    return [c for c in num if c not in cat], cat


def reference_moments(ref: DataFrame, cols) -> DataFrame:
    """Mean, std, min, max per continuous column."""
    long = unpivot(ref, [], list(cols))
    return long.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                       F.min("value").alias("min"), F.max("value").alias("max"))


def reference_stats(ref: DataFrame, cols) -> DataFrame:
    """V4: mean, std, min, quartiles and max per continuous column."""
    q = exact_quantiles(ref, list(cols), [0.25, 0.5, 0.75])
    at = lambda p: F.max(F.when(F.col("p") == p, F.col("q")))
    quartiles = q.groupBy("feature").agg(at(0.25).alias("q25"), at(0.5).alias("median"), at(0.75).alias("q75"))
    return reference_moments(ref, cols).join(quartiles, "feature")


def reference_frequencies(ref: DataFrame, cols) -> DataFrame:
    """V4 for categorical columns: count and share of every value, NULL too."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols]))
    counts = ref.select(pairs.alias("p")).groupBy("p.feature", "p.value").agg(F.count(F.lit(1)).alias("count"))
    total = counts.groupBy("feature").agg(F.sum("count").alias("_all"))
    return counts.join(total, "feature").select("feature", "value", "count", (F.col("count") / F.col("_all")).alias("share"))


REPORT = ("feature string, type string, has_drift boolean, ks_statistic double, ks_pvalue double, psi double, "
          "chi2_statistic double, chi2_pvalue double, ref_mean double, curr_mean double, ref_std double, curr_std double")
REPORT_COLS = [c.split()[0] for c in REPORT.split(", ")]


def detect_drift(ref: DataFrame, cur: DataFrame, continuous=(), categorical=(), *,
                 threshold: float = DEFAULT.drift_threshold, psi_threshold: float = DEFAULT.psi_threshold,
                 compat: bool = False) -> DataFrame:
    """V1 per feature: continuous -> KS + PSI (+ means / stds), drift when
    p < threshold or PSI >= psi_threshold; categorical -> chi-square, drift
    when p < threshold. Columns absent from ``cur`` are skipped."""
    cont = [c for c in continuous if c in cur.columns and c in ref.columns]
    cats = [c for c in categorical if c in cur.columns and c in ref.columns]
    parts = []
    if cont:
        ks = ks_2samp(ref, cur, cont)
        ps = psi(ref, cur, cont)
        mr = reference_moments(ref, cont).select("feature", F.col("mean").alias("ref_mean"), F.col("std").alias("ref_std"))
        mc = reference_moments(cur, cont).select("feature", F.col("mean").alias("curr_mean"), F.col("std").alias("curr_std"))
        parts.append(_continuous_rows(ks.join(ps, "feature").join(mr, "feature").join(mc, "feature"), threshold, psi_threshold))
    if cats:
        parts.append(_categorical_rows(chi2_drift(ref, cur, cats, compat=compat), threshold))
    return _report(parts, ref.sparkSession)


def _continuous_rows(tests: DataFrame, threshold: float, psi_threshold: float) -> DataFrame:
    c = (tests.withColumn("type", F.lit("continuous"))
         .withColumn("has_drift", (F.col("ks_pvalue") < threshold) | (F.col("psi") >= psi_threshold))
         .withColumns({"chi2_statistic": F.lit(None).cast("double"), "chi2_pvalue": F.lit(None).cast("double")}))
    return c.select(*REPORT_COLS)


def _categorical_rows(tests: DataFrame, threshold: float) -> DataFrame:
    nul = {k: F.lit(None).cast("double") for k in ("ks_statistic", "ks_pvalue", "psi", "ref_mean", "curr_mean",
                                                     "ref_std", "curr_std")}
    return (tests.withColumn("type", F.lit("categorical")).withColumn("has_drift", F.col("chi2_pvalue") < threshold)
            .withColumns(nul).select(*REPORT_COLS))


def _report(parts: list, spark) -> DataFrame:
    if not parts:  # no shared column: an empty report
        return spark.createDataFrame([], REPORT)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drift_summary(per_feature: DataFrame, total_features: int) -> DataFrame:
    """V1 summary row: has_drift, drift_score (mean PSI, else share of drifted
    tests), drifted_features, tests_performed, total_features."""
    s = per_feature.agg(F.coalesce(F.bool_or("has_drift"), F.lit(False)).alias("has_drift"),
                        F.avg("psi").alias("_mpsi"), F.count_if("has_drift").alias("drifted_features"),
                        F.count(F.lit(1)).alias("tests_performed"))
    score = F.coalesce(F.col("_mpsi"), F.when(F.col("tests_performed") > 0,
                                              F.col("drifted_features") / F.col("tests_performed")), F.lit(0.0))
    return s.select("has_drift", score.alias("drift_score"), "drifted_features", "tests_performed",
                    F.lit(total_features).cast("long").alias("total_features"))


def check_performance(pred: DataFrame, baseline: dict, *, y="y", yhat="prediction", threshold: float = 0.2,
                      metric: str = "mae") -> DataFrame:
    """V2: relative degradation of ``metric`` vs baseline (R^2 reversed,
    baseline 0 -> 0), flag above threshold, alert above 1.5 x threshold; no
    baseline -> no flag."""
    metric = metric.lower()
    if metric not in ("mae", "rmse", "r2"):
        raise ValueError(f"metric_type must be 'mae', 'rmse', or 'r2', got {metric}")
    m = evaluate(pred, y, yhat).select("mae", "rmse", "r2")
    b = baseline.get(metric)
    cur = F.col(metric)
    if b is None:
        deg = F.lit(0.0)
    elif b == 0:
        deg = F.lit(0.0)
    elif metric == "r2":
        deg = (F.lit(float(b)) - cur) / abs(float(b))
    else:
        deg = (cur - F.lit(float(b))) / float(b)
    out = m.withColumn("degradation_score", deg)
    none = b is None
    return out.withColumns({
        "has_degradation": F.lit(False) if none else F.col("degradation_score") > threshold,
        "alert": F.lit(False) if none else F.col("degradation_score") > threshold * 1.5,
        "baseline_value": F.lit(None if none else float(b)).cast("double")})


def inject_drift(df: DataFrame, kind: str = "mean_shift", magnitude: float = 1.0, cols=None, *,
                 stats: dict | None = None, seed: int = DEFAULT.seed) -> DataFrame:
    """V5: mean shift (+ m * ref std), variance shift (spread x sqrt(1 + m)
    around the frame mean), distribution shift (mean shift + N(0, 0.5 m std)
    noise). Zero / missing std falls back to |mean| * 0.1 or 1. Sampling rows
    beforehand is ``scale.sample_*``."""
    cols = list(cols) if cols else [f.name for f in df.schema.fields
                                    if isinstance(f.dataType, (T.DoubleType, T.FloatType))][:3]
    if stats is None:
        row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]).first()
        stats = {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}
    out = {}
    for i, c in enumerate(cols):
        m, s = stats[c]
        if s is None or s == 0 or s != s or s in (float("inf"), float("-inf")):
            s = abs(m) * 0.1 if m else 1.0
        x = F.col(c).cast("double")
        if kind == "mean_shift":
            out[c] = x + magnitude * s
        elif kind == "variance_shift":
            out[c] = F.lit(m) + (x - F.lit(m)) * ((1.0 + magnitude) ** 0.5)
        elif kind == "distribution_shift":
            out[c] = x + magnitude * s + F.randn(seed + i) * (magnitude * s * 0.5)
        else:
            raise ValueError(kind)
    return df.withColumns(out)


def drift_between(df: DataFrame, key: str, a, b, cols, **kw) -> DataFrame:
    """V6: drift of ``cols`` between two slices (e.g. yr 0 vs 1) with the
    mean change in percent."""
    ra, rb = df.where(F.col(key) == a), df.where(F.col(key) == b)
    d = detect_drift(ra, rb, continuous=cols, **kw)
    return d.withColumn("mean_change_pct", (F.col("curr_mean") - F.col("ref_mean")) / F.col("ref_mean") * 100)


def monitor(ref: DataFrame, cur: DataFrame, pred: DataFrame, baseline: dict, *, continuous=(), categorical=(),
            y="y", yhat="prediction", threshold: float = 0.2, metric: str = "mae") -> DataFrame:
    """V7: drift summary + performance check in one row with the four-way
    recommendation."""
    per = detect_drift(ref, cur, continuous, categorical)
    s = drift_summary(per, len(continuous) + len(categorical))
    p = check_performance(pred, baseline, y=y, yhat=yhat, threshold=threshold, metric=metric)
    # both sides are single-row aggregates: equi-join on a constant key
    j = s.withColumn("_k", F.lit(1)).join(p.withColumn("_k", F.lit(1)), "_k").drop("_k")
    adv = (F.when(F.col("alert"), ADVICE[0]).when(F.col("has_drift") & F.col("has_degradation"), ADVICE[1])
           .when(F.col("has_drift"), ADVICE[2]).otherwise(ADVICE[3]))
    return j.select(F.col("has_drift").alias("drift_detected"), "drift_score",
                    F.col("has_degradation").alias("performance_degradation"), "degradation_score", "alert",
                    F.col("baseline_value").alias("baseline_mae") if metric == "mae" else F.col("baseline_value"),
                    F.col(metric).alias(f"current_{metric}"), adv.alias("recommendation"))
