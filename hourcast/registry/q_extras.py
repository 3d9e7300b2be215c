"""Operators found only in the reference's documents."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FT
from ..operators import models as MD
from ..operators import scale as P
from ..operators import selection as X
from ..operators import windows as W
from ..sources import adapters as A
from .common import hourly_clean, hourly_split
from .core import query
from .q_models import feature_list, model_frame
from .sqlgen import stack_union
from .sqlviews import cte
from .sqlwin import W as WS

SEL_COLS = ["temp", "atemp", "hum", "windspeed", "hr", "weekday", "casual", "registered"]


def _ewma_sql():
    a = 2.0 / 25.0
    K = 414
    fr = f"(PARTITION BY series_id ORDER BY \"timestamp\", row_id ROWS BETWEEN {K} PRECEDING AND CURRENT ROW)"
    return cte("hsplit") + f""",
l AS (SELECT series_id, row_id, "timestamp", list(cnt_transformed) OVER {fr} AS arr, idx FROM hsplit),
e AS (SELECT *, list_sum(list_transform(range(0, len(arr)), lambda j: (CASE WHEN idx <= {K} AND j = len(arr) - 1
        THEN pow({1 - a}, j) ELSE {a} * pow({1 - a}, j) END) * arr[len(arr) - j])) AS e FROM l)
SELECT series_id, row_id, round(lag(e, 1) OVER (PARTITION BY series_id ORDER BY "timestamp", row_id), 6) AS cnt_transformed_ewm_24h FROM e"""


@query("extras_ewma_shifted", _ewma_sql())
def q_ewma(spark, sf_dir):
    """EWMA (span 24, adjust=False) of the previous sqrt demand values."""
    d = FT.ewma_shifted(hourly_split(spark, sf_dir))
    return d.select("series_id", "row_id", "cnt_transformed_ewm_24h")


@query("extras_calendar_features", cte("hourly") + f"""
SELECT series_id, row_id, CAST(day(dteday) AS INTEGER) AS day_of_month, CAST(weekofyear(dteday) AS INTEGER) AS week_of_year,
  CAST(day(dteday) = 1 AS INTEGER) AS is_month_start, CAST(dteday = last_day(dteday) AS INTEGER) AS is_month_end,
  CAST(day(dteday) <= 15 AS INTEGER) AS is_first_half_month, hr * season AS hr_season, hr * weathersit AS hr_weathersit,
  weekday * weathersit AS weekday_weathersit, round(CAST(weekday IN (0, 6) AS INTEGER) * temp, 6) AS is_weekend_temp,
  round(temp * season, 6) AS temp_season, weathersit * season AS weathersit_season,
  round(temp - lag(temp, 24) OVER {WS}, 6) AS temp_change_24h FROM hourly""")
def q_cal(spark, sf_dir):
    """Extra calendar / weather interaction features."""
    d = FT.calendar_extras(A.hourly(spark, sf_dir))
    return d.select("series_id", "row_id", "day_of_month", "week_of_year", "is_month_start", "is_month_end",
                    "is_first_half_month", "hr_season", "hr_weathersit", "weekday_weathersit", "is_weekend_temp",
                    "temp_season", "weathersit_season", "temp_change_24h")


@query("extras_special_days", cte("hourly") + """
SELECT series_id, row_id, CAST(day(dteday) >= 28 AS INTEGER) AS is_end_of_month, CAST(day(dteday) = 1 AS INTEGER) AS is_start_of_month,
  CAST(mnth IN (1, 2, 3, 4, 5, 9, 10, 11) AS INTEGER) AS is_school_season, CAST(mnth IN (6, 7, 8) AS INTEGER) AS is_summer_vacation
FROM hourly""")
def q_special(spark, sf_dir):
    """End / start of month, school season, summer vacation flags."""
    return FT.special_days(A.hourly(spark, sf_dir)).select(
        "series_id", "row_id", "is_end_of_month", "is_start_of_month", "is_school_season", "is_summer_vacation")


@query("extras_conditional_lag", cte("hsplit") + f"""
SELECT series_id, row_id, round(CASE WHEN weekday IN (5, 6) THEN lag(cnt_transformed, 168) OVER {WS}
  ELSE lag(cnt_transformed, 24) OVER {WS} END, 6) AS cnt_lag_conditional FROM hsplit""")
def q_condlag(spark, sf_dir):
    """Weekend rows (notebook rule: weekday 5/6) take lag 168, others lag 24."""
    return FT.conditional_lag(hourly_split(spark, sf_dir)).select("series_id", "row_id", "cnt_lag_conditional")


@query("extras_variance_filter", cte("hourly") + "\n" + stack_union(
    [f"SELECT '{c}' AS feature, round(var_pop({c}), 6) AS variance, var_pop({c}) > 0.01 AS keep FROM hourly" for c in SEL_COLS]))
def q_var(spark, sf_dir):
    """Population variance per column, kept above 0.01."""
    return X.variance_filter(A.hourly(spark, sf_dir), SEL_COLS)


def _corrf_sql():
    parts = []
    for j, b in enumerate(SEL_COLS[1:], 1):
        earlier = ", ".join(f"abs(corr({a}, {b}))" for a in SEL_COLS[:j])
        parts.append(f"SELECT '{b}' AS feature, round(greatest({earlier}), 6) AS max_abs_corr_earlier, "
                     f"greatest({earlier}) > 0.95 AS \"drop\" FROM hourly")
    return cte("hourly") + "\n" + stack_union(parts)


@query("extras_correlation_filter", _corrf_sql())
def q_corrf(spark, sf_dir):
    """Drop a column whose |r| with an earlier column exceeds 0.95."""
    return X.correlation_filter(A.hourly(spark, sf_dir), SEL_COLS)


@query("extras_f_scores", cte("hourly") + "\n" + f"SELECT feature, round(f, 6) AS f_score, rank() OVER (ORDER BY f DESC NULLS LAST) <= 5 AS selected FROM ("
       + stack_union([f"SELECT '{c}' AS feature, pow(corr({c}, cnt), 2) / (1 - pow(corr({c}, cnt), 2)) * (count(*) - 2) AS f FROM hourly"
                      for c in SEL_COLS]) + ") t")
def q_f(spark, sf_dir):
    """Univariate F scores against cnt; top 5 selected."""
    return X.f_scores(A.hourly(spark, sf_dir), SEL_COLS, "cnt", k=5)


def _mi_sql():
    allc = SEL_COLS + ["cnt"]
    qs = ", ".join(f"quantile_cont({c}, [{', '.join(str(i / 10) for i in range(1, 10))}]) AS q_{c}" for c in allc)
    bins = ", ".join(f"len(list_filter(q_{c}, lambda b: b < CAST({c} AS DOUBLE))) AS {c}" for c in allc)
    long = stack_union([f"SELECT '{c}' AS feature, {c} AS x, cnt AS y FROM b" for c in SEL_COLS])
    return cte("hourly") + f""",
q AS (SELECT {qs} FROM hourly),
b AS (SELECT {bins} FROM hourly, q),
l AS ({long}),
j AS (SELECT feature, x, y, count(*) AS c FROM l GROUP BY 1, 2, 3),
n AS (SELECT count(*) AS n FROM hourly),
px AS (SELECT feature, x, sum(c) AS cx FROM j GROUP BY 1, 2), py AS (SELECT feature, y, sum(c) AS cy FROM j GROUP BY 1, 2)
SELECT j.feature, round(sum(c / n * ln((c / n) / ((cx / n) * (cy / n)))), 6) AS mutual_info
FROM j JOIN px USING (feature, x) JOIN py USING (feature, y), n GROUP BY j.feature"""


@query("extras_mutual_info", _mi_sql())
def q_mi(spark, sf_dir):
    """Mutual information with cnt on exact-decile bins."""
    return X.mutual_info_binned(A.hourly(spark, sf_dir), SEL_COLS, "cnt")


@query("extras_vif")
def q_vif(spark, sf_dir):
    """Variance inflation factors from the inverse correlation matrix, and
    which of the columns above 10 go (the 3 largest)."""
    return X.vif_filter(A.hourly(spark, sf_dir), SEL_COLS)


@query("extras_rfe_forest")
def q_rfe(spark, sf_dir):
    """Recursive elimination with a forest (50 trees, depth 10) over the
    engineered features down to 30, ten at a time, on the training rows."""
    d = model_frame(spark, sf_dir)
    return X.rfe(d.where(F.col("split") == "train"), feature_list(d), n_select=30, step=10)


@query("extras_scaler_compare")
def q_scalers(spark, sf_dir):
    """Ridge on the same features with standard / robust / min-max /
    quantile scaling, validation metrics per scaler."""
    hs = hourly_split(spark, sf_dir)
    tr, va = hs.where(F.col("split") == "train"), hs.where(F.col("split") == "val")
    cols = SEL_COLS[:6]
    out = None
    for kind in ("standard", "robust", "minmax", "quantile"):
        dm = MD.fit_pipeline(tr, cols, model="ridge", scaler=kind, exclude=())
        m = MD.evaluate_model(dm, va).withColumn("scaler", F.lit(kind))
        out = m if out is None else out.unionByName(m)
    return out


@query("extras_leak_test")
def q_leak(spark, sf_dir):
    """Shuffled-target forest on the engineered features must not predict
    validation (R^2 < 0.05)."""
    d = model_frame(spark, sf_dir)
    return X.leak_test(d.where(F.col("split") == "train"), d.where(F.col("split") == "val"), feature_list(d))


@query("extras_leak_denylist", cte("hourly") + """
SELECT * EXCLUDE (cnt, casual, registered) REPLACE (round(temp, 6) AS temp, round(atemp, 6) AS atemp,
  round(hum, 6) AS hum, round(windspeed, 6) AS windspeed) FROM hourly""")
def q_deny(spark, sf_dir):
    """X11: the rows of a table with target lags after the leakage denylist and
    the targets have been removed."""
    d = W.lags(A.hourly(spark, sf_dir), "cnt", (1, 24, 168))
    return X.drop_leaky(d)
