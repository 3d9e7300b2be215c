"""Flagship and feature-chain queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT
from ..operators import clean as C
from ..operators import features as FT
from ..operators import profile as J
from ..operators import split as S
from ..operators import windows as W
from ..sources import adapters as A
from .core import query
from .sqlviews import cte

FLAGSHIP_SQL = cte("hourly") + """,
fixed AS (
  SELECT *,
    CASE WHEN casual + registered <= cnt THEN casual + registered ELSE cnt END AS n2,
    CASE WHEN casual + registered <= cnt THEN casual WHEN cnt >= registered THEN cnt - registered ELSE casual END AS c2,
    CASE WHEN casual + registered <= cnt THEN registered WHEN cnt >= registered THEN registered
         WHEN cnt >= casual THEN cnt - casual ELSE registered END AS r2
  FROM hourly),
fixed2 AS (
  SELECT series_id, row_id, "timestamp", hr, weekday, c2 AS casual, r2 AS registered,
    CASE WHEN casual + registered > cnt AND cnt < registered AND cnt < casual THEN casual + registered ELSE n2 END AS cnt
  FROM fixed),
feat AS (
  SELECT *, sqrt(CAST(cnt AS DOUBLE)) AS y FROM fixed2),
win AS (
  SELECT *,
    lag(y, 1) OVER w AS cnt_transformed_lag_1h,
    lag(y, 24) OVER w AS cnt_transformed_lag_24h,
    lag(y, 168) OVER w AS cnt_transformed_lag_168h,
    avg(y) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS cnt_transformed_roll_mean_3h,
    coalesce(stddev_samp(y) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) AS cnt_transformed_roll_std_3h,
    avg(y) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS cnt_transformed_roll_mean_24h,
    coalesce(stddev_samp(y) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) AS cnt_transformed_roll_std_24h,
    row_number() OVER w - 1 AS idx, count(*) OVER (PARTITION BY series_id) AS n
  FROM feat WINDOW w AS (PARTITION BY series_id ORDER BY "timestamp", row_id)),
sp AS (
  SELECT *, CASE WHEN idx < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
                 WHEN idx < floor(n * CAST(0.7 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'val'
                 ELSE 'test' END AS split FROM win),
prof AS (
  SELECT hr, weekday, avg(y) AS p FROM sp WHERE split = 'train' GROUP BY 1, 2)
SELECT sp.series_id, sp."timestamp", sp.hr, sp.weekday, sp.casual, sp.registered, sp.cnt,
  round(y, 6) AS cnt_transformed,
  round(cnt_transformed_lag_1h, 6) AS cnt_transformed_lag_1h,
  round(cnt_transformed_lag_24h, 6) AS cnt_transformed_lag_24h,
  round(cnt_transformed_lag_168h, 6) AS cnt_transformed_lag_168h,
  round(cnt_transformed_roll_mean_3h, 6) AS cnt_transformed_roll_mean_3h,
  round(cnt_transformed_roll_std_3h, 6) AS cnt_transformed_roll_std_3h,
  round(cnt_transformed_roll_mean_24h, 6) AS cnt_transformed_roll_mean_24h,
  round(cnt_transformed_roll_std_24h, 6) AS cnt_transformed_roll_std_24h,
  split,
  round(coalesce(p, 0.0), 6) AS cnt_historical_avg_raw,
  round(cnt_transformed_lag_1h - coalesce(p, 0.0), 6) AS cnt_vs_historical
FROM sp LEFT JOIN prof ON sp.hr = prof.hr AND sp.weekday = prof.weekday
"""


def flagship_frame(spark, sf_dir, strategy="halo"):
    h = A.hourly(spark, sf_dir)
    h = C.enforce_sum(h)
    h = FT.transform_target(h)
    h = h.select("series_id", "row_id", "timestamp", "hr", "weekday", "casual", "registered", "cnt",
                 "cnt_transformed")
    # one row index for split and windows; split before the windows so the
    # train-only profile branch does not repeat the halo shuffle
    h = S.split(W.order_rows(h), keep_index=True)

    def build(w):
        out = {f"cnt_transformed_lag_{k}h": W.lag_expr("cnt_transformed", k, w) for k in (1, 24, 168)}
        for n in (3, 24):
            out[f"cnt_transformed_roll_mean_{n}h"] = W.roll_mean_expr("cnt_transformed", n, w, 1, False)
            out[f"cnt_transformed_roll_std_{n}h"] = W.roll_std_expr("cnt_transformed", n, w, 1, False)
        return out
    prof_src = h.where(F.col("split") == "train")
    h = W.series_select(h, build, 168, strategy=strategy, keep_index=True)
    h = J.historical_profile(prof_src, h)
    h = J.vs_profile(h)
    return h.drop("row_id", "row_idx")


@query("flagship_hourly_features", FLAGSHIP_SQL)
def flagship(spark, sf_dir):
    """events -> hourly -> part-sum repair (C13) -> sqrt target (T2) -> leak-safe
    lags / rolling mean+std (W1-W3, halo windows) -> 70/15/15 split (P1s) ->
    train-only (hr, weekday) profile joined back (J1) -> deviation (J2)."""
    return flagship_frame(spark, sf_dir)
