"""Split, scaling and matrix-preparation queries (P1s-P9s)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FT
from ..operators import scale as P
from ..operators import split as S
from ..operators import windows as W
from ..sources import adapters as A
from .common import hourly_clean, hourly_split
from .core import query
from .sqlviews import cte

SCALE_COLS = ["temp", "atemp", "hum", "windspeed", "hr", "weekday", "holiday", "workingday", "hr_workingday",
              "cnt_transformed"]


@query("split_temporal_keyed", cte("hourly_by_type") + """
SELECT series_id, row_id, CASE WHEN idx < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
  WHEN idx < floor(n * CAST(0.7 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY "timestamp", row_id) - 1 AS idx,
        count(*) OVER (PARTITION BY series_id) AS n FROM hourly_by_type) t""")
def q_split(spark, sf_dir):
    """P1s: per-series 70/15/15 temporal split of five keyed series."""
    return S.split(A.hourly_by_type(spark, sf_dir)).select("series_id", "row_id", "split")


@query("split_at_dates", cte("hourly") + """
SELECT series_id, row_id, CASE WHEN "timestamp" <= TIMESTAMP '2024-01-21 23:00:00' THEN 'train'
  WHEN "timestamp" <= TIMESTAMP '2024-01-25 23:00:00' THEN 'val' ELSE 'test' END AS split FROM hourly""")
def q_split_at(spark, sf_dir):
    """P2s: split by cut timestamps (inclusive upper bounds)."""
    return S.split_at(A.hourly(spark, sf_dir), "2024-01-21 23:00:00", "2024-01-25 23:00:00").select(
        "series_id", "row_id", "split")


def _scaled_sql(kind: str) -> str:
    sc = [c for c in SCALE_COLS if c not in ("holiday", "workingday", "hr_workingday")]
    if kind == "robust":
        stats = ", ".join(f"quantile_cont({c}, 0.5) AS c_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}"
                          for c in sc)
    elif kind == "standard":
        stats = ", ".join(f"avg({c}) AS c_{c}, stddev_pop({c}) AS s_{c}" for c in sc)
    else:
        stats = ", ".join(f"min({c}) AS c_{c}, max({c}) - min({c}) AS s_{c}" for c in sc)
    outs = ", ".join(f"round((CAST({c} AS DOUBLE) - c_{c}) / CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}"
                     for c in sc)
    return (cte("hsplit") + ",\nx AS (SELECT *, hr * workingday AS hr_workingday FROM hsplit),\n"
            f"st AS (SELECT {stats} FROM x WHERE split = 'train')\n"
            f"SELECT series_id, row_id, {outs}, holiday, workingday, hr_workingday FROM x, st")


def _scaled(spark, sf_dir, kind):
    hs = FT.hr_workingday(hourly_split(spark, sf_dir))
    model = P.Scaler(kind).fit(hs.where(F.col("split") == "train"), SCALE_COLS)
    return model.transform(hs, passthrough=("series_id", "row_id"))


@query("scale_robust", _scaled_sql("robust"))
def q_robust(spark, sf_dir):
    """P4s robust scaler (median / IQR, exact quantiles) fit on train, applied
    to all splits; P5s substring exclusions keep holiday, workingday and
    hr_workingday unscaled (F10), scaled columns first."""
    return _scaled(spark, sf_dir, "robust")


@query("scale_standard", _scaled_sql("standard"))
def q_standard(spark, sf_dir):
    """P4s standard scaler (population std) fit on train."""
    return _scaled(spark, sf_dir, "standard")


@query("scale_minmax", _scaled_sql("minmax"))
def q_minmax(spark, sf_dir):
    """P4s min-max scaler fit on train (zero range -> 1)."""
    return _scaled(spark, sf_dir, "minmax")


def _inf_sql() -> str:
    base = cte("hourly") + """,
z AS (SELECT series_id, row_id, "timestamp", CAST(cnt % 5 AS DOUBLE) AS x FROM hourly),
p AS (SELECT series_id, row_id, x, lag(x, 1) OVER w AS p1, lag(x, 24) OVER w AS p24
      FROM z WINDOW w AS (PARTITION BY series_id ORDER BY "timestamp", row_id)),
q AS (SELECT series_id, row_id, x,
  CASE WHEN x IS NULL OR p1 IS NULL THEN 0.0 WHEN p1 = 0 THEN CASE WHEN x = 0 THEN 0.0 ELSE NULL END ELSE x / p1 - 1 END AS pc1,
  CASE WHEN x IS NULL OR p24 IS NULL THEN 0.0 WHEN p24 = 0 THEN CASE WHEN x = 0 THEN 0.0 ELSE NULL END ELSE x / p24 - 1 END AS pc24
  FROM p),
m AS (SELECT quantile_cont(pc1, 0.5) AS m1, quantile_cont(pc24, 0.5) AS m24, quantile_cont(x, 0.5) AS mx,
        quantile_cont(row_id, 0.5) AS mr FROM q)
SELECT series_id, row_id, round(x, 6) AS x, round(coalesce(pc1, m1), 6) AS cnt_pct_change_1h,
  round(coalesce(pc24, m24), 6) AS cnt_pct_change_24h FROM q, m"""
    return base


@query("impute_infinite_median", _inf_sql())
def q_inf(spark, sf_dir):
    """P7s / F6: percent change of a count with zeros produces +-inf; since an
    inf exists, infs become NULL and every NULL gets its column median."""
    h = A.hourly(spark, sf_dir).select("series_id", "row_id", "timestamp",
                                       (F.col("cnt") % 5).cast("double").alias("x"))
    h = W.pct_change(h, "x", (1, 24)).drop("timestamp")
    return FT.clean_infinite(h, mode="compat")


@query("fill_zero_serving", cte("hsplit") + """
SELECT series_id, row_id, round(coalesce(lag(cnt_transformed, 24) OVER w, 0), 6) AS lag24,
  round(coalesce(lag(cnt_transformed, 168) OVER w, 0), 6) AS lag168
FROM hsplit WINDOW w AS (PARTITION BY series_id ORDER BY "timestamp", row_id)""")
def q_fill0(spark, sf_dir):
    """P8s: NULL serving features (lag warm-up) become 0."""
    h = W.lags(hourly_split(spark, sf_dir), ks=(24, 168), name="lag{k}")
    return P.fill_zero(h.select("series_id", "row_id", "lag24", "lag168"), ["lag24", "lag168"])


@query("align_columns", cte("hsplit") + """
SELECT hr, weekday, round(temp, 6) AS temp, round(hum, 6) AS hum, workingday FROM hsplit""")
def q_align(spark, sf_dir):
    """P6s: required columns checked, extras dropped, fixed order."""
    return P.align_columns(hourly_split(spark, sf_dir), ["hr", "weekday", "temp", "hum", "workingday"])


@query("sample_seeded_rows")
def q_sample(spark, sf_dir):
    """P9s: deterministic seeded sample of 50 rows (hash order; the limit is the feature)."""
    return P.sample_rows(hourly_clean(spark, sf_dir), 50).select("series_id", "row_id", "cnt")
