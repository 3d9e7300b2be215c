"""Profile / join / history queries (T9-T15 on splits, J1-J9)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FT
from ..operators import profile as J
from ..operators import windows as W
from ..sources import adapters as A
from .common import hourly_clean, hourly_split
from .core import query
from .sqlviews import cte
from .sqlwin import W as WS


def _qd_sql():
    return cte("hsplit") + """,
med AS (SELECT quantile_cont(temp, 0.5) AS mt, quantile_cont(hum, 0.5) AS mh FROM hsplit WHERE split = 'train')
SELECT series_id, row_id,
  CASE WHEN temp >= mt AND hum >= mh THEN 'hot_humid' WHEN temp >= mt AND NOT hum >= mh THEN 'hot_dry'
       WHEN NOT temp >= mt AND hum >= mh THEN 'cold_humid' ELSE 'cold_dry' END AS weather_quadrant,
  CASE WHEN temp > mt AND hum > mh THEN 'hot_humid' WHEN temp > mt AND NOT hum > mh THEN 'hot_dry'
       WHEN NOT temp > mt AND hum > mh THEN 'cold_humid' ELSE 'cold_dry' END AS weather_quadrant_gt,
  CASE WHEN weekday IN (0, 6) THEN 'Fin de Semana' WHEN holiday = 1 THEN 'Festivo' ELSE 'Laboral' END AS day_type,
  CASE WHEN cnt < 10 THEN 'low' WHEN cnt <= 20 THEN 'medium' ELSE 'high' END AS demand_band
FROM hsplit, med"""


@query("features_quadrant_daytype_band", _qd_sql())
def q_quadrant(spark, sf_dir):
    """T9 weather quadrant from train-only medians (exact distributed quantiles),
    both boundary conventions; T10 day type; T11 demand band with thresholds
    10 / 20 (this data's hourly counts are 4-30; the reference uses 1000 / 7000
    on daily-scale counts)."""
    hs = hourly_split(spark, sf_dir)
    med = FT.fit_medians(hs.where(F.col("split") == "train"))
    d = FT.weather_quadrant(hs, med, convention="gt").withColumnRenamed("weather_quadrant", "weather_quadrant_gt")
    d = FT.weather_quadrant(d, med, convention="ge")
    d = FT.demand_band(FT.day_type(d), lo=10, hi=20)
    return d.select("series_id", "row_id", "weather_quadrant", "weather_quadrant_gt", "day_type", "demand_band")


@query("features_labels_onehot", cte("hourly") + """
SELECT series_id, row_id,
  CASE weathersit WHEN 1 THEN 'Despejado' WHEN 2 THEN 'Nublado/Niebla' WHEN 3 THEN 'Lluvia Ligera'
    WHEN 4 THEN 'Lluvia Intensa' END AS weathersit_label,
  CASE weekday WHEN 0 THEN 'Dom' WHEN 1 THEN 'Lun' WHEN 2 THEN 'Mar' WHEN 3 THEN 'Mié' WHEN 4 THEN 'Jue'
    WHEN 5 THEN 'Vie' WHEN 6 THEN 'Sáb' END AS weekday_label,
  CAST(season = 1 AS INTEGER) AS season_1, CAST(season = 2 AS INTEGER) AS season_2,
  CAST(season = 3 AS INTEGER) AS season_3, CAST(season = 4 AS INTEGER) AS season_4,
  CAST(weathersit = 2 AS INTEGER) AS weathersit_2, CAST(weathersit = 3 AS INTEGER) AS weathersit_3,
  CAST(weathersit = 4 AS INTEGER) AS weathersit_4, temp, hum
FROM hourly""")
def q_labels(spark, sf_dir):
    """T12 label maps, T13 one-hot (season fixed 1..4 without drop; weathersit
    with drop_first over explicit categories 1..4), T15 drop atemp."""
    h = A.hourly(spark, sf_dir)
    h = FT.map_labels(h, "weathersit", FT.WEATHER_LABELS)
    h = FT.map_labels(h, "weekday", FT.DAY_NAMES)
    h = FT.one_hot(h, {"season": [1, 2, 3, 4]}, keep=True)
    h = FT.one_hot(h, {"weathersit": [1, 2, 3, 4]}, drop_first=True, keep=True)
    h = FT.drop_collinear(h, ("atemp",))
    return h.select("series_id", "row_id", "weathersit_label", "weekday_label", "season_1", "season_2", "season_3",
                    "season_4", "weathersit_2", "weathersit_3", "weathersit_4", "temp", "hum")


@query("features_build_timestamp", cte("hourly") + """
SELECT series_id, row_id, dteday + hr * INTERVAL 1 HOUR AS ts_built,
  make_timestamp(2011 + yr, mnth, 1, hr, 0, 0) AS ts_from_parts FROM hourly""")
def q_ts(spark, sf_dir):
    """Timestamp from dteday + hr, and the (yr, mnth, 1, hr) fallback."""
    h = A.hourly(spark, sf_dir)
    a = FT.build_timestamp(h.drop("timestamp"), name="ts_built")
    b = FT.build_timestamp(h.drop("timestamp", "dteday"), name="ts_from_parts")
    return a.select("series_id", "row_id", "ts_built").join(b.select("series_id", "row_id", "ts_from_parts"),
                                                             ["series_id", "row_id"])


@query("features_drop_warmup", cte("hsplit") + f"""
SELECT * FROM (SELECT series_id, row_id,
  round(lag(cnt_transformed, 1) OVER {WS}, 6) AS cnt_transformed_lag_1h,
  round(lag(cnt_transformed, 24) OVER {WS}, 6) AS cnt_transformed_lag_24h,
  round(lag(cnt_transformed, 168) OVER {WS}, 6) AS cnt_transformed_lag_168h FROM hsplit) t
WHERE cnt_transformed_lag_1h IS NOT NULL AND cnt_transformed_lag_24h IS NOT NULL
  AND cnt_transformed_lag_168h IS NOT NULL""")
def q_warmup(spark, sf_dir):
    """Lags then drop the warm-up rows whose lags are NULL."""
    h = W.lags(hourly_split(spark, sf_dir), ks=(1, 24, 168))
    return FT.drop_warmup(h).select("series_id", "row_id", "cnt_transformed_lag_1h", "cnt_transformed_lag_24h",
                                    "cnt_transformed_lag_168h")


@query("profile_variants", cte("hsplit") + """,
tr AS (SELECT hr, weekday, avg(cnt_transformed) AS pm, sqrt(avg(CAST(cnt AS DOUBLE))) AS ps,
         sum(cnt_transformed) AS s, count(cnt_transformed) AS c FROM hsplit WHERE split = 'train' GROUP BY 1, 2)
SELECT h.series_id, h.row_id, h.split,
  round(coalesce(pm, 0.0), 6) AS prof_zero,
  round(coalesce(pm, cnt_transformed), 6) AS prof_self,
  round(coalesce(ps, 0.0), 6) AS prof_sqrt_mean,
  round(coalesce(CASE WHEN split = 'train' THEN (s - cnt_transformed) / NULLIF(CAST(c - 1 AS DOUBLE), 0) ELSE pm END, 0.0), 6) AS prof_loo
FROM hsplit h LEFT JOIN tr ON h.hr = tr.hr AND h.weekday = tr.weekday""")
def q_profile(spark, sf_dir):
    """J1 variants: fallback 0 / own value, X17 sqrt of mean raw count,
    leave-one-out on training rows. The profile is fit on all training rows."""
    hs = hourly_split(spark, sf_dir)
    tr = hs.where(F.col("split") == "train")
    d = J.historical_profile(tr, hs, name="prof_zero")
    d = J.historical_profile(tr, d, name="prof_self", fallback="self")
    d = J.historical_profile(tr, d, name="prof_sqrt_mean", value="cnt", sqrt_of_mean=True)
    d = J.historical_profile(tr, d, name="prof_loo", leave_one_out=True, train_flag=F.col("split") == "train")
    return d.select("series_id", "row_id", "split", "prof_zero", "prof_self", "prof_sqrt_mean", "prof_loo")


@query("profile_all_rows", cte("hsplit") + """
SELECT series_id, row_id, round(avg(cnt_transformed) OVER (PARTITION BY series_id, hr, weekday), 6) AS cnt_profile_all
FROM hsplit""")
def q_profile_all(spark, sf_dir):
    """Whole-table (hr, weekday) mean on every row (aggregate + join)."""
    return J.profile_all(hourly_split(spark, sf_dir)).select("series_id", "row_id", "cnt_profile_all")


HIST_SQL = cte("hsplit") + """,
obs AS (SELECT series_id, "timestamp", cnt_transformed FROM hsplit WHERE split <> 'test'),
pred AS (SELECT series_id, "timestamp", sqrt(CAST(registered AS DOUBLE)) AS cnt_transformed FROM hsplit WHERE split <> 'train')"""


def _obs_pred(spark, sf_dir):
    hs = hourly_split(spark, sf_dir)
    obs = hs.where(F.col("split") != "test").select("series_id", "timestamp", "cnt_transformed")
    pred = hs.where(F.col("split") != "train").select(
        "series_id", "timestamp", F.sqrt(F.col("registered").cast("double")).alias("cnt_transformed"))
    return obs, pred


@query("history_merge", HIST_SQL + """
SELECT coalesce(o.series_id, p.series_id) AS series_id, coalesce(o."timestamp", p."timestamp") AS "timestamp",
  round(coalesce(o.cnt_transformed, p.cnt_transformed), 6) AS cnt_transformed, o.series_id IS NOT NULL AS is_observed
FROM obs o FULL OUTER JOIN pred p ON o.series_id = p.series_id AND o."timestamp" = p."timestamp\"""")
def q_merge(spark, sf_dir):
    """Observed U predicted, observed wins per hour (one aggregation).
    Observed = all val/train hours; predicted = sqrt(registered) on val/test."""
    obs, pred = _obs_pred(spark, sf_dir)
    return J.merge_history(obs, pred)


@query("history_write_predictions", HIST_SQL + """
SELECT p.series_id, p."timestamp", round(p.cnt_transformed, 6) AS cnt_transformed FROM pred p
WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.series_id = p.series_id AND o."timestamp" = p."timestamp")""")
def q_write_pred(spark, sf_dir):
    """Keep predictions only for hours without an observation (left-anti)."""
    obs, pred = _obs_pred(spark, sf_dir)
    return J.write_predictions(pred, obs)


@query("history_window_range", cte("hsplit") + """
SELECT series_id, "timestamp", round(cnt_transformed, 6) AS cnt_transformed FROM hsplit
WHERE "timestamp" >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 72 HOUR AND "timestamp" < TIMESTAMP '2024-01-20 00:00:00'""")
def q_hwin(spark, sf_dir):
    """History rows of the 72 hours strictly before a given end (F8)."""
    hs = hourly_split(spark, sf_dir).select("series_id", "timestamp", "cnt_transformed")
    return J.history_window(hs, "2024-01-20 00:00:00", 72, strict=True)


@query("history_per_request", cte("hsplit") + """,
rq AS (SELECT row_id AS request_id, series_id, "timestamp" FROM hsplit WHERE split = 'test')
SELECT r.request_id, count(*) AS n_hist, round(avg(h.cnt_transformed), 6) AS mean_hist,
  round(max(h.cnt_transformed), 6) AS max_hist
FROM rq r JOIN hsplit h ON h.series_id = r.series_id AND h."timestamp" < r."timestamp"
  AND h."timestamp" >= r."timestamp" - INTERVAL 24 HOUR
GROUP BY r.request_id""")
def q_hreq(spark, sf_dir):
    """J5 per request: every test-hour request sees the 24 hours before it
    (join on the days it can see, exact range inside a day)."""
    hs = hourly_split(spark, sf_dir)
    rq = hs.where(F.col("split") == "test").select(F.col("row_id").alias("request_id"), "series_id", "timestamp")
    hist = hs.select("series_id", "timestamp", "cnt_transformed")
    j = J.request_history(rq, hist, 24)
    return j.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_hist"), F.avg("cnt_transformed").alias("mean_hist"),
                                       F.max("cnt_transformed").alias("max_hist"))


@query("serve_request_features", cte("hsplit") + """,
rq AS (SELECT series_id, row_id, "timestamp" FROM hsplit WHERE split = 'test'),
seen AS (SELECT r.series_id, r.row_id, h.cnt_transformed AS y,
  row_number() OVER (PARTITION BY r.series_id, r.row_id ORDER BY h."timestamp" DESC, h.row_id DESC) AS k
  FROM rq r JOIN hsplit h ON h.series_id = r.series_id AND h."timestamp" < r."timestamp")
SELECT series_id, row_id, round(max(y) FILTER (k = 1), 6) AS cnt_transformed_lag_1h,
  round(max(y) FILTER (k = 24), 6) AS cnt_transformed_lag_24h,
  round(avg(y) FILTER (k <= 3), 6) AS cnt_transformed_roll_mean_3h, true AS is_request
FROM rq LEFT JOIN seen USING (series_id, row_id) GROUP BY series_id, row_id""")
def q_serve(spark, sf_dir):
    """Requests (every test hour) get window features from their own
    history, all observed hours strictly before them."""
    hs = hourly_split(spark, sf_dir)
    rq = hs.where(F.col("split") == "test").select("series_id", "row_id", "timestamp")
    hist = hs.select("series_id", "row_id", "timestamp", "cnt_transformed")

    def build(w):
        return {"cnt_transformed_lag_1h": W.lag_expr("cnt_transformed", 1, w),
                "cnt_transformed_lag_24h": W.lag_expr("cnt_transformed", 24, w),
                "cnt_transformed_roll_mean_3h": W.roll_mean_expr("cnt_transformed", 3, w, 1, False)}
    out = J.serve_features(rq, hist, build, 24)
    return out.select("series_id", "row_id", "cnt_transformed_lag_1h", "cnt_transformed_lag_24h",
                      "cnt_transformed_roll_mean_3h", F.lit(True).alias("is_request"))


@query("serve_cached_score", cte("hsplit") + """
SELECT row_id, round(CASE WHEN row_id % 3 = 0 THEN -1.0 ELSE 100 * temp + 10 * hum END, 6) AS prediction,
  row_id % 3 = 0 AS cache_hit FROM hsplit WHERE split = 'test'""")
def q_cached(spark, sf_dir):
    """SHA-256 request key (+ model id); cached predictions reused
    (cache = every third test hour, marked -1), misses scored by the model."""
    hs = hourly_split(spark, sf_dir).where(F.col("split") == "test")
    feats = ["dteday", "hr", "temp", "hum", "windspeed", "weathersit", "workingday"]
    cache = J.request_key(hs.where(F.col("row_id") % 3 == 0), feats, "m1").select(
        "request_hash", F.lit(-1.0).alias("prediction"))

    def model(df):
        return df.withColumn("prediction", 100 * F.col("temp") + 10 * F.col("hum"))
    out = J.cached_score(hs, cache, model, feats, model_id="m1")
    return out.select("row_id", "prediction", "cache_hit")


@query("semi_filter_top_days", cte("hsplit") + """,
dd AS (SELECT dteday, sum(cnt) AS c FROM hsplit GROUP BY 1),
top AS (SELECT dteday FROM dd ORDER BY c DESC, dteday LIMIT 5)
SELECT series_id, row_id, cnt FROM hsplit WHERE dteday IN (SELECT dteday FROM top)""")
def q_semi(spark, sf_dir):
    """Hourly rows of the 5 busiest days (top-k days -> left-semi join)."""
    hs = hourly_split(spark, sf_dir)
    top = (hs.groupBy("dteday").agg(F.sum("cnt").alias("c")).orderBy(F.desc("c"), "dteday").limit(5)
           .select("dteday"))
    return J.semi_filter(hs, F.broadcast(top), "dteday").select("series_id", "row_id", "cnt")
