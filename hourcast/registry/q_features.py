"""Feature, window and join queries."""
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
from .sqlgen import enforce_sum_cols
from .sqlviews import cte
from .sqlwin import W as WS
from .sqlwin import pct, r6, roll_mean, roll_std

LAGS, ROLLS = DEFAULT.lags, DEFAULT.rolling_windows
BASE_INT = ["series_id", "row_id", '"timestamp"', "dteday", "yr", "mnth", "hr", "weekday", "season",
            "holiday", "workingday", "weathersit"]
BASE_DBL = ["temp", "atemp", "hum", "windspeed"]


def _base_sql(view: str) -> str:
    return (cte(view) + f",\nen AS (SELECT {', '.join(BASE_INT + BASE_DBL)}, {enforce_sum_cols()} FROM {view}),\n"
            "y AS (SELECT *, sqrt(CAST(cnt AS DOUBLE)) AS cnt_transformed FROM en)")


def chain_sql(view: str = "hourly") -> str:
    c = "cnt_transformed"
    feats = [f"lag({c}, {k}) OVER {WS} AS {c}_lag_{k}h" for k in LAGS]
    for n in ROLLS:
        feats += [f"{roll_mean(c, n)} AS {c}_roll_mean_{n}h", f"{roll_std(c, n)} AS {c}_roll_std_{n}h"]
    feats += [f"CASE WHEN {roll_mean(c, 24)} > 0 THEN {roll_std(c, 24)} / {roll_mean(c, 24)} ELSE 0.0 END AS cnt_cv_24h",
              f"{roll_std('d1', 24)} AS cnt_volatility_24h",
              f"{c} - 2 * lag({c}, 1) OVER {WS} + lag({c}, 2) OVER {WS} AS cnt_acceleration_1h",
              f"{c} - lag({c}, 24) OVER {WS} - lag({c}, 1) OVER {WS} + lag({c}, 25) OVER {WS} AS cnt_acceleration_24h",
              f"{pct(c, 1)} AS cnt_pct_change_1h", f"{pct(c, 24)} AS cnt_pct_change_24h"]
    out = BASE_INT + [r6(x, x) for x in BASE_DBL] + ["casual", "registered", "cnt", r6(c, c)]
    out += [r6(f"{c}_lag_{k}h", f"{c}_lag_{k}h") for k in LAGS]
    out += [r6(f"{c}_roll_{s}_{n}h", f"{c}_roll_{s}_{n}h") for n in ROLLS for s in ("mean", "std")]
    out += [r6(x, x) for x in ("cnt_cv_24h", "cnt_volatility_24h", "cnt_acceleration_1h", "cnt_acceleration_24h",
                               "cnt_pct_change_1h", "cnt_pct_change_24h")]
    for cc in ("hr", "mnth", "weekday"):
        out += [r6(f"sin(2 * pi() * {cc} / (SELECT CAST(max({cc}) AS DOUBLE) FROM f))", f"{cc}_sin"),
                r6(f"cos(2 * pi() * {cc} / (SELECT CAST(max({cc}) AS DOUBLE) FROM f))", f"{cc}_cos")]
    out += ["hr * workingday AS hr_workingday", r6("temp * hum", "temp_hum"), r6("temp * windspeed", "temp_windspeed"),
            r6("pow(temp, 2)", "temp_squared"), r6("temp * hum", "temp_hum_interaction"),
            r6("temp * windspeed", "temp_wind_interaction"),
            "CAST(coalesce(temp > 0.5 AND hum < 0.7 AND windspeed < 0.5 AND weathersit = 1, FALSE) AS INTEGER) AS is_perfect_weather",
            "CAST(hr IN (7, 8, 9, 17, 18, 19) AS INTEGER) AS is_peak_hour",
            "CAST(hr IN (7, 8, 9, 17, 18) AS INTEGER) AS is_commute_window"]
    return (_base_sql(view) + f",\nd AS (SELECT *, {c} - lag({c}, 1) OVER {WS} AS d1 FROM y),\n"
            f"f AS (SELECT *, {', '.join(feats)} FROM d)\nSELECT {', '.join(out)} FROM f")


@query("features_full_chain", chain_sql("hourly"))
def q_chain(spark, sf_dir):
    """W11 library chain on one long series: sqrt target, lags 1..168, rolling
    mean/std 3/24/72 (frame incl. current row, as the library), cv, volatility,
    acceleration, pct change (one halo pass), observed-max cyclical encodings,
    interactions, weather interactions, flags, F6 infinity cleaning."""
    return FT.engineer(C.enforce_sum(A.hourly(spark, sf_dir)), variant="library")


@query("features_keyed_series", chain_sql("hourly_by_type"))
def q_keyed(spark, sf_dir):
    """W11 on five keyed series with ``strategy="partition"`` windows."""
    return FT.engineer(C.enforce_sum(A.hourly_by_type(spark, sf_dir)), variant="library", strategy="partition")


@query("features_keyed_series_halo", chain_sql("hourly_by_type"))
def q_keyed_halo(spark, sf_dir):
    """Same as features_keyed_series with halo windows (strategies must agree)."""
    return FT.engineer(C.enforce_sum(A.hourly_by_type(spark, sf_dir)), variant="library", strategy="halo")


def _nb_sql() -> str:
    c = "cnt_transformed"
    feats = []
    for n in ROLLS:
        feats += [f"{roll_mean(c, n, n, False)} AS {c}_roll_mean_{n}h",
                  f"{roll_std(c, n, n, False)} AS {c}_roll_std_{n}h"]
    fr = "(PARTITION BY series_id ORDER BY \"timestamp\", row_id ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)"
    feats += [f"CASE WHEN count({c}) OVER {fr} >= 12 THEN stddev_samp({c}) OVER {fr} END AS cnt_volatility_24h",
              f"coalesce(CASE WHEN count({c}) OVER {fr} >= 1 THEN stddev_samp({c}) OVER {fr} END, 0) / "
              f"({roll_mean(c, 24, 1, False)} + 0.001) AS cnt_cv_24h",
              f"{pct(c, 1)} AS p1", f"{pct(c, 24)} AS p24"]
    out = ["series_id", "row_id"] + [r6(f"{c}_roll_{s}_{n}h", f"{c}_roll_{s}_{n}h") for n in ROLLS for s in ("mean", "std")]
    out += [r6("cnt_volatility_24h", "cnt_volatility_24h"), r6("cnt_cv_24h", "cnt_cv_24h"),
            r6(f"p1 - lag(p1, 1) OVER {WS}", "cnt_acceleration_1h"), r6(f"p24 - lag(p24, 1) OVER {WS}", "cnt_acceleration_24h")]
    return _base_sql("hourly") + f",\nf AS (SELECT *, {', '.join(feats)} FROM y)\nSELECT {', '.join(out)} FROM f"


@query("features_notebook_windows", _nb_sql())
def q_nb(spark, sf_dir):
    """W2-W6 notebook variants: leak-safe frames (end at t-1) with
    min_periods = window, volatility = shifted std (min 12), cv = std/(mean+0.001),
    acceleration = first difference of percent change."""
    h = FT.transform_target(C.enforce_sum(A.hourly(spark, sf_dir)))
    h = W.rolling(h, min_periods="window", include_current=False)
    h = W.volatility(h, variant="notebook")
    h = W.roll_cv(h, variant="notebook", include_current=False)
    h = W.acceleration(h, variant="notebook")
    return h.select("series_id", "row_id", *[f"cnt_transformed_roll_{s}_{n}h" for n in ROLLS for s in ("mean", "std")],
                    "cnt_volatility_24h", "cnt_cv_24h", "cnt_acceleration_1h", "cnt_acceleration_24h")


def _time_lag_sql() -> str:
    joins, sel = [], ["h.series_id", "h.row_id"]
    for k in LAGS:
        joins.append(f"LEFT JOIN hourly l{k} ON l{k}.series_id = h.series_id AND "
                     f"l{k}.\"timestamp\" + INTERVAL {k} HOUR = h.\"timestamp\"")
        sel.append(f"l{k}.cnt AS cnt_lag_{k}h")
    return cte("hourly") + f"\nSELECT {', '.join(sel)} FROM hourly h " + " ".join(joins)


@query("windows_time_mode_lags", _time_lag_sql())
def q_time_lags(spark, sf_dir):
    """W1 mode="time": value exactly k hours earlier (gap-aware equi-join)."""
    h = A.hourly(spark, sf_dir).select("series_id", "row_id", "timestamp", "cnt")
    return W.lags(h, "cnt", LAGS, mode="time", name="{c}_lag_{k}h").drop("timestamp", "cnt")


@query("windows_row_index", cte("hourly_by_type") + "\nSELECT series_id, row_id, "
       "row_number() OVER (PARTITION BY series_id ORDER BY \"timestamp\", row_id) - 1 AS row_idx FROM hourly_by_type")
def q_rowidx(spark, sf_dir):
    """Deterministic per-series row index without a one-partition window."""
    return W.order_rows(A.hourly_by_type(spark, sf_dir)).select("series_id", "row_id", "row_idx")


@query("windows_moving_average_daily", cte("daily_orders") + "\nSELECT series_id, dteday, cnt, "
       + r6(roll_mean("cnt", 7, 7, True), "cnt_ma_7") + " FROM daily_orders")
def q_ma(spark, sf_dir):
    """7-day moving average of daily order counts; NULL until 7 rows."""
    return W.moving_average(A.daily_orders(spark, sf_dir), "cnt", 7).select("series_id", "dteday", "cnt", "cnt_ma_7")


@query("windows_lagged_share", cte("hourly") + "\nSELECT series_id, row_id, " + r6(
    f"CASE WHEN lag(cnt, 1) OVER {WS} > 0 THEN lag(casual, 1) OVER {WS} / lag(cnt, 1) OVER {WS} ELSE 0.0 END",
    "casual_share_lag1") + " FROM hourly")
def q_share(spark, sf_dir):
    """casual(t-1) / cnt(t-1), 0 when cnt(t-1) <= 0."""
    return W.lagged_share(A.hourly(spark, sf_dir)).select("series_id", "row_id", "casual_share_lag1")


def _transform_sql() -> str:
    lam_b, lam_y = 0.27, 0.273
    y = "CAST(cnt AS DOUBLE)"
    fw = {"sqrt": f"sqrt({y})", "log1p": f"ln(1 + {y})", "boxcox": f"(pow({y}, {lam_b}) - 1) / {lam_b}",
          "yeojohnson": f"(pow({y} + 1, {lam_y}) - 1) / {lam_y}"}
    inv = {"sqrt": "pow(y_sqrt, 2)", "log1p": "exp(y_log1p) - 1", "boxcox": f"pow(y_boxcox * {lam_b} + 1, 1 / {lam_b})",
           "yeojohnson": f"pow(y_yeojohnson * {lam_y} + 1, 1 / {lam_y}) - 1"}
    inner = ", ".join(f"{e} AS y_{k}" for k, e in fw.items())
    out = ["series_id", "row_id", "cnt"] + [r6(f"y_{k}", f"y_{k}") for k in fw] + [r6(e, f"inv_{k}") for k, e in inv.items()]
    return cte("hourly") + f",\nt AS (SELECT *, {inner} FROM hourly)\nSELECT {', '.join(out)} FROM t"


@query("features_target_transforms", _transform_sql())
def q_transforms(spark, sf_dir):
    """Sqrt / log1p / Box-Cox / Yeo-Johnson of cnt and their inverses (M7)."""
    h = A.hourly(spark, sf_dir)
    lams = {"sqrt": None, "log1p": None, "boxcox": 0.27, "yeojohnson": 0.273}
    cols = {f"y_{m}": FT.forward_expr(F.col("cnt").cast("double"), m, l) for m, l in lams.items()}
    h = h.withColumns(cols)
    h = h.withColumns({f"inv_{m}": FT.inverse_expr(F.col(f"y_{m}"), m, l) for m, l in lams.items()})
    return h.select("series_id", "row_id", "cnt", *cols, *[f"inv_{m}" for m in lams])


def _presets_sql() -> str:
    out = ["series_id", "row_id"]
    for name, per in (("nb", {"hr": 24, "mnth": 12, "weekday": 7}), ("svc", {"hr": 23, "mnth": 12, "weekday": 6})):
        for c, p in per.items():
            out += [r6(f"sin(2 * pi() * {c} / {p}.0)", f"{c}_sin_{name}"), r6(f"cos(2 * pi() * {c} / {p}.0)", f"{c}_cos_{name}")]
    pw = {"library": "temp > 0.5 AND hum < 0.7 AND windspeed < 0.5 AND weathersit = 1",
          "notebook": "temp BETWEEN 0.5 AND 0.7 AND hum < 0.5 AND weathersit = 1", "service": "weathersit = 1"}
    peaks = {"library": (7, 8, 9, 17, 18, 19), "notebook": (8, 17, 18), "service": (7, 8, 9, 17, 18, 19)}
    comm = {"library": (7, 8, 9, 17, 18), "notebook": (7, 8, 9, 16, 17, 18, 19),
            "service": (6, 7, 8, 9, 10, 16, 17, 18, 19, 20)}
    wk = {"library": (0, 6), "notebook": (5, 6), "service": (0, 6)}
    for p in ("library", "notebook", "service"):
        out += [f"CAST(coalesce({pw[p]}, FALSE) AS INTEGER) AS is_perfect_weather_{p}",
                f"CAST(hr IN {peaks[p]} AS INTEGER) AS is_peak_hour_{p}",
                f"CAST(hr IN {comm[p]} AS INTEGER) AS is_commute_window_{p}",
                f"CAST(weekday IN {wk[p]} AS INTEGER) AS is_weekend_{p}"]
    return cte("hourly") + f"\nSELECT {', '.join(out)} FROM hourly"


@query("features_presets", _presets_sql())
def q_presets(spark, sf_dir):
    """T3 fixed-period presets (notebook 24/12/7, service 23/12/6), T6 perfect
    weather and T7 peak / commute / weekend flags for all three presets."""
    h = A.hourly(spark, sf_dir)
    outs = [F.col("series_id"), F.col("row_id")]
    for name, pre in (("nb", "notebook"), ("svc", "service")):
        h = FT.cyclical(h, period=pre)
        h = h.withColumnsRenamed({f"{c}_{t}": f"{c}_{t}_{name}" for c in ("hr", "mnth", "weekday") for t in ("sin", "cos")})
    for p in ("library", "notebook", "service"):
        h = FT.time_flags(FT.perfect_weather(h, p), p).withColumnsRenamed(
            {k: f"{k}_{p}" for k in ("is_perfect_weather", "is_peak_hour", "is_commute_window", "is_weekend")})
    keep = [c for c in h.columns if c.endswith(("_nb", "_svc", "_library", "_notebook", "_service"))]
    return h.select(*outs, *keep)
