"""Time, scalar and interaction features (T1-T15) and the W11 feature chain."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT
from ..functions.exprs import cyclical_pair, is_inf, safe_div
from ..plans.ordering import with_row_index
from .windows import window_features

# FIXED VALUES: the three presets of the reference (library / notebook / service)
PEAK_HOURS = {"library": (7, 8, 9, 17, 18, 19), "notebook": (8, 17, 18),
              "service": (7, 8, 9, 17, 18, 19)}
COMMUTE_HOURS = {"library": (7, 8, 9, 17, 18), "notebook": (7, 8, 9, 16, 17, 18, 19),
                 "service": (6, 7, 8, 9, 10, 16, 17, 18, 19, 20)}
WEEKEND_DAYS = {"library": (0, 6), "notebook": (5, 6), "service": (0, 6)}
CYCLE_PERIODS = {"notebook": {"hr": 24, "mnth": 12, "weekday": 7},
                 "service": {"hr": 23, "mnth": 12, "weekday": 6}}
# FIXED VALUES: labels used by the reference's exploratory analysis
WEATHER_LABELS = {1: "Despejado", 2: "Nublado/Niebla", 3: "Lluvia Ligera", 4: "Lluvia Intensa"}
DAY_NAMES = {0: "Dom", 1: "Lun", 2: "Mar", 3: "Mié", 4: "Jue", 5: "Vie", 6: "Sáb"}
YEAR_LABELS = {0: "2011", 1: "2012"}
DAY_TYPES = ("Laboral", "Fin de Semana", "Festivo")  # workday, weekend, holiday (report order)


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def build_timestamp(df: DataFrame, base_year: int = DEFAULT.base_year, *, series="series_id",
                    name: str = "timestamp") -> DataFrame:
    """Dteday + hr hours; else an existing timestamp; else (yr, mnth, 1, hr);
    else an hourly sequence from Jan 1 of the base year by row position."""
    cols = set(df.columns)
    if {"dteday", "hr"} <= cols:
        ts = F.to_timestamp_ntz(F.col("dteday").cast("string")) + F.make_dt_interval(F.lit(0), F.col("hr"))
        if name in cols:
            ts = F.coalesce(ts, F.col(name).cast("timestamp_ntz"))
        return df.withColumn(name, ts)
    if name in cols:
        return df.withColumn(name, F.col(name).cast("timestamp_ntz"))
    if {"yr", "mnth", "hr"} <= cols:
        return df.withColumn(name, F.make_timestamp_ntz(F.col("yr") + base_year, F.col("mnth"), F.lit(1),
                                                        F.col("hr"), F.lit(0), F.lit(0)))
    d = with_row_index(df, series, ("row_id",), name="_i") if series in cols else \
        with_row_index(df.withColumn("_s", F.lit(1)), "_s", ("row_id",), name="_i").drop("_s")
    return d.withColumn(name, F.make_timestamp_ntz(F.lit(base_year), F.lit(1), F.lit(1), F.lit(0), F.lit(0),
                                                   F.lit(0)) + F.make_dt_interval(F.lit(0), F.col("_i"))).drop("_i")


def transform_target(df: DataFrame, col="cnt", method="sqrt", lam: float | None = None,
                     name="cnt_transformed") -> DataFrame:
    """Sqrt / log1p / Box-Cox(lam) / Yeo-Johnson(lam) of the target."""
    return df.withColumn(name, forward_expr(_q(col).cast("double"), method, lam))


def forward_expr(x: Column, method: str, lam: float | None = None) -> Column:
    if method == "sqrt":
        return F.sqrt(x)
    if method == "log1p":
        return F.log1p(x)
    if method == "none":
        return x
    if method == "boxcox":
        return F.log(x) if abs(lam) < 1e-12 else (F.pow(x, lam) - 1.0) / lam
    if method == "boxcox1":  # Box-Cox of x + 1
        return forward_expr(x + 1.0, "boxcox", lam)
    if method == "yeojohnson":
        pos = F.log1p(x) if abs(lam) < 1e-12 else (F.pow(x + 1.0, lam) - 1.0) / lam
        neg = -F.log1p(-x) if abs(lam - 2) < 1e-12 else -(F.pow(-x + 1.0, 2 - lam) - 1.0) / (2 - lam)
        return F.when(x >= 0, pos).otherwise(neg)
    raise ValueError(f"unknown transform {method!r}")


def inverse_expr(y: Column, method: str, lam: float | None = None) -> Column:
    if method == "sqrt":
        return F.pow(y, 2.0)
    if method == "log1p":
        return F.expm1(y)
    if method == "none":
        return y
    if method == "boxcox":
        return F.exp(y) if abs(lam) < 1e-12 else F.pow(y * lam + 1.0, 1.0 / lam)
    if method == "boxcox1":
        return inverse_expr(y, "boxcox", lam) - 1.0
    if method == "yeojohnson":
        pos = F.expm1(y) if abs(lam) < 1e-12 else F.pow(y * lam + 1.0, 1.0 / lam) - 1.0
        neg = -F.expm1(-y) if abs(lam - 2) < 1e-12 else 1.0 - F.pow(-(2 - lam) * y + 1.0, 1.0 / (2 - lam))
        return F.when(y >= 0, pos).otherwise(neg)
    raise ValueError(f"unknown transform {method!r}")


def cyclical(df: DataFrame, cols=DEFAULT.cyclical, period="observed_max") -> DataFrame:
    """c_sin / c_cos with angle 2*pi*c/period.

    ``period`` is a number, a {col: number} dict, a preset name ("notebook",
    "service"), or "observed_max" (F5: the column's maximum over ``df``,
    computed as a scalar sub-query -- use ``fit_periods`` on train to freeze).
    """
    cols = [c for c in cols if c in df.columns]
    if period == "observed_max":
        mx = df.agg(*[F.max(_q(c)).cast("double").alias(c) for c in cols])
        periods = {c: mx.select(c).scalar() for c in cols}
    elif isinstance(period, str):
        periods = {c: F.lit(float(CYCLE_PERIODS[period][c])) for c in cols}
    elif isinstance(period, dict):
        periods = {c: F.lit(float(period[c])) for c in cols}
    else:
        periods = {c: F.lit(float(period)) for c in cols}
    out = {}
    for c in cols:
        s, co = cyclical_pair(_q(c).cast("double"), periods[c])
        out[f"{c}_sin"], out[f"{c}_cos"] = s, co
    return df.withColumns(out)


def fit_periods(train: DataFrame, cols=DEFAULT.cyclical) -> dict:
    """Observed maxima on train, frozen for serving (one small aggregate)."""
    row = train.agg(*[F.max(_q(c)).alias(c) for c in cols if c in train.columns]).first()
    return {c: float(row[c]) for c in row.asDict()}


def interactions(df: DataFrame, pairs=DEFAULT.interactions) -> DataFrame:
    """T4: a_b = a * b for each configured pair present in ``df``."""
    return df.withColumns({f"{a}_{b}": _q(a) * _q(b) for a, b in pairs
                           if a in df.columns and b in df.columns})


def weather_interactions(df: DataFrame) -> DataFrame:
    """T5: temp^2, temp*hum, temp*windspeed."""
    out = {}
    if "temp" in df.columns:
        out["temp_squared"] = F.pow(_q("temp"), 2.0)
        if "hum" in df.columns:
            out["temp_hum_interaction"] = _q("temp") * _q("hum")
        if "windspeed" in df.columns:
            out["temp_wind_interaction"] = _q("temp") * _q("windspeed")
    return df.withColumns(out)


def perfect_weather_expr(preset="library") -> Column:
    t, h, w, s = _q("temp"), _q("hum"), _q("windspeed"), _q("weathersit")
    if preset == "library":
        c = (t > 0.5) & (h < 0.7) & (w < 0.5) & (s == 1)
    elif preset == "notebook":
        c = t.between(0.5, 0.7) & (h < 0.5) & (s == 1)
    elif preset == "service":
        c = s == 1
    else:
        raise ValueError(preset)
    return F.coalesce(c, F.lit(False)).cast("int")


def perfect_weather(df: DataFrame, preset="library") -> DataFrame:
    """is_perfect_weather under one of three presets."""
    return df.withColumn("is_perfect_weather", perfect_weather_expr(preset))


def time_flags(df: DataFrame, preset="library") -> DataFrame:
    """is_peak_hour, is_commute_window, is_weekend for a preset."""
    hr, wd = _q("hr"), _q("weekday")
    return df.withColumns({
        "is_peak_hour": hr.isin(*PEAK_HOURS[preset]).cast("int"),
        "is_commute_window": hr.isin(*COMMUTE_HOURS[preset]).cast("int"),
        "is_weekend": wd.isin(*WEEKEND_DAYS[preset]).cast("int")})


def hr_workingday(df: DataFrame) -> DataFrame:
    """T8."""
    return df.withColumn("hr_workingday", _q("hr") * _q("workingday"))


def fit_medians(train: DataFrame, cols=("temp", "hum"), approx: bool = False) -> dict:
    from ..plans.quantiles import quantile_map
    m = quantile_map(train, list(cols), [0.5], approx=approx)
    return {c: m[(c, 0.5)] for c in cols}


def weather_quadrant(df: DataFrame, medians: dict, *, convention: str = "ge") -> DataFrame:
    """Quadrant label from temp/hum medians (fit on train).

    convention "ge": hot = temp >= median, humid = hum >= median;
    convention "gt": hot = temp > median,  humid = hum > median.
    """
    t, h = _q("temp"), _q("hum")
    mt, mh = F.lit(medians["temp"]), F.lit(medians["hum"])
    hot = t >= mt if convention == "ge" else t > mt
    hum = h >= mh if convention == "ge" else h > mh
    lab = (F.when(hot & hum, "hot_humid").when(hot & ~hum, "hot_dry")
           .when(~hot & hum, "cold_humid").otherwise("cold_dry"))
    return df.withColumn("weather_quadrant", lab)


def day_type(df: DataFrame) -> DataFrame:
    """Weekend (Sat/Sun) wins, then holiday, else workday."""
    return df.withColumn("day_type", F.when(_q("weekday").isin(0, 6), DAY_TYPES[1])
                         .when(_q("holiday") == 1, DAY_TYPES[2]).otherwise(DAY_TYPES[0]))


def demand_band(df: DataFrame, col="cnt", lo=1000, hi=7000, name="demand_band") -> DataFrame:
    """Low < lo, medium <= hi, high > hi."""
    return df.withColumn(name, F.when(_q(col) < lo, "low").when(_q(col) <= hi, "medium").otherwise("high"))


def map_labels(df: DataFrame, col: str, mapping: dict, name: str | None = None) -> DataFrame:
    """Code -> label via a literal map (no join)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn(name or f"{col}_label", m[_q(col)])


def one_hot(df: DataFrame, cols: dict, *, drop_first: bool = False, keep: bool = False) -> DataFrame:
    """Named int indicator columns ``c_value`` for the given value lists
    (explicit categories keep the schema stable; see ``fit_categories``)."""
    out = {}
    for c, values in cols.items():
        vals = sorted(values)[1:] if drop_first else list(values)
        for v in vals:
            out[f"{c}_{v}"] = F.coalesce(_q(c) == F.lit(v), F.lit(False)).cast("int")
    d = df.withColumns(out)
    return d if keep else d.drop(*cols.keys())


def fit_categories(train: DataFrame, cols, most: int = 10_000) -> dict:
    """Distinct non-NULL categories per column, sorted. They become columns, so
    a column with more than ``most`` of them is an error; no more are fetched."""
    out = {}
    for c in cols:
        rows = train.select(_q(c).alias("v")).where("v IS NOT NULL").distinct().limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"{c} has more than {most} categories")
        out[c] = sorted(r["v"] for r in rows)
    return out


def drop_warmup(df: DataFrame, lag_cols=None) -> DataFrame:
    """Drop rows whose lag features are still NULL."""
    lag_cols = lag_cols or [c for c in df.columns if "_lag_" in c]
    return df.na.drop(subset=lag_cols)


def drop_collinear(df: DataFrame, cols=("atemp",)) -> DataFrame:
    """T15."""
    return df.drop(*cols)


def clean_infinite(df: DataFrame, *, mode="compat", approx: bool = False) -> DataFrame:
    """P7s / F6: +-inf -> NULL -> column median -> 0.

    ``mode="compat"`` reproduces the reference: only when some +-inf exists in
    the frame are *all* NULLs of numeric columns replaced by the medians
    (computed after inf -> NULL); otherwise the frame is unchanged.
    ``mode="always"`` always imputes; ``mode="inf_only"`` only nulls the infs.
    """
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    ints = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in num]
    if not num and not ints:
        return df
    d = df.withColumns({c: F.when(is_inf(_q(c)), F.lit(None).cast("double")).otherwise(_q(c)) for c in num})
    if mode == "inf_only":
        return d
    from ..plans.quantiles import quantile_map
    if mode == "compat":
        # the global condition needs one pass before the result: write the frame
        # once (shared checkpoint folder) so the check and the result read it
        from ..session import cut_lineage
        df = cut_lineage(df)
        d = df.withColumns({c: F.when(is_inf(_q(c)), F.lit(None).cast("double")).otherwise(_q(c)) for c in num})
        has_inf = df.agg(F.max(_any([is_inf(_q(c)) for c in num]).cast("int"))).first()[0] if num else 0
        if not has_inf:
            return d
    allc = num + ints
    med = quantile_map(d, allc, [0.5], approx=approx)
    fill = {c: F.coalesce(_q(c), F.lit(0.0 if med[(c, 0.5)] is None else med[(c, 0.5)])
                          .cast(df.schema[c].dataType)) for c in allc}
    return d.withColumns(fill)


def _any(cs):
    out = F.lit(False)
    for c in cs:
        out = out | c
    return out


def engineer(df: DataFrame, cfg=DEFAULT, *, variant="safe", series="series_id",
             order=("timestamp", "row_id"), strategy="halo", periods=None,
             inf_mode=None) -> DataFrame:
    """The full feature chain in one plan.

    ``variant="library"`` reproduces the reference: rolling frames include the
    current target (F4), cyclical periods are the frame's observed maxima (F5)
    and infinities follow the global compat rule (F6, one extra pass). The
    default ``"safe"`` ends every frame at t-1, uses the fixed 24 / 12 / 7
    periods and only nulls infinities (row-level; median imputation is a
    separate fit / apply step, ``clean_infinite(mode="always")``).
    sqrt target -> lags / rolling / cv / volatility / acceleration / pct change
    (one halo window pass) -> cyclical -> interactions -> weather interactions
    -> peak / commute flags, hr x workingday -> F6 infinity cleaning.
    """
    lib = variant == "library"
    periods = periods or ("observed_max" if lib else "notebook")
    inf_mode = inf_mode or ("compat" if lib else "inf_only")
    d = transform_target(df, cfg.target_col) if cfg.target_col in df.columns else df
    if "cnt_transformed" in d.columns:
        d = window_features(d, cfg, variant=variant, series=series, order=order, strategy=strategy)
    d = cyclical(d, cfg.cyclical, periods)
    d = interactions(d, cfg.interactions)
    if cfg.weather_interactions:
        d = weather_interactions(d)
        if all(c in d.columns for c in ("temp", "hum", "windspeed", "weathersit")):
            d = perfect_weather(d, "library")
    if "hr" in d.columns:
        d = d.withColumns({"is_peak_hour": _q("hr").isin(*PEAK_HOURS["library"]).cast("int"),
                           "is_commute_window": _q("hr").isin(*COMMUTE_HOURS["library"]).cast("int")})
        if "workingday" in d.columns:
            d = hr_workingday(d)
    return clean_infinite(d, mode=inf_mode) if inf_mode else d


# ---- operators found only in the reference's documents (X1, X10, X13, X14) ----

def ewma_shifted(df: DataFrame, col="cnt_transformed", span: int = 24, *, name=None, series="series_id",
                 order=("timestamp", "row_id"), strategy="halo", tol: float = 1e-15) -> DataFrame:
    """EWMA of the previous values, span 24, adjust=False
    (pandas ``x.shift(1).ewm(span, adjust=False).mean()``).

    e_t = a x_t + (1-a) e_{t-1}, e_0 = x_0, a = 2/(span+1), output e_{t-1}.
    Folded over the last K rows, where what came before weighs less than
    ``tol``; NULLs fade the weights and leave the mean (pandas' default). One
    halo pass with a bounded list frame.
    """
    import math as _m
    from ..plans.halo import series_select
    a = 2.0 / (span + 1.0)
    K = int(_m.ceil(_m.log(tol) / _m.log(1 - a)))
    name = name or f"{col}_ewm_{span}h"

    def build(w):
        # structs keep NULLs in their places (collect_list leaves bare NULLs out)
        arr = F.collect_list(F.struct(F.col(col).cast("double").alias("v"))).over(w.rowsBetween(-K, 0))
        start = F.struct(F.lit(None).cast("double").alias("y"), F.lit(1.0).alias("w"))

        def step(acc, x):
            # the mean's weight fades at every row; a value pulls the mean and resets it
            y, old = acc["y"], acc["w"] * (1 - a)
            seen = x["v"].isNotNull()
            mean = F.when(y.isNull(), x["v"]).when(seen, (old * y + a * x["v"]) / (old + a)).otherwise(y)
            return F.struct(mean.alias("y"), F.when(seen, F.lit(1.0)).otherwise(old).alias("w"))
        st1 = {"_e": F.aggregate(arr, start, step)["y"]}
        return [st1, {name: F.lag("_e", 1).over(w)}]
    had = "row_idx" in df.columns
    d = df if had else with_row_index(df, series, order, name="row_idx")
    out = series_select(d, build, K + 1, series=series, order=order, strategy=strategy).drop("_e")
    return out if had else out.drop("row_idx")


def calendar_extras(df: DataFrame, *, series="series_id", order=("timestamp", "row_id"), strategy="halo") -> DataFrame:
    """Day of month, ISO week, month start / end / first half, hour x
    season, hour x weather, weekday x weather, weekend (Sat/Sun) x temp,
    temp x season, weather x season, 24-hour temperature change."""
    from ..plans.halo import series_select
    d = df.withColumns({
        "day_of_month": F.dayofmonth("dteday"), "week_of_year": F.weekofyear("dteday"),
        "is_month_start": (F.dayofmonth("dteday") == 1).cast("int"),
        "is_month_end": (F.col("dteday") == F.last_day("dteday")).cast("int"),
        "is_first_half_month": (F.dayofmonth("dteday") <= 15).cast("int"),
        "hr_season": _q("hr") * _q("season"), "hr_weathersit": _q("hr") * _q("weathersit"),
        "weekday_weathersit": _q("weekday") * _q("weathersit"),
        "is_weekend_temp": _q("weekday").isin(0, 6).cast("int") * _q("temp"),
        "temp_season": _q("temp") * _q("season"), "weathersit_season": _q("weathersit") * _q("season")})
    return series_select(d, lambda w: {"temp_change_24h": _q("temp") - F.lag("temp", 24).over(w)}, 24,
                         series=series, order=order, strategy=strategy)


def special_days(df: DataFrame) -> DataFrame:
    """End of month (day >= 28), first day, school season (months 1-5,
    9-11), summer vacation (6-8)."""
    return df.withColumns({
        "is_end_of_month": (F.dayofmonth("dteday") >= 28).cast("int"),
        "is_start_of_month": (F.dayofmonth("dteday") == 1).cast("int"),
        "is_school_season": _q("mnth").isin(1, 2, 3, 4, 5, 9, 10, 11).cast("int"),
        "is_summer_vacation": _q("mnth").isin(6, 7, 8).cast("int")})


def conditional_lag(df: DataFrame, col="cnt_transformed", *, weekend_preset="notebook", series="series_id",
                    order=("timestamp", "row_id"), strategy="halo", name="cnt_lag_conditional") -> DataFrame:
    """Weekend rows take the value one week back, other rows one day back."""
    from ..plans.halo import series_select
    wk = _q("weekday").isin(*WEEKEND_DAYS[weekend_preset])
    return series_select(df, lambda w: {name: F.when(wk, F.lag(col, 168).over(w)).otherwise(F.lag(col, 24).over(w))},
                         168, series=series, order=order, strategy=strategy)
