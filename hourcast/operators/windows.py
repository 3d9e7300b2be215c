"""Window / time-series features (W1-W11) over keyed hourly series.

Every function evaluates its windows through ``plans.halo.series_select``:
``strategy="halo"`` (default) is exact for one very long series,
``strategy="partition"`` uses ``Window.partitionBy(series)`` for many short
series. All same-window expressions land in one Window node.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.exprs import safe_div
from ..plans.halo import series_select
from ..plans.ordering import with_row_index

ORDER = ("timestamp", "row_id")
POS_INF, NEG_INF = float("inf"), float("-inf")


def _frame(w: Window, lo: int, hi: int) -> Window:
    return w.rowsBetween(lo, hi)


# ---- expression builders (used inside series_select) -----------------------

def lag_expr(c: str, k: int, w: Window) -> Column:
    return F.lag(F.col(c), k).over(w)


def roll_mean_expr(c: str, n: int, w: Window, min_periods: int = 1, include_current: bool = True) -> Column:
    fr = _frame(w, -(n - 1), 0) if include_current else _frame(w, -n, -1)
    return F.when(F.count(F.col(c)).over(fr) >= min_periods, F.avg(F.col(c)).over(fr))


def roll_std_expr(c: str, n: int, w: Window, min_periods: int = 1, include_current: bool = True,
                  fill_zero: bool = True) -> Column:
    fr = _frame(w, -(n - 1), 0) if include_current else _frame(w, -n, -1)
    v = F.when(F.count(F.col(c)).over(fr) >= min_periods, F.stddev_samp(F.col(c)).over(fr))
    return F.coalesce(v, F.lit(0.0)) if fill_zero else v


def pct_change_expr(c: str, k: int, w: Window, shift: int = 0) -> Column:
    """x_t / x_{t-k} - 1 (on the series shifted by ``shift`` rows); NULL -> 0;
    0/0 -> 0; x/0 -> +-inf (cleaned by F6 rules)."""
    x = F.col(c) if shift == 0 else F.lag(F.col(c), shift).over(w)
    p = F.lag(F.col(c), k + shift).over(w)
    return (F.when(x.isNull() | p.isNull(), F.lit(0.0))
            .when(p == 0, F.when(x == 0, F.lit(0.0)).when(x > 0, F.lit(POS_INF)).otherwise(F.lit(NEG_INF)))
            .otherwise(x / p - 1.0))


# ---- operators -------------------------------------------------------------

def order_rows(df: DataFrame, series="series_id", order=ORDER, name="row_idx") -> DataFrame:
    """Deterministic 0-based position per series (P1; no global sort)."""
    return with_row_index(df, series, order, name=name)


def lags(df: DataFrame, col: str = "cnt_transformed", ks=DEFAULT.lags, *, mode: str = "rows",
         series="series_id", order=ORDER, strategy="halo", name="{c}_lag_{k}h") -> DataFrame:
    """Lag k rows (``mode="rows"``) or the value exactly k hours earlier
    (``mode="time"``: gap-aware; of several rows in that hour the last one counts).
    Time mode shifts one value per hour by every k and joins all lags at once, so
    its plan has the same exchanges for any number of lags."""
    if mode == "time":
        # one value per (series, hour), the last row's, so that no row is multiplied
        rest = [c for c in order[1:] if c in df.columns]
        last = F.max_by(F.struct(F.col(col).alias("v")), F.struct(*(rest or [order[0]])))["v"]
        hours = df.groupBy(F.col(series).alias("_s"), F.col(order[0]).alias("_h")).agg(last.alias("_v"))
        shifted = hours.select("_s", "_h", "_v", F.explode(F.array(*[F.lit(int(k)) for k in ks])).alias("_k"))
        at = lambda k: F.max(F.when(F.col("_k") == k, F.col("_v"))).alias(name.format(c=col, k=k))
        right = (shifted.withColumn("_t", F.col("_h") + F.make_dt_interval(F.lit(0), F.col("_k")))
                 .groupBy("_s", "_t").agg(*[at(k) for k in ks]))  # one value per (hour, k)
        return df.join(right, (df[series] == right["_s"]) & (df[order[0]] == right["_t"]), "left").drop("_s", "_t")
    return series_select(df, lambda w: {name.format(c=col, k=k): lag_expr(col, k, w) for k in ks},
                         max(ks), series=series, order=order, strategy=strategy)


def rolling(df: DataFrame, col: str = "cnt_transformed", windows=DEFAULT.rolling_windows, *,
            min_periods=1, include_current: bool = False, stats=("mean", "std"),
            series="series_id", order=ORDER, strategy="halo") -> DataFrame:
    """Rolling mean / sample std over n rows.

    ``include_current=True`` reproduces the library (frame ends at the current
    row, a leak); the default frame ends one row earlier. ``min_periods`` is an
    int, or "window" (= n) or "half" (= n // 2).
    """
    def mp(n):
        return n if min_periods == "window" else (n // 2 if min_periods == "half" else int(min_periods))

    def build(w):
        out = {}
        for n in windows:
            if "mean" in stats:
                out[f"{col}_roll_mean_{n}h"] = roll_mean_expr(col, n, w, mp(n), include_current)
            if "std" in stats:
                out[f"{col}_roll_std_{n}h"] = roll_std_expr(col, n, w, mp(n), include_current)
        return out
    return series_select(df, build, max(windows) + (0 if include_current else 1),
                         series=series, order=order, strategy=strategy)


def roll_cv(df: DataFrame, col="cnt_transformed", n=24, *, variant="library", include_current=True,
            series="series_id", order=ORDER, strategy="halo", name="cnt_cv_24h") -> DataFrame:
    """Rolling std / rolling mean; library: 0 when mean <= 0;
    notebook: std / (mean + 0.001)."""
    def build(w):
        m = roll_mean_expr(col, n, w, 1, include_current)
        s = roll_std_expr(col, n, w, 1, include_current)
        if variant == "notebook":
            return {name: safe_div(s, m + 0.001)}
        return {name: F.when(m > 0, safe_div(s, m)).otherwise(F.lit(0.0))}
    return series_select(df, build, n + 1, series=series, order=order, strategy=strategy)


def volatility(df: DataFrame, col="cnt_transformed", n=24, *, variant="library",
               series="series_id", order=ORDER, strategy="halo", name="cnt_volatility_24h") -> DataFrame:
    """library = rolling std (min 1, NULL->0) of first differences;
    notebook = rolling std of the value shifted by one, min_periods 12."""
    if variant == "notebook":
        return series_select(df, lambda w: {name: roll_std_expr(col, n, w, 12, False, fill_zero=False)},
                             n + 1, series=series, order=order, strategy=strategy)
    stages = lambda w: [{"_d1": F.col(col) - F.lag(F.col(col), 1).over(w)},
                        {name: roll_std_expr("_d1", n, w, 1, True)}]
    return series_select(df, stages, n + 1, series=series, order=order, strategy=strategy).drop("_d1")


def acceleration(df: DataFrame, col="cnt_transformed", *, variant="library",
                 series="series_id", order=ORDER, strategy="halo") -> DataFrame:
    """Library: diff(diff(x)) and diff(diff(x, 24)) as lag algebra;
    notebook: first difference of the 1h / 24h percent change."""
    if variant == "notebook":
        def build(w):
            p1, p24 = pct_change_expr(col, 1, w), pct_change_expr(col, 24, w)
            return [{"_p1": p1, "_p24": p24},
                    {"cnt_acceleration_1h": F.col("_p1") - F.lag("_p1", 1).over(w),
                     "cnt_acceleration_24h": F.col("_p24") - F.lag("_p24", 1).over(w)}]
        return series_select(df, build, 26, series=series, order=order, strategy=strategy).drop("_p1", "_p24")

    def build(w):
        x = F.col(col)
        l1, l2, l24, l25 = (F.lag(x, k).over(w) for k in (1, 2, 24, 25))
        return {"cnt_acceleration_1h": x - 2 * l1 + l2, "cnt_acceleration_24h": x - l24 - l1 + l25}
    return series_select(df, build, 25, series=series, order=order, strategy=strategy)


def pct_change(df: DataFrame, col="cnt_transformed", ks=(1, 24), *, series="series_id",
               order=ORDER, strategy="halo") -> DataFrame:
    """Percent change over k rows (NULL/0-over-0 -> 0, x/0 -> +-inf)."""
    return series_select(df, lambda w: {f"cnt_pct_change_{k}h": pct_change_expr(col, k, w) for k in ks},
                         max(ks), series=series, order=order, strategy=strategy)


def moving_average(df: DataFrame, col="cnt", n=7, *, series="series_id", order=ORDER,
                   strategy="halo", name=None) -> DataFrame:
    """Mean of the last n rows including the current one; NULL until n rows."""
    name = name or f"{col}_ma_{n}"
    return series_select(df, lambda w: {name: roll_mean_expr(col, n, w, n, True)}, n,
                         series=series, order=order, strategy=strategy)


def lagged_share(df: DataFrame, part="casual", total="cnt", *, series="series_id", order=ORDER,
                 strategy="halo", name="casual_share_lag1") -> DataFrame:
    """part(t-1) / total(t-1); 0 when total(t-1) <= 0 or missing."""
    def build(w):
        p, t = F.lag(F.col(part), 1).over(w), F.lag(F.col(total), 1).over(w)
        return {name: F.when(t > 0, p / t).otherwise(F.lit(0.0))}
    return series_select(df, build, 1, series=series, order=order, strategy=strategy)


def window_features(df: DataFrame, cfg=DEFAULT, *, col="cnt_transformed", variant="library",
                    include_current=None, series="series_id", order=ORDER, strategy="halo") -> DataFrame:
    """All window features of W11 in one halo pass (two stages, one shuffle).

    library: lags, rolling mean/std (frame includes the current row),
    cv_24h, volatility_24h, acceleration 1h/24h, pct_change 1h/24h -- all of
    which read the current target (F4). Leak-safe (``include_current=False``):
    every frame ends at t-1 and the momentum features are computed on the
    series shifted by one row, so no feature of row t reads the target at t.
    """
    inc = (variant == "library") if include_current is None else include_current
    x = F.col(col)
    sh = 0 if inc else 1

    def build(w):
        st1 = {f"{col}_lag_{k}h": lag_expr(col, k, w) for k in cfg.lags}
        for n in cfg.rolling_windows:
            st1[f"{col}_roll_mean_{n}h"] = roll_mean_expr(col, n, w, 1, inc)
            st1[f"{col}_roll_std_{n}h"] = roll_std_expr(col, n, w, 1, inc)
        st2 = {}
        if cfg.volatility:
            m, s = roll_mean_expr(col, 24, w, 1, inc), roll_std_expr(col, 24, w, 1, inc)
            st1["cnt_cv_24h"] = F.when(m > 0, safe_div(s, m)).otherwise(F.lit(0.0))
            st1["_d1"] = x - F.lag(x, 1).over(w)
            st2["cnt_volatility_24h"] = roll_std_expr("_d1", 24, w, 1, inc)
        if cfg.momentum:
            lg = {k: (F.lag(x, k + sh).over(w) if k + sh > 0 else x) for k in (0, 1, 2, 24, 25)}
            st1["cnt_acceleration_1h"] = lg[0] - 2 * lg[1] + lg[2]
            st1["cnt_acceleration_24h"] = lg[0] - lg[24] - lg[1] + lg[25]
            st1["cnt_pct_change_1h"] = pct_change_expr(col, 1, w, sh)
            st1["cnt_pct_change_24h"] = pct_change_expr(col, 24, w, sh)
        return [st1, st2] if st2 else [st1]

    reach = max(max(cfg.lags), max(cfg.rolling_windows) + 1, 27)
    out = series_select(df, build, reach, series=series, order=order, strategy=strategy)
    return out.drop("_d1") if "_d1" in out.columns else out
