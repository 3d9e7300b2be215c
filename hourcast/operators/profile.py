"""Joins and profile features."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.blocked import blocked_fill
from .windows import ORDER, series_select

PROFILE_KEYS = ("hr", "weekday")
# calendar keys with a fixed number of values: a profile over them has a proven size bound
BOUNDED_KEYS = {"hr": 24, "weekday": 7, "mnth": 12, "season": 4, "weathersit": 4, "holiday": 2, "workingday": 2}


def historical_profile(train: DataFrame, df: DataFrame, *, keys=PROFILE_KEYS, value="cnt_transformed",
                       by_series: bool = False, series="series_id", fallback="zero",
                       name="cnt_historical_avg_raw", sqrt_of_mean: bool = False,
                       leave_one_out: bool = False, train_flag: Column | None = None) -> DataFrame:
    """Mean of ``value`` per ``keys`` on train rows, left-joined to ``df``.

    Missing keys get 0.0 (``fallback="zero"``) or the row's own value
    (``fallback="self"``, notebook form). ``sqrt_of_mean`` gives X17
    (sqrt of the mean raw count). ``leave_one_out`` removes a training row's
    own value from its profile (rows where ``train_flag`` is true).
    A global profile over calendar keys has a fixed size (24 x 7 by default)
    and is broadcast; per-series or other profiles are left to AQE.
    """
    gk = ([series] if by_series else []) + list(keys)
    agg = F.sqrt(F.avg(value)) if sqrt_of_mean else F.avg(value)
    prof = train.groupBy(*gk).agg(agg.alias(name), F.sum(value).alias("_ps"), F.count(value).alias("_pn"))
    if not leave_one_out:
        prof = prof.drop("_ps", "_pn")
    bounded = not by_series and all(k in BOUNDED_KEYS for k in keys)
    right = F.broadcast(prof) if bounded else prof   # otherwise AQE decides from runtime sizes
    out = df.join(right, gk, "left")
    if leave_one_out:
        own = F.coalesce(train_flag, F.lit(False)) if train_flag is not None else F.lit(True)
        loo = F.try_divide(F.col("_ps") - F.col(value), (F.col("_pn") - 1).cast("double"))
        out = out.withColumn(name, F.when(own, loo).otherwise(F.col(name))).drop("_ps", "_pn")
    fb = F.lit(0.0) if fallback == "zero" else F.col(value).cast("double")
    return out.withColumn(name, F.coalesce(F.col(name), fb))


def vs_profile(df: DataFrame, lag_col="cnt_transformed_lag_1h", profile_col="cnt_historical_avg_raw",
               name="cnt_vs_historical") -> DataFrame:
    """Lagged value minus the profile."""
    return df.withColumn(name, F.col(lag_col) - F.col(profile_col))


def profile_all(df: DataFrame, *, keys=PROFILE_KEYS, value="cnt_transformed", series="series_id",
                name="cnt_profile_all") -> DataFrame:
    """Whole-table mean per (series, keys) attached to every row (leaky
    notebook form) -- aggregate + join, not a per-group window."""
    gk = [series] + list(keys)
    prof = df.groupBy(*gk).agg(F.avg(value).alias(name))
    return df.join(prof, gk, "left")


def merge_history(observed: DataFrame, predicted: DataFrame, *, series="series_id", ts="timestamp",
                  value="cnt_transformed") -> DataFrame:
    """Observed U predicted; per (series, ts) the observed value wins.

    One aggregation (partial aggregation map-side), no per-key window.
    """
    u = (observed.select(series, ts, value, F.lit(0).alias("_pri"))
         .unionByName(predicted.select(series, ts, value, F.lit(1).alias("_pri"))))
    return (u.groupBy(series, ts)
            .agg(F.min_by(F.struct(F.col(value).alias("v"), F.col("_pri").alias("p")), F.col("_pri")).alias("_w"))
            .select(series, ts, F.col("_w.v").alias(value), (F.col("_w.p") == 0).alias("is_observed")))


def history_window(history: DataFrame, end, hours: int, *, ts="timestamp", strict: bool = False) -> DataFrame:
    """Rows with end - hours <= ts <= end (``strict``: ts < end, F8)."""
    e = F.lit(end).cast("timestamp_ntz") if not isinstance(end, Column) else end
    lo = e - F.make_dt_interval(F.lit(0), F.lit(hours))
    cond = (F.col(ts) >= lo) & ((F.col(ts) < e) if strict else (F.col(ts) <= e))
    return history.where(cond)


def request_history(requests: DataFrame, history: DataFrame, hours: int, *, series="series_id",
                    ts="timestamp", req_id="request_id", strict: bool = True) -> DataFrame:
    """J5 per request: each request's history rows within ``hours`` before it
    (exact to the second, whatever minute the request comes at).

    A request is copied to the days it can see (one per day, not per hour) and
    joined on (series, day); the exact range then filters inside a day.
    """
    day = lambda c: F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date"))
    first = F.col("_rts") - F.make_dt_interval(F.lit(0), F.lit(hours))
    rq = requests.select(req_id, series, F.col(ts).alias("_rts")).withColumn("_first", first)
    rq = rq.withColumn("_day", F.explode(F.sequence(day("_first"), day("_rts"))))
    inside = (F.col(ts) >= F.col("_first")) & ((F.col(ts) < F.col("_rts")) if strict else (F.col(ts) <= F.col("_rts")))
    return rq.join(history.withColumn("_day", day(ts)), [series, "_day"]).where(inside).drop("_day", "_first")


def write_predictions(predicted: DataFrame, observed: DataFrame, *, series="series_id",
                      ts="timestamp") -> DataFrame:
    """Predictions only for (series, ts) without an observation (left-anti)."""
    return predicted.join(observed.select(series, ts), [series, ts], "left_anti")


def serve_features(requests: DataFrame, history: DataFrame, build_fn, lookback: int, *,
                   series="series_id", ts="timestamp", value="cnt_transformed",
                   strategy="halo", tiebreak=()) -> DataFrame:
    """Every request gets the window features of its own history, the rows
    of its series strictly before its hour (F8); other requests play no part.

    ``build_fn(w) -> {name: Column}`` gives the features; their frames must end
    at the previous row. What a request sees is then what the first history row
    at or after its hour sees, so the features are computed once over history
    (plus an open end per series) and filled backward onto the requests.
    ``tiebreak`` columns order history rows of the same hour after ``row_id``.
    """
    order = (ts, *[c for c in ("row_id", *tiebreak) if c in history.columns])
    end = requests.select(series).distinct().withColumn(ts, F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"))
    known = history.select(series, *order, value).unionByName(end, allowMissingColumns=True)
    base = known.columns
    seen = series_select(known, build_fn, lookback, series=series, order=order, strategy=strategy)
    names = [c for c in seen.columns if c not in base]
    kind = seen.select(F.struct(*names).alias("_seen")).schema["_seen"].dataType
    seen = seen.select(series, *order, F.struct(*names).alias("_seen"), F.lit(1).alias("_later"))
    asked = (requests.select(series, ts, F.struct(*[F.col(f"`{c}`") for c in requests.columns]).alias("_request"))
             .withColumns({"_seen": F.lit(None).cast(kind), "_later": F.lit(0)}))
    both = asked.unionByName(seen, allowMissingColumns=True)
    # at the same hour requests stand before history, whose first row is then the next one
    both = blocked_fill(both, ["_seen"], series=series, order=(ts, "_later", *order[1:]), backward=True)
    out = both.where("_later = 0")
    return out.select(*[F.col(f"_request.`{c}`").alias(c) for c in requests.columns if c not in names],
                      *[F.col(f"_seen.`{n}`").alias(n) for n in names])


def request_key(df: DataFrame, feature_cols, model_id: str = "default", name="request_hash") -> DataFrame:
    """J8 key: SHA-256 of the JSON of the (name-sorted) feature struct + model id."""
    cols = sorted(feature_cols)
    js = F.to_json(F.struct(*[F.col(c) for c in cols]))
    return df.withColumn(name, F.sha2(F.concat(js, F.lit("|"), F.lit(model_id)), 256))


def cached_score(requests: DataFrame, cache: DataFrame, score_fn, feature_cols, *, model_id="default",
                 key="request_hash") -> DataFrame:
    """Reuse cached predictions for identical inputs; score only misses.

    Returns all requests with ``prediction`` and ``cache_hit``.
    """
    r = request_key(requests, feature_cols, model_id, key)
    # one cached value per key (a hash store overwrites: the newest entry wins)
    pick = F.max_by("prediction", "created") if "created" in cache.columns else F.max("prediction")
    c = cache.groupBy(key).agg(pick.alias("_cp"))
    hits = r.join(c, key).withColumnRenamed("_cp", "prediction").withColumn("cache_hit", F.lit(True))
    misses = score_fn(r.join(c, key, "left_anti")).withColumn("cache_hit", F.lit(False))
    return hits.unionByName(misses.select(*hits.columns))


def semi_filter(df: DataFrame, keys_df: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key appears in ``keys_df`` (left-semi join)."""
    return df.join(keys_df, on, "left_semi")
