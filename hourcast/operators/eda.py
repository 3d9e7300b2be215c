"""Exploratory aggregations, pivots, top-k and outlier reports.

Everything is one or two aggregation jobs; per-column statistics use the
unpivoted long form (``plans.quantiles.unpivot``) instead of column loops, and
exact quantiles use the distributed plan of ``plans.quantiles``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.quantiles import quantiles_long, unpivot
from ..plans.topk import group_top_k
from .features import DAY_TYPES, day_type


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def describe(df: DataFrame, cols, by=(), *, approx: bool = False) -> DataFrame:
    """A1: count, mean, sample std, min, 25/50/75 % (linear), max per column."""
    by = list(by)
    long = unpivot(df, by, list(cols))
    g = by + ["feature"]
    base = long.groupBy(*g).agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                                F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                F.max("value").alias("max"))
    if approx:
        q = long.groupBy(*g).agg(F.percentile_approx("value", [0.25, 0.5, 0.75], 100000).alias("_q"))
        q = q.select(*g, F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q75"))
    else:
        ql = quantiles_long(long, [0.25, 0.5, 0.75], by)
        q = ql.groupBy(*g).agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n)
                                 for p, n in ((0.25, "q25"), (0.5, "median"), (0.75, "q75"))])
    return base.join(q, g)


def daily(df: DataFrame, value="cnt", series="series_id") -> DataFrame:
    """A2: daily totals per series."""
    return df.groupBy(series, "dteday").agg(F.sum(value).alias(value))


def daily_profile(df: DataFrame, series="series_id") -> DataFrame:
    """A3: per day: total cnt, mean temp, modal weathersit (lowest on ties),
    max holiday, weekday of the day's first hour."""
    return df.groupBy(series, "dteday").agg(
        F.sum("cnt").alias("cnt"), F.avg("temp").alias("temp"),
        F.mode("weathersit", deterministic=True).alias("weathersit"),
        F.max("holiday").alias("holiday"), F.min_by("weekday", F.struct("timestamp", "row_id")).alias("weekday"))


def profile_by(df: DataFrame, keys, value="cnt", aggs=("mean",)) -> DataFrame:
    """A4: grouped statistics of ``value`` (mean / median / sum / count / std)."""
    fns = {"mean": F.avg, "sum": F.sum, "count": F.count, "std": F.stddev_samp, "min": F.min, "max": F.max}
    ex = [fns[a](value).alias(f"{value}_{a}") for a in aggs if a != "median"]
    out = df.groupBy(*keys).agg(*ex) if ex else df.select(*keys).distinct()
    if "median" in aggs:
        ql = quantiles_long(unpivot(df, list(keys), [value]), [0.5], keys)
        out = out.join(ql.select(*keys, F.col("q").alias(f"{value}_median")), list(keys), "left")
    return out


def profile_sets(df: DataFrame, sets, value="cnt") -> DataFrame:
    """A5: all A4 profiles in one scan with GROUPING SETS; ``grouping_id``
    tells which set a row belongs to."""
    keys = sorted({k for s in sets for k in s})
    return df.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys]).agg(
        F.avg(value).alias(f"{value}_mean"), F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid"))


def pivot_mean(df: DataFrame, row: str, col: str, value: str, values) -> DataFrame:
    """Mean of ``value`` by row x col with explicit column values."""
    return df.groupBy(row).pivot(col, list(values)).agg(F.avg(value))


def crosstab(df: DataFrame, row: str, col: str, values, normalize: bool = False) -> DataFrame:
    """Counts (or row percentages) by row x col."""
    ct = df.groupBy(row).pivot(col, list(values)).agg(F.count(F.lit(1)))
    ct = ct.fillna(0, subset=[str(v) for v in values])
    if not normalize:
        return ct
    tot = sum([F.col(f"`{v}`") for v in values], F.lit(0))
    return ct.select(row, *[(F.col(f"`{v}`") * 100.0 / tot).alias(str(v)) for v in values])


def corr_matrix(df: DataFrame, cols) -> DataFrame:
    """Pearson correlation of every pair in one aggregation pass (long form)."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.agg(*[F.corr(_q(a).cast("double"), _q(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    up = wide.selectExpr(f"stack({len(pairs)}, {stack}) AS (a, b, corr)")
    low = up.where(F.col("a") != F.col("b")).select(F.col("b").alias("a"), F.col("a").alias("b"), "corr")
    return up.unionByName(low)


def corr_with_target(df: DataFrame, cols, target="cnt") -> DataFrame:
    """Correlation of each column with the target, sorted by |r| desc."""
    wide = df.agg(*[F.corr(_q(c).cast("double"), _q(target).cast("double")).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, corr)").orderBy(F.abs("corr").desc())


def part_share(df: DataFrame, keys=(), parts=("casual", "registered"), total="cnt") -> DataFrame:
    """Totals and means of the parts (casual / registered), share of total."""
    keys = list(keys)
    ag = [F.sum(p).alias(f"{p}_sum") for p in parts] + [F.avg(p).alias(f"{p}_mean") for p in parts]
    ag.append(F.sum(total).alias(f"{total}_sum"))
    g = df.groupBy(*keys).agg(*ag) if keys else df.agg(*ag)
    return g.withColumns({f"{p}_share": F.col(f"{p}_sum") * 100.0 / F.col(f"{total}_sum") for p in parts})


def day_type_stats(df: DataFrame, value="cnt") -> DataFrame:
    """A10: mean / median / std / count per day type, rounded to 2 digits,
    CV = std / mean, rows in the fixed report order."""
    d = day_type(df)
    st = profile_by(d, ["day_type"], value, ("mean", "median", "std", "count"))
    order = F.create_map(*[x for i, t in enumerate(DAY_TYPES) for x in (F.lit(t), F.lit(i))])
    return st.select("day_type", order[F.col("day_type")].alias("report_order"),
                     F.round(f"{value}_mean", 2).alias("mean"), F.round(f"{value}_median", 2).alias("median"),
                     F.round(f"{value}_std", 2).alias("std"), F.col(f"{value}_count").alias("count"),
                     (F.col(f"{value}_std") / F.col(f"{value}_mean")).alias("cv"))


def quadrant_stats(df: DataFrame, value="cnt", label="weather_quadrant") -> DataFrame:
    """Mean and count per quadrant (desc by mean) with best / worst ratio."""
    st = df.groupBy(label).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("count"))
    best = st.agg(F.max_by(label, "mean").alias("best"), F.min_by(label, "mean").alias("worst"),
                  (F.max("mean") / F.min("mean")).alias("best_worst_ratio")).first()
    return st.withColumns({"best": F.lit(best["best"]), "worst": F.lit(best["worst"]),
                           "best_worst_ratio": F.lit(best["best_worst_ratio"])}).orderBy(F.desc("mean"))


def top_k(df: DataFrame, col: str, k: int, *, ascending: bool = False, by=(), tiebreak=()) -> DataFrame:
    """The k largest (smallest) rows by ``col``; per ``by`` group with a
    bounded two-stage rank, globally with TakeOrdered (orderBy + limit)."""
    o = F.col(col).asc() if ascending else F.col(col).desc()
    order = [o] + [F.col(t) for t in tiebreak]
    if by:
        return group_top_k(df, list(by), order, k)
    return df.orderBy(*order).limit(k)


def argmax(df: DataFrame, key: str, value: str, by=()) -> DataFrame:
    """Key of the max and min ``value``; of tied keys the smallest."""
    first = lambda v: F.min(F.when(F.col(value).isNotNull(), F.struct(v.alias("v"), F.col(key).alias("k"))))["k"]
    ag = [first(-F.col(value)).alias(f"argmax_{key}"), first(F.col(value)).alias(f"argmin_{key}"),
          F.max(value).alias(f"max_{value}"), F.min(value).alias(f"min_{value}")]
    return df.groupBy(*by).agg(*ag) if by else df.agg(*ag)


def extreme_days(daily_prof: DataFrame, k: int = 10) -> DataFrame:
    """Top-k and bottom-k days by total, of every series, with a ``label`` column."""
    by = [c for c in ("series_id",) if c in daily_prof.columns]
    hi = top_k(daily_prof, "cnt", k, by=by, tiebreak=("dteday",)).withColumn("label", F.lit("high"))
    lo = top_k(daily_prof, "cnt", k, by=by, ascending=True, tiebreak=("dteday",)).withColumn("label", F.lit("low"))
    return hi.unionByName(lo, allowMissingColumns=True)


def extreme_compare(daily_prof: DataFrame, k: int = 10) -> DataFrame:
    """Mean temp, modal weather, weekend % (weekday 5/6, notebook rule)
    and holiday count of the top-k vs bottom-k days, of every series by itself."""
    ex = extreme_days(daily_prof, k)
    by = [c for c in ("series_id",) if c in daily_prof.columns]
    return ex.groupBy(*by, "label").agg(
        F.avg("temp").alias("temp_mean"), F.mode("weathersit", deterministic=True).alias("weathersit_mode"),
        (F.count_if(F.col("weekday").isin(5, 6)) * 100.0 / F.count(F.lit(1))).alias("weekend_pct"),
        F.count_if(F.col("holiday") == 1).alias("holidays"))


def extreme_curves(hourly: DataFrame, daily_prof: DataFrame, k: int = 10, value="cnt") -> DataFrame:
    """Hourly mean curve of the high days, the low days and all days."""
    on = [c for c in ("series_id",) if c in daily_prof.columns and c in hourly.columns] + ["dteday"]
    ex = extreme_days(daily_prof, k).select(*on, "label")
    sel = hourly.join(ex, on).groupBy("label", "hr").agg(F.avg(value).alias("mean"))
    allc = hourly.groupBy("hr").agg(F.avg(value).alias("mean")).withColumn("label", F.lit("all"))
    return sel.unionByName(allc)


def holiday_stats(df: DataFrame, value="cnt") -> DataFrame:
    """Holiday rows, share, distinct holiday dates; per holiday date mean."""
    tot = df.agg(F.sum("holiday").alias("holiday_rows"), F.count(F.lit(1)).alias("rows"),
                 F.count_distinct(F.when(F.col("holiday") == 1, F.col("dteday"))).alias("holiday_dates"))
    return tot.withColumn("holiday_pct", F.col("holiday_rows") * 100.0 / F.col("rows"))


def holiday_dates(df: DataFrame, value="cnt") -> DataFrame:
    return df.where(F.col("holiday") == 1).groupBy("dteday").agg(F.avg(value).alias("mean"))


def iqr_outliers(df: DataFrame, cols, k: float = 1.5) -> DataFrame:
    """Per column Q1, Q3, IQR bounds, outlier count and percent."""
    long = unpivot(df, [], list(cols))
    q = quantiles_long(long, [0.25, 0.75]).groupBy("feature").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"))
    q = q.withColumns({"lower": F.col("q1") - k * (F.col("q3") - F.col("q1")),
                       "upper": F.col("q3") + k * (F.col("q3") - F.col("q1"))})
    cnt = long.join(F.broadcast(q), "feature").groupBy("feature", "q1", "q3", "lower", "upper").agg(
        F.count_if((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))
    return cnt.withColumn("pct", F.col("n_outliers") * 100.0 / F.col("n"))


def zscore_anomalies(df: DataFrame, value="cnt", threshold: float = 2.5, by=("series_id",)) -> DataFrame:
    """Rows with |z| > threshold, z from the population std of their
    series (aggregate + join, not a per-series window)."""
    st = df.groupBy(*by).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    z = (F.col(value) - F.col("_m")) / F.col("_s")
    return df.join(st, list(by)).withColumn("z", F.when(F.col("_s") > 0, z)).where(
        F.abs(F.col("z")) > threshold).drop("_m", "_s")


def verify_ranges(df: DataFrame, cols, z: float = 3.0) -> DataFrame:
    """Per column: stats, z>3 outliers (sample std; <3 values -> none),
    stats without outliers and the [-0.1, 1.1] 'normalised' flag."""
    long = unpivot(df, [], list(cols))
    st = long.groupBy("feature").agg(F.count("value").alias("count"), F.min("value").alias("min"),
                                     F.max("value").alias("max"), F.avg("value").alias("mean"),
                                     F.stddev_samp("value").alias("std"))
    nulls = unpivot(df, [], list(cols), dropna=False).groupBy("feature").agg(
        F.count_if(F.col("value").isNull()).alias("nulls"))
    j = long.join(F.broadcast(st.select("feature", "count", "mean", "std")), "feature")
    out = (F.col("count") >= 3) & (F.abs((F.col("value") - F.col("mean")) / F.col("std")) > z)
    j = j.withColumn("_o", F.coalesce(out, F.lit(False)))
    cl = j.groupBy("feature").agg(
        F.count_if("_o").alias("outliers"),
        F.min(F.when(~F.col("_o"), F.col("value"))).alias("min_clean"),
        F.max(F.when(~F.col("_o"), F.col("value"))).alias("max_clean"),
        F.avg(F.when(~F.col("_o"), F.col("value"))).alias("mean_clean"))
    r = st.join(cl, "feature").join(nulls, "feature")
    r = r.withColumns({f"{c}_clean": F.coalesce(F.col(f"{c}_clean"), F.col(c)) for c in ("min", "max", "mean")})
    return r.withColumn("is_normalized", (F.col("min_clean") >= -0.1) & (F.col("max_clean") <= 1.1))


def compare_ranges(raw: DataFrame, processed: DataFrame, tol: float = 0.001) -> DataFrame:
    """Clean range of raw vs processed per column; changed when either
    bound moved by tol or more."""
    a = raw.select("feature", F.col("min_clean").alias("raw_min"), F.col("max_clean").alias("raw_max"))
    b = processed.select("feature", F.col("min_clean").alias("proc_min"), F.col("max_clean").alias("proc_max"))
    j = a.join(b, "feature")
    same = (F.abs(F.col("raw_min") - F.col("proc_min")) < tol) & (F.abs(F.col("raw_max") - F.col("proc_max")) < tol)
    return j.withColumn("changed", ~same)


# FIXED VALUES: expected category sets of the integrity audit
EXPECTED_VALUES = {"season": [1, 2, 3, 4], "yr": [0, 1], "mnth": list(range(1, 13)), "hr": list(range(0, 24)),
                   "holiday": [0, 1], "weekday": list(range(0, 7)), "workingday": [0, 1],
                   "weathersit": [1, 2, 3, 4]}


def integrity_report(df: DataFrame, expected=EXPECTED_VALUES) -> DataFrame:
    """One row per check: part-sum mismatches, [0,1] range of the
    normalised columns, category set equality (which expected values occur, and
    the smallest and largest of others), workingday inconsistencies. One
    aggregate with a flag per expected value, however many bad values a column
    holds."""
    cols = [c for c in expected if c in df.columns]
    wd = F.col("workingday")
    incons = ((F.col("weekday").isin(0, 6)) | (F.col("holiday") == 1)) & (wd == 1)
    ag = [F.count_if(F.col("cnt") != F.col("casual") + F.col("registered")).alias("sum_mismatches"),
          F.count_if(incons).alias("workingday_inconsistent")]
    for c in ("temp", "atemp", "hum", "windspeed"):
        ag.append(((F.min(c) >= 0) & (F.max(c) <= 1)).alias(f"in01_{c}"))
    for c in cols:
        x = F.col(c).cast("int")
        ag.append(F.array_compact(F.array(*[F.when(F.bool_or(x == v), F.lit(v)) for v in expected[c]])).alias(f"found_{c}"))
        other = F.when(~x.isin(*expected[c]), x)
        ag.append(F.array_compact(F.array(F.min(other), F.max(other))).alias(f"other_{c}"))
    w = df.agg(*ag)
    rows = [F.struct(F.lit("sum_mismatches").alias("check"), F.col("sum_mismatches").cast("string").alias("value"),
                     (F.col("sum_mismatches") == 0).alias("ok")),
            F.struct(F.lit("workingday_inconsistent").alias("check"),
                     F.col("workingday_inconsistent").cast("string").alias("value"),
                     (F.col("workingday_inconsistent") == 0).alias("ok"))]
    for c in ("temp", "atemp", "hum", "windspeed"):
        rows.append(F.struct(F.lit(f"in_0_1_{c}").alias("check"),
                             F.lower(F.col(f"in01_{c}").cast("string")).alias("value"),
                             F.col(f"in01_{c}").alias("ok")))
    for c in cols:
        rows.append(F.struct(F.lit(f"categories_{c}").alias("check"),
                             F.array_join(F.sort_array(F.array_union(f"found_{c}", f"other_{c}")), ",").alias("value"),
                             ((F.size(f"found_{c}") == len(expected[c])) & (F.size(f"other_{c}") == 0)).alias("ok")))
    return w.select(F.explode(F.array(*rows)).alias("r")).select("r.check", "r.value", "r.ok")


def moments(df: DataFrame, cols, by=()) -> DataFrame:
    """Skewness and excess kurtosis with pandas' bias correction
    (G1 = g1 sqrt(n(n-1))/(n-2); G2 = ((n+1) g2 + 6)(n-1)/((n-2)(n-3)))."""
    long = unpivot(df, list(by), list(cols))
    g = long.groupBy(*by, "feature").agg(F.count("value").alias("n"), F.skewness("value").alias("g1"),
                                         F.kurtosis("value").alias("g2"))
    n = F.col("n").cast("double")
    return g.select(*by, "feature", "n",
                    F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"),
                    F.when(n > 3, ((n + 1) * F.col("g2") + 6) * (n - 1) / ((n - 2) * (n - 3))).alias("kurt"))
