"""Statistical tests and series diagnostics as Spark jobs.

Heavy parts (sorting, cumulative counts, lag products, normal equations) run
as distributed aggregates / halo windows; only fixed-size results (a few
numbers per series or feature) are finished on the driver or in a pandas UDF.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import chi2_sf, kolmogorov_sf, log_erfc, nan_to_null
from ..functions.special import f_sf_udf
from ..plans.blocked import blocked_cumsum
from ..plans.halo import series_select
from ..plans.ordering import with_row_index
from ..plans.quantiles import exact_quantiles, quantile_map, unpivot, value_cumulative

ORDER = ("timestamp", "row_id")


# ---- D1 Kolmogorov-Smirnov --------------------------------------------------

def ks_2samp(ref: DataFrame, cur: DataFrame, cols, *, rows_per_block: int = 1_000_000) -> DataFrame:
    """Two-sample KS per column: (feature, n_ref, n_cur, ks_statistic, ks_pvalue).

    Exact statistic from cumulative counts over the union of distinct values;
    p-value from the asymptotic Kolmogorov distribution (SciPy's default is
    the exact small-sample distribution for n <= 10 000: expect differences
    in the p-value there, not in the statistic)."""
    a = unpivot(ref, [], list(cols)).withColumn("_t", F.lit(0))
    b = unpivot(cur, [], list(cols)).withColumn("_t", F.lit(1))
    cum = value_cumulative(a.unionByName(b), ["feature"],
                           {"na": F.count_if(F.col("_t") == 0), "nb": F.count_if(F.col("_t") == 1)},
                           rows_per_block=rows_per_block)
    diff = F.abs(F.col("cum_na") / F.col("tot_na") - F.col("cum_nb") / F.col("tot_nb"))
    g = cum.groupBy("feature").agg(F.first("tot_na").alias("n_ref"), F.first("tot_nb").alias("n_cur"),
                                   F.max(diff).alias("ks_statistic"))
    return ks_pvalues(g.where((F.col("n_ref") > 0) & (F.col("n_cur") > 0)))


def ks_pvalues(g: DataFrame) -> DataFrame:
    """``ks_pvalue`` of rows with n_ref, n_cur and ks_statistic."""
    en = F.sqrt(F.col("n_ref") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur")).cast("double"))
    return g.withColumn("ks_pvalue", kolmogorov_sf(en * F.col("ks_statistic")))


# ---- D2 PSI -------------------------------------------------------------------

def hist_bin(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """NumPy-compatible uniform histogram bin of v on [lo, hi] (last bin closed;
    edges i*(hi-lo)/bins + lo); NULL when v is outside."""
    step = (hi - lo) / bins
    guess = F.least(F.floor((v - lo) * (F.lit(float(bins)) / (hi - lo))).cast("int"), F.lit(bins - 1))
    edge = lambda i: F.when(i >= bins, hi).otherwise(i * step + lo)
    g1 = F.when(v < edge(guess), guess - 1).otherwise(guess)
    g2 = F.when((v >= edge(g1 + 1)) & (g1 != bins - 1), g1 + 1).otherwise(g1)
    return F.when((v >= lo) & (v <= hi), g2)


def psi(ref: DataFrame, cur: DataFrame, cols, bins: int = 10, floor: float = 1e-10) -> DataFrame:
    """PSI with reference-range equal-width bins (F12: current values outside
    the reference range are dropped from the bins but kept in the total).
    Returns (feature, psi, out_of_range_frac)."""
    a, b = unpivot(ref, [], list(cols)), unpivot(cur, [], list(cols))
    st = psi_ranges(a.groupBy("feature").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"),
                                             F.count(F.lit(1)).alias("_na")))
    return psi_of(st, bin_counts(a, st, bins, "_ca"), b, bins, floor)


def psi_ranges(st: DataFrame) -> DataFrame:
    """(feature, _na, _lo, _hi): the histogram range; a constant column gets 0.5 on both sides."""
    flat = F.col("_lo") == F.col("_hi")
    return st.select("feature", "_na", F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
                     F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))


def bin_counts(long: DataFrame, st: DataFrame, bins: int, name: str, weight: str | None = None) -> DataFrame:
    """(feature, _bin, ``name``): values of a long table (with a column of counts,
    their counts) per histogram bin of ``st``."""
    at = hist_bin(F.col("value"), F.col("_lo"), F.col("_hi"), bins)
    return (long.join(F.broadcast(st.select("feature", "_lo", "_hi")), "feature")
            .groupBy("feature", at.alias("_bin")).agg(F.sum(F.col(weight) if weight else F.lit(1)).alias(name)))


def psi_of(st: DataFrame, ca: DataFrame, cur_long: DataFrame, bins: int = 10, floor: float = 1e-10) -> DataFrame:
    """PSI from the reference's ranges and bin counts and the current values."""
    st = st.join(cur_long.groupBy("feature").agg(F.count(F.lit(1)).alias("_nb")), "feature")
    cb = bin_counts(cur_long, st, bins, "_cb")
    dense = st.select("feature", "_na", "_nb", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("_bin"))
    j = dense.join(ca, ["feature", "_bin"], "left").join(cb, ["feature", "_bin"], "left")
    r = F.coalesce(F.col("_ca"), F.lit(0)) / F.col("_na")
    c = F.coalesce(F.col("_cb"), F.lit(0)) / F.col("_nb")
    r = F.when(r == 0, F.lit(floor)).otherwise(r)
    c = F.when(c == 0, F.lit(floor)).otherwise(c)
    oor = cb.where(F.col("_bin").isNull()).select("feature", F.col("_cb").alias("_oor"))
    out = j.groupBy("feature", "_nb").agg(F.sum((c - r) * F.log(c / r)).alias("psi"))
    return (out.join(oor, "feature", "left")
            .select("feature", "psi", (F.coalesce(F.col("_oor"), F.lit(0)) / F.col("_nb")).alias("out_of_range_frac")))


# ---- D3 chi-square ------------------------------------------------------------

def _unpivot_str(df: DataFrame, cols) -> DataFrame:
    stack = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, category)")


def chi2_drift(ref: DataFrame, cur: DataFrame, cols, *, compat: bool = False, floor: float = 1e-10) -> DataFrame:
    """Chi-square goodness of fit of current category counts against the
    reference shares rescaled to the current total. ``compat=True`` uses the
    reference's NULL-including row counts (F17). Features with fewer than two
    categories are skipped. Returns (feature, n_categories, chi2_statistic,
    dof, chi2_pvalue)."""
    return chi2_of(category_counts(ref, cols), category_counts(cur, cols), compat=compat, floor=floor)


def category_counts(df: DataFrame, cols) -> DataFrame:
    """(feature, category, n) of every value, NULL too."""
    return _unpivot_str(df, cols).groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))


def chi2_of(a: DataFrame, b: DataFrame, *, compat: bool = False, floor: float = 1e-10) -> DataFrame:
    """Chi-square of two tables of category counts (reference, current)."""
    known = F.col("category").isNotNull()
    part = F.sum(F.when(known, F.col("n")).otherwise(0))
    ta = a.groupBy("feature").agg(part.alias("_nna"), F.sum("n").alias("_lena"))
    tb = b.groupBy("feature").agg(part.alias("_nnb"), F.sum("n").alias("_lenb"))
    ca = a.where(known).withColumnRenamed("n", "_ca")
    cb = b.where(known).withColumnRenamed("n", "_cb")
    j = ca.join(cb, ["feature", "category"], "full").join(ta, "feature").join(tb, "feature")
    la = F.col("_lena") if compat else F.col("_nna")
    lb = F.col("_lenb") if compat else F.col("_nnb")
    j = j.withColumns({"_rf": F.coalesce(F.col("_ca"), F.lit(0)) / F.col("_nna") * la,
                       "_of": F.coalesce(F.col("_cb"), F.lit(0)) / F.col("_nnb") * lb})
    s = j.groupBy("feature").agg(F.count(F.lit(1)).alias("n_categories"), F.sum("_rf").alias("_te"),
                                 F.sum("_of").alias("_to"))
    j = j.join(s, "feature").where((F.col("n_categories") >= 2) & (F.col("_te") > 0))
    e = F.col("_rf") * (F.col("_to") / F.col("_te"))
    e = F.when(e > 0, F.greatest(e, F.lit(floor))).otherwise(F.lit(floor))
    out = j.groupBy("feature", "n_categories").agg(F.sum(F.pow(F.col("_of") - e, 2) / e).alias("chi2_statistic"))
    out = out.withColumn("dof", (F.col("n_categories") - 1).cast("int"))
    return out.withColumn("chi2_pvalue", chi2_sf("chi2_statistic", "dof"))


# ---- D4 Levene ------------------------------------------------------------------

def levene(df: DataFrame, value: str = "temp", group_col: str = "_grp", *, with_pvalue: bool = False) -> DataFrame:
    """Brown-Forsythe / Levene (median-centred) across ``group_col`` groups.
    Returns one row (k, n, levene_statistic[, levene_pvalue])."""
    d = df.select(F.col(group_col).alias("_g"), nan_to_null(F.col(value).cast("double")).alias("_x")).where(
        F.col("_x").isNotNull())
    med = exact_quantiles(d, ["_x"], [0.5], by=["_g"]).select("_g", F.col("q").alias("_med"))
    z = d.join(med, "_g").withColumn("_z", F.abs(F.col("_x") - F.col("_med")))
    g = z.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"), F.avg("_z").alias("_zm"),
                            F.sum(F.col("_z") * F.col("_z")).alias("_zz"))
    tot = g.agg(F.count(F.lit(1)).alias("k"), F.sum("_n").alias("n"),
                (F.sum(F.col("_n") * F.col("_zm")) / F.sum("_n")).alias("_zbar"),
                F.sum(F.col("_zz") - F.col("_n") * F.col("_zm") * F.col("_zm")).alias("_den"))
    # the totals are one row; groups stay a distributed table of any length
    near = g.select("_n", "_zm", F.lit(0).alias("_one")).join(F.broadcast(tot.withColumn("_one", F.lit(0))), "_one")
    between = F.sum(F.col("_n") * F.pow(F.col("_zm") - F.col("_zbar"), 2))
    tot = near.groupBy("k", "n", "_den").agg(between.alias("_num"))
    w = (F.col("n") - F.col("k")) / (F.col("k") - 1) * F.col("_num") / F.col("_den")
    out = tot.select(F.col("k").cast("long").alias("k"), F.col("n"), w.alias("levene_statistic"))
    if with_pvalue:
        out = out.withColumn("levene_pvalue", f_sf_udf(F.col("levene_statistic"), (F.col("k") - 1).cast("double"),
                                                       (F.col("n") - F.col("k")).cast("double")))
    return out


def quartile_groups(df: DataFrame, by: str = "cnt", name: str = "_grp") -> DataFrame:
    """Label rows by the quartile of ``by`` (<=q1, <=q2, <=q3, >q3), exact quantiles."""
    q = quantile_map(df, [by], [0.25, 0.5, 0.75])
    x = F.col(by)
    return df.withColumn(name, F.when(x <= q[(by, 0.25)], 0).when(x <= q[(by, 0.5)], 1)
                         .when(x <= q[(by, 0.75)], 2).otherwise(3))


# ---- D5 Anderson-Darling ----------------------------------------------------------

AD_SIGNIFICANCE = (15.0, 10.0, 5.0, 2.5, 1.0)
# FIXED VALUES: asymptotic critical values of the normal-case A^2 test
AD_CRITICAL = (0.576, 0.656, 0.787, 0.918, 1.092)


def anderson_darling(df: DataFrame, col: str = "cnt") -> DataFrame:
    """A^2 for normality (sample-std standardisation) with the finite-sample
    adjusted critical values. Ranks come from the cumulative value counts, so
    ties are handled exactly and no task sorts the whole column."""
    long = unpivot(df, [], [col])
    st = long.agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"), F.count(F.lit(1)).alias("_n")).first()
    m, s, n = st["_m"], st["_s"], st["_n"]
    cum = value_cumulative(long, ["feature"])
    # logs of both normal tails, exact however far a value lies out
    x = (F.col("value") - m) / s / math.sqrt(2.0)
    below, above = log_erfc(-x) - math.log(2.0), log_erfc(x) - math.log(2.0)
    hi, c = F.col("cum__c").cast("double"), F.col("_c").cast("double")
    lo = hi - c
    w1 = hi * hi - lo * lo                                   # sum of (2i-1) over ranks lo+1..hi
    w2 = c * (2 * n + 1) - (hi * (hi + 1) - lo * (lo + 1))   # sum of (2n-2i+1)
    contrib = w1 * below + w2 * above
    a2 = F.lit(-float(n)) - F.sum(contrib) / n
    res = cum.agg(a2.alias("ad_statistic")).withColumn("n", F.lit(n).cast("long"))
    adj = 1.0 + 4.0 / n - 25.0 / (n * n)
    for sig, cv in zip(AD_SIGNIFICANCE, AD_CRITICAL):
        res = res.withColumn(f"critical_{str(sig).replace('.', '_')}", F.lit(round(cv / adj, 3)))
    return res


# ---- D8 ACF / D6 Ljung-Box / D9 PACF / D10 ------------------------------------------

def acf(df: DataFrame, col: str, nlags: int = 336, *, series="series_id", order=ORDER, strategy="halo",
        half_cap: bool = True) -> DataFrame:
    """Autocorrelation per series up to ``nlags`` (denominator n, as
    statsmodels' default). Each row collects its previous ``nlags`` centred
    values in one bounded window frame (halo blocks for a long series);
    ``posexplode`` turns them into (lag, product) pairs that are summed per
    (series, lag) with map-side partial aggregation -- one expression instead
    of ``nlags`` window functions. With ``half_cap`` lags above n // 2 are
    dropped. Returns (series, lag, acf, n)."""
    st = df.groupBy(series).agg(F.avg(col).alias("_m"), F.count(col).alias("_n"))
    d = df.join(st, series).withColumn("_d", F.col(col) - F.col("_m"))
    # structs, as collect_list leaves NULLs out and places would shift
    build = lambda w: {"_prev": F.collect_list(F.struct(F.col("_d").alias("v"))).over(w.rowsBetween(-nlags, 0))}
    x = series_select(d, build, nlags, series=series, order=order, strategy=strategy)
    pe = x.select(series, "_n", "_d", F.size("_prev").alias("_sz"), F.posexplode("_prev").alias("_pos", "_v"))
    lag = (F.col("_sz") - 1 - F.col("_pos")).cast("int")
    prods = pe.groupBy(series, "_n", lag.alias("lag")).agg(F.sum(F.col("_d") * F.col("_v.v")).alias("_sk"))
    s0 = prods.where(F.col("lag") == 0).select(series, F.col("_sk").alias("_s0"))
    lags = st.select(series, "_n", F.explode(F.sequence(F.lit(0), F.lit(nlags))).alias("lag"))
    out = (lags.join(s0, series).join(prods.drop("_n"), [series, "lag"], "left")
           .select(series, F.col("lag").cast("int").alias("lag"),
                   (F.coalesce(F.col("_sk"), F.lit(0.0)) / F.col("_s0")).alias("acf"), F.col("_n").alias("n")))
    if half_cap:
        out = out.where(F.col("lag") <= F.floor(F.col("n") / 2))
    return out


def ljung_box(acf_df: DataFrame, lags=(1, 7, 14, 30), *, series="series_id") -> DataFrame:
    """Ljung-Box Q(h) = n(n+2) sum_{k<=h} r_k^2/(n-k) and chi-square(h) p-value."""
    h = F.explode(F.array(*[F.lit(x) for x in lags])).alias("h")
    a = acf_df.where(F.col("lag") >= 1).join(acf_df.select(series).distinct().select(series, h), series)
    a = a.where(F.col("lag") <= F.col("h"))
    q = a.groupBy(series, "h", "n").agg(
        (F.col("n") * (F.col("n") + 2) * F.sum(F.col("acf") * F.col("acf") / (F.col("n") - F.col("lag")))).alias("lb_stat"))
    return q.select(series, F.col("h").alias("lag"), "lb_stat", chi2_sf("lb_stat", "h").alias("lb_pvalue"))


def _pacf_group(pdf: pd.DataFrame) -> pd.DataFrame:
    """Durbin-Levinson on one series' ACF (<= nlags + 1 numbers)."""
    pdf = pdf.sort_values("lag")
    r = pdf["acf"].to_numpy(dtype=float)
    K = len(r) - 1
    out = [1.0]
    phi_prev = np.zeros(0)
    for k in range(1, K + 1):
        if k == 1:
            phikk = r[1]
            phi = np.array([phikk])
        else:
            num = r[k] - np.dot(phi_prev, r[1:k][::-1])
            den = 1.0 - np.dot(phi_prev, r[1:k])
            phikk = num / den if den != 0 else float("nan")
            phi = np.append(phi_prev - phikk * phi_prev[::-1], phikk)
        out.append(float(phikk))
        phi_prev = phi
    return pd.DataFrame({pdf.columns[0]: pdf.iloc[0, 0], "lag": np.arange(K + 1, dtype=np.int32), "pacf": out})


def pacf(acf_df: DataFrame, *, series="series_id") -> DataFrame:
    """PACF (Yule-Walker, biased autocovariance = statsmodels 'ywm') per
    series via Durbin-Levinson in ``applyInPandas``; each group holds only the
    series' ACF values (<= nlags + 1 rows). Returns (series, lag, pacf)."""
    sch = T.StructType([acf_df.schema[series], T.StructField("lag", T.IntegerType()),
                        T.StructField("pacf", T.DoubleType())])
    return acf_df.select(series, "lag", "acf").groupBy(series).applyInPandas(_pacf_group, sch)


# FIXED VALUES: seasonal and critical lags of the reference's lag recommendation
SEASONAL_LAGS = (1, 24, 48, 72, 168)
CRITICAL_LAGS = (1, 24, 168)


def recommend_lags(acf_df: DataFrame, pacf_df: DataFrame, *, series="series_id") -> DataFrame:
    """Significant ACF / PACF lags (|r| > 1.96 / sqrt(n)), strong ACF
    (> 0.3) and PACF (> 0.1) lags, the recommended set (strong PACF <= 168 plus
    the seasonal set) and the important set (recommended <= 72 with
    |PACF| > 0.15, plus the critical lags). One row per series, sorted arrays."""
    j = acf_df.join(pacf_df, [series, "lag"]).where(F.col("lag") >= 1)
    ci = 1.96 / F.sqrt(F.col("n"))
    L = F.col("lag")
    g = j.groupBy(series, "n").agg(
        F.sort_array(F.collect_list(F.when(F.abs("acf") > ci, L))).alias("significant_acf"),
        F.sort_array(F.collect_list(F.when(F.abs("pacf") > ci, L))).alias("significant_pacf"),
        F.sort_array(F.collect_list(F.when(F.abs("acf") > 0.3, L))).alias("high_acf"),
        F.sort_array(F.collect_list(F.when(F.abs("pacf") > 0.1, L))).alias("strong_pacf"),
        F.map_from_entries(F.collect_list(F.struct(L, F.col("pacf")))).alias("_pm"))
    seas = F.array(*[F.lit(x) for x in SEASONAL_LAGS])
    rec = F.array_sort(F.array_union(F.filter("strong_pacf", lambda x: x <= 168), seas))
    imp = F.array_sort(F.array_union(
        F.filter(rec, lambda x: (x <= 72) & (F.abs(F.col("_pm")[x]) > 0.15)),
        F.array(*[F.lit(x) for x in CRITICAL_LAGS])))
    return g.select(series, "n", "significant_acf", "significant_pacf", "high_acf", "strong_pacf",
                    rec.alias("recommended"), imp.alias("important"))


# ---- D7 KPSS / ADF --------------------------------------------------------------

# FIXED VALUES: KPSS level-stationarity critical values and their p-values
KPSS_CRIT = (0.347, 0.463, 0.574, 0.739)
KPSS_PVALS = (0.10, 0.05, 0.025, 0.01)


def _lag_products(d: DataFrame, col: str, L: int, *, series, order, strategy) -> DataFrame:
    """(series, i, p_i = sum_t x_t x_{t-i}) for i = 1..L: one bounded list
    frame per row, exploded and summed per (series, lag) with partial aggregation."""
    if L < 1:
        return d.sparkSession.createDataFrame([], T.StructType([d.schema[series], T.StructField("i", T.IntegerType()),
                                                              T.StructField("p", T.DoubleType())]))
    x = series_select(d, lambda w: {"_prev": F.collect_list(F.struct(F.col(col).alias("v"))).over(w.rowsBetween(-L, -1))}, L,
                      series=series, order=order, strategy=strategy)
    pe = x.select(series, F.col(col).alias("_x"), F.size("_prev").alias("_sz"), F.posexplode("_prev").alias("_pos", "_v"))
    s = pe.groupBy(series, (F.col("_sz") - F.col("_pos")).cast("int").alias("i")).agg(
        F.sum(F.col("_x") * F.col("_v.v")).alias("p"))
    lags = d.select(series).distinct().select(series, F.explode(F.sequence(F.lit(1), F.lit(L))).alias("i"))
    return lags.join(s, [series, "i"], "left").withColumn("p", F.coalesce("p", F.lit(0.0)))


def kpss(df: DataFrame, col: str = "cnt", *, series="series_id", order=ORDER, strategy="halo",
         block_rows: int = 4096) -> DataFrame:
    """KPSS level-stationarity test with the automatic (Hobijn et al.) lag.

    Partial sums of the demeaned series come from a blocked running sum; lag
    products from halo windows. Returns (series, n, kpss_stat, nlags, kpss_pvalue)."""
    from ..session import cut_lineage
    st = df.groupBy(series).agg(F.avg(col).alias("_m"), F.count(col).alias("n"))
    d = df.join(st, series).withColumn("_r", F.col(col).cast("double") - F.col("_m"))
    # several passes follow (lag choice, then statistics): index and write once
    d = cut_lineage(with_row_index(d, series, order, name="row_idx").select(series, "row_idx", "_r"))
    st = cut_lineage(st)
    cum = blocked_cumsum(d, ["_r"], partition=[series], order=["row_idx"],
                         block=F.floor(F.col("row_idx") / block_rows))
    ss = cum.groupBy(series).agg(F.sum(F.col("cum__r") * F.col("cum__r")).alias("_ss"),
                                 F.sum(F.col("_r") * F.col("_r")).alias("_rr"))
    nmax = st.agg(F.max("n")).first()[0] or 0
    L1 = int(math.pow(nmax, 2.0 / 9.0)) if nmax else 0  # pow is monotone: the largest lag any series needs
    p1 = _lag_products(d, "_r", L1, series=series, order=("row_idx",), strategy=strategy)
    base = ss.join(st.select(series, "n"), series)
    cov = F.floor(F.pow(F.col("n").cast("double"), F.lit(2.0 / 9.0)))
    pp = p1.join(base, series).where(F.col("i") <= cov).withColumn("_pr", F.col("p") / (F.col("n") / 2.0))
    s01 = pp.groupBy(series).agg(F.sum("_pr").alias("_s0p"), F.sum(F.col("i") * F.col("_pr")).alias("_s1"))
    auto = base.join(s01, series, "left").withColumn(
        "_s0", F.col("_rr") / F.col("n") + F.coalesce("_s0p", F.lit(0.0))).withColumn(
        "_shat", F.coalesce("_s1", F.lit(0.0)) / F.col("_s0")).withColumn(
        "nlags", F.least(F.floor(F.lit(1.1447) * F.pow(F.col("_shat") * F.col("_shat"), F.lit(1.0 / 3.0))
                                 * F.pow(F.col("n").cast("double"), F.lit(1.0 / 3.0))), F.col("n") - 1).cast("int"))
    L2 = auto.agg(F.max("nlags")).first()[0] or 0
    p2 = p1 if L2 <= L1 else _lag_products(d, "_r", L2, series=series, order=("row_idx",), strategy=strategy)
    lv = p2.join(auto.select(series, "nlags"), series).where(F.col("i") <= F.col("nlags")).groupBy(series).agg(
        F.sum(2 * F.col("p") * (1.0 - F.col("i") / (F.col("nlags") + 1.0))).alias("_lv"))
    res = auto.join(lv, series, "left").withColumn(
        "_sh", (F.col("_rr") + F.coalesce("_lv", F.lit(0.0))) / F.col("n")).withColumn(
        "kpss_stat", (F.col("_ss") / (F.col("n").cast("double") ** 2)) / F.col("_sh"))
    k = F.col("kpss_stat")
    c, pv = KPSS_CRIT, KPSS_PVALS
    interp = F.when(k <= c[0], pv[0])
    for i in range(3):
        interp = interp.when(k <= c[i + 1], pv[i] + (k - c[i]) * (pv[i + 1] - pv[i]) / (c[i + 1] - c[i]))
    res = res.withColumn("kpss_pvalue", interp.otherwise(pv[-1]))
    return res.select(series, "n", "kpss_stat", "nlags", "kpss_pvalue")


def _ols_stats(zz: np.ndarray, zy: np.ndarray, yy: float, n: float):
    b = np.linalg.solve(zz, zy)
    ssr = float(yy - 2 * b @ zy + b @ zz @ b)
    k = len(b)
    llf = -n / 2.0 * (math.log(2 * math.pi) + math.log(ssr / n) + 1)
    return b, ssr, -2 * llf + 2 * k, k


def adf(df: DataFrame, col: str = "cnt", *, series="series_id", order=ORDER, maxlag: int | None = None,
        autolag: str | None = "AIC", strategy="halo") -> DataFrame:
    """Augmented Dickey-Fuller (constant) with the AIC lag choice.

    Regressors [1, x_{t-1}, dx_{t-1..t-p}] come from one halo pass; the normal
    equations Z'Z, Z'y, y'y are one distributed aggregate per series and lag
    sample; the (p+2)-square solves run per series in ``applyInPandas`` over
    those sums. Returns (series, adf_stat, usedlag, nobs, icbest) and the
    asymptotic 1/5/10 % critical values."""
    from ..session import cut_lineage
    d = cut_lineage(with_row_index(df.select(series, *order, col), series, order, name="row_idx"))
    # lag range of each series by its own length; the widest one sets the columns
    n = F.count(col)
    own = F.lit(maxlag) if maxlag is not None else F.greatest(F.lit(0), F.least(
        F.floor(n / 2) - 2, F.ceil(F.lit(12.0) * F.pow(n / 100.0, F.lit(0.25)))))
    span = cut_lineage(d.groupBy(series).agg(own.cast("int").alias("_maxlag")))
    maxlag = span.agg(F.max("_maxlag")).first()[0] or 0
    d = d.join(span, series)

    def build(w):
        st1 = {"_dx": F.col(col) - F.lag(col, 1).over(w), "_x1": F.lag(col, 1).over(w).cast("double")}
        st2 = {f"_g{j}": F.lag("_dx", j).over(w) for j in range(1, maxlag + 1)}
        return [st1, st2] if maxlag else [st1]
    x = series_select(d, build, maxlag + 1, series=series, order=("row_idx",), strategy=strategy)
    regs = ["_one", "_x1"] + [f"_g{j}" for j in range(1, maxlag + 1)]
    x = x.withColumn("_one", F.lit(1.0))

    def sums(frame, cols):
        ag = [F.count(F.lit(1)).alias("_nobs"), F.sum(F.col("_dx") * F.col("_dx")).alias("_yy")]
        for i, a in enumerate(cols):
            ag.append(F.sum(F.col(a) * F.col("_dx")).alias(f"zy_{i}"))
            for j in range(i, len(cols)):
                ag.append(F.sum(F.col(a) * F.col(cols[j])).alias(f"zz_{i}_{j}"))
        return frame.groupBy(series, "_maxlag").agg(*ag)

    def unpack(r, k):
        zz = np.zeros((k, k))
        zy = np.zeros(k)
        for i in range(k):
            zy[i] = r[f"zy_{i}"]
            for j in range(i, k):
                zz[i, j] = zz[j, i] = r[f"zz_{i}_{j}"]
        return zz, zy

    full = sums(x.where(F.col("row_idx") >= F.col("_maxlag") + 1), regs)
    out_schema = T.StructType([df.schema[series], T.StructField("adf_stat", T.DoubleType()),
                               T.StructField("usedlag", T.IntegerType()), T.StructField("nobs", T.LongType()),
                               T.StructField("icbest", T.DoubleType())])

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        widest = int(r["_maxlag"])
        best, bestlag = None, widest
        if autolag:
            zz, zy = unpack(r, widest + 2)
            for p in range(0, widest + 1):
                k = p + 2
                _, _, aic, _ = _ols_stats(zz[:k, :k], zy[:k], r["_yy"], float(r["_nobs"]))
                if best is None or aic < best:
                    best, bestlag = aic, p
        return pd.DataFrame({series: [r[series]], "adf_stat": [float("nan")], "usedlag": [bestlag],
                             "nobs": [0], "icbest": [best if best is not None else float("nan")]})
    lag_choice = full.groupBy(series).applyInPandas(choose, out_schema).select(series, "usedlag", "icbest")
    # refit every series on its own sample (rows with all chosen lags present)
    x2 = x.join(lag_choice.select(series, "usedlag"), series).where(F.col("row_idx") >= F.col("usedlag") + 1)
    sub = sums(x2, regs).join(lag_choice, series)

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        p = int(r["usedlag"])
        k = p + 2
        zz, zy = unpack(r, k)
        n = float(r["_nobs"])
        b, ssr, _, _ = _ols_stats(zz[:k, :k], zy[:k], r["_yy"], n)
        cov = np.linalg.inv(zz[:k, :k]) * (ssr / (n - k))
        t = b[1] / math.sqrt(cov[1, 1])
        return pd.DataFrame({series: [r[series]], "adf_stat": [float(t)], "usedlag": [p],
                             "nobs": [int(n)], "icbest": [float(r["icbest"])]})
    out = sub.groupBy(series).applyInPandas(final, out_schema)
    # FIXED VALUES: asymptotic Dickey-Fuller critical values, constant only
    return out.withColumns({"crit_1pct": F.lit(-3.43), "crit_5pct": F.lit(-2.86), "crit_10pct": F.lit(-2.57)})


# ---- D11 transform lambda by likelihood ----------------------------------------------

def fit_lambda(df: DataFrame, col: str = "cnt", method: str = "boxcox", grid=None) -> DataFrame:
    """Box-Cox (of y + 1, so that counts of 0 stay in) or Yeo-Johnson
    log-likelihood on a lambda grid in ONE aggregation (population variance per
    lambda); returns (lambda, llf, is_best)."""
    grid = grid if grid is not None else [round(-2 + 0.05 * i, 2) for i in range(81)]
    x = F.col(col).cast("double")
    if method == "boxcox":
        x = x + 1.0
        d = df.where(x > 0)
        jac = F.sum(F.log(x))
    else:
        d = df.where(x.isNotNull())
        jac = F.sum(F.signum(x) * F.log1p(F.abs(x)))
    from .features import forward_expr
    ag = [F.count(F.lit(1)).alias("_n"), jac.alias("_j")]
    ag += [F.var_pop(forward_expr(x, method, l)).alias(f"_v{i}") for i, l in enumerate(grid)]
    w = d.agg(*ag)
    stack = ", ".join(f"CAST({l} AS DOUBLE), `_v{i}`" for i, l in enumerate(grid))
    long = w.selectExpr("_n", "_j", f"stack({len(grid)}, {stack}) AS (lambda, _v)")
    llf = (F.col("lambda") - 1) * F.col("_j") - F.col("_n") / 2.0 * F.log(F.col("_v"))
    long = long.select("lambda", llf.alias("llf"))
    best = long.agg(F.max_by("lambda", "llf").alias("_b"))
    return long.join(F.broadcast(best), F.col("lambda") == F.col("_b"), "left").select(
        "lambda", "llf", F.col("_b").isNotNull().alias("is_best"))


def best_lambda(df: DataFrame, col: str = "cnt", method: str = "boxcox") -> float:
    """The likeliest lambda to 1e-4: the grid, then twice a finer one around its best point."""
    lam, step = None, 0.05
    grid = None
    for _ in range(3):
        lam = fit_lambda(df, col, method, grid).where("is_best").first()["lambda"]
        grid = [round(lam + step * i / 20, 6) for i in range(-20, 21)]
        step /= 20
    return lam
