"""EDA queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import eda as E
from ..operators import features as FT
from ..sources import adapters as A
from .common import hourly_clean, hourly_split
from .core import query
from .sqlgen import stack_union
from .sqlviews import cte

DESC_COLS = ["temp", "atemp", "hum", "windspeed", "cnt", "casual", "registered"]
CORR_COLS = ["temp", "atemp", "hum", "windspeed", "hr", "weekday", "casual", "registered", "cnt"]


def _describe_sql(view, cols, by=None):
    g = f"{by}, " if by else ""
    gb = f" GROUP BY {by}" if by else ""
    parts = [f"SELECT {g}'{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean, "
             f"round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min, "
             f"round(CAST(max({c}) AS DOUBLE), 6) AS max, round(quantile_cont({c}, 0.25), 6) AS q25, "
             f"round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q75 "
             f"FROM {view}{gb}" for c in cols]
    return cte(view) + "\n" + stack_union(parts)


@query("eda_describe", _describe_sql("hourly", DESC_COLS))
def q_describe(spark, sf_dir):
    """A1 / V4: count, mean, std, min, quartiles (exact, linear), max per column."""
    return E.describe(A.hourly(spark, sf_dir), DESC_COLS)


@query("eda_describe_by_series", _describe_sql("hourly_by_type", ["cnt", "temp"], "series_id"))
def q_describe_by(spark, sf_dir):
    """A1 per keyed series (grouped exact quantiles)."""
    return E.describe(A.hourly_by_type(spark, sf_dir), ["cnt", "temp"], by=["series_id"])


@query("eda_daily_profile", cte("hourly") + """,
wc AS (SELECT series_id, dteday, weathersit, count(*) AS c FROM hourly GROUP BY 1, 2, 3),
wm AS (SELECT series_id, dteday, weathersit FROM (SELECT *, row_number() OVER (PARTITION BY series_id, dteday
        ORDER BY c DESC, weathersit) AS rn FROM wc) t WHERE rn = 1),
d AS (SELECT series_id, dteday, CAST(sum(cnt) AS BIGINT) AS cnt, round(avg(temp), 6) AS temp, max(holiday) AS holiday,
        arg_min(weekday, "timestamp") AS weekday FROM hourly GROUP BY 1, 2)
SELECT d.*, wm.weathersit FROM d JOIN wm USING (series_id, dteday)""")
def q_daily(spark, sf_dir):
    """A2 / A3: daily totals with mean temp, modal weather (lowest on ties),
    max holiday and the weekday of the first hour."""
    return E.daily_profile(A.hourly(spark, sf_dir))


@query("eda_profile_by_year", cte("hourly") + """
SELECT yr, round(avg(cnt), 6) AS cnt_mean, round(median(cnt), 6) AS cnt_median, CAST(sum(cnt) AS BIGINT) AS cnt_sum,
  count(cnt) AS cnt_count FROM hourly GROUP BY yr""")
def q_by_year(spark, sf_dir):
    """A4: mean / median / sum / count of cnt by year."""
    return E.profile_by(A.hourly(spark, sf_dir), ["yr"], "cnt", ("mean", "median", "sum", "count"))


@query("eda_profile_hour_workingday", cte("hourly") + """
SELECT hr, workingday, round(avg(cnt), 6) AS cnt_mean FROM hourly GROUP BY 1, 2""")
def q_hr_wd(spark, sf_dir):
    """A4: mean demand by hour x working day."""
    return E.profile_by(A.hourly(spark, sf_dir), ["hr", "workingday"], "cnt", ("mean",))


SETS = [["hr"], ["weekday"], ["hr", "workingday"], ["weathersit"], ["season", "hr"], ["weathersit", "hr"]]


@query("eda_profile_sets", cte("hourly") + """
SELECT hr, season, weathersit, weekday, workingday, round(avg(cnt), 6) AS cnt_mean, count(*) AS n,
  CAST(GROUPING(hr, season, weathersit, weekday, workingday) AS INTEGER) AS gid
FROM hourly GROUP BY GROUPING SETS ((hr), (weekday), (hr, workingday), (weathersit), (season, hr), (weathersit, hr))""")
def q_sets(spark, sf_dir):
    """A5: all A4 profiles in one scan (GROUPING SETS + grouping_id)."""
    return E.profile_sets(A.hourly(spark, sf_dir), SETS).withColumn("gid", F.col("gid").cast("int"))


@query("eda_pivot_hour_weekday", cte("hourly") + "\nSELECT hr, " + ", ".join(
    f"round(avg(cnt) FILTER (WHERE weekday = {d}), 6) AS \"{d}\"" for d in range(7)) + " FROM hourly GROUP BY hr")
def q_pivot(spark, sf_dir):
    """Mean demand pivot hour x weekday (explicit values 0..6)."""
    return E.pivot_mean(A.hourly(spark, sf_dir), "hr", "weekday", "cnt", range(7))


@query("eda_crosstab_weather_season", cte("hourly") + "\nSELECT weathersit, " + ", ".join(
    f"round(count(*) FILTER (WHERE season = {s}) * 100.0 / count(*), 6) AS \"{s}\"" for s in range(1, 5))
    + " FROM hourly GROUP BY weathersit")
def q_crosstab(spark, sf_dir):
    """Row-normalised crosstab weathersit x season (percent)."""
    return E.crosstab(A.hourly(spark, sf_dir), "weathersit", "season", range(1, 5), normalize=True)


def _corr_sql():
    parts = []
    for i, a in enumerate(CORR_COLS):
        for b in CORR_COLS[i:]:
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM hourly")
            if a != b:
                parts.append(f"SELECT '{b}' AS a, '{a}' AS b, round(corr({a}, {b}), 6) AS corr FROM hourly")
    return cte("hourly") + "\n" + stack_union(parts)


@query("eda_corr_matrix", _corr_sql())
def q_corr(spark, sf_dir):
    """Full correlation matrix (long form) in one aggregation pass."""
    return E.corr_matrix(A.hourly(spark, sf_dir), CORR_COLS)


@query("eda_part_share_by_hour", cte("hsplit") + """
SELECT hr, CAST(sum(casual) AS BIGINT) AS casual_sum, CAST(sum(registered) AS BIGINT) AS registered_sum, round(avg(casual), 6) AS casual_mean,
  round(avg(registered), 6) AS registered_mean, CAST(sum(cnt) AS BIGINT) AS cnt_sum,
  round(sum(casual) * 100.0 / sum(cnt), 6) AS casual_share, round(sum(registered) * 100.0 / sum(cnt), 6) AS registered_share
FROM hsplit GROUP BY hr""")
def q_share(spark, sf_dir):
    """Casual / registered totals, means and shares by hour."""
    return E.part_share(hourly_clean(spark, sf_dir), ["hr"])


@query("eda_day_type_stats", cte("hourly") + """,
d AS (SELECT *, CASE WHEN weekday IN (0, 6) THEN 'Fin de Semana' WHEN holiday = 1 THEN 'Festivo' ELSE 'Laboral' END AS day_type FROM hourly)
SELECT day_type, CASE day_type WHEN 'Laboral' THEN 0 WHEN 'Fin de Semana' THEN 1 ELSE 2 END AS report_order,
  round(round(avg(cnt), 2), 6) AS mean, round(round(median(cnt), 2), 6) AS median, round(round(stddev_samp(cnt), 2), 6) AS std,
  count(cnt) AS count, round(stddev_samp(cnt) / avg(cnt), 6) AS cv FROM d GROUP BY day_type""")
def q_daytype(spark, sf_dir):
    """A10: per day type mean / median / std / count (2 digits) and CV."""
    return E.day_type_stats(A.hourly(spark, sf_dir))


@query("eda_quadrant_stats", cte("hsplit") + """,
med AS (SELECT quantile_cont(temp, 0.5) AS mt, quantile_cont(hum, 0.5) AS mh FROM hsplit WHERE split = 'train'),
q AS (SELECT cnt, CASE WHEN temp >= mt AND hum >= mh THEN 'hot_humid' WHEN temp >= mt THEN 'hot_dry'
        WHEN hum >= mh THEN 'cold_humid' ELSE 'cold_dry' END AS weather_quadrant FROM hsplit, med),
s AS (SELECT weather_quadrant, avg(cnt) AS mean, count(*) AS count FROM q GROUP BY 1)
SELECT weather_quadrant, round(mean, 6) AS mean, count,
  (SELECT arg_max(weather_quadrant, mean) FROM s) AS best, (SELECT arg_min(weather_quadrant, mean) FROM s) AS worst,
  round((SELECT max(mean) / min(mean) FROM s), 6) AS best_worst_ratio FROM s""")
def q_quadstats(spark, sf_dir):
    """Demand per weather quadrant (train medians), best / worst ratio."""
    hs = hourly_split(spark, sf_dir)
    med = FT.fit_medians(hs.where(F.col("split") == "train"))
    return E.quadrant_stats(FT.weather_quadrant(hs, med))


@query("eda_top_days", cte("hourly") + """,
d AS (SELECT dteday, CAST(sum(cnt) AS BIGINT) AS cnt FROM hourly GROUP BY 1)
(SELECT dteday, cnt, 'top' AS kind FROM d ORDER BY cnt DESC, dteday LIMIT 10)
UNION ALL (SELECT dteday, cnt, 'bottom' AS kind FROM d ORDER BY cnt, dteday LIMIT 5)""")
def q_topdays(spark, sf_dir):
    """Top-10 and bottom-5 days by total demand (the limit is the feature)."""
    d = E.daily(A.hourly(spark, sf_dir)).drop("series_id")
    top = E.top_k(d, "cnt", 10, tiebreak=("dteday",)).withColumn("kind", F.lit("top"))
    bot = E.top_k(d, "cnt", 5, ascending=True, tiebreak=("dteday",)).withColumn("kind", F.lit("bottom"))
    return top.unionByName(bot)


@query("eda_top_hours_per_series", cte("hourly_by_type") + """
SELECT series_id, row_id, cnt, rank FROM (SELECT series_id, row_id, cnt,
  CAST(row_number() OVER (PARTITION BY series_id ORDER BY cnt DESC, row_id) AS INTEGER) AS rank FROM hourly_by_type) t
WHERE rank <= 3""")
def q_tophours(spark, sf_dir):
    """A12 per series: 3 busiest hours of each keyed series (two-stage rank)."""
    h = A.hourly_by_type(spark, sf_dir)
    return E.top_k(h, "cnt", 3, by=["series_id"], tiebreak=("row_id",)).select("series_id", "row_id", "cnt", "rank")


@query("eda_argmax_hour", cte("hourly_by_type") + """,
p AS (SELECT series_id, hr, avg(cnt) AS m FROM hourly_by_type GROUP BY 1, 2)
SELECT series_id, first(hr ORDER BY m DESC, hr) AS argmax_hr, first(hr ORDER BY m, hr) AS argmin_hr, round(max(m), 6) AS max_m,
  round(min(m), 6) AS min_m FROM p GROUP BY 1""")
def q_argmax(spark, sf_dir):
    """Hour with the highest / lowest mean demand per series."""
    p = E.profile_by(A.hourly_by_type(spark, sf_dir), ["series_id", "hr"], "cnt", ("mean",)).withColumnRenamed(
        "cnt_mean", "m")
    return E.argmax(p, "hr", "m", by=["series_id"])


DAILY_PROF_SQL = """,
wc AS (SELECT dteday, weathersit, count(*) AS c FROM hourly GROUP BY 1, 2),
wm AS (SELECT dteday, weathersit FROM (SELECT *, row_number() OVER (PARTITION BY dteday ORDER BY c DESC, weathersit) AS rn
        FROM wc) t WHERE rn = 1),
dp AS (SELECT d.*, wm.weathersit FROM (SELECT dteday, CAST(sum(cnt) AS BIGINT) AS cnt, avg(temp) AS temp, max(holiday) AS holiday,
        arg_min(weekday, "timestamp") AS weekday FROM hourly GROUP BY 1) d JOIN wm USING (dteday)),
ex AS ((SELECT *, 'high' AS label FROM dp ORDER BY cnt DESC, dteday LIMIT 10)
       UNION ALL (SELECT *, 'low' AS label FROM dp ORDER BY cnt, dteday LIMIT 10))"""


@query("eda_extreme_compare", cte("hourly") + DAILY_PROF_SQL + """,
wmode AS (SELECT label, weathersit FROM (SELECT label, weathersit, row_number() OVER (PARTITION BY label
          ORDER BY count(*) DESC, weathersit) AS rn FROM ex GROUP BY 1, 2) t WHERE rn = 1)
SELECT e.label, round(avg(temp), 6) AS temp_mean, any_value(wmode.weathersit) AS weathersit_mode,
  round(count(*) FILTER (WHERE weekday IN (5, 6)) * 100.0 / count(*), 6) AS weekend_pct,
  count(*) FILTER (WHERE holiday = 1) AS holidays
FROM ex e JOIN wmode USING (label) GROUP BY e.label""")
def q_extreme(spark, sf_dir):
    """Top-10 vs bottom-10 days: mean temp, modal weather, weekend %, holidays."""
    dp = E.daily_profile(A.hourly(spark, sf_dir)).drop("series_id")
    return E.extreme_compare(dp, 10)


@query("eda_extreme_curves", cte("hourly") + DAILY_PROF_SQL + """
SELECT label, hr, round(avg(cnt), 6) AS mean FROM hourly JOIN (SELECT dteday, label FROM ex) x USING (dteday) GROUP BY 1, 2
UNION ALL SELECT 'all' AS label, hr, round(avg(cnt), 6) AS mean FROM hourly GROUP BY 2""")
def q_curves(spark, sf_dir):
    """Hourly demand curve of high days, low days and all days."""
    h = A.hourly(spark, sf_dir)
    dp = E.daily_profile(h).drop("series_id")
    return E.extreme_curves(h, dp, 10)


@query("eda_holiday_stats", cte("hourly") + """
SELECT CAST(sum(holiday) AS BIGINT) AS holiday_rows, count(*) AS rows, count(DISTINCT CASE WHEN holiday = 1 THEN dteday END) AS holiday_dates,
  round(sum(holiday) * 100.0 / count(*), 6) AS holiday_pct FROM hourly""")
def q_holiday(spark, sf_dir):
    """Holiday rows, share and distinct holiday dates."""
    return E.holiday_stats(A.hourly(spark, sf_dir)).withColumn("holiday_rows", F.col("holiday_rows").cast("long"))


@query("eda_holiday_dates", cte("hourly") + """
SELECT dteday, round(avg(cnt), 6) AS mean FROM hourly WHERE holiday = 1 GROUP BY 1""")
def q_holdates(spark, sf_dir):
    """Mean demand per holiday date."""
    return E.holiday_dates(A.hourly(spark, sf_dir))


def _iqr_sql():
    parts = [f"SELECT '{c}' AS feature, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, "
             f"count({c}) AS n FROM hourly" for c in DESC_COLS]
    cnts = [f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM hourly WHERE {c} IS NOT NULL" for c in DESC_COLS]
    return (cte("hourly") + ",\nq AS (" + stack_union(parts) + "),\nb AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower, "
            "q3 + 1.5 * (q3 - q1) AS upper FROM q),\nv AS (" + stack_union(cnts) + ")\n"
            "SELECT b.feature, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lower, 6) AS lower, round(upper, 6) AS upper, "
            "count(*) FILTER (WHERE value < lower OR value > upper) AS n_outliers, count(*) AS n, "
            "round(count(*) FILTER (WHERE value < lower OR value > upper) * 100.0 / count(*), 6) AS pct "
            "FROM v JOIN b USING (feature) GROUP BY b.feature, q1, q3, lower, upper")


@query("eda_iqr_outliers", _iqr_sql())
def q_iqr(spark, sf_dir):
    """IQR (1.5x) outlier bounds, count and percent per column."""
    return E.iqr_outliers(A.hourly(spark, sf_dir), DESC_COLS)


@query("eda_zscore_daily", cte("daily_orders") + """,
s AS (SELECT series_id, avg(cnt) AS m, stddev_pop(cnt) AS sd FROM daily_orders GROUP BY 1)
SELECT d.series_id, d.dteday, d.cnt, round((cnt - m) / sd, 6) AS z FROM daily_orders d JOIN s USING (series_id)
WHERE sd > 0 AND abs((cnt - m) / sd) > 2.5""")
def q_z(spark, sf_dir):
    """Days with |z| > 2.5 (population std) in the daily order series."""
    return E.zscore_anomalies(A.daily_orders(spark, sf_dir), "cnt", 2.5).select("series_id", "dteday", "cnt", "z")


VR_COLS = ["temp", "atemp", "hum", "windspeed", "cnt"]


def _vr_sql(view):
    parts = [f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {view}" for c in VR_COLS]
    return (",\nv AS (" + stack_union(parts) + "),\n"
            "st AS (SELECT feature, count(value) AS count, min(value) AS min, max(value) AS max, avg(value) AS mean, "
            "stddev_samp(value) AS std, count(*) FILTER (WHERE value IS NULL) AS nulls FROM v GROUP BY 1),\n"
            "o AS (SELECT v.feature, value, coalesce(count >= 3 AND abs((value - mean) / std) > 3, FALSE) AS o "
            "FROM v JOIN st USING (feature) WHERE value IS NOT NULL),\n"
            "cl AS (SELECT feature, count(*) FILTER (WHERE o) AS outliers, min(value) FILTER (WHERE NOT o) AS min_clean, "
            "max(value) FILTER (WHERE NOT o) AS max_clean, avg(value) FILTER (WHERE NOT o) AS mean_clean FROM o GROUP BY 1),\n"
            "r AS (SELECT st.*, outliers, coalesce(min_clean, min) AS min_clean, coalesce(max_clean, max) AS max_clean, "
            "coalesce(mean_clean, mean) AS mean_clean FROM st JOIN cl USING (feature))")


@query("eda_verify_ranges", cte("hourly") + _vr_sql("hourly") + """
SELECT feature, count, round(min, 6) AS min, round(max, 6) AS max, round(mean, 6) AS mean, round(std, 6) AS std,
  outliers, round(min_clean, 6) AS min_clean, round(max_clean, 6) AS max_clean, round(mean_clean, 6) AS mean_clean,
  nulls, min_clean >= -0.1 AND max_clean <= 1.1 AS is_normalized FROM r""")
def q_vr(spark, sf_dir):
    """Ranges, z>3 outliers (sample std), clean ranges and normalised flag."""
    return E.verify_ranges(A.hourly(spark, sf_dir), VR_COLS).select(
        "feature", "count", "min", "max", "mean", "std", "outliers", "min_clean", "max_clean", "mean_clean",
        "nulls", "is_normalized")


def _vr_named(view, p):
    return (_vr_sql(view).replace("v AS (", f"{p}v AS (").replace("FROM v ", f"FROM {p}v ")
            .replace("st AS (", f"{p}st AS (").replace("JOIN st ", f"JOIN {p}st ").replace("o AS (", f"{p}o AS (")
            .replace("FROM o ", f"FROM {p}o ").replace("cl AS (", f"{p}cl AS (").replace("r AS (SELECT st.*", f"{p}r AS (SELECT {p}st.*")
            .replace("FROM st JOIN cl", f"FROM {p}st JOIN {p}cl").replace("SELECT v.feature", f"SELECT {p}v.feature"))


@query("eda_compare_ranges", cte("hourly") + """,
proc AS (SELECT least(greatest(temp, 0), 1) AS temp, least(greatest(atemp, 0), 1) AS atemp,
  least(greatest(hum, 0), 1) AS hum, least(greatest(windspeed, 0), 1) AS windspeed, cnt FROM hourly)"""
       + _vr_named("hourly", "a_") + _vr_named("proc", "b_") + """
SELECT a.feature, round(a.min_clean, 6) AS raw_min, round(a.max_clean, 6) AS raw_max, round(b.min_clean, 6) AS proc_min,
  round(b.max_clean, 6) AS proc_max,
  NOT (abs(a.min_clean - b.min_clean) < 0.001 AND abs(a.max_clean - b.max_clean) < 0.001) AS changed
FROM a_r a JOIN b_r b USING (feature)""")
def q_cmp(spark, sf_dir):
    """Clean ranges of the raw table vs the range-repaired table."""
    h = A.hourly(spark, sf_dir)
    raw = E.verify_ranges(h, VR_COLS)
    proc = E.verify_ranges(C.repair_ranges(h), VR_COLS)
    return E.compare_ranges(raw, proc)


def _integrity_sql():
    exp = E.EXPECTED_VALUES
    rows = ["SELECT 'sum_mismatches' AS \"check\", CAST(count(*) FILTER (WHERE cnt <> casual + registered) AS VARCHAR) AS value, "
            "count(*) FILTER (WHERE cnt <> casual + registered) = 0 AS ok FROM hourly",
            "SELECT 'workingday_inconsistent' AS \"check\", CAST(count(*) FILTER (WHERE (weekday IN (0, 6) OR holiday = 1) "
            "AND workingday = 1) AS VARCHAR) AS value, count(*) FILTER (WHERE (weekday IN (0, 6) OR holiday = 1) "
            "AND workingday = 1) = 0 AS ok FROM hourly"]
    for c in ("temp", "atemp", "hum", "windspeed"):
        rows.append(f"SELECT 'in_0_1_{c}' AS \"check\", CASE WHEN min({c}) >= 0 AND max({c}) <= 1 THEN 'true' ELSE 'false' END "
                    f"AS value, min({c}) >= 0 AND max({c}) <= 1 AS ok FROM hourly")
    for c, vals in exp.items():
        lst = ", ".join(str(v) for v in vals)
        rows.append(f"SELECT 'categories_{c}' AS \"check\", array_to_string(list_sort(list(DISTINCT CAST({c} AS INTEGER))), ',') "
                    f"AS value, list_sort(list(DISTINCT CAST({c} AS INTEGER))) = [{lst}] AS ok FROM hourly")
    return cte("hourly") + "\n" + stack_union(rows)


@query("eda_integrity_report", _integrity_sql())
def q_integrity(spark, sf_dir):
    """Part-sum mismatches, [0, 1] checks, category sets, workingday consistency."""
    return E.integrity_report(A.hourly(spark, sf_dir))


@query("eda_moments", cte("hourly") + "\n" + stack_union(
    [f"SELECT '{c}' AS feature, count({c}) AS n, round(skewness({c}), 6) AS skew, round(kurtosis({c}), 6) AS kurt FROM hourly"
     for c in DESC_COLS]))
def q_moments(spark, sf_dir):
    """Bias-corrected skewness and excess kurtosis per column."""
    return E.moments(A.hourly(spark, sf_dir), DESC_COLS)


@query("eda_crosstab_counts", cte("hourly") + "\nSELECT hr, " + ", ".join(
    f"count(*) FILTER (WHERE weathersit = {w}) AS \"{w}\"" for w in range(1, 5)) + " FROM hourly GROUP BY hr")
def q_crosstab_counts(spark, sf_dir):
    """Crosstab counts hour x weathersit (explicit values 1..4, missing -> 0)."""
    return E.crosstab(A.hourly(spark, sf_dir), "hr", "weathersit", range(1, 5))


@query("eda_corr_with_target", cte("hourly") + "\n" + stack_union(
    [f"SELECT '{c}' AS feature, round(corr({c}, cnt), 6) AS corr FROM hourly" for c in CORR_COLS if c != "cnt"]))
def q_corr_target(spark, sf_dir):
    """Correlation of each column with cnt (sorted by |r|)."""
    return E.corr_with_target(A.hourly(spark, sf_dir), [c for c in CORR_COLS if c != "cnt"])
