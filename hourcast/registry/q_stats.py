"""Statistical-test and series-diagnostic queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT
from ..operators import stats as D
from ..sources import adapters as A
from .common import hourly_clean
from .core import query
from .sqlgen import chi2_sf_sql, hist_bin_sql, kolmogorov_sql, stack_union
from .sqlviews import VIEWS, cte

DRIFT_COLS = ["value", "k"]


def _ks_sql():
    u = stack_union([f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, {t} AS t FROM {src} WHERE {c} IS NOT NULL"
                     for c in DRIFT_COLS for t, src in ((0, "drift_ref"), (1, "drift_cur"))])
    z = "sqrt(n_ref * n_cur / CAST(n_ref + n_cur AS DOUBLE)) * d"
    return (cte("drift_ref", "drift_cur") + f",\nu AS ({u}),\n"
            "c AS (SELECT feature, v, count(*) FILTER (WHERE t = 0) AS na, count(*) FILTER (WHERE t = 1) AS nb FROM u GROUP BY 1, 2),\n"
            "cu AS (SELECT feature, sum(na) OVER w AS ca, sum(nb) OVER w AS cb, sum(na) OVER (PARTITION BY feature) AS ta, "
            "sum(nb) OVER (PARTITION BY feature) AS tb FROM c WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)),\n"
            "g AS (SELECT feature, CAST(max(ta) AS BIGINT) AS n_ref, CAST(max(tb) AS BIGINT) AS n_cur, max(abs(ca / ta - cb / tb)) AS d FROM cu GROUP BY 1)\n"
            f"SELECT feature, n_ref, n_cur, round(d, 6) AS ks_statistic, round({kolmogorov_sql(z)}, 6) AS ks_pvalue FROM g")


@query("stats_ks_drift", _ks_sql())
def q_ks(spark, sf_dir):
    """Two-sample KS (exact statistic, asymptotic p) first vs second half."""
    ref, cur = A.drift_pair(spark, sf_dir)
    return D.ks_2samp(ref, cur, DRIFT_COLS)


def _psi_sql():
    a = stack_union([f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM drift_ref WHERE {c} IS NOT NULL" for c in DRIFT_COLS])
    b = stack_union([f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM drift_cur WHERE {c} IS NOT NULL" for c in DRIFT_COLS])
    bn = hist_bin_sql("v", "lo", "hi", 10)
    r = "(CASE WHEN coalesce(ca, 0) = 0 THEN 1e-10 ELSE ca / na END)"
    c = "(CASE WHEN coalesce(cb, 0) = 0 THEN 1e-10 ELSE cb / nb END)"
    return (cte("drift_ref", "drift_cur") + f",\na AS ({a}),\nb AS ({b}),\n"
            "st0 AS (SELECT feature, min(v) AS mn, max(v) AS mx, count(*) AS na FROM a GROUP BY 1),\n"
            "st AS (SELECT feature, na, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi, "
            "(SELECT count(*) FROM b WHERE b.feature = st0.feature) AS nb FROM st0),\n"
            f"ba AS (SELECT a.feature, {bn} AS bin FROM a JOIN st USING (feature)),\n"
            f"bb AS (SELECT b.feature, {bn} AS bin FROM b JOIN st USING (feature)),\n"
            "ca AS (SELECT feature, bin, count(*) AS ca FROM ba GROUP BY 1, 2),\n"
            "cb AS (SELECT feature, bin, count(*) AS cb FROM bb GROUP BY 1, 2),\n"
            "dense AS (SELECT feature, na, nb, unnest(range(0, 10)) AS bin FROM st)\n"
            f"SELECT d.feature, round(sum(({c} - {r}) * ln({c} / {r})), 6) AS psi, "
            "round(coalesce(max(o.oor), 0) / max(nb), 6) AS out_of_range_frac "
            "FROM dense d LEFT JOIN ca USING (feature, bin) LEFT JOIN cb USING (feature, bin) "
            "LEFT JOIN (SELECT feature, cb AS oor FROM cb WHERE bin IS NULL) o ON o.feature = d.feature GROUP BY d.feature")


@query("stats_psi_drift", _psi_sql())
def q_psi(spark, sf_dir):
    """PSI over 10 reference-range bins (F12 out-of-range rule)."""
    ref, cur = A.drift_pair(spark, sf_dir)
    return D.psi(ref, cur, DRIFT_COLS)


def _chi2_sql():
    x = "chi2_statistic"
    return (cte("drift_ref", "drift_cur") + """,
ca AS (SELECT event_type AS category, count(*) AS ca FROM drift_ref WHERE event_type IS NOT NULL GROUP BY 1),
cb AS (SELECT event_type AS category, count(*) AS cb FROM drift_cur WHERE event_type IS NOT NULL GROUP BY 1),
ta AS (SELECT count(event_type) AS nna FROM drift_ref), tb AS (SELECT count(event_type) AS nnb FROM drift_cur),
j AS (SELECT coalesce(ca, 0) / nna * nna AS rf, coalesce(cb, 0) / nnb * nnb AS obs FROM ca FULL OUTER JOIN cb USING (category), ta, tb),
s AS (SELECT count(*) AS n_categories, sum(rf) AS te, sum(obs) AS tobs FROM j),
e AS (SELECT obs, CASE WHEN rf * (tobs / te) > 0 THEN greatest(rf * (tobs / te), 1e-10) ELSE 1e-10 END AS ex, n_categories FROM j, s)
SELECT 'event_type' AS feature, n_categories, round(chi2_statistic, 6) AS chi2_statistic, dof, round("""
            + chi2_sf_sql(x, "dof") + """, 6) AS chi2_pvalue
FROM (SELECT n_categories, sum(pow(obs - ex, 2) / ex) AS chi2_statistic, CAST(n_categories - 1 AS INTEGER) AS dof
      FROM e GROUP BY n_categories) t""")


@query("stats_chi2_drift", _chi2_sql())
def q_chi2(spark, sf_dir):
    """D3: chi-square of event-type shares, current vs reference period."""
    ref, cur = A.drift_pair(spark, sf_dir)
    return D.chi2_drift(ref, cur, ["event_type"])


def detect_sql(digits: int = 6, cur: str | None = None):
    """The drift report per feature (V1) from the three tests' SQL; ``cur``: the
    rows of the current side, if not the second half of the events."""
    def part(sql):
        sql = sql.replace(", 6)", ", 15)")
        return sql.replace(VIEWS["drift_cur"], f"drift_cur AS ({cur})") if cur else sql
    views = part(cte("drift_ref", "drift_cur"))
    r = lambda x: f"round({x}, {digits}) AS {x}"
    none = lambda *names: ", ".join(f"CAST(NULL AS DOUBLE) AS {x}" for x in names)
    side = lambda s, v: stack_union([f"SELECT '{c}' AS feature, avg({c}) AS {s}_mean, stddev_samp({c}) AS {s}_std FROM {v}" for c in DRIFT_COLS])
    return (f"{views}, ks AS ({part(_ks_sql())}), ps AS ({part(_psi_sql())}), ch AS ({part(_chi2_sql())}),\n"
            f"mr AS ({side('ref', 'drift_ref')}), mc AS ({side('curr', 'drift_cur')})\n"
            f"SELECT feature, 'continuous' AS type, ks_pvalue < {DEFAULT.drift_threshold} OR psi >= {DEFAULT.psi_threshold} AS has_drift, {r('ks_statistic')}, {r('ks_pvalue')}, {r('psi')}, "
            f"{none('chi2_statistic', 'chi2_pvalue')}, {r('ref_mean')}, {r('curr_mean')}, {r('ref_std')}, {r('curr_std')} "
            "FROM ks JOIN ps USING (feature) JOIN mr USING (feature) JOIN mc USING (feature)\n"
            f"UNION ALL SELECT feature, 'categorical', chi2_pvalue < {DEFAULT.drift_threshold}, {none('a', 'b', 'c')}, {r('chi2_statistic')}, {r('chi2_pvalue')}, "
            f"{none('d', 'e', 'f', 'g')} FROM ch")


LEVENE_SQL = cte("hsplit") + """,
q AS (SELECT quantile_cont(cnt, 0.25) AS q1, quantile_cont(cnt, 0.5) AS q2, quantile_cont(cnt, 0.75) AS q3 FROM hsplit),
g AS (SELECT CASE WHEN cnt <= q1 THEN 0 WHEN cnt <= q2 THEN 1 WHEN cnt <= q3 THEN 2 ELSE 3 END AS grp, temp FROM hsplit, q),
m AS (SELECT grp, quantile_cont(temp, 0.5) AS med FROM g GROUP BY 1),
z AS (SELECT grp, abs(temp - med) AS z FROM g JOIN m USING (grp)),
gs AS (SELECT grp, count(*) AS n, avg(z) AS zm, sum(z * z) AS zz FROM z GROUP BY 1),
t AS (SELECT count(*) AS k, sum(n) AS n, sum(n * zm) / sum(n) AS zbar, sum(zz - n * zm * zm) AS den FROM gs)
SELECT k, CAST(n AS BIGINT) AS n, round((n - k) / CAST(k - 1 AS DOUBLE) * (SELECT sum(gs.n * pow(zm - zbar, 2)) FROM gs) / den, 6)
  AS levene_statistic FROM t"""


@query("stats_levene_quartiles", LEVENE_SQL)
def q_levene(spark, sf_dir):
    """Levene (median-centred) of temperature across demand quartiles."""
    return D.levene(D.quartile_groups(hourly_clean(spark, sf_dir), "cnt"), "temp")


@query("stats_levene_pvalue")
def q_levene_p(spark, sf_dir):
    """D4 with the F-distribution p-value (incomplete beta on the result row)."""
    return D.levene(D.quartile_groups(hourly_clean(spark, sf_dir), "cnt"), "temp", with_pvalue=True)


@query("stats_anderson_darling")
def q_ad(spark, sf_dir):
    """Anderson-Darling normality statistic of hourly demand with
    finite-sample critical values (15, 10, 5, 2.5, 1 %)."""
    return D.anderson_darling(hourly_clean(spark, sf_dir), "cnt")


def _acf_sql(view, col, nlags, lb_lags=None):
    base = (cte(view) + f""",
st AS (SELECT series_id, avg({col}) AS m, count({col}) AS nn FROM {view} GROUP BY 1),
d AS (SELECT v.series_id, nn, {col} - m AS d,
        row_number() OVER (PARTITION BY v.series_id ORDER BY "timestamp", row_id) AS idx FROM {view} v JOIN st USING (series_id)),
s0 AS (SELECT series_id, sum(d * d) AS s0 FROM d GROUP BY 1),
lp AS (SELECT a.series_id, k AS lag, sum(a.d * b.d) AS sk FROM d a, range(1, {nlags + 1}) r(k), d b
       WHERE b.series_id = a.series_id AND b.idx = a.idx - k GROUP BY 1, 2),
lags AS (SELECT series_id, nn AS n, unnest(range(0, {nlags + 1})) AS lag FROM st),
acf AS (SELECT l.series_id, CAST(l.lag AS INTEGER) AS lag,
          CASE WHEN l.lag = 0 THEN 1.0 ELSE coalesce(sk, 0) / s0 END AS acf, l.n
        FROM lags l JOIN s0 USING (series_id) LEFT JOIN lp ON lp.series_id = l.series_id AND lp.lag = l.lag
        WHERE l.lag <= l.n // 2)""")
    if lb_lags is None:
        return base + "\nSELECT series_id, lag, round(acf, 6) AS acf, n FROM acf"
    hs = ", ".join(f"({h})" for h in lb_lags)
    return (base + f""",
hh AS (SELECT * FROM (VALUES {hs}) t(h)),
q AS (SELECT series_id, h, n * (n + 2) * sum(acf * acf / (n - lag)) AS lb_stat FROM acf, hh
      WHERE lag >= 1 AND lag <= h GROUP BY series_id, h, n)
SELECT series_id, CAST(h AS INTEGER) AS lag, round(lb_stat, 6) AS lb_stat, round({chi2_sf_sql('lb_stat', 'h')}, 6) AS lb_pvalue FROM q""")


@query("stats_acf_hourly", _acf_sql("hsplit", "cnt", 336))
def q_acf(spark, sf_dir):
    """ACF of hourly demand up to 336 lags (one halo pass + one aggregate)."""
    return D.acf(hourly_clean(spark, sf_dir), "cnt", 336)


@query("stats_pacf_hourly")
def q_pacf(spark, sf_dir):
    """PACF (Yule-Walker 'ywm') from the ACF via Durbin-Levinson per series."""
    return D.pacf(D.acf(hourly_clean(spark, sf_dir), "cnt", 336))


@query("stats_recommend_lags")
def q_rec(spark, sf_dir):
    """Significant / strong / recommended / important lags from ACF + PACF."""
    a = D.acf(hourly_clean(spark, sf_dir), "cnt", 336)
    return D.recommend_lags(a, D.pacf(a))


@query("stats_ljung_box_daily", _acf_sql("daily_orders", "cnt", 30, lb_lags=(1, 7, 14, 30)))
def q_lb(spark, sf_dir):
    """Ljung-Box at lags 1, 7, 14, 30 on the daily order series."""
    return D.ljung_box(D.acf(A.daily_orders(spark, sf_dir), "cnt", 30))


def _kpss_sql(view):
    return cte(view) + """,
st AS (SELECT series_id, avg(cnt) AS m, count(cnt) AS n FROM """ + view + """ GROUP BY 1),
r AS (SELECT o.series_id, n, cnt - m AS r, row_number() OVER (PARTITION BY o.series_id ORDER BY "timestamp", row_id) AS idx
      FROM """ + view + """ o JOIN st USING (series_id)),
ps AS (SELECT series_id, sum(s * s) AS ss, sum(r * r) AS rr FROM (SELECT series_id, r,
        sum(r) OVER (PARTITION BY series_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS s FROM r) t GROUP BY 1),
lp AS (SELECT a.series_id, i, sum(a.r * b.r) AS p FROM r a, range(1, 400) t(i), r b
       WHERE b.series_id = a.series_id AND b.idx = a.idx - i GROUP BY 1, 2),
cv AS (SELECT ps.series_id, n, ss, rr, rr / n + coalesce(sum(p / (n / 2.0)) FILTER (WHERE i <= floor(pow(n, 2.0 / 9.0))), 0) AS s0,
         coalesce(sum(i * p / (n / 2.0)) FILTER (WHERE i <= floor(pow(n, 2.0 / 9.0))), 0) AS s1
       FROM ps JOIN st USING (series_id) LEFT JOIN lp USING (series_id) GROUP BY 1, 2, 3, 4),
al AS (SELECT *, CAST(least(floor(1.1447 * pow((s1 / s0) * (s1 / s0), 1.0 / 3.0) * pow(CAST(n AS DOUBLE), 1.0 / 3.0)), n - 1) AS INTEGER) AS nlags FROM cv),
res AS (SELECT al.series_id, n, nlags, (ss / (CAST(n AS DOUBLE) * n)) / ((rr + coalesce(sum(2 * p * (1.0 - i / (nlags + 1.0))) FILTER (WHERE i <= nlags), 0)) / n) AS k
        FROM al LEFT JOIN lp USING (series_id) GROUP BY al.series_id, n, nlags, ss, rr)
SELECT series_id, n, round(k, 6) AS kpss_stat, nlags, round(CASE WHEN k <= 0.347 THEN 0.10
  WHEN k <= 0.463 THEN 0.10 + (k - 0.347) * (0.05 - 0.10) / (0.463 - 0.347)
  WHEN k <= 0.574 THEN 0.05 + (k - 0.463) * (0.025 - 0.05) / (0.574 - 0.463)
  WHEN k <= 0.739 THEN 0.025 + (k - 0.574) * (0.01 - 0.025) / (0.739 - 0.574) ELSE 0.01 END, 6) AS kpss_pvalue FROM res"""


@query("stats_kpss_daily", _kpss_sql("daily_orders"))
def q_kpss(spark, sf_dir):
    """KPSS level stationarity with automatic lags on daily orders."""
    return D.kpss(A.daily_orders(spark, sf_dir), "cnt")


@query("stats_kpss_keyed", _kpss_sql("hourly_by_type"))
def q_kpss_keyed(spark, sf_dir):
    """D7 re-aimed to many series: KPSS per event-type hourly series."""
    return D.kpss(A.hourly_by_type(spark, sf_dir), "cnt")


@query("stats_adf_daily")
def q_adf(spark, sf_dir):
    """Augmented Dickey-Fuller (constant, AIC lag) on daily orders."""
    return D.adf(A.daily_orders(spark, sf_dir), "cnt")


def _lambda_sql(method):
    grid = [round(-2 + 0.05 * i, 2) for i in range(81)]
    vals = ", ".join(f"({l})" for l in grid)
    x = "CAST(cnt AS DOUBLE)"
    if method == "boxcox":
        x = "(CAST(cnt AS DOUBLE) + 1)"
        y = f"CASE WHEN abs(l) < 1e-12 THEN ln({x}) ELSE (pow({x}, l) - 1) / l END"
        jac, where = f"sum(ln({x}))", f"{x} > 0"
    else:
        y = (f"CASE WHEN {x} >= 0 THEN (CASE WHEN abs(l) < 1e-12 THEN ln(1 + {x}) ELSE (pow({x} + 1, l) - 1) / l END) "
             f"ELSE (CASE WHEN abs(l - 2) < 1e-12 THEN -ln(1 - {x}) ELSE -(pow(-{x} + 1, 2 - l) - 1) / (2 - l) END) END")
        jac, where = f"sum(sign({x}) * ln(1 + abs({x})))", f"{x} IS NOT NULL"
    return (cte("hourly") + f""",
g AS (SELECT * FROM (VALUES {vals}) t(l)),
j AS (SELECT count(*) AS n, {jac} AS jj FROM hourly WHERE {where}),
s AS (SELECT l, var_pop({y}) AS v FROM hourly, g WHERE {where} GROUP BY l),
ll AS (SELECT CAST(l AS DOUBLE) AS "lambda", (l - 1) * jj - n / 2.0 * ln(v) AS llf FROM s, j)
SELECT "lambda", round(llf, 6) AS llf, "lambda" = (SELECT arg_max("lambda", llf) FROM ll) AS is_best FROM ll""")


@query("stats_boxcox_lambda", _lambda_sql("boxcox"))
def q_boxcox(spark, sf_dir):
    """Box-Cox log-likelihood of cnt + 1 on a lambda grid (one aggregation), best lambda."""
    return D.fit_lambda(A.hourly(spark, sf_dir), "cnt", "boxcox")


@query("stats_yeojohnson_lambda", _lambda_sql("yeojohnson"))
def q_yj(spark, sf_dir):
    """Yeo-Johnson log-likelihood on a lambda grid, best lambda."""
    return D.fit_lambda(A.hourly(spark, sf_dir), "cnt", "yeojohnson")
