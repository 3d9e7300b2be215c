"""Cleaning queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..config import CONTINUOUS_RANGES, DISCRETE_RANGES, FILTER_RANGES, NUMERIC_COLS
from ..operators import clean as C
from ..sources import adapters as A
from .core import query
from .sqlgen import (CONT, DISC, FILT, INTS, NUMERIC, coerced_select, enforce_sum_cols, filled_select,
                     stack_union)
from .sqlviews import cte

R = lambda c: f"round({c}, 6) AS {c}"


def coerced(spark, sf_dir):
    d = C.trim_strings(A.dirty(spark, sf_dir))
    d = d.withColumn("ord", F.expr("try_cast(instant as long)"))
    d = C.coerce_dates(C.coerce_numeric(d))
    return d.select("ord", "dteday", *NUMERIC_COLS)


CO = cte("dirty") + f",\nco AS ({coerced_select()})"


@query("clean_coerce_types", CO + f"\nSELECT ord, dteday, {', '.join(R(c) for c in NUMERIC)} FROM co")
def q_coerce(spark, sf_dir):
    """C1 trim + C2 numeric coercion (bad text / NaN -> NULL) + C3 date coercion."""
    return coerced(spark, sf_dir)


FILLED = CO + f",\nfi AS ({filled_select('co', ['dteday', *NUMERIC])})"


@query("clean_fill_nulls", FILLED + f"\nSELECT ord, dteday, {', '.join(R(c) for c in NUMERIC)} FROM fi")
def q_fill(spark, sf_dir):
    """C4: forward then backward fill in file order (blocked two-pass carry)."""
    return C.fill_nulls(coerced(spark, sf_dir), ["dteday", *NUMERIC_COLS], order=("ord",))


def _chain_sql() -> str:
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in ["dteday", *NUMERIC])
    clip = []
    for c in NUMERIC:
        if c == "yr":
            clip.append("CAST(year(dteday) - 2011 AS DOUBLE) AS yr")
        elif c == "mnth":
            clip.append("least(greatest(CAST(month(dteday) AS DOUBLE), 1), 12) AS mnth")
        elif c in CONT or c in DISC:
            lo, hi = {**CONT, **DISC}[c]
            clip.append(f"least(greatest({c}, {lo}), {hi}) AS {c}")
        else:
            clip.append(c)
    out = ["ord AS row_id", "dteday"]
    for c in NUMERIC:
        if c in INTS:
            out.append(f"CAST({c} AS INTEGER) AS {c}")
        elif c not in ("casual", "registered", "cnt"):
            out.append(R(c))
    out.append(enforce_sum_cols())
    return (FILLED + f",\ndn AS (SELECT * FROM fi WHERE {notnull}),\n"
            f"cl AS (SELECT ord, dteday, {', '.join(clip)} FROM dn)\n"
            f"SELECT {', '.join(out)} FROM cl")


@query("clean_full_chain", _chain_sql())
def q_chain(spark, sf_dir):
    """Trim -> coerce -> ffill/bfill -> drop NULL rows (C5) -> drop columns
    (C6) -> calendar index (C7) -> range repair (C8/C9) -> part-sum impute and
    enforce (C12/C13) -> validation (C14, raises on failure)."""
    return C.clean(A.dirty(spark, sf_dir), min_rows=100)


def _without_instant(spark, sf_dir):
    """The raw table as written without ``instant``, rows in file order."""
    d = A.dirty(spark, sf_dir).withColumn("ord", F.expr("try_cast(instant as long)"))
    return d.repartitionByRange("ord").sortWithinPartitions("ord").drop("ord")


@query("clean_no_instant", f"SELECT * REPLACE (row_number() OVER (ORDER BY row_id) AS row_id) FROM ({_chain_sql()}) t")
def q_no_instant(spark, sf_dir):
    """C15 on a table without ``instant``: rows keep their place in the file."""
    return C.clean(_without_instant(spark, sf_dir).drop("instant"), min_rows=100)


@query("clean_bad_instant", f"SELECT * REPLACE (row_number() OVER (ORDER BY row_id) AS row_id) FROM ({_chain_sql()}) t")
def q_bad_instant(spark, sf_dir):
    """C15 where every tenth ``instant`` is unreadable: no row is lost."""
    d = _without_instant(spark, sf_dir)
    bad = F.expr("try_cast(instant as long)") % 10 == 3
    return C.clean(d.withColumn("instant", F.when(bad, F.lit("??")).otherwise(F.col("instant"))), min_rows=100)


@query("clean_dropped_rows", CO + "\nSELECT count(*) AS n_before, count(*) FILTER (WHERE " + " OR ".join(
    f"{c} IS NULL" for c in ["dteday", *NUMERIC]) + ") AS n_dropped, count(*) FILTER (WHERE NOT (" + " OR ".join(
    f"{c} IS NULL" for c in ["dteday", *NUMERIC]) + ")) AS n_kept FROM co")
def q_dropped(spark, sf_dir):
    """How many rows ``drop_nulls`` drops, here of the table before filling."""
    return C.dropped_rows(coerced(spark, sf_dir), ["dteday", *NUMERIC_COLS])


def _null_sql() -> str:
    cols = ["ord", "dteday", *NUMERIC]
    anyn = " OR ".join(f"{c} IS NULL" for c in cols)
    parts = [f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
             f"round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 6) AS null_pct FROM co" for c in cols]
    parts.append(f"SELECT '__rows_with_any_null__' AS feature, count(*) FILTER (WHERE {anyn}) AS null_count, "
                 f"round(count(*) FILTER (WHERE {anyn}) * 100.0 / count(*), 6) AS null_pct FROM co")
    return CO + "\n" + stack_union(parts)


@query("clean_null_report", _null_sql())
def q_nulls(spark, sf_dir):
    """NULL count and percent per column plus rows with any NULL."""
    return C.null_report(coerced(spark, sf_dir))


def _audit_sql() -> str:
    parts = []
    for c, (lo, hi) in {**CONT, **DISC}.items():
        out = f"({c} < {lo} OR {c} > {hi})"
        if c in CONT:
            tol = (hi - lo) * 0.1
            ren = f"{out} AND {c} BETWEEN {lo - tol} AND {hi + tol}"
            cmin, cmax = f"{c} < {lo - tol}", f"{c} > {hi + tol}"
        else:
            ren, cmin, cmax = "FALSE", f"{c} < {lo}", f"{c} > {hi}"
        parts.append(f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {out}) AS n_invalid, "
                     f"count(*) FILTER (WHERE {ren}) AS renormalised, count(*) FILTER (WHERE {cmin}) AS clipped_min, "
                     f"count(*) FILTER (WHERE {cmax}) AS clipped_max FROM co")
    return CO + "\n" + stack_union(parts)


@query("clean_range_audit", _audit_sql())
def q_audit(spark, sf_dir):
    """C8/C9 counters: invalid, re-normalised, clipped-to-min/max per column."""
    return C.range_audit(coerced(spark, sf_dir), CONTINUOUS_RANGES, DISCRETE_RANGES)


HOURLY_COLS = ["series_id", "row_id", "timestamp", "dteday", "yr", "mnth", "hr", "weekday", "season",
               "holiday", "workingday", "weathersit"]
HOURLY_DBL = ["temp", "atemp", "hum", "windspeed"]
HOURLY_SEL = ", ".join(HOURLY_COLS + [R(c) for c in HOURLY_DBL] + ["casual", "registered", "cnt"])


def _filter_sql() -> str:
    own = {"yr": ("(SELECT min(yr) FROM hourly)", "(SELECT max(yr) FROM hourly)")}
    cond = " AND ".join(f"coalesce({c} BETWEEN {lo} AND {hi}, FALSE)" for c, (lo, hi) in (FILT | own).items())
    return cte("hourly") + f"\nSELECT {HOURLY_SEL.replace('timestamp', chr(34) + 'timestamp' + chr(34))} FROM hourly WHERE {cond}"


@query("clean_range_filter", _filter_sql())
def q_filter(spark, sf_dir):
    """Drop rows with any value outside its range (notebook variant).

    The default yr bound [0, 1] belongs to a table of two years; here it is taken
    from the years that the table holds."""
    hourly = A.hourly(spark, sf_dir)
    return C.filter_ranges(hourly, FILTER_RANGES | C.observed_ranges(hourly, ["yr"]))


def _report_sql() -> str:
    parts = [f"SELECT '{c}' AS feature, row_id, CAST({c} AS DOUBLE) AS value FROM hourly "
             f"WHERE CAST({c} AS DOUBLE) < {lo} OR CAST({c} AS DOUBLE) > {hi}" for c, (lo, hi) in FILT.items()]
    return (cte("hourly") + ",\nbad AS (" + stack_union(parts) + "),\n"
            "rk AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY row_id, value) AS rn FROM bad)\n"
            "SELECT feature, count(*) AS n_out, "
            "round(max(value) FILTER (WHERE rn = 1), 6) AS example_1, "
            "round(max(value) FILTER (WHERE rn = 2), 6) AS example_2, "
            "round(max(value) FILTER (WHERE rn = 3), 6) AS example_3 FROM rk GROUP BY feature")


@query("clean_range_report", _report_sql())
def q_report(spark, sf_dir):
    """C11: out-of-range count and the first three examples (row order) per column."""
    r = C.range_report(A.hourly(spark, sf_dir), FILTER_RANGES, order_col="row_id")
    return r.select("feature", "n_out", *[F.col("examples")[i].alias(f"example_{i + 1}") for i in range(3)])


@query("clean_impute_sum_parts", CO + "\nSELECT ord, "
       "CASE WHEN casual IS NULL AND cnt IS NOT NULL AND registered IS NOT NULL THEN cnt - registered ELSE casual END AS casual, "
       "CASE WHEN registered IS NULL AND coalesce(cnt, casual + registered) IS NOT NULL AND casual IS NOT NULL "
       "THEN coalesce(cnt, casual + registered) - casual ELSE registered END AS registered, "
       "coalesce(cnt, casual + registered) AS cnt FROM co")
def q_impute(spark, sf_dir):
    """Fill one missing part of casual + registered = cnt from the other two."""
    return C.impute_sum_parts(coerced(spark, sf_dir)).select("ord", "casual", "registered", "cnt")


@query("clean_enforce_sum", cte("hourly") + ",\nsc AS (SELECT series_id, row_id, casual, registered, "
       "(cnt * 7) % 23 AS cnt FROM hourly)\nSELECT series_id, row_id, " + enforce_sum_cols() + " FROM sc")
def q_enforce(spark, sf_dir):
    """Enforce casual + registered = cnt (F2 minimal-change rule) on hourly
    rows whose total is scrambled by a fixed rule so every branch occurs."""
    h = A.hourly(spark, sf_dir).withColumn("cnt", (F.col("cnt") * 7) % 23)
    return C.enforce_sum(h).select("series_id", "row_id", "casual", "registered", "cnt")


@query("clean_validation_summary", _chain_sql().replace(
    "SELECT ord AS row_id", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS null_cells, CAST(0 AS BIGINT) AS "
    "sum_mismatches, TRUE AS has_target FROM (SELECT ord AS row_id", 1) + ") t")
def q_validate(spark, sf_dir):
    """C14 as data: rows, NULL cells and part-sum mismatches of the cleaned table."""
    return C.validation_summary(C.clean(A.dirty(spark, sf_dir), validate=False))


def _distinct_sql() -> str:
    cols = HOURLY_COLS[1:] + HOURLY_DBL + ["casual", "registered", "cnt"]
    return cte("hourly") + "\n" + stack_union(
        [f"SELECT '{c}' AS feature, count(DISTINCT {chr(34)}{c}{chr(34)}) AS n_distinct FROM hourly" for c in cols])


@query("clean_distinct_report", _distinct_sql())
def q_distinct(spark, sf_dir):
    """C17: exact distinct count per column."""
    h = A.hourly(spark, sf_dir).drop("series_id")
    return C.distinct_report(h)


@query("clean_value_counts", cte("hourly") + "\nSELECT weathersit, count(*) AS count, "
       "round(count(*) / sum(count(*)) OVER (), 6) AS share FROM hourly GROUP BY weathersit")
def q_vc(spark, sf_dir):
    """C17: normalised value counts of weathersit."""
    return C.value_counts(A.hourly(spark, sf_dir), "weathersit", normalize=True)
