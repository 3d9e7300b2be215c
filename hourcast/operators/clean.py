"""Cleaning operators (C1-C17) for the raw hourly table."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (CONTINUOUS_RANGES, DEFAULT, DISCRETE_RANGES, FILTER_RANGES,
                      NULL_TOKENS, NUMERIC_COLS, WEATHER_COLS)
from ..functions.exprs import clip, nan_to_null, sum_repair
from ..plans.blocked import blocked_fill, blocked_fill_both
from ..plans.ordering import with_row_index
from ..plans.topk import group_top_k

INT_COLS = ("season", "yr", "mnth", "hr", "weekday", "holiday", "workingday", "weathersit")
COUNT_COLS = ("casual", "registered", "cnt")


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def trim_strings(df: DataFrame, cols=None) -> DataFrame:
    """Trim every string column (or ``cols``) in one projection."""
    cols = set(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    return df.select(*[F.trim(_q(c)).alias(c) if c in cols else _q(c) for c in df.columns])


def null_tokens_to_null(df: DataFrame, cols=None, tokens=NULL_TOKENS) -> DataFrame:
    """S2 helper: empty-ish tokens (after trim) become NULL."""
    cols = set(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    toks = [t.strip() for t in tokens]
    return df.select(*[F.when(F.trim(_q(c)).isin(*toks), F.lit(None)).otherwise(_q(c)).alias(c)
                       if c in cols else _q(c) for c in df.columns])


def coerce_numeric(df: DataFrame, cols=NUMERIC_COLS) -> DataFrame:
    """Text -> double; unparsable text and NaN become NULL."""
    cols = [c for c in cols if c in df.columns]
    return df.select(*[nan_to_null(F.expr(f"try_cast(trim(`{c}`) as double)")).alias(c)
                       if c in cols else _q(c) for c in df.columns])


def coerce_dates(df: DataFrame, date_cols=("dteday",), ts_cols=("timestamp",)) -> DataFrame:
    """Text -> DATE / TIMESTAMP_NTZ; bad values become NULL."""
    out = []
    for c in df.columns:
        dt = df.schema[c].dataType
        if c in date_cols and isinstance(dt, T.StringType):
            out.append(F.expr(f"try_cast(trim(`{c}`) as date)").alias(c))
        elif c in ts_cols and isinstance(dt, T.StringType):
            out.append(F.expr(f"try_cast(trim(`{c}`) as timestamp_ntz)").alias(c))
        else:
            out.append(_q(c))
    return df.select(*out)


def fill_nulls(df: DataFrame, cols=None, *, series: str = "series_id",
               order=("row_id",), first=WEATHER_COLS) -> DataFrame:
    """C4: forward fill then back fill per column in row order.

    The reference fills the weather columns first and then every column; both
    passes are per-column ffill+bfill, and ffill followed by bfill equals
    coalesce(ffill, bfill) -- one blocked pass over all columns
    (``plans.blocked.blocked_fill_both``, no single-task window).
    """
    cols = [c for c in (cols or df.columns) if c not in (series,) and c not in order]
    d = df if series in df.columns else df.withColumn(series, F.lit("all"))
    d = blocked_fill_both(d, cols, series=series, order=tuple(order))
    return d if series in df.columns else d.drop(series)


def drop_nulls(df: DataFrame, cols=None) -> DataFrame:
    """Drop rows that still hold a NULL (``dropped_rows`` counts them)."""
    return df.na.drop(subset=cols) if cols else df.na.drop()


def dropped_rows(df: DataFrame, cols=None) -> DataFrame:
    """C5 counts, one row: rows before, dropped by ``drop_nulls`` and kept."""
    bad = F.lit(False)
    for c in cols or df.columns:
        bad = bad | _q(c).isNull()
    return df.agg(F.count(F.lit(1)).alias("n_before"), F.count_if(bad).alias("n_dropped"),
                  F.count_if(~bad).alias("n_kept"))


def drop_columns(df: DataFrame, exclude=DEFAULT.exclude_cols,
                 keep=("cnt", "casual", "registered", "dteday")) -> DataFrame:
    """Drop instant, mixed_type_col and excluded metadata; keep targets/date."""
    drop = {"instant", "mixed_type_col"} | {c for c in exclude if c not in keep}
    return df.drop(*[c for c in df.columns if c in drop])


def calendar_index(df: DataFrame, base_year: int = DEFAULT.base_year, date_col="dteday") -> DataFrame:
    """yr = year - base_year, mnth = month, both from the date."""
    return df.withColumns({"yr": (F.year(date_col) - base_year).cast("int"),
                           "mnth": F.month(date_col).cast("int")})


def repair_ranges(df: DataFrame, continuous=CONTINUOUS_RANGES, discrete=DISCRETE_RANGES) -> DataFrame:
    """Continuous values outside [lo, hi] -> nearest bound (F1: the
    re-normalise-or-clip rule of the reference always lands on the bound);
    discrete values clipped to their bounds."""
    spec = {**continuous, **discrete}
    return df.select(*[clip(_q(c), *spec[c]).cast(df.schema[c].dataType).alias(c) if c in spec
                       else _q(c) for c in df.columns])


def range_audit(df: DataFrame, continuous=CONTINUOUS_RANGES, discrete=DISCRETE_RANGES,
                tolerance: float = 0.1) -> DataFrame:
    """C8/C9 counters: one row per column with n_invalid, renormalised,
    clipped_min, clipped_max. A continuous value is 'renormalised' when it lies
    within ``tolerance`` of the range width, else clipped."""
    aggs, names = [], []
    for c, (lo, hi) in {**continuous, **discrete}.items():
        if c not in df.columns:
            continue
        x = _q(c)
        out = (x < lo) | (x > hi)
        if c in continuous:
            tol = (hi - lo) * tolerance
            ren = out & x.between(lo - tol, hi + tol)
            cmin, cmax = x < lo - tol, x > hi + tol
        else:
            ren, cmin, cmax = F.lit(False), x < lo, x > hi
        aggs += [F.count_if(out).alias(f"{c}__n_invalid"), F.count_if(ren).alias(f"{c}__renormalised"),
                 F.count_if(cmin).alias(f"{c}__clipped_min"), F.count_if(cmax).alias(f"{c}__clipped_max")]
        names.append(c)
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__n_invalid`, `{c}__renormalised`, `{c}__clipped_min`, `{c}__clipped_max`"
                      for c in names)
    return wide.selectExpr(f"stack({len(names)}, {stack}) as (feature, n_invalid, renormalised, "
                           f"clipped_min, clipped_max)")


def observed_ranges(df: DataFrame, cols) -> dict:
    """(smallest, largest) value of each column, for bounds that belong to the
    data rather than to the defaults; one aggregate."""
    ends = df.agg(*[f(F.col(f"`{c}`")).alias(f"{k}_{c}") for c in cols for k, f in (("lo", F.min), ("hi", F.max))]).first()
    return {c: (ends[f"lo_{c}"], ends[f"hi_{c}"]) for c in cols}


def filter_ranges(df: DataFrame, spec=FILTER_RANGES) -> DataFrame:
    """Keep rows whose every checked value is inside its range (NULL fails)."""
    cond = F.lit(True)
    for c, (lo, hi) in spec.items():
        if c in df.columns:
            cond = cond & F.coalesce(_q(c).between(lo, hi), F.lit(False))
    return df.where(cond)


def _long(df: DataFrame, cols: list, order_col: str) -> DataFrame:
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return df.selectExpr(f"`{order_col}` AS _ord", f"stack({len(cols)}, {stack}) AS (feature, value)")


def range_report(df: DataFrame, spec=FILTER_RANGES, order_col: str = "row_id", examples: int = 3) -> DataFrame:
    """C11: per column, number of out-of-range values and the first
    ``examples`` of them in row order (bounded two-stage top-k, no collect)."""
    cols = [c for c in spec if c in df.columns]
    lo = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(float(spec[c][0])))])
    hi = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(float(spec[c][1])))])
    long = _long(df, cols, order_col)
    bad = long.where((F.col("value") < lo[F.col("feature")]) | (F.col("value") > hi[F.col("feature")]))
    counts = bad.groupBy("feature").agg(F.count(F.lit(1)).alias("n_out"))
    top = group_top_k(bad, ["feature"], [F.col("_ord"), F.col("value")], examples, rank_col="_rk")
    ex = top.groupBy("feature").agg(F.sort_array(F.collect_list(F.struct("_rk", "value"))).alias("_e"))
    return (counts.join(ex, "feature")
            .select("feature", "n_out", F.transform("_e", lambda s: s["value"]).alias("examples")))


def impute_sum_parts(df: DataFrame, a="casual", b="registered", total="cnt") -> DataFrame:
    """Fill a single missing one of a, b, total from the other two."""
    A, B, N = _q(a), _q(b), _q(total)
    n2 = F.when(N.isNull() & A.isNotNull() & B.isNotNull(), A + B).otherwise(N)
    a2 = F.when(A.isNull() & n2.isNotNull() & B.isNotNull(), n2 - B).otherwise(A)
    b2 = F.when(B.isNull() & n2.isNotNull() & a2.isNotNull(), n2 - a2).otherwise(B)
    return df.withColumns({total: n2, a: a2, b: b2})


def enforce_sum(df: DataFrame, a="casual", b="registered", total="cnt") -> DataFrame:
    """Make a + b == total (F2 rule), clamp at 0, round half-even, cast to long."""
    ra, rb, rn = sum_repair(a, b, total)
    return df.withColumns({a: ra.cast("long"), b: rb.cast("long"), total: rn.cast("long")})


def require_sum(df: DataFrame, a="casual", b="registered", total="cnt") -> DataFrame:
    """C13 check: raise if a + b == total cannot be enforced on some row, which
    is so where a part is still NULL after imputation. Returns ``df``."""
    bad = df.agg(F.count_if(_q(a).isNull() | _q(b).isNull() | _q(total).isNull())).first()[0]
    if bad:
        raise ValueError(f"{a} + {b} = {total} cannot be enforced on {bad} rows with missing parts")
    return df


def validation_summary(df: DataFrame, target="cnt", parts=("casual", "registered", "cnt")) -> DataFrame:
    """C14 (as data): one row with rows, null cells, sum mismatches."""
    nulls = sum([F.count_if(_q(c).isNull()) for c in df.columns], F.lit(0))
    has_parts = all(p in df.columns for p in parts)
    mism = F.count_if(~(_q(parts[0]) + _q(parts[1])).eqNullSafe(_q(parts[2]))) if has_parts else F.lit(0)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), nulls.cast("long").alias("null_cells"),
                  mism.cast("long").alias("sum_mismatches"),
                  F.lit(target in df.columns).alias("has_target"))


def validate_clean(df: DataFrame, target="cnt", min_rows: int = 100) -> DataFrame:
    """C14: raise if NULLs remain, the target is missing, fewer than ``min_rows``
    rows, or a + b != total anywhere. One aggregate; returns ``df``."""
    if target not in df.columns:
        raise ValueError(f"Target column '{target}' not found in cleaned data")
    s = validation_summary(df, target).first()
    if s["null_cells"] > 0:
        raise ValueError("Cleaned data still contains null values")
    if s["n_rows"] < min_rows:
        raise ValueError(f"Too few rows in cleaned data: {s['n_rows']}")
    if s["sum_mismatches"] > 0:
        raise ValueError("Cleaned data violates the casual + registered = cnt relationship.")
    return df


def in_file_order(df: DataFrame, order_col: str = "instant") -> tuple[DataFrame, bool]:
    """Add the sort keys ``_ord`` (``order_col`` as a number) and ``_pos`` (place
    in the file). Where ``order_col`` is missing the place decides; a row whose
    own value is no number stands after the last row before it that has one.
    Returns the table and whether ``_ord`` is the number of every row."""
    from ..session import cut_lineage
    d = df.withColumn("_pos", F.monotonically_increasing_id())
    if order_col not in df.columns:
        return cut_lineage(d.withColumn("_ord", F.col("_pos"))), False
    d = d.withColumn("_ord", F.expr(f"try_cast(`{order_col}` as long)"))
    if not d.where(F.col("_ord").isNull()).limit(1).count():
        return d, True
    d = cut_lineage(d.withColumn("_all", F.lit("all")))  # places are fixed before the plan branches
    d = blocked_fill(d, ["_ord"], series="_all", order=("_pos",)).drop("_all")
    return d.withColumn("_ord", F.coalesce("_ord", F.lit(-(1 << 62)))), False


def clean(df: DataFrame, cfg=DEFAULT, *, order_col: str = "instant", series: str = "series_id",
          validate: bool = True, min_rows: int = 100) -> DataFrame:
    """The full cleaning chain on the raw all-string table.

    trim -> numeric/date coercion -> ffill/bfill in file order (``order_col``;
    rows without a valid one keep their place in the file) -> drop remaining
    NULL rows -> drop columns -> calendar index -> range repair -> part-sum
    imputation and enforcement -> typed output -> validate. ``row_id`` is
    ``order_col`` or, if some row has none, the place in that order from 1.
    """
    d, numbered = in_file_order(trim_strings(df), order_col)
    d = coerce_numeric(d)
    d = coerce_dates(d)
    drop_series = series not in d.columns
    if drop_series:
        d = d.withColumn(series, F.lit("all"))
    fill_cols = [c for c in d.columns if c not in (series, "_ord", "_pos", order_col, "mixed_type_col")]
    d = fill_nulls(d, fill_cols, series=series, order=("_ord", "_pos"))
    if not numbered:
        d = with_row_index(d, series, ("_ord", "_pos"), name="_row").withColumn("_ord", F.col("_row") + 1).drop("_row")
    d = drop_nulls(d, [c for c in d.columns if c not in ("mixed_type_col", order_col)]).drop("_pos")
    d = drop_columns(d, cfg.exclude_cols)
    if "dteday" in d.columns:
        d = calendar_index(d, cfg.base_year)
    d = repair_ranges(d)
    d = impute_sum_parts(d)
    d = enforce_sum(d)
    d = d.select(*[_q(c).cast("int").alias(c) if c in INT_COLS else _q(c) for c in d.columns])
    d = d.withColumnRenamed("_ord", "row_id")
    if drop_series:
        d = d.drop(series)
    if validate:
        # validation is a pass over the result: write it once (shared
        # checkpoint folder) so the check and the caller read the same table
        from ..session import cut_lineage
        d = cut_lineage(d)
        validate_clean(d, cfg.target_col, min_rows)
    return d


def null_report(df: DataFrame) -> DataFrame:
    """Per column NULL count and percent (desc), plus a row for rows with any NULL."""
    cols = df.columns
    anyn = F.lit(False)
    for c in cols:
        anyn = anyn | _q(c).isNull()
    wide = df.agg(F.count(F.lit(1)).alias("_n"), F.count_if(anyn).alias("_any"),
                  *[F.count_if(_q(c).isNull()).alias(f"n__{c}") for c in cols])
    stack = ", ".join(f"'{c}', `n__{c}`" for c in cols) + ", '__rows_with_any_null__', `_any`"
    return (wide.selectExpr("_n", f"stack({len(cols) + 1}, {stack}) AS (feature, null_count)")
            .select("feature", F.col("null_count").cast("long").alias("null_count"),
                    (F.col("null_count") * 100.0 / F.col("_n")).alias("null_pct")))


def distinct_report(df: DataFrame, cols=None, approx: bool = False) -> DataFrame:
    """Distinct non-NULL values per column (HyperLogLog++ when approx).

    Exact counts group (column, value) rows, so every column's values are
    counted map-side and spread over all tasks.
    """
    cols = cols or df.columns
    if approx:
        wide = df.agg(*[F.approx_count_distinct(_q(c)).alias(f"d__{c}") for c in cols])
        stack = ", ".join(f"'{c}', `d__{c}`" for c in cols)
        return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, n_distinct)")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), _q(c).cast("string").alias("v")) for c in cols]))
    values = df.select(pairs.alias("p")).select("p.*").distinct()
    return values.groupBy("feature").agg(F.count("v").alias("n_distinct"))


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Counts (or shares of non-null rows) per value of ``col``; NULLs excluded."""
    g = df.where(_q(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        # the total is a one-row aggregate of the counts, in the same job
        total = g.agg(F.sum("count").alias("_total"))
        g = (g.withColumn("_k", F.lit(1)).join(total.withColumn("_k", F.lit(1)), "_k")
             .select(col, "count", (F.col("count") / F.col("_total")).alias("share")))
    return g
