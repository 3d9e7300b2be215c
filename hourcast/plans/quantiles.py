"""Exact quantiles (NumPy 'linear' interpolation) and ranked value counts.

Quantiles take two scans, whatever the size, and never sort a whole column:

1. one aggregate per (group, column): the row count and a quantile sketch
   (bounded memory) that brackets every target rank by two values;
2. rows are counted per slot between the bracket values, and per value only
   inside a bracket or on its edge, so little more than the rows near the
   targets is exchanged. Running counts over the slots of a group, then inside
   a slot, give the values at ranks floor(h), floor(h)+1 with h = (n-1)p.

``value_cumulative`` (for tests that need every rank) counts per distinct value
and takes running sums inside value ranges of a bounded number of values.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import nan_to_null


def unpivot(df: DataFrame, by: list, cols: list, *, dropna: bool = True) -> DataFrame:
    """(by..., column, value double) -- one row per (row, column)."""
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    out = df.selectExpr(*[f"`{b}`" for b in by], f"stack({len(cols)}, {stack}) AS (feature, value)")
    out = out.withColumn("value", nan_to_null("value"))
    return out.where(F.col("value").isNotNull()) if dropna else out


def value_cumulative(long: DataFrame, g: list, counts: dict | None = None, *,
                     rows_per_block: int = 1_000_000):
    """Per distinct (g..., value): the count columns of ``counts`` (name ->
    Column aggregate, default ``{"_c": count(*)}``) and their running totals
    ``cum_<name>`` in ascending value order, plus the value-range block
    ``_blk`` and per-group totals ``tot_<name>``.

    Distinct values are pre-aggregated (hot values collapse). Every group is cut
    by a sketch of its distinct values into ranges of about ``rows_per_block``
    of them, as many as it takes; running sums are taken inside a range and
    shifted by offsets from the block table, so no task holds more than one
    range of one group.
    """
    counts = counts or {"_c": F.count(F.lit(1))}
    names = list(counts)
    vc = long.groupBy(*g, "value").agg(*[e.alias(n) for n, e in counts.items()])
    gst = vc.groupBy(*g).agg(F.count(F.lit(1)).alias("_nd"), *[F.sum(n).alias(f"tot_{n}") for n in names])
    widest = gst.agg(F.max("_nd")).first()[0] or 0
    cuts = max(1, -(-widest // rows_per_block))
    marks = [i / cuts for i in range(1, cuts)] or [1.0]
    sk = vc.groupBy(*g).agg(F.percentile_approx("value", marks, max(10_000, 10 * cuts)).alias("_b"))
    vcs = vc.join(gst, g).join(sk, g).withColumn(
        "_blk", F.size(F.filter("_b", lambda c: c < F.col("value"))).cast("int")).drop("_b", "_nd")
    btot = vcs.groupBy(*g, "_blk").agg(*[F.sum(n).alias(f"_bt_{n}") for n in names])
    bw = Window.partitionBy(*g).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    bo = btot.select(*g, "_blk", *[F.coalesce(F.sum(f"_bt_{n}").over(bw), F.lit(0)).alias(f"_bo_{n}") for n in names])
    wv = Window.partitionBy(*g, "_blk").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return vcs.join(bo, g + ["_blk"]).select(
        *g, "value", "_blk", *names, *[f"tot_{n}" for n in names],
        *[(F.col(f"_bo_{n}") + F.sum(n).over(wv)).alias(f"cum_{n}") for n in names])


#: rank errors of the sketch: one part in SKETCH; half-widths of the brackets to choose from
SKETCH = 10_000
MARGINS = (3 / SKETCH, 0.01, 0.1, 1.0)


def group_quantiles(df: DataFrame, g: list, value: str, probs, extra=()) -> tuple[DataFrame, DataFrame]:
    """(groups, quantiles) of the non-NULL ``value`` per ``g``: groups has the
    columns of ``g`` and the aggregates ``extra`` of the first scan; quantiles
    has (g..., p, q). Two scans of ``df``."""
    from ..session import cut_lineage
    probs = sorted({float(p) for p in probs})
    ends = [min(1.0, max(0.0, p + s * m)) for p in probs for m in MARGINS for s in (-1, 1)]
    v = F.col(value).cast("double")
    first = cut_lineage(df.groupBy(*g).agg(*extra, F.count(v).alias("_n"), F.percentile_approx(v, _doubles(ends), SKETCH).alias("_e")))
    n = F.col("_n")
    # the narrowest margin that holds the sketch's error and the two ranks around h
    pick = F.lit(len(MARGINS) - 1)
    for i, m in reversed(list(enumerate(MARGINS[:-1]))):
        pick = F.when(n * m >= n * (2 / SKETCH) + 2, F.lit(i)).otherwise(pick)
    index = F.sequence(F.lit(0), F.lit(len(probs) - 1))
    at = lambda k, side: F.get("_e", (k * len(MARGINS) + F.col("_pick")) * 2 + side)
    # the ends of all brackets in order; a stretch between two of them lies inside
    # a bracket while more brackets have begun than ended
    begun = (first.where("_n > 0").withColumn("_pick", pick)
             .select(*g, "_n", F.explode(F.transform(index, lambda k: F.array(
                 F.struct(at(k, 0).alias("e"), F.lit(1).alias("d")), F.struct(at(k, 1).alias("e"), F.lit(-1).alias("d"))))).alias("_b"))
             .select(*g, "_n", F.explode("_b").alias("_b")).groupBy(*g, "_n", F.col("_b.e").alias("_at")).agg(F.sum("_b.d").alias("_d")))
    open_ = F.sum("_d").over(Window.partitionBy(*g).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)) > 0
    marked = (begun.withColumn("_open", open_).groupBy(*g, "_n")
              .agg(F.array_sort(F.collect_list(F.struct("_at", "_open"))).alias("_m"))
              .select(*g, "_n", F.col("_m._at").alias("_edges"), F.col("_m._open").alias("_inside")))
    rows = df.select(*g, v.alias("_v")).where(F.col("_v").isNotNull())
    rows = _edges_below(rows.join(marked.select(*g, "_edges", "_inside"), g), 2 * len(probs))
    slot = F.col("_slot")
    kept = F.coalesce(F.get("_inside", slot - 1), F.lit(False)) | (F.get("_edges", slot - 1) == F.col("_v"))
    counts = (rows.select(*g, slot, F.when(kept, F.col("_v")).alias("_v"))
              .groupBy(*g, "_slot", "_v").agg(F.count(F.lit(1)).alias("_c")))
    counts = cut_lineage(counts)
    # ranks: running counts over slots, then inside a slot (an edge, the inner values, or the rest as one row)
    slots = counts.groupBy(*g, "_slot").agg(F.sum("_c").alias("_s"))
    before = Window.partitionBy(*g).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select(*g, "_slot", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"))
    order = Window.partitionBy(*g, "_slot").orderBy(F.col("_v").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = (counts.join(slots, [*g, "_slot"]).withColumn("_hi", F.col("_off") + F.sum("_c").over(order))
              .withColumn("_lo", F.col("_hi") - F.col("_c")).where(F.col("_v").isNotNull()))
    # the two ranks around each target, then the slot that each rank lies in
    h = (n - 1) * F.col("p")
    ranks = F.array(F.struct(F.lit(0).alias("k"), F.floor(h).alias("r")), F.struct(F.lit(1).alias("k"), F.least(F.floor(h) + 1, n - 1).alias("r")))
    wanted = (marked.select(*g, "_n", F.explode(_doubles(probs)).alias("p"))
              .select(*g, "p", (h - F.floor(h)).alias("_fr"), F.inline(ranks)))
    none = lambda kind: F.lit(None).cast(kind)
    lined = (wanted.select(*g, F.col("r").alias("_key"), F.lit(1).alias("_is"), none("int").alias("_slot"), "p", "_fr", "k")
             .unionByName(slots.select(*g, F.col("_off").alias("_key"), F.lit(0).alias("_is"), "_slot",
                                       none("double").alias("p"), none("double").alias("_fr"), none("int").alias("k"))))
    upto = Window.partitionBy(*g).orderBy("_key", "_is", "_slot").rowsBetween(Window.unboundedPreceding, 0)
    placed = lined.withColumn("_slot", F.last("_slot", ignorenulls=True).over(upto)).where("_is = 1").drop("_is")
    hits = placed.join(ranked, [*g, "_slot"]).where((F.col("_lo") <= F.col("_key")) & (F.col("_key") < F.col("_hi")))
    side = lambda k: F.max(F.when(F.col("k") == k, F.col("_v")))
    q = hits.groupBy(*g, "p").agg(F.max("_fr").alias("_fr"), side(0).alias("_x0"), side(1).alias("_x1"))
    q = q.select(*g, "p", (F.col("_x0") + F.col("_fr") * (F.col("_x1") - F.col("_x0"))).alias("q"))
    return first.drop("_n", "_e"), q


def _doubles(values):
    """An array constant; one call for any number of values."""
    return F.expr("array(" + ", ".join(f"{float(x)!r}D" for x in values) + ")")


def _edges_below(rows: DataFrame, most: int) -> DataFrame:
    """``_slot``: how many of the sorted ``_edges`` (``most`` at most) are not
    above ``_v``, by halving; one step is one projection."""
    out, step = rows.withColumn("_slot", F.lit(0)), 1 << (most.bit_length() - 1)
    while step:
        passed = F.get("_edges", F.col("_slot") + F.lit(step - 1)) <= F.col("_v")
        out = out.withColumn("_slot", F.col("_slot") + F.when(passed, F.lit(step)).otherwise(F.lit(0)))
        step >>= 1
    return out


def quantiles_long(long: DataFrame, probs, by=()) -> DataFrame:
    """Exact quantiles of ``value`` per (by..., column) of an unpivoted table.
    Returns (by..., feature, p, q)."""
    return group_quantiles(long, list(by) + ["feature"], "value", probs)[1]


def exact_quantiles(df: DataFrame, cols: list, probs, by=()) -> DataFrame:
    """Exact quantiles of ``cols`` per ``by`` group: (by..., column, p, q)."""
    return quantiles_long(unpivot(df, list(by), list(cols)), probs, by)


def quantile_map(df: DataFrame, cols: list, probs, *, approx: bool = False) -> dict:
    """Driver-side {(column, p): q} of global quantiles (small fit statistics)."""
    if approx:
        row = df.agg(*[F.percentile_approx(nan_to_null(F.col(f"`{c}`")).cast("double"),
                                           [float(p) for p in probs], 100000).alias(c) for c in cols]).first()
        return {(c, float(p)): (row[c][i] if row[c] is not None else None)
                for c in cols for i, p in enumerate(probs)}
    rows = exact_quantiles(df, cols, probs).collect()
    out = {(c, float(p)): None for c in cols for p in probs}
    out.update({(r["feature"], float(r["p"])): r["q"] for r in rows})
    return out
