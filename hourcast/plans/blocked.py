"""Unbounded frames over long series in two passes (no one-task window).

* ``blocked_fill``  -- forward / backward fill (last / first non-null value).
* ``blocked_cumsum`` -- running sums.

Both split each partition key into monotone blocks, evaluate the frame inside
every block, summarise each block to one row, carry the summary across blocks
with a window over the (tiny) summary table, and join the carry back.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import coarse_block


def _block(df: DataFrame, order: list, block, span: int) -> DataFrame:
    if block is None:
        block = coarse_block(df, order[0], span)
    elif isinstance(block, str):
        block = F.col(block)
    return df.withColumn("_fb", block)


def blocked_fill(df: DataFrame, cols: list, *, series: str = "series_id",
                 order: tuple = ("timestamp", "row_id"), backward: bool = False,
                 block: Column | str | None = None, span: int = 4096) -> DataFrame:
    """Replace NULLs in ``cols`` by the last (``backward``: next) non-null value
    of the same series in ``order``; leading (trailing) NULLs stay NULL."""
    order = list(order)
    d = _block(df, order, block, span)
    keys = [series, "_fb"]
    ordc = [F.col(o).desc_nulls_last() if backward else F.col(o) for o in order]
    win = Window.partitionBy(*keys).orderBy(*ordc).rowsBetween(Window.unboundedPreceding, 0)
    pos = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordc))
    d = d.withColumn("_fp", pos)
    filled = d.select("*", *[F.last(c, ignorenulls=True).over(win).alias(f"_in_{c}") for c in cols])
    # block summary: the value nearest the block end (start) in fill direction
    summ = d.groupBy(*keys).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_fp"))).alias(f"_ls_{c}")
        for c in cols])
    bw = Window.partitionBy(series).orderBy(F.col("_fb").desc() if backward else F.col("_fb")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(*keys, *[F.last(f"_ls_{c}", ignorenulls=True).over(bw).alias(f"_cy_{c}")
                                 for c in cols])
    out = filled.join(carry, keys, "left")
    sel = []
    for f in df.columns:
        if f in cols:
            sel.append(F.coalesce(F.col(f"_in_{f}"), F.col(f"_cy_{f}")).cast(df.schema[f].dataType).alias(f))
        else:
            sel.append(F.col(f"`{f}`"))
    return out.select(*sel)


def blocked_cumsum(df: DataFrame, values: list, *, partition: list, order: list,
                   block: Column | str, prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``values`` per ``partition`` in ``order``.

    ``block`` must be monotone in ``order`` within a partition. ``order``
    should be unique within a partition (aggregate ties first).
    """
    d = df.withColumn("_fb", F.col(block) if isinstance(block, str) else block)
    keys = list(partition) + ["_fb"]
    win = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inblk = d.select("*", *[F.sum(v).over(win).alias(f"_ib_{v}") for v in values])
    tot = d.groupBy(*keys).agg(*[F.sum(v).alias(f"_bt_{v}") for v in values])
    bw = Window.partitionBy(*partition).orderBy("_fb").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*keys, *[F.coalesce(F.sum(f"_bt_{v}").over(bw), F.lit(0)).alias(f"_of_{v}")
                               for v in values])
    out = inblk.join(offs, keys)
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      *[(F.col(f"_ib_{v}") + F.col(f"_of_{v}")).alias(f"{prefix}{v}") for v in values])


def blocked_fill_both(df: DataFrame, cols: list, *, series: str = "series_id",
                      order: tuple = ("timestamp", "row_id"), block: Column | str | None = None,
                      span: int = 4096) -> DataFrame:
    """Forward fill, then back fill the leading NULLs, in ONE blocked pass:
    coalesce(last non-null so far, first non-null from here on). Both in-block
    frames share the (series, block) partitioning; one block summary carries
    both directions."""
    order = list(order)
    d = _block(df, order, block, span)
    keys = [series, "_fb"]
    fw = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    bw = Window.partitionBy(*keys).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    pos = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    d = d.withColumn("_fp", pos)
    filled = d.select("*", *[F.last(c, ignorenulls=True).over(fw).alias(f"_f_{c}") for c in cols],
                      *[F.first(c, ignorenulls=True).over(bw).alias(f"_b_{c}") for c in cols])
    summ = d.groupBy(*keys).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_fp"))).alias(f"_l_{c}") for c in cols],
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_fp"))).alias(f"_e_{c}") for c in cols])
    prev = Window.partitionBy(series).orderBy("_fb").rowsBetween(Window.unboundedPreceding, -1)
    nxt = Window.partitionBy(series).orderBy("_fb").rowsBetween(1, Window.unboundedFollowing)
    carry = summ.select(*keys, *[F.last(f"_l_{c}", ignorenulls=True).over(prev).alias(f"_cf_{c}") for c in cols],
                        *[F.first(f"_e_{c}", ignorenulls=True).over(nxt).alias(f"_cb_{c}") for c in cols])
    out = filled.join(carry, keys, "left")
    sel = []
    for f in df.columns:
        if f in cols:
            sel.append(F.coalesce(F.col(f"_f_{f}"), F.col(f"_cf_{f}"), F.col(f"_b_{f}"), F.col(f"_cb_{f}"))
                       .cast(df.schema[f].dataType).alias(f))
        else:
            sel.append(F.col(f"`{f}`"))
    return out.select(*sel)
