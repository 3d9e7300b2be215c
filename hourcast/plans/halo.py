"""Halo windows -- bounded-lookback window expressions over a long series.

Rows are cut into blocks of ``block_rows`` consecutive rows of a series (by
the P1 index). Each row is also copied into the next block when it lies in
the last ``lookback`` rows of its block (and into the previous block when it
is within ``lookahead`` of the start). Windows are then evaluated per
``(series, block)`` and only each row's home copy is kept. Any frame that
reaches at most ``lookback`` rows back (``lookahead`` forward) is exact.

With ``strategy="partition"`` the same expressions run over
``Window.partitionBy(series).orderBy(order)`` instead -- right for many short
series; the halo form is the default since one series may be very long.
"""
from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import with_row_index

BuildFn = Callable[[Window], dict]


def series_select(df: DataFrame, build: BuildFn, lookback: int, *,
                  series: str = "series_id", order: tuple = ("timestamp", "row_id"),
                  strategy: str = "halo", block_rows: int = 4096, lookahead: int = 0,
                  index_col: str = "row_idx", keep_index: bool = False) -> DataFrame:
    """Append the columns ``build(w)`` returns (name -> Column over window w).

    ``w`` is already partitioned and ordered; frames are added by ``build``.
    ``build`` may return a list of dicts: stages evaluated in order, a later
    stage may use earlier columns (same partitioning, so no extra shuffle).
    ``lookback`` must cover the total reach of all stages.
    """
    def apply(d, w):
        stages = build(w)
        for st in (stages if isinstance(stages, list) else [stages]):
            d = d.select("*", *[c.alias(n) for n, c in st.items()])
        return d

    if strategy == "partition":
        return apply(df, Window.partitionBy(series).orderBy(*order))
    if strategy != "halo":
        raise ValueError(f"unknown strategy {strategy!r}")
    had_index = index_col in df.columns
    d = df if had_index else with_row_index(df, series, order, name=index_col)
    B = max(int(block_rows), lookback + 1, lookahead + 1)
    idx = F.col(index_col)
    home = F.floor(idx / F.lit(B)).cast("long")
    pos = idx - home * B
    tags = [home]
    if lookback > 0:
        tags.append(F.when(pos >= F.lit(B - lookback), home + 1))
    if lookahead > 0:
        tags.append(F.when(pos < F.lit(lookahead), home - 1))
    d = d.withColumn("_home", home).withColumn(
        "_blk", F.explode(F.array_compact(F.array(*tags))) if len(tags) > 1 else home)
    w = Window.partitionBy(series, "_blk").orderBy(index_col)
    out = apply(d, w).where(F.col("_blk") == F.col("_home")).drop("_blk", "_home")
    if not had_index and not keep_index:
        out = out.drop(index_col)
    return out
