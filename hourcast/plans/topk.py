"""Top-k per group without one task holding a whole group.

Stage 1 keeps the k best rows of every (group, block) -- block is any
spreading key (a salt, a time bucket); stage 2 ranks the <= k * blocks
survivors per group. Ties must be broken by the order columns.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def group_top_k(df: DataFrame, keys: list, order: list, k: int, *,
                spread: Column | None = None, n_salt: int = 64, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..k within each ``keys`` group by ``order`` (Columns/str)."""
    if spread is None:
        spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(n_salt))
    d = df.withColumn("_sp", spread)
    w1 = Window.partitionBy(*keys, "_sp").orderBy(*order)
    d = d.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1", "_sp")
    w2 = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    return d.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)
