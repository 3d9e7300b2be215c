"""Temporal splits (P1s, P2s)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..plans.ordering import with_row_index


def check_fractions(fractions) -> tuple:
    tr, va, te = fractions
    if abs(tr + va + te - 1.0) > 0.01:
        raise ValueError(f"Splits must sum to 1.0, got {tr + va + te}: train={tr}, val={va}, test={te}")
    return fractions


def split(df: DataFrame, fractions=(DEFAULT.train_split, DEFAULT.val_split, DEFAULT.test_split), *,
          series="series_id", order=("timestamp", "row_id"), name="split",
          index_col="row_idx", keep_index: bool = False, count_col: str = "series_n") -> DataFrame:
    """P1s: per series, first int(n*train) rows -> 'train', next int(n*val)
    -> 'val', rest -> 'test' (in ``order``). One table with a split column;
    callers filter, and a Parquet write partitioned by ``split`` prunes.
    """
    tr, va, _ = check_fractions(fractions)
    if index_col in df.columns and count_col in df.columns:
        d = df
    elif index_col in df.columns:
        d = df.join(df.groupBy(series).agg(F.count(F.lit(1)).alias(count_col)), series)
    else:
        d = with_row_index(df, series, order, name=index_col, count_col=count_col)
    ntr = F.floor(F.col(count_col) * F.lit(float(tr)))
    nva = F.floor(F.col(count_col) * F.lit(float(va)))
    lab = (F.when(F.col(index_col) < ntr, "train").when(F.col(index_col) < ntr + nva, "val")
           .otherwise("test"))
    out = d.withColumn(name, lab)
    if count_col not in df.columns:
        out = out.drop(count_col)
    return out if keep_index or index_col in df.columns else out.drop(index_col)


def split_at(df: DataFrame, train_end, val_end, *, ts="timestamp", name="split") -> DataFrame:
    """P2s: cut dates, inclusive upper bounds."""
    t = F.col(ts)
    return df.withColumn(name, F.when(t <= F.lit(train_end).cast("timestamp_ntz"), "train")
                         .when(t <= F.lit(val_end).cast("timestamp_ntz"), "val").otherwise("test"))
