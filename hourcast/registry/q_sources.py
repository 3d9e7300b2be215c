"""Source / sink queries (S1-S4, S6, S7): data goes through real files in
the session's checkpoint folder and is read back."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..config import NULL_TOKENS
from ..operators import evaluate as M
from ..operators import windows as W
from ..session import checkpoint_dir
from ..sources import adapters as A
from ..sources import io as IO
from .common import hourly_split
from .core import query
from .sqlviews import cte


def _folder(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/io/{name}-{uuid.uuid4().hex}"


DIRTY_SEL = ", ".join(A.DIRTY_COLS)


@query("source_raw_csv", cte("dirty") + f"\nSELECT {DIRTY_SEL} FROM dirty")
def q_csv(spark, sf_dir):
    """The raw all-string table written as header CSV and read back with
    an explicit string schema (whitespace and faults preserved)."""
    path = _folder(spark, "raw_csv")
    IO.write_raw_csv(A.dirty(spark, sf_dir), path)
    return IO.load_raw(spark, path, null_value="\\N")


def _perm_sql():
    toks = ", ".join("'" + t.strip() + "'" for t in NULL_TOKENS)
    return cte("dirty") + "\nSELECT " + ", ".join(
        f"CASE WHEN trim({c}) IN ({toks}) THEN NULL ELSE {c} END AS {c}" for c in A.DIRTY_COLS) + " FROM dirty"


@query("source_raw_permissive", _perm_sql())
def q_perm(spark, sf_dir):
    """Permissive read: null tokens ('', ' ', NA, N/A, null, NULL, None,
    NaN ...) become NULL."""
    path = _folder(spark, "raw_csv")
    IO.write_raw_csv(A.dirty(spark, sf_dir), path)
    return IO.load_raw_permissive(spark, path, null_value="\\N")


@query("source_split_partitioned", cte("hsplit") + """
SELECT series_id, row_id, "timestamp", hr, cnt, round(cnt_transformed, 6) AS cnt_transformed, split FROM hsplit WHERE split = 'val'""")
def q_split_read(spark, sf_dir):
    """S4 + S3: processed table written as Parquet partitioned by split; the
    'validation' split read back (partition filter, the other splits are not read)."""
    base = _folder(spark, "processed")
    df = hourly_split(spark, sf_dir).select("series_id", "row_id", "timestamp", "hr", "cnt", "cnt_transformed", "split")
    IO.save(df, f"{base}/processed")
    return IO.load_split(spark, base, "validation")


@query("source_bootstrap_history", cte("hourly") + """
SELECT series_id, "timestamp", round(sqrt(CAST(cnt AS DOUBLE)), 6) AS cnt_transformed FROM hourly""")
def q_boot(spark, sf_dir):
    """Stores reset; observed history = sqrt(cnt) per hour; predicted and
    cache tables empty (the observed table is returned)."""
    paths = IO.bootstrap_history(A.hourly(spark, sf_dir), _folder(spark, "history"))
    assert spark.read.parquet(paths["predicted"]).isEmpty() and spark.read.parquet(paths["cache"]).isEmpty()
    return spark.read.parquet(paths["observed"])


@query("source_model_report", cte("hsplit") + """,
p AS (SELECT *, lag(cnt, 24) OVER w AS p24, lag(cnt, 168) OVER w AS p168 FROM hsplit
      WINDOW w AS (PARTITION BY series_id ORDER BY "timestamp", row_id)),
m AS (SELECT 'naive_24h' AS model, split, sqrt(avg(pow(cnt - p24, 2))) AS rmse FROM p WHERE p24 IS NOT NULL GROUP BY split
      UNION ALL SELECT 'naive_168h' AS model, split, sqrt(avg(pow(cnt - p168, 2))) AS rmse FROM p WHERE p168 IS NOT NULL GROUP BY split)
SELECT arg_min(model, rmse) AS best_model, round(min(rmse), 6) AS best_val_rmse FROM m WHERE split = 'val'""")
def q_report(spark, sf_dir):
    """A model comparison (two seasonal-naive forecasts, metrics per split)
    written to Parquet with the best-model marker (lowest validation RMSE)."""
    hs = hourly_split(spark, sf_dir)
    p = W.lags(hs, "cnt", (24, 168), name="p{k}")
    comp = (M.evaluate(p.where(F.col("p24").isNotNull()), "cnt", "p24", by=["split"]).withColumn("model", F.lit("naive_24h"))
            .unionByName(M.evaluate(p.where(F.col("p168").isNotNull()), "cnt", "p168", by=["split"])
                         .withColumn("model", F.lit("naive_168h"))))
    return IO.write_report(comp, _folder(spark, "report"))
