"""Readers and writers (S1-S4, S6, S7). Parquet is the default format; CSV
is kept for the raw file. Nothing is inferred: the raw file is read with an
explicit all-string schema."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import NULL_TOKENS
from .adapters import DIRTY_COLS

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in DIRTY_COLS])
SPLIT_NAMES = {"train": "train", "val": "val", "validation": "val", "test": "test"}


def load_raw(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, *, null_value: str = "") -> DataFrame:
    """Header CSV, every column a string; whitespace is kept (cleaning
    trims); fields equal to ``null_value`` are NULL (default: empty fields, as
    pandas reads them). A missing path raises (Spark's PATH_NOT_FOUND)."""
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("nullValue", null_value).csv(path))


def load_raw_permissive(spark: SparkSession, path: str, na_values=NULL_TOKENS,
                        schema: T.StructType = RAW_SCHEMA, *, null_value: str = "") -> DataFrame:
    """As S1, then empty-ish tokens ('', ' ', NA, N/A, null, NULL, None,
    NaN) become NULL (compared after trimming)."""
    from ..operators.clean import null_tokens_to_null
    return null_tokens_to_null(load_raw(spark, path, schema, null_value=null_value), tokens=na_values)


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Write an all-string table as header CSV keeping whitespace and marking
    NULL distinctly from the empty string."""
    (df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).option("nullValue", "\\N").option("emptyValue", '""').csv(path))


def save(df: DataFrame, path: str, *, fmt: str = "parquet", partition_by=("split",), mode: str = "overwrite") -> None:
    """Write a table (directories are created); Parquet partitioned by
    split by default, so split reads prune partitions."""
    w = df.write.mode(mode)
    parts = [c for c in partition_by if c in df.columns]
    if parts:
        w = w.partitionBy(*parts)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def load_split(spark: SparkSession, base: str, name: str, *, normalized: bool = False) -> DataFrame:
    """S3: one split of the processed dataset ('validation' -> 'val'); the
    ``_normalized`` dataset sits next to the plain one. The split filter is a
    partition filter (no data of other splits is read)."""
    key = SPLIT_NAMES.get(name)
    if key is None:
        raise ValueError(f"unknown split {name!r}")
    path = f"{base.rstrip('/')}/processed{'_normalized' if normalized else ''}"
    return spark.read.parquet(path).where(F.col("split") == key)


HISTORY_SCHEMA = "series_id string, timestamp timestamp_ntz, cnt_transformed double"
CACHE_SCHEMA = "request_hash string, features string, prediction double, created double"


def bootstrap_history(hourly: DataFrame, base: str) -> dict:
    """Clear the three stores and write sqrt(cnt) per hour as observed
    history; predicted history and result cache start empty."""
    spark = hourly.sparkSession
    obs = hourly.select("series_id", "timestamp", F.sqrt(F.col("cnt").cast("double")).alias("cnt_transformed"))
    obs.write.mode("overwrite").parquet(f"{base}/observed")
    spark.createDataFrame([], HISTORY_SCHEMA).write.mode("overwrite").parquet(f"{base}/predicted")
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("overwrite").parquet(f"{base}/cache")
    return {k: f"{base}/{k}" for k in ("observed", "predicted", "cache")}


def write_report(comparison: DataFrame, base: str, *, metric: str = "rmse", split_col: str = "split",
                 importance: DataFrame | None = None) -> DataFrame:
    """Model comparison (+ importances) to Parquet and the best-model
    marker (lowest validation ``metric``, ``min_by``); returns the marker."""
    comparison.write.mode("overwrite").parquet(f"{base}/model_comparison")
    if importance is not None:
        importance.write.mode("overwrite").parquet(f"{base}/feature_importance")
    best = comparison.where(F.col(split_col) == "val").agg(F.min_by("model", metric).alias("best_model"),
                                                           F.min(metric).alias(f"best_val_{metric}"))
    best.write.mode("overwrite").parquet(f"{base}/best_model")
    return comparison.sparkSession.read.parquet(f"{base}/best_model")
