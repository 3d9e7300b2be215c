"""A drift reference kept as mergeable summaries.

``summarise`` reduces a table to counts per (feature, value) and (feature,
category), per day or other key if wanted; counts of several days add up
(``merge``), so a reference over a moving window is the sum of its days.
``write_reference`` lays them down once as cumulative tables, and every later
check (``check_drift``) reads these, never the reference's rows:

* ``values``: (feature, value, n, cum), files by (feature, value range); a batch
  reads only the ranges that its values fall into.
* ``ranges``: lowest value of each range; ``stats``: rows, mean, std, ends;
  ``bins``: the histogram of PSI; ``categories``: counts, NULL too.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..plans.quantiles import _edges_below, unpivot, value_cumulative
from .stats import bin_counts, category_counts, chi2_of, ks_pvalues, psi_of, psi_ranges

TABLES = {
    "values": "value double, n long, cum long, feature string, range int",
    "ranges": "feature string, range int, low double",
    "stats": "feature string, n long, mean double, std double, low double, high double",
    "bins": "feature string, _bin int, _ca long",
    "categories": "feature string, category string, n long",
}


def summarise(df: DataFrame, continuous=(), categorical=(), by=()) -> DataFrame:
    """(by..., feature, kind, value, category, n): how often each value of the
    continuous columns (NULL and NaN left out) and each category (NULL counted)
    stands in ``df``. Continuous rows have no category, categorical ones no value;
    ``kind`` tells them apart."""
    by, parts = list(by), []
    if continuous:
        parts.append(unpivot(df, by, list(continuous)).groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("n"))
                     .select(*by, "feature", F.lit("value").alias("kind"), "value", F.lit(None).cast("string").alias("category"), "n"))
    if categorical:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("category")) for c in categorical]))
        parts.append(df.select(*by, pairs.alias("_p")).groupBy(*by, "_p.feature", "_p.category").agg(F.count(F.lit(1)).alias("n"))
                     .select(*by, "feature", F.lit("category").alias("kind"), F.lit(None).cast("double").alias("value"), "category", "n"))
    if not parts:
        raise ValueError("no columns to summarise")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def merge(*summaries: DataFrame) -> DataFrame:
    """The summary of all rows behind ``summaries`` (days, batches); a further
    key of theirs is summed over."""
    cols = ["feature", "kind", "value", "category", "n"]
    out = summaries[0].select(*cols)
    for s in summaries[1:]:
        out = out.unionByName(s.select(*cols))
    return out.groupBy("feature", "kind", "value", "category").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Reference:
    """The tables that ``write_reference`` wrote."""
    values: DataFrame
    ranges: DataFrame
    stats: DataFrame
    bins: DataFrame
    categories: DataFrame
    n_bins: int = 10


def write_reference(summary: DataFrame, path: str, *, bins: int = 10, rows_per_block: int = 1_000_000) -> Reference:
    """Lay a summary down under ``path``. A value range holds about
    ``rows_per_block`` distinct values."""
    spark = summary.sparkSession
    save = lambda name, df: df.write.mode("overwrite").parquet(f"{path}/{name}")
    # read four times below: written once
    save("summary", summary)
    s = spark.read.schema(summary.schema).parquet(f"{path}/summary")
    long = s.where("kind = 'value'").select("feature", "value", "n")
    cum = value_cumulative(long, ["feature"], {"n": F.sum("n")}, rows_per_block=rows_per_block)
    (cum.select("value", "n", F.col("cum_n").cast("long").alias("cum"), "feature", F.col("_blk").cast("int").alias("range"))
     .repartition("feature", "range").sortWithinPartitions("feature", "range", "value")
     .write.mode("overwrite").partitionBy("feature", "range").parquet(f"{path}/values"))
    values = load_reference(spark, path).values
    save("ranges", values.groupBy("feature", "range").agg(F.min("value").alias("low")))
    head = long.groupBy("feature").agg(F.sum("n").alias("n"), (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
                                       F.min("value").alias("low"), F.max("value").alias("high"))
    # one row per feature: spread about the mean in a second pass over the counts
    off = F.col("value") - F.col("mean")
    spread = long.join(F.broadcast(head.select("feature", "mean")), "feature").groupBy("feature").agg(F.sum(off * off * F.col("n")).alias("_ss"))
    save("stats", head.join(spread, "feature").select(
        "feature", "n", "mean", F.when(F.col("n") > 1, F.sqrt(F.col("_ss") / (F.col("n") - 1))).alias("std"), "low", "high"))
    st = _ranges_of(load_reference(spark, path).stats)
    save("bins", bin_counts(long, st, bins, "_ca", "n"))
    save("categories", s.where("kind = 'category'").select("feature", "category", "n"))
    return load_reference(spark, path, bins)


def load_reference(spark: SparkSession, path: str, bins: int = 10) -> Reference:
    read = {t: spark.read.schema(schema).parquet(f"{path}/{t}") for t, schema in TABLES.items() if t == "values" or _there(spark, f"{path}/{t}")}
    return Reference(**{t: read.get(t) for t in TABLES}, n_bins=bins)


def _there(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _ranges_of(stats: DataFrame) -> DataFrame:
    return psi_ranges(stats.select("feature", F.col("n").alias("_na"), F.col("low").alias("_lo"), F.col("high").alias("_hi")))


def ks_stored(ref: Reference, cur_long: DataFrame, *, rows_per_block: int = 1_000_000) -> DataFrame:
    """Exact two-sample KS of a long table (feature, value) against the stored
    reference: between two values of the batch its share stands still, so the
    largest gap lies at a batch value or just below one. The reference's share
    there is the cumulative count of the last stored value, found inside the
    value range that the batch value falls into."""
    own = value_cumulative(cur_long, ["feature"], rows_per_block=rows_per_block).select(
        "feature", F.col("value").alias("_v"), F.col("_c").alias("_nb"), F.col("cum__c").alias("_cb"), F.col("tot__c").alias("_tb"))
    lows = ref.ranges.groupBy("feature").agg(F.array_sort(F.collect_list(F.struct("low", "range"))).alias("_m")).select(
        "feature", F.col("_m.low").alias("_edges"), F.col("_m.range").alias("_names"))
    most = ref.ranges.groupBy("feature").count().agg(F.max("count")).first()[0] or 1
    placed = _edges_below(own.join(lows, "feature"), most)
    placed = placed.withColumn("range", F.get("_names", F.col("_slot") - 1)).drop("_edges", "_names", "_slot")
    inside = placed.where(F.col("range").isNotNull())
    touched = inside.select("feature", "range").distinct()
    none = lambda kind: F.lit(None).cast(kind)
    stored = ref.values.join(touched, ["feature", "range"], "left_semi").select(
        "feature", "range", F.col("value").alias("_v"), "n", "cum", F.col("value").alias("_at"),
        none("long").alias("_nb"), none("long").alias("_cb"), none("long").alias("_tb"), F.lit(0).alias("_is"))
    asked = inside.select("feature", "range", "_v", none("long").alias("n"), none("long").alias("cum"), none("double").alias("_at"),
                          "_nb", "_cb", "_tb", F.lit(1).alias("_is"))
    upto = Window.partitionBy("feature", "range").orderBy("_v", "_is").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(c, ignorenulls=True).over(upto)
    found = stored.unionByName(asked).withColumns({"_ca": last("cum"), "_na": last("n"), "_at": last("_at")}).where("_is = 1")
    upon = F.when(F.col("_at") == F.col("_v"), F.col("_na")).otherwise(0)
    found = found.select("feature", "_nb", "_cb", "_tb", "_ca", (F.col("_ca") - upon).alias("_below"))
    before = placed.where(F.col("range").isNull()).select("feature", "_nb", "_cb", "_tb", F.lit(0).cast("long").alias("_ca"), F.lit(0).cast("long").alias("_below"))
    gaps = found.unionByName(before).join(F.broadcast(ref.stats.select("feature", F.col("n").alias("n_ref"))), "feature")
    at = F.abs(F.col("_ca") / F.col("n_ref") - F.col("_cb") / F.col("_tb"))
    below = F.abs(F.col("_below") / F.col("n_ref") - (F.col("_cb") - F.col("_nb")) / F.col("_tb"))
    g = gaps.groupBy("feature").agg(F.first("n_ref").alias("n_ref"), F.first("_tb").alias("n_cur"),
                                    F.max(F.greatest(at, below)).alias("ks_statistic"))
    return ks_pvalues(g)


def check_drift(ref: Reference, cur: DataFrame, continuous=(), categorical=(), *, threshold: float = DEFAULT.drift_threshold,
                psi_threshold: float = DEFAULT.psi_threshold, compat: bool = False) -> DataFrame:
    """V1's report against a stored reference; columns absent from ``cur`` are
    skipped, a feature without values on either side gives no row."""
    from .drift import _categorical_rows, _continuous_rows, _report, reference_moments
    cont = [c for c in continuous if c in cur.columns]
    cats = [c for c in categorical if c in cur.columns]
    parts = []
    if cont:
        long = unpivot(cur, [], cont)
        tests = (ks_stored(ref, long).join(psi_of(_ranges_of(ref.stats), ref.bins, long, ref.n_bins), "feature")
                 .join(ref.stats.select("feature", F.col("mean").alias("ref_mean"), F.col("std").alias("ref_std")), "feature")
                 .join(reference_moments(cur, cont).select("feature", F.col("mean").alias("curr_mean"), F.col("std").alias("curr_std")), "feature"))
        parts.append(_continuous_rows(tests, threshold, psi_threshold))
    if cats:
        stored = ref.categories.where(F.col("feature").isin(cats))
        parts.append(_categorical_rows(chi2_of(stored, category_counts(cur, cats), compat=compat), threshold))
    return _report(parts, cur.sparkSession)
