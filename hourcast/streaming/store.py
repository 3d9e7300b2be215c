"""A table of observed hours that streams correct in place.

The store is kept by day: ``observed/day=<day>/batch_id=<n>`` holds the rows of
one day as micro-batch n left them, ``manifest/batch_id=<n>`` one row per day
that names the folder in force. A micro-batch merges its rows with those of the
days it touches, writes these days anew and then its manifest; the manifest is
the commit. Hence

* readers see a batch whole or not at all, and reading a span of days costs the
  files of these days;
* a replayed batch starts from the manifest before it, overwrites its own
  folders and ends as it did the first time;
* the store stays compacted: folders that neither the last nor the present
  manifest names are deleted.

Of several rows of one hour the largest version counts; among equal versions
(or without a version) a later batch replaces an earlier one, and inside a batch
the largest value counts. Rows without series or time are left out.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class HourStore:
    """Observed values by (series, hour) under ``path``, partitioned by day."""

    def __init__(self, spark: SparkSession, path: str, *, series: str = "series_id", ts: str = "timestamp",
                 value: str = "cnt_transformed", version: str | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.series, self.ts, self.value, self.version = series, ts, value, version

    # -- reading ---------------------------------------------------------
    def manifest(self, before: int | None = None) -> dict[str, int]:
        """Day -> batch whose folder is in force (one entry per day of the
        store), as of the newest commit, or the newest before ``before``."""
        done = [n for n in self._commits() if before is None or n < before]
        if not done:
            return {}
        rows = self.spark.read.schema("day string, held_by long").parquet(f"{self.path}/manifest/batch_id={done[-1]}")
        return {r.day: r.held_by for r in rows.collect()}

    def read(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """The rows in force; only those of the days ``first`` to ``last`` (inclusive) where given."""
        held = {d: n for d, n in self.manifest().items() if (first is None or d >= first) and (last is None or d <= last)}
        return self._rows(held).select(self.series, self.ts, self.value)

    def _rows(self, held: dict[str, int]) -> DataFrame:
        if not held:
            return self.spark.createDataFrame([], self._schema())
        return self.spark.read.schema(self._schema()).parquet(*[self._folder(d, n) for d, n in sorted(held.items())])

    # -- writing ---------------------------------------------------------
    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        """Merge ``rows`` (series, ts, value, version) into the days they touch
        and commit them as ``batch_id``. The same call again changes nothing."""
        s, t, v = self.series, self.ts, self.value
        version = F.col(self.version).cast("long") if self.version else F.lit(None).cast("long")
        new = (rows.where(F.col(s).isNotNull() & F.col(t).isNotNull())
               .select(F.col(s).cast("string").alias(s), F.col(t).cast("timestamp_ntz").alias(t),
                       F.col(v).cast("double").alias(v), version.alias("_version")))
        new = self._newest(new.withColumn("_turn", F.lit(1))).persist()  # read for its days, then merged
        try:
            touched = [r[0] for r in new.select(F.date_format(t, "yyyy-MM-dd")).distinct().collect()]
            if not touched:
                return
            before = self.manifest(before=batch_id)
            old = self._rows({d: before[d] for d in touched if d in before})
            merged = self._newest(old.withColumn("_turn", F.lit(0)).unionByName(new)).drop("_turn")
            # few files for a small day, several for a large one
            (merged.withColumn("day", F.date_format(t, "yyyy-MM-dd")).withColumn("batch_id", F.lit(batch_id))
             .hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("day", "batch_id").parquet(f"{self.path}/observed"))
        finally:
            new.unpersist()
        after = before | {d: batch_id for d in touched}
        (self.spark.createDataFrame(sorted(after.items()), "day string, held_by long").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/manifest/batch_id={batch_id}"))
        self._compact(batch_id)

    def _newest(self, rows: DataFrame) -> DataFrame:
        rank = F.struct("_version", "_turn", self.value)
        best = rows.groupBy(self.series, self.ts).agg(F.max(rank).alias("b"))
        return best.select(self.series, self.ts, F.col(f"b.{self.value}").alias(self.value),
                           F.col("b._version").alias("_version"), F.col("b._turn").alias("_turn"))

    def _compact(self, batch_id: int) -> None:
        """Delete what neither the manifest of ``batch_id`` nor the one before
        it (which a replay starts from, and open readers use) names."""
        commits = [n for n in self._commits() if n <= batch_id]
        for old, then in zip(commits[:-2], commits[1:-1]):
            kept = self._entries(then)
            for day, held_by in self._entries(old).items() - kept.items():
                self._delete(self._folder(day, held_by))
            self._delete(f"{self.path}/manifest/batch_id={old}")

    def _entries(self, n: int) -> dict[str, int]:
        return self.manifest(before=n + 1)

    # -- files -----------------------------------------------------------
    def _schema(self) -> T.StructType:
        return T.StructType([T.StructField(self.series, T.StringType()), T.StructField(self.ts, T.TimestampNTZType()),
                             T.StructField(self.value, T.DoubleType()), T.StructField("_version", T.LongType())])

    def _folder(self, day: str, batch_id: int) -> str:
        return f"{self.path}/observed/day={day}/batch_id={batch_id}"

    def _commits(self) -> list[int]:
        """Batches with a finished manifest, oldest first."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(place):
            return []
        found = []
        for f in files.listStatus(place):
            name = re.fullmatch(r"batch_id=(\d+)", f.getPath().getName())
            if name and files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS")):
                found.append(int(name[1]))
        return sorted(found)

    def _delete(self, path: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
