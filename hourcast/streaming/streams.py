"""Structured Streaming forms of the online path.

* ``hourly_counts``  (O5) tumbling 1-hour event-time windows with a watermark;
  late rows are dropped, a window is final once the watermark passes its end.
* ``sliding_demand`` (O9) the event-time form of the rolling mean.
* ``stream_features`` (O6) per-series lags / rolling mean from bounded state
  (the last ``keep`` values) with ``transformWithStateInPandas``.
* ``stream_history`` (O7) observed rows upserted per micro-batch with
  ``foreachBatch`` into a store kept by day (``store.py``).
* ``stream_monitor`` (O8) drift of every micro-batch against a reference,
  appended to a log table.

The same functions accept batch DataFrames where that makes sense (windows,
counts), so batch and stream plans are one plan. Sinks and checkpoints go
under the session's shared checkpoint folder.
"""
from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..session import checkpoint_dir
from ..sources.adapters import REGISTERED_TYPES
from .store import HourStore


def event_stream(spark: SparkSession, folder: str, table: str = "events", *, schema=None,
                 max_files: int | None = None) -> DataFrame:
    """File stream over ``folder/<table>.parquet`` (one table of a folder of tables)."""
    schema = schema or spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _event_time(df: DataFrame, ts: str, watermark: str | None) -> DataFrame:
    """Watermarks and windows need TIMESTAMP; the wall-clock TIMESTAMP_NTZ is
    mapped through epoch microseconds, so windows align to wall-clock hours
    whatever the session time zone is."""
    micros = F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, CAST(`{ts}` AS TIMESTAMP_NTZ))")
    d = df.withColumn("_et", F.timestamp_micros(micros))
    return d.withWatermark("_et", watermark) if (watermark and df.isStreaming) else d


def _to_ntz(c) -> "F.Column":
    """Inverse of the event-time mapping: TIMESTAMP instant -> wall-clock NTZ."""
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({c}), {EPOCH_NTZ})")


def hourly_counts(events: DataFrame, *, ts="ts", watermark: str | None = "2 hours", by=None) -> DataFrame:
    """Per hour (and ``by``): cnt, casual (signup), registered (view / click
    / purchase), error count. Works on streams and batch frames."""
    d = _event_time(events, ts, watermark)
    keys = [F.window("_et", "1 hour")] + ([F.col(by)] if by else [])
    et = F.col("event_type")
    g = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"), F.count_if(et == "signup").alias("casual"),
                             F.count_if(et.isin(*REGISTERED_TYPES)).alias("registered"),
                             F.count_if(et == "error").alias("n_error"))
    return g.select((F.col(by) if by else F.lit("all")).alias("series_id"),
                    _to_ntz("window.start").alias("timestamp"),
                    "cnt", "casual", "registered", "n_error")


def sliding_demand(events: DataFrame, size: str = "3 hours", slide: str = "1 hour", *, ts="ts",
                   watermark: str | None = "2 hours", value: str | None = None) -> DataFrame:
    """Event counts (and mean ``value``) over sliding event-time windows."""
    d = _event_time(events, ts, watermark)
    ag = [F.count(F.lit(1)).alias("cnt")] + ([F.avg(value).alias(f"{value}_mean")] if value else [])
    g = d.groupBy(F.window("_et", size, slide)).agg(*ag)
    return g.select(_to_ntz("window.start").alias("window_start"),
                    _to_ntz("window.end").alias("window_end"), *[a for a in g.columns if a != "window"])


def stream_features(hourly: DataFrame, *, col="cnt", lags=(1, 24), roll: int = 3, keep: int = 168,
                    series="series_id", ts="timestamp", ttl_hours: float | None = None) -> DataFrame:
    """Lags and a leak-safe rolling mean per series from bounded state.

    State per series = a list of the newest ``keep`` (timestamp, value) pairs
    (at least as many as the lags and the mean need). In a micro-batch the
    hours of a series are taken in time order, whatever order they come in; of
    an hour's rows the largest value counts. An hour later than all before
    sees the hours before it. A late hour is put in its place: it sees the hours
    before it, later rows see it, rows already given out stay. An hour that the
    state holds already is a repeat and gives no row; so does an hour older than
    a full state. Rows without series or time are left out.

    With ``ttl_hours`` a series that lies so far behind the newest hour of the
    stream loses its list: a timer goes off when the watermark, ``ttl_hours``
    behind, passes its last hour. Rows behind the watermark are dropped. It is
    event time, so that an ``availableNow`` run ends and a rerun gives the same
    rows (Spark never ends such a run under a processing-time TTL). The frames of a series are read one by one; 16 bytes of each
    row are kept until the series is done. Needs the RocksDB state store, which
    is set here for the session's streams."""
    lags, keep = tuple(lags), max(keep, roll, *lags)
    names = [f"{col}_lag_{k}h" for k in lags] + [f"{col}_roll_mean_{roll}h"]
    out_schema = T.StructType([T.StructField(series, T.StringType()), T.StructField(ts, T.TimestampNTZType()),
                               T.StructField(col, T.DoubleType())] +
                              [T.StructField(n, T.DoubleType()) for n in names])

    class Lags(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.past = handle.getListState("past", "at long, v double")

        def handleInputRows(self, key, rows, timerValues):
            held = list(self.past.get()) if self.past.exists() else []
            if held and ttl_hours and held[-1][0] // 1000 <= timerValues.getCurrentWatermarkInMs():
                held = []  # its timer goes off in this micro-batch
            old_t = np.array([r[0] for r in held], np.int64)
            old_v = np.array([r[1] for r in held], float)
            parts = [(f["at_micros"].to_numpy(np.int64), f[col].to_numpy(float)) for f in rows]
            t = np.concatenate([p[0] for p in parts])
            v = np.concatenate([p[1] for p in parts])
            by = np.lexsort((np.where(np.isnan(v), -np.inf, v), t))
            last = by[np.append(np.diff(t[by]) != 0, True)]  # of an hour's rows the largest
            t, v = t[last], v[last]
            new = ~np.isin(t, old_t)
            if len(old_t) >= keep:
                new &= t > old_t[0]
            t, v = t[new], v[new]
            if not len(t):
                return
            every = np.concatenate([old_t, t])
            order = np.argsort(every, kind="stable")
            every, value = every[order], np.concatenate([old_v, v])[order]
            at = np.flatnonzero(order >= len(old_t))  # places of the new hours
            for i in range(0, len(at), 10_000):
                a = at[i:i + 10_000]
                out = {series: key[0], ts: every[a].astype("M8[us]"), col: value[a]}
                for k in lags:
                    out[f"{col}_lag_{k}h"] = np.where(a >= k, value[np.maximum(a - k, 0)], np.nan)
                back = a[:, None] - np.arange(roll, 0, -1)
                near = np.where(back >= 0, value[np.maximum(back, 0)], np.nan)
                some = ~np.isnan(near)
                n = some.sum(axis=1)
                out[names[-1]] = np.where(n, np.where(some, near, 0).sum(axis=1) / np.maximum(n, 1), np.nan)
                frame = pd.DataFrame(out, columns=[series, ts, col] + names)
                yield frame.astype({c: object for c in names}).where(frame.notna(), None)
            self.past.put([(int(x), float(y)) for x, y in zip(every[-keep:], value[-keep:])])
            if ttl_hours:
                self.handle.registerTimer(int(every[-1]) // 1000)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            held = list(self.past.get()) if self.past.exists() else []
            if held and held[-1][0] // 1000 <= expiredTimerInfo.getExpiryTimeInMs():  # no later hour since
                self.past.clear()
            return iter(())

        def close(self):
            pass

    hourly.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass",
                                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    at = F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, CAST(`{ts}` AS TIMESTAMP_NTZ))")
    d = (hourly.select(F.col(series).cast("string").alias(series), at.alias("at_micros"), F.col(col).cast("double").alias(col))
         .where(F.col(series).isNotNull() & F.col("at_micros").isNotNull()))
    if ttl_hours:
        d = d.withColumn("event_time", F.timestamp_micros("at_micros")).withWatermark("event_time", f"{int(ttl_hours * 3600)} seconds")
    return d.groupBy(series).transformWithStateInPandas(Lags(), out_schema, "Append", "EventTime" if ttl_hours else "None")


def sink_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """Stream the Parquet files a previous streaming query wrote (in file order)."""
    return spark.readStream.schema(schema).parquet(path)


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


def run_available_now(df: DataFrame, name: str, *, mode: str = "append", path: str | None = None) -> DataFrame:
    """Run a streaming frame to completion (``availableNow``) into a Parquet
    sink under the checkpoint folder and return the sink as a batch frame."""
    spark = df.sparkSession
    base = path or _scratch(spark, name)
    q = (df.writeStream.outputMode(mode).format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/_ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def _written(spark: SparkSession, path: str) -> bool:
    """Whether anything was written to ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def stream_history(observed: DataFrame, name: str = "history", *, series="series_id", ts="timestamp",
                   value="cnt", version: str | None = None, path: str | None = None,
                   unique=None, watermark: str = "2 hours") -> tuple[str, DataFrame]:
    """Upsert observed hours per micro-batch into a ``store.HourStore``: only
    the days that a batch touches are written anew, and a replayed batch changes
    nothing. Of several rows for an hour the one with the largest ``version``
    column counts; among equal versions (or without one) a later batch replaces
    earlier ones, and inside a batch the largest value counts. With ``unique``
    (columns that name a delivery) a row delivered again within ``watermark`` is
    dropped before it reaches the store, as are rows that come later than that:
    let it cover the longest delay of a correction. With a ``path`` a later call
    goes on where the last one stopped. Returns (folder, observed table) -- merge
    with predictions via ``profile.merge_history``; ``HourStore.read`` reads a
    span of days."""
    spark = observed.sparkSession
    base = path or _scratch(spark, name)
    store = HourStore(spark, f"{base}/store", series=series, ts=ts, version=version)
    if unique:
        observed = _event_time(observed, ts, watermark).dropDuplicatesWithinWatermark(list(unique)).drop("_et")

    def upsert(batch: DataFrame, batch_id: int):
        store.upsert(batch.withColumn(store.value, F.sqrt(F.col(value).cast("double"))), batch_id)

    q = (observed.writeStream.foreachBatch(upsert).option("checkpointLocation", f"{base}/_ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return base, store.read()


def stream_monitor(current: DataFrame, reference: DataFrame | None, continuous=(), categorical=(),
                   name: str = "monitor", baseline: dict | None = None, y: str = "y", yhat: str = "prediction",
                   threshold: float = 0.2, metric: str = "mae", path: str | None = None, **kw) -> DataFrame:
    """Every micro-batch is checked -- drift (V1) against ``reference``
    and, with a ``baseline``, performance decay (V2) of its predictions -- and
    the result rows are appended to a log table (idempotent per batch id). With
    both, the log has the rows of both, told apart by ``check`` (drift or
    performance); columns of the other kind are NULL. The reference (rows, or
    a stored ``reference.Reference``) is summarised once before the stream
    starts; micro-batches read the summary only."""
    from ..operators.drift import check_performance
    from ..operators.reference import Reference, check_drift, summarise, write_reference
    spark = current.sparkSession
    base = path or _scratch(spark, name)
    drift = reference is not None and bool(continuous or categorical)
    if drift and not isinstance(reference, Reference):
        reference = write_reference(summarise(reference, [c for c in continuous if c in reference.columns],
                                              [c for c in categorical if c in reference.columns]), f"{base}/reference")

    def check(batch: DataFrame, batch_id: int):
        batch = batch.persist()  # read by every check below
        try:
            if batch.isEmpty():
                return
            if drift:
                rep = check_drift(reference, batch, continuous, categorical, **kw)
                rep.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
                    f"{base}/log/batch_id={batch_id}")
            if baseline is not None:
                perf = check_performance(batch, baseline, y=y, yhat=yhat, threshold=threshold, metric=metric)
                perf.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
                    f"{base}/perf/batch_id={batch_id}")
        finally:
            batch.unpersist()

    q = (current.writeStream.foreachBatch(check).option("checkpointLocation", f"{base}/_ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    logs = [(n, spark.read.parquet(f"{base}/{d}")) for n, d, on in
            (("drift", "log", drift), ("performance", "perf", baseline is not None)) if on and _written(spark, f"{base}/{d}")]
    if len(logs) < 2:
        return logs[0][1] if logs else spark.createDataFrame([], "batch_id int")
    tagged = [t.withColumn("check", F.lit(n)) for n, t in logs]
    return tagged[0].unionByName(tagged[1], allowMissingColumns=True)
