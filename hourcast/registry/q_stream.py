"""Structured Streaming queries (O5-O9), run with ``availableNow`` into
Parquet sinks under the checkpoint folder."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as V
from ..operators import profile as J
from ..operators import windows as W
from ..sources import adapters as A
from ..streaming import streams as ST
from .core import query
from .q_stats import detect_sql
from .sqlviews import cte

# hours whose 1-hour window is final under a 2-hour watermark at the end of the input
FINAL = "h + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR"

HOURLY_STREAM_SQL = f"""WITH hs AS (
  SELECT 'all' AS series_id, date_trunc('hour', ts) AS h, count(*) AS cnt,
    count(*) FILTER (WHERE event_type = 'signup') AS casual,
    count(*) FILTER (WHERE event_type IN ('view', 'click', 'purchase')) AS registered,
    count(*) FILTER (WHERE event_type = 'error') AS n_error
  FROM events GROUP BY 2)"""


@query("stream_hourly_counts", HOURLY_STREAM_SQL + f"""
SELECT series_id, h AS "timestamp", cnt, casual, registered, n_error FROM hs WHERE {FINAL}""")
def q_hourly(spark, sf_dir):
    """Tumbling hourly demand from the event stream (2-hour watermark,
    append mode: only final windows are emitted)."""
    return ST.run_available_now(ST.hourly_counts(ST.event_stream(spark, sf_dir)), "hourly")


def _sliding_sql(final: bool):
    cond = "WHERE ws + INTERVAL 3 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR" if final else ""
    return f"""WITH x AS (SELECT date_trunc('hour', ts) - k * INTERVAL 1 HOUR AS ws FROM events, range(0, 3) t(k))
SELECT ws AS window_start, ws + INTERVAL 3 HOUR AS window_end, count(*) AS cnt FROM x {cond} GROUP BY ws"""


@query("stream_sliding_demand", _sliding_sql(True))
def q_sliding(spark, sf_dir):
    """Sliding 3-hour windows every hour over the event stream (watermark 2 h)."""
    return ST.run_available_now(ST.sliding_demand(ST.event_stream(spark, sf_dir)), "sliding")


@query("batch_sliding_demand", _sliding_sql(False))
def q_sliding_batch(spark, sf_dir):
    """O9 on a batch frame: the same plan without a watermark."""
    return ST.sliding_demand(A.table(spark, sf_dir, "events"))


def _lag_sql():
    w = '(PARTITION BY series_id ORDER BY h)'
    return HOURLY_STREAM_SQL + f""",
f AS (SELECT * FROM hs WHERE {FINAL})
SELECT series_id, h AS "timestamp", CAST(cnt AS DOUBLE) AS cnt, CAST(lag(cnt, 1) OVER {w} AS DOUBLE) AS cnt_lag_1h,
  CAST(lag(cnt, 24) OVER {w} AS DOUBLE) AS cnt_lag_24h,
  round(avg(cnt) OVER (PARTITION BY series_id ORDER BY h ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS cnt_roll_mean_3h
FROM f"""


@query("stream_lag_features", _lag_sql())
def q_stream_lags(spark, sf_dir):
    """Stateful per-series lags (1 h, 24 h) and leak-safe 3-hour mean
    (bounded state: 168 values). Stage 1 writes final hourly windows to a
    Parquet sink; stage 2 streams that sink through the stateful operator
    (Spark does not allow the stateful pandas operator after an append-mode
    aggregation in the same query)."""
    hourly = ST.hourly_counts(ST.event_stream(spark, sf_dir))
    base = ST._scratch(spark, "lags")
    ST.run_available_now(hourly, "hourly", path=f"{base}/hourly")
    src = ST.sink_stream(spark, f"{base}/hourly/out", hourly.schema)
    feats = ST.stream_features(src, col="cnt", lags=(1, 24), roll=3)
    return ST.run_available_now(feats, "lags", path=f"{base}/features")


@query("stream_history_upsert", HOURLY_STREAM_SQL + f""",
obs AS (SELECT series_id, h AS "timestamp", sqrt(cnt) AS v FROM hs WHERE {FINAL}),
pred AS (SELECT series_id, h AS "timestamp", sqrt(CAST(lag(cnt, 24) OVER (ORDER BY h) AS DOUBLE)) AS v FROM hs)
SELECT coalesce(o.series_id, p.series_id) AS series_id, coalesce(o."timestamp", p."timestamp") AS "timestamp",
  round(coalesce(o.v, p.v), 6) AS cnt_transformed, o.series_id IS NOT NULL AS is_observed
FROM obs o FULL OUTER JOIN (SELECT * FROM pred WHERE v IS NOT NULL) p
  ON o.series_id = p.series_id AND o."timestamp" = p."timestamp\"""")
def q_history(spark, sf_dir):
    """Observed hours upserted per micro-batch (idempotent foreachBatch);
    seasonal-naive predictions are persisted only where no observation exists
    (J6) and the history is the observed-over-predicted merge (J4)."""
    _, obs = ST.stream_history(ST.hourly_counts(ST.event_stream(spark, sf_dir)))
    hourly = ST.hourly_counts(A.table(spark, sf_dir, "events"), watermark=None)
    pred = W.lags(hourly, "cnt", (24,), order=("timestamp",), name="p").where(F.col("p").isNotNull()) \
        .select("series_id", "timestamp", F.sqrt(F.col("p").cast("double")).alias("cnt_transformed"))
    pred = J.write_predictions(pred, obs)
    return J.merge_history(obs, pred)


@query("stream_history_corrections", HOURLY_STREAM_SQL + """
SELECT series_id, h AS "timestamp",
  round(sqrt(CASE WHEN hour(h) = 23 THEN cnt - casual ELSE cnt END), 6) AS cnt_transformed
FROM hs""")
def q_corrections(spark, sf_dir):
    """Three deliveries of the hourly table, one run each, into one store
    kept by day. First all hours without their errors (version 1); then the
    first delivery again with the full count of hours that had errors (version
    2); then the last hour of every day without signups (version 3), with the
    first delivery once more, which must change nothing."""
    hours = ST.hourly_counts(A.table(spark, sf_dir, "events"), watermark=None)
    base = ST._scratch(spark, "corrections")
    row = lambda value, version: ["series_id", "timestamp", value.alias("cnt"), F.lit(version).cast("long").alias("version")]
    first = hours.select(*row(F.col("cnt") - F.col("n_error"), 1))
    errors = hours.where(F.col("n_error") > 0).select(*row(F.col("cnt"), 2))
    evening = hours.where(F.hour("timestamp") == 23).select(*row(F.col("cnt") - F.col("casual"), 3))
    for delivery in (first, first.unionByName(errors), evening.unionByName(first)):
        delivery.write.mode("append").parquet(f"{base}/deliveries")
        source = spark.readStream.schema(delivery.schema).parquet(f"{base}/deliveries")
        _, observed = ST.stream_history(source, version="version", path=base)
    return observed


_ALL_EVENTS = "SELECT value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type FROM events"


@query("stream_drift_monitor", f"SELECT *, CAST(0 AS INTEGER) AS batch_id FROM ({detect_sql(cur=_ALL_EVENTS)}) r")
def q_monitor(spark, sf_dir):
    """Every micro-batch of the event stream checked for drift (KS + PSI on
    value, chi-square on event_type) against the first half, which is summarised
    once before the stream starts; log rows per batch (the table is one file, so
    one batch)."""
    ref, _ = A.drift_pair(spark, sf_dir)
    cur = ST.event_stream(spark, sf_dir).select(
        "value", F.get_json_object("props", "$.k").cast("double").alias("k"), "event_type")
    return ST.stream_monitor(cur, ref, ["value", "k"], ["event_type"])


@query("stream_performance_check")
def q_perf_stream(spark, sf_dir):
    """O8 (scheduled performance check): seasonal-naive predictions of the
    test period arrive as a file stream, one file per day; every micro-batch's
    MAE is compared with the validation baseline (V2) and logged."""
    from ..operators import evaluate as M
    from .common import hourly_split
    hs = hourly_split(spark, sf_dir)
    p = W.lags(hs, "cnt", (24,), name="prediction").where(F.col("prediction").isNotNull()).select(
        "dteday", "split", F.col("cnt").cast("double").alias("y"), F.col("prediction").cast("double"))
    base = M.evaluate(p.where(F.col("split") == "val"), "y", "prediction").first().asDict()
    folder = ST._scratch(spark, "predictions")
    p.where(F.col("split") == "test").repartition("dteday").write.partitionBy("dteday").parquet(folder)
    src = spark.readStream.schema("y double, prediction double, split string").option("maxFilesPerTrigger", 1) \
        .parquet(folder)
    return ST.stream_monitor(src, None, name="perf", baseline=base, y="y", yhat="prediction")
