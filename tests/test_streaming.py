"""Streaming: batch and stream plans agree; state carries across micro-batches."""
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hourcast.streaming import streams as ST


def test_hourly_stream_equals_batch(spark):
    sf = "/root/testdata/sf0.001"
    s = ST.run_available_now(ST.hourly_counts(ST.event_stream(spark, sf)), "t_hourly")
    b = ST.hourly_counts(spark.read.parquet(f"{sf}/events.parquet"), watermark=None)
    mx = spark.read.parquet(f"{sf}/events.parquet").agg(F.max("ts")).first()[0]
    final = b.where(F.col("timestamp") + F.expr("INTERVAL 1 HOUR") <= F.lit(mx) - F.expr("INTERVAL 2 HOURS"))
    assert s.exceptAll(final).count() == 0 and final.exceptAll(s).count() == 0


def test_stateful_features_across_batches(spark):
    ts = pd.date_range("2024-01-01", periods=120, freq="h")
    vals = np.arange(120, dtype=float) ** 1.5
    pdf = pd.DataFrame({"series_id": "s", "timestamp": ts, "cnt": vals})
    folder = tempfile.mkdtemp(prefix="hourcast-stream-")
    sch = "series_id string, timestamp timestamp_ntz, cnt double"
    for i in range(4):   # four files written in time order -> four micro-batches
        spark.createDataFrame(pdf.iloc[i * 30:(i + 1) * 30], sch).coalesce(1).write.mode("append").parquet(folder)
    src = spark.readStream.schema(sch).option("maxFilesPerTrigger", 1).parquet(folder)
    out = ST.run_available_now(ST.stream_features(src, col="cnt", lags=(1, 24), roll=3), "t_state") \
        .toPandas().sort_values("timestamp").reset_index(drop=True)
    s = pd.Series(vals)
    np.testing.assert_allclose(out["cnt_lag_1h"].astype(float), s.shift(1), equal_nan=True)
    np.testing.assert_allclose(out["cnt_lag_24h"].astype(float), s.shift(24), equal_nan=True)
    np.testing.assert_allclose(out["cnt_roll_mean_3h"].astype(float), s.shift(1).rolling(3, min_periods=1).mean(), equal_nan=True)


def test_sliding_batch_counts(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    sd = ST.sliding_demand(ev, "3 hours", "1 hour").toPandas()
    pdf = ev.toPandas()
    h = pdf["ts"].dt.floor("h")
    exp = pd.concat([h - pd.Timedelta(hours=k) for k in range(3)]).value_counts()
    got = sd.set_index("window_start")["cnt"]
    assert got.sort_index().to_dict() == exp.sort_index().to_dict()


def test_stream_performance_log_matches_batches(spark):
    from hourcast.operators.drift import check_performance
    folder = tempfile.mkdtemp(prefix="hourcast-perf-")
    sch = "y double, prediction double"
    batches = [[(10.0, 11.0), (20.0, 18.0)], [(10.0, 30.0), (20.0, 0.0)]]   # MAE 1.5, then 20
    for rows in batches:
        spark.createDataFrame(rows, sch).coalesce(1).write.mode("append").parquet(folder)
    src = spark.readStream.schema(sch).option("maxFilesPerTrigger", 1).parquet(folder)
    log = ST.stream_monitor(src, None, name="t_perf", baseline={"mae": 2.0}).toPandas().sort_values("batch_id")
    assert log["mae"].tolist() == [1.5, 20.0]
    assert log["has_degradation"].tolist() == [False, True] and log["alert"].tolist() == [False, True]
    exp = check_performance(spark.createDataFrame(batches[1], sch), {"mae": 2.0}).first()["degradation_score"]
    assert log["degradation_score"].iloc[1] == exp


def test_history_stops_and_resumes(spark, tmp_path):
    """Two runs over a growing source equal one run; later batches win, ties by version."""
    from hourcast.streaming import streams as ST
    src, base = str(tmp_path / "src"), str(tmp_path / "hist")
    schema = "series_id string, timestamp timestamp_ntz, cnt long, version long"

    def add(rows):
        (spark.createDataFrame(rows, "series_id string, timestamp string, cnt long, version long")
         .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(src))

    def run(path):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        _, obs = ST.stream_history(stream, version="version", path=path)
        return sorted((r.series_id, str(r.timestamp), round(r.cnt_transformed ** 2)) for r in obs.collect())
    add([("a", "2024-01-01 00:00:00", 9, 1), ("a", "2024-01-01 00:00:00", 4, 2), ("a", "2024-01-01 01:00:00", 16, 1)])
    first = run(base)
    assert first == [("a", "2024-01-01 00:00:00", 4), ("a", "2024-01-01 01:00:00", 16)]
    add([("a", "2024-01-01 01:00:00", 25, 1), ("b", "2024-01-01 00:00:00", 1, 1)])
    assert run(base) == run(str(tmp_path / "once")) == [
        ("a", "2024-01-01 00:00:00", 4), ("a", "2024-01-01 01:00:00", 25), ("b", "2024-01-01 00:00:00", 1)]


def test_monitor_returns_both_logs(spark, tmp_path):
    from hourcast.streaming import streams as ST
    src = str(tmp_path / "src")
    d = spark.range(200).select(F.col("id").cast("double").alias("value"), (F.col("id") * 2.0).alias("y"), F.col("id").cast("double").alias("prediction"))
    d.coalesce(1).write.parquet(src)
    log = ST.stream_monitor(spark.readStream.schema(d.schema).parquet(src), d, ["value"], baseline={"mae": 1.0})
    rows = {r.check: r for r in log.collect()}
    assert set(rows) == {"drift", "performance"}
    assert rows["drift"].has_drift is False and rows["performance"].has_degradation is True


HOURS = "series_id string, timestamp timestamp_ntz, cnt double"


def _put(spark, folder, rows, schema=HOURS):
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
    frame["timestamp"] = pd.to_datetime(frame["timestamp"])
    spark.createDataFrame(frame, schema).coalesce(1).write.mode("append").parquet(folder)


def _features(spark, src, path, **kw):
    stream = spark.readStream.schema(HOURS).option("maxFilesPerTrigger", 1).parquet(src)
    out = ST.run_available_now(ST.stream_features(stream, lags=(1, 2), roll=2, **kw), "t_lags", path=path)
    return {(r.series_id, r.timestamp.strftime("%d %H")): (r.cnt, r.cnt_lag_1h, r.cnt_lag_2h, r.cnt_roll_mean_2h) for r in out.collect()}


def test_features_late_and_repeated_hours(spark, tmp_path):
    src = str(tmp_path / "src")
    _put(spark, src, [("a", "2024-01-01 02:00", 4.0), ("a", "2024-01-01 00:00", 1.0), ("a", "2024-01-01 02:00", 3.0)])
    _put(spark, src, [("a", "2024-01-01 01:00", 7.0), ("a", "2024-01-01 03:00", 8.0), ("a", "2024-01-01 02:00", 99.0),
                      ("b", "2024-01-01 00:00", None), ("b", "2024-01-01 01:00", 5.0), (None, "2024-01-01 01:00", 5.0)])
    assert _features(spark, src, str(tmp_path / "out")) == {
        ("a", "01 00"): (1.0, None, None, None), ("a", "01 02"): (4.0, 1.0, None, 1.0),
        ("a", "01 01"): (7.0, 1.0, None, 1.0), ("a", "01 03"): (8.0, 4.0, 7.0, 5.5),
        ("b", "01 00"): (None, None, None, None), ("b", "01 01"): (5.0, None, None, None)}


def test_features_stop_and_resume(spark, tmp_path):
    """Two runs over a growing source equal one run; a run with TTL ends."""
    src = str(tmp_path / "src")
    rows = [(s, f"2024-01-{1 + h // 24:02d} {h % 24:02d}:00", float(h * h % 17)) for h in range(40) for s in "ab"]
    _put(spark, src, rows[:30])
    _features(spark, src, str(tmp_path / "two"), ttl_hours=24)
    _put(spark, src, rows[30:])
    two = _features(spark, src, str(tmp_path / "two"), ttl_hours=24)
    assert len(two) == 80 and two == _features(spark, src, str(tmp_path / "one"))


def test_features_expire(spark, tmp_path):
    """A series a day behind the stream's newest hour starts anew; one within the day does not."""
    src = str(tmp_path / "src")
    for rows in ([("a", "2024-01-01 00:00", 1.0), ("c", "2024-01-04 12:00", 2.0)], [("b", "2024-01-05 00:00", 1.0)],
                 [("a", "2024-01-05 01:00", 3.0), ("c", "2024-01-05 01:00", 4.0), ("b", "2024-01-02 00:00", 9.0)]):
        _put(spark, src, rows)
    got = _features(spark, src, str(tmp_path / "out"), ttl_hours=24)
    assert got["a", "05 01"] == (3.0, None, None, None) and got["c", "05 01"] == (4.0, 2.0, None, 2.0)
    assert ("b", "02 00") not in got


def _store(spark, path):
    from hourcast.streaming.store import HourStore
    return HourStore(spark, path, value="v", version="version")


def _rows(spark, rows):
    return (spark.createDataFrame(rows, "series_id string, timestamp string, v double, version long")
            .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")))


def _held(frame):
    return sorted((r.series_id, str(r.timestamp), r.v) for r in frame.collect())


def test_store_replay_and_compaction(spark, tmp_path):
    store = _store(spark, str(tmp_path / "s"))
    assert _held(store.read()) == []
    one = _rows(spark, [("a", "2024-01-01 00:00:00", 1.0, 1), ("a", "2024-01-02 00:00:00", 2.0, 1), ("a", None, 2.0, 1)])
    two = _rows(spark, [("a", "2024-01-02 00:00:00", 5.0, 2), ("b", "2024-01-02 01:00:00", 6.0, 1)])
    three = _rows(spark, [("a", "2024-01-02 00:00:00", 9.0, 1), ("b", "2024-01-02 01:00:00", 7.0, 1)])
    store.upsert(one, 0)
    store.upsert(two, 1)
    want = [("a", "2024-01-01 00:00:00", 1.0), ("a", "2024-01-02 00:00:00", 5.0), ("b", "2024-01-02 01:00:00", 6.0)]
    assert _held(store.read()) == want and store.manifest() == {"2024-01-01": 0, "2024-01-02": 1}
    store.upsert(two, 1)  # replayed
    assert _held(store.read()) == want
    store.upsert(three, 2)  # an older version changes nothing, an equal one does
    assert _held(store.read()) == want[:2] + [("b", "2024-01-02 01:00:00", 7.0)]
    day = tmp_path / "s" / "observed" / "day=2024-01-02"
    assert sorted(p.name for p in day.iterdir()) == ["batch_id=1", "batch_id=2"]
    store.upsert(_rows(spark, []), 3)
    assert store.manifest() == {"2024-01-01": 0, "2024-01-02": 2}


def test_store_reads_the_files_of_a_day(spark, tmp_path):
    store = _store(spark, str(tmp_path / "s"))
    store.upsert(_rows(spark, [("a", f"2024-01-{d:02d} 05:00:00", 1.0, 1) for d in range(1, 29)]), 0)
    files = store.read("2024-01-03", "2024-01-04").inputFiles()
    assert {f.split("day=")[1][:10] for f in files} == {"2024-01-03", "2024-01-04"}


def test_store_batch_without_commit_is_not_seen(spark, tmp_path):
    store = _store(spark, str(tmp_path / "s"))
    store.upsert(_rows(spark, [("a", "2024-01-01 00:00:00", 1.0, 1)]), 0)
    store.upsert(_rows(spark, [("a", "2024-01-01 00:00:00", 2.0, 2)]), 1)
    (tmp_path / "s" / "manifest" / "batch_id=1" / "_SUCCESS").unlink()  # as if the driver had died before
    assert _held(store.read()) == [("a", "2024-01-01 00:00:00", 1.0)]
    store.upsert(_rows(spark, [("a", "2024-01-01 00:00:00", 2.0, 2)]), 1)
    assert _held(store.read()) == [("a", "2024-01-01 00:00:00", 2.0)]


def test_history_drops_what_is_delivered_twice(spark, tmp_path):
    """Within the watermark a delivery counts once, also after a correction without a version."""
    src, base = str(tmp_path / "src"), str(tmp_path / "hist")
    schema = HOURS + ", delivery string"
    for rows in ([("a", "2024-01-01 00:00", 9.0, "x")], [("a", "2024-01-01 00:00", 16.0, "y")], [("a", "2024-01-01 00:00", 9.0, "x")]):
        _put(spark, src, rows, schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    _, observed = ST.stream_history(stream, unique=["delivery"], watermark="1 day", path=base)
    assert [r.cnt_transformed for r in observed.collect()] == [4.0]
