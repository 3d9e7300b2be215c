"""Request parsing / validation and history persistence."""
import json

import pytest
from pyspark.sql import functions as F

from hourcast.operators import profile as J
from hourcast.operators import serving as O

BASE = {"dteday": "2011-01-01", "temp": 0.24, "atemp": 0.2879, "hum": 0.81, "windspeed": 0.0, "season": 1,
        "weathersit": 1, "hr": 0, "weekday": 6, "holiday": 0, "workingday": 0}


def _parse(spark, bodies):
    df = spark.createDataFrame([(i, json.dumps(b) if not isinstance(b, str) else b) for i, b in enumerate(bodies)],
                               "request_id long, body string")
    return {(r["request_id"], r["record_idx"]): r for r in O.parse_requests(df).collect()}


def test_request_shapes(spark):
    out = _parse(spark, [
        {"features": BASE},                                               # 0 single
        {"records": [BASE, {"features": BASE}]},                          # 1 flat + wrapped
        {"features": BASE, "records": [BASE]},                            # 2 both
        {},                                                               # 3 none
        {"features": {**BASE, "yr": 0, "mnth": 1}},                       # 4 unknown fields (old examples)
        {"features": {k: v for k, v in BASE.items() if k != "dteday"}},   # 5 missing dteday
        {"features": {**BASE, "hr": 24}},                                 # 6 range
        {"features": {**BASE, "hr": 3.5}},                                # 7 int type
        {"features": {**BASE, "temp": 1}},                                # 8 int accepted for float
        {"features": BASE, "extra": 1},                                   # 9 unknown top-level key
    ])
    assert out[(0, 0)]["reject_reason"] is None and out[(0, 0)]["hr"] == 0
    assert out[(1, 0)]["reject_reason"] is None and out[(1, 1)]["reject_reason"] is None
    assert out[(2, 0)]["reject_reason"] == "request:both"
    assert out[(3, 0)]["reject_reason"] == "request:none"
    assert out[(4, 0)]["reject_reason"] == "record:extra_field"
    assert out[(5, 0)]["reject_reason"] == "missing:dteday"
    assert out[(6, 0)]["reject_reason"] == "range:hr"
    assert out[(7, 0)]["reject_reason"] == "type:hr"
    assert out[(8, 0)]["reject_reason"] is None and out[(8, 0)]["temp"] == 1.0
    assert out[(9, 0)]["reject_reason"] == "request:extra_field"


def test_history_rules(spark):
    sch = "series_id string, timestamp timestamp_ntz, cnt_transformed double"
    t = lambda h: f"2024-01-01 {h:02d}:00:00"
    obs = spark.createDataFrame([("s", t(0), 5.0), ("s", t(1), 6.0)], "series_id string, timestamp string, cnt_transformed double") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    pred = spark.createDataFrame([("s", t(1), 9.0), ("s", t(2), 7.0), ("s", t(3), 7.0)],
                                 "series_id string, timestamp string, cnt_transformed double") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    m = {r["timestamp"].hour: r for r in J.merge_history(obs, pred).collect()}
    assert m[1]["cnt_transformed"] == 6.0 and m[1]["is_observed"]          # observed wins
    assert m[2]["cnt_transformed"] == m[3]["cnt_transformed"] == 7.0      # equal values both kept (F9)
    w = J.write_predictions(pred, obs).collect()
    assert sorted(r["timestamp"].hour for r in w) == [2, 3]
    p = O.persist_predictions(pred.withColumnRenamed("cnt_transformed", "prediction")
                              .union(spark.createDataFrame([("s", None, -4.0)], "series_id string, timestamp timestamp_ntz, prediction double")
                                     .withColumn("timestamp", F.lit(t(4)).cast("timestamp_ntz")))
                              .union(spark.createDataFrame([("s", None, float("nan"))], "series_id string, timestamp timestamp_ntz, prediction double")
                                     .withColumn("timestamp", F.lit(t(5)).cast("timestamp_ntz"))), obs)
    got = {r["timestamp"].hour: r["cnt_transformed"] for r in p.collect()}
    assert got == {2: pytest.approx(7.0 ** 0.5), 3: pytest.approx(7.0 ** 0.5), 4: 0.0}
    del sch


def test_malformed_requests_are_rejected_not_dropped(spark):
    out = _parse(spark, [
        {"records": [1]},                 # 0 record that is not an object
        {"features": None},               # 1 null features
        {"records": []},                  # 2 empty records
        "not json",                       # 3 not JSON at all
    ])
    assert len(out) == 4                  # every request keeps a row with a reason
    assert all(r["reject_reason"] is not None for r in out.values())
    assert out[(2, 0)]["reject_reason"] == "request:none" and out[(3, 0)]["reject_reason"] == "request:none"


def _history(spark, rows):
    return (spark.createDataFrame(rows, "series_id string, row_id long, h int, cnt_transformed double")
            .withColumn("timestamp", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, h)")).drop("h"))


def _asked(spark, rows):
    return (spark.createDataFrame(rows, "request_id long, series_id string, m int")
            .withColumn("timestamp", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, m)")).drop("m"))


def _build(w):
    from hourcast.operators import windows as W
    return {"lag1": W.lag_expr("cnt_transformed", 1, w), "lag24": W.lag_expr("cnt_transformed", 24, w),
            "mean3": W.roll_mean_expr("cnt_transformed", 3, w, 1, False)}


def test_batch_equals_one_by_one(spark):
    """Each request alone sees what it sees in a batch: its own history only."""
    rows = [("a", h, h, float(h * h)) for h in range(60) if h % 7] + [("a", 100, 10, 5.5), ("b", 1, 3, 9.0)]
    hist = _history(spark, rows)
    asks = [(1, "a", 0), (2, "a", 65), (3, "a", 600), (4, "a", 630), (5, "a", 630), (6, "a", 50 * 60), (7, "a", 10_000),
            (8, "b", 200), (9, "none", 60), (10, "a", 61)]
    batch = {r.request_id: (r.lag1, r.lag24, r.mean3) for r in J.serve_features(_asked(spark, asks), hist, _build, 24).collect()}
    want = {}
    for i, s, m in asks:
        own = [v for _, _, v in sorted((h, k, v) for t, k, h, v in rows if t == s and 60 * h < m)]
        want[i] = (own[-1] if own else None, own[-24] if len(own) >= 24 else None, pytest.approx(sum(own[-3:]) / len(own[-3:])) if own else None)
    assert batch == want
    for ask in asks[2:5]:
        one = J.serve_features(_asked(spark, [ask]), hist, _build, 24).first()
        assert (one.lag1, one.lag24, one.mean3) == batch[ask[0]]


def test_request_history_at_any_minute(spark):
    hist = _history(spark, [("a", h, h, float(h)) for h in range(60)])
    asks = [(1, "a", 40 * 60), (2, "a", 40 * 60 + 30), (3, "a", 5)]
    got = {}
    for r in J.request_history(_asked(spark, asks), hist, 24).collect():
        got.setdefault(r.request_id, set()).add(int(r.cnt_transformed))
    assert got == {1: set(range(16, 40)), 2: set(range(17, 41)), 3: {0}}
