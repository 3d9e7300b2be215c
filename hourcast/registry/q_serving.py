"""Batch scoring queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FT
from ..operators import models as MD
from ..operators import serving as O
from ..operators import windows as W
from ..sources import adapters as A
from .common import hourly_split
from .core import query
from .sqlviews import cte

FLOATS = list(O.FLOAT_FIELDS)
INTS = list(O.INT_FIELDS)


def _parse_sql():
    f = ("json_object('dteday', CAST(dteday AS VARCHAR), 'temp', least(temp, 1.0), 'atemp', least(atemp, 1.0), "
         "'hum', CASE WHEN row_id % 25 = 0 THEN 1.5 ELSE hum END, 'windspeed', windspeed, 'season', season, "
         "'weathersit', weathersit, 'hr', hr, 'weekday', weekday, 'holiday', holiday, 'workingday', workingday)")
    fields = ", ".join(f"'{x}'" for x in O.FIELDS)
    reason = ["WHEN rq IS NOT NULL THEN rq",
              f"WHEN len(list_filter(json_keys(rec), lambda k: k NOT IN ({fields}))) > 0 THEN 'record:extra_field'"]
    reason += [f"WHEN NOT list_contains(json_keys(rec), '{x}') THEN 'missing:{x}'" for x in O.FIELDS]
    reason.append("WHEN json_type(rec, '$.dteday') <> 'VARCHAR' OR TRY_CAST(json_extract_string(rec, '$.dteday') AS DATE) IS NULL "
                  "THEN 'type:dteday'")
    reason += [f"WHEN json_type(rec, '$.{x}') NOT IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN 'type:{x}'" for x in FLOATS]
    reason += [f"WHEN json_type(rec, '$.{x}') NOT IN ('BIGINT', 'UBIGINT') THEN 'type:{x}'" for x in INTS]
    reason += [f"WHEN NOT CAST(json_extract(rec, '$.{x}') AS DOUBLE) BETWEEN {lo} AND {hi} THEN 'range:{x}'"
               for x, (lo, hi) in {**O.FLOAT_FIELDS, **O.INT_FIELDS}.items()]
    outs = ["CASE WHEN reason IS NULL THEN CAST(json_extract_string(rec, '$.dteday') AS DATE) END AS dteday"]
    outs += [f"CASE WHEN reason IS NULL THEN round(CAST(json_extract(rec, '$.{x}') AS DOUBLE), 6) END AS {x}" for x in FLOATS]
    outs += [f"CASE WHEN reason IS NULL THEN CAST(json_extract(rec, '$.{x}') AS INTEGER) END AS {x}" for x in INTS]
    return cte("hourly") + f""",
rq0 AS (SELECT row_id AS request_id, CASE WHEN row_id % 50 = 0 THEN json_object('features', f, 'extra', 1)
          WHEN row_id % 2 = 0 THEN json_object('features', f)
          ELSE json_object('records', json_array(f, json_object('features', f))) END AS body
        FROM (SELECT row_id, {f} AS f FROM hourly) t),
p AS (SELECT request_id, json_keys(body) AS top, json_extract(body, '$.features') AS feat,
        coalesce(json_array_length(json_extract(body, '$.records')), 0) AS nrec, json_extract(body, '$.records') AS recs FROM rq0),
p2 AS (SELECT request_id, CASE WHEN len(list_filter(top, lambda k: k NOT IN ('features', 'records'))) > 0 THEN 'request:extra_field'
          WHEN feat IS NOT NULL AND nrec > 0 THEN 'request:both' WHEN feat IS NULL AND nrec = 0 THEN 'request:none' END AS rq,
        CASE WHEN feat IS NOT NULL AND nrec = 0 THEN [feat] WHEN nrec > 0 AND feat IS NULL THEN CAST(recs AS JSON[])
          ELSE [NULL::JSON] END AS items FROM p),
ex AS (SELECT request_id, rq, unnest(items) AS raw, CAST(generate_subscripts(items, 1) - 1 AS INTEGER) AS record_idx FROM p2),
rc AS (SELECT *, CASE WHEN json_keys(raw) = ['features'] THEN json_extract(raw, '$.features') ELSE raw END AS rec FROM ex),
rs AS (SELECT *, CASE {' '.join(reason)} END AS reason FROM rc)
SELECT request_id, record_idx, {', '.join(outs)}, reason AS reject_reason FROM rs"""


@query("serve_parse_requests", _parse_sql())
def q_parse(spark, sf_dir):
    """O1 + O2: JSON requests (single ``features`` or ``records`` lists with
    flat / wrapped records) exploded to records, typed and validated; invalid
    records carry the first failing check as ``reject_reason``."""
    return O.parse_requests(A.requests(spark, sf_dir))


@query("serve_persist_predictions", cte("npred") + """,
obs AS (SELECT series_id, "timestamp" FROM hsplit WHERE split <> 'test'),
p AS (SELECT series_id, "timestamp", CAST(prediction AS DOUBLE) - 12 AS prediction FROM npred WHERE split <> 'train')
SELECT series_id, "timestamp", round(CASE WHEN prediction >= 0 THEN sqrt(prediction) ELSE 0.0 END, 6) AS cnt_transformed
FROM p WHERE NOT EXISTS (SELECT 1 FROM obs WHERE obs.series_id = p.series_id AND obs."timestamp" = p."timestamp")""")
def q_persist(spark, sf_dir):
    """Predictions become history rows: sqrt(max(p, 0)), skipped where an
    observation exists (observed = all non-test hours;
    predictions = seasonal-naive forecast minus 12, so some are negative)."""
    hs = hourly_split(spark, sf_dir)
    p = W.lags(hs, "cnt", (24,), name="prediction").where(F.col("prediction").isNotNull())
    p = p.where(F.col("split") != "train").withColumn("prediction", F.col("prediction").cast("double") - 12)
    obs = hs.where(F.col("split") != "test").select("series_id", "timestamp")
    return O.persist_predictions(p, obs)


SERVICE_FEATURES = ["temp", "atemp", "hum", "windspeed", "season", "weathersit", "hr", "weekday", "holiday",
                    "workingday", "hr_sin", "hr_cos", "weekday_sin", "weekday_cos", "is_peak_hour",
                    "is_commute_window", "is_perfect_weather", "hr_workingday", "temp_squared",
                    "cnt_transformed_lag_1h", "cnt_transformed_lag_24h", "cnt_transformed_roll_mean_3h"]


def _derive(d):
    d = FT.cyclical(d, ("hr", "weekday"), period="service")
    d = FT.time_flags(d, "service")
    d = FT.perfect_weather(d, "service")
    d = FT.hr_workingday(FT.weather_interactions(d))
    return d


def _hist_build(w):
    return {"cnt_transformed_lag_1h": W.lag_expr("cnt_transformed", 1, w),
            "cnt_transformed_lag_24h": W.lag_expr("cnt_transformed", 24, w),
            "cnt_transformed_roll_mean_3h": W.roll_mean_expr("cnt_transformed", 3, w, 1, False)}


@query("serve_score_requests")
def q_score(spark, sf_dir):
    """O3: valid requests of the test period are scored: history lags from the
    observed table (each request: strictly before its own hour, F8), service-preset derived features,
    a ridge pipeline fit on train with the same feature plan, sqrt inverse."""
    hs = hourly_split(spark, sf_dir)
    train = _derive(W.series_select(hs, _hist_build, 24)).where(F.col("split") == "train")
    dm = MD.fit_pipeline(train, SERVICE_FEATURES, label="cnt", model="ridge", transform="sqrt")
    parsed = O.parse_requests(A.requests(spark, sf_dir))
    test_hours = hs.where(F.col("split") == "test").select("dteday", "hr")
    valid = O.valid_requests(parsed).join(test_hours, ["dteday", "hr"], "left_semi")
    hist = hs.select("series_id", "row_id", "timestamp", "cnt_transformed")
    return O.score_requests(valid, dm, hist, _hist_build, 24, derive=_derive)
