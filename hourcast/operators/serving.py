"""Batch scoring path (O1-O4): parse and validate JSON requests, score,
persist predictions under the observed-over-predicted rule."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .profile import write_predictions

# FIXED VALUES: request fields, their kinds and inclusive ranges
FLOAT_FIELDS = {"temp": (0.0, 1.0), "atemp": (0.0, 1.0), "hum": (0.0, 1.0), "windspeed": (0.0, 1.0)}
INT_FIELDS = {"season": (1, 4), "weathersit": (1, 4), "hr": (0, 23), "weekday": (0, 6),
              "holiday": (0, 1), "workingday": (0, 1)}
FIELDS = ["dteday", "temp", "atemp", "hum", "windspeed", "season", "weathersit", "hr", "weekday",
          "holiday", "workingday"]

RECORD_SCHEMA = T.StructType(
    [T.StructField("dteday", T.DateType())]
    + [T.StructField(f, T.DoubleType()) for f in FLOAT_FIELDS]
    + [T.StructField(f, T.IntegerType()) for f in INT_FIELDS])


def _keys(js: Column) -> Column:
    return F.map_keys(F.from_json(js, T.MapType(T.StringType(), T.StringType())))


def parse_requests(requests: DataFrame, body="body", req_id="request_id", keep=()) -> DataFrame:
    """O1 + O2: one row per record with ``record_idx``, the typed fields (NULL
    when rejected) and ``reject_reason`` (NULL when valid).

    Request level: only the keys ``features`` / ``records``, exactly one of
    them (records non-empty). Record level: a record is flat or
    ``{"features": {...}}``; every field present, no extra field, JSON type
    right (floats: any number; ints: integer numbers; dteday: a date), value in
    range. The first failing check names the reason.
    """
    b = F.col(body)
    top = _keys(b)
    recs = F.from_json(F.get_json_object(b, "$.records"), T.ArrayType(T.StringType()))
    feat = F.get_json_object(b, "$.features")
    has_f = feat.isNotNull()
    has_r = F.coalesce(F.size(recs) > 0, F.lit(False))
    req_reason = (F.when(F.size(F.array_except(top, F.array(F.lit("features"), F.lit("records")))) > 0,
                         F.lit("request:extra_field"))
                  .when(has_f & has_r, F.lit("request:both"))
                  .when(~has_f & ~has_r, F.lit("request:none")))
    items = F.when(has_f & ~has_r, F.array(feat)).when(has_r & ~has_f, recs).otherwise(F.array(F.lit(None).cast("string")))
    d = requests.select(req_id, *keep, req_reason.alias("_rq"), F.posexplode(items).alias("record_idx", "_raw"))
    rk = _keys(F.col("_raw"))
    wrapped = (F.size(rk) == 1) & F.array_contains(rk, "features")
    d = d.withColumn("_rec", F.when(wrapped, F.get_json_object("_raw", "$.features")).otherwise(F.col("_raw")))
    k = _keys(F.col("_rec"))
    typed = F.from_json(F.col("_rec"), RECORD_SCHEMA)
    d = d.withColumn("_k", k).withColumn("_t", typed)
    reason = F.when(F.col("_rq").isNotNull(), F.col("_rq"))
    reason = reason.when(F.size(F.array_except("_k", F.array(*[F.lit(f) for f in FIELDS]))) > 0,
                         F.lit("record:extra_field"))
    for f in FIELDS:
        reason = reason.when(~F.array_contains("_k", f), F.lit(f"missing:{f}"))
    for f in FIELDS:
        reason = reason.when(F.col("_t")[f].isNull(), F.lit(f"type:{f}"))
    for f, (lo, hi) in {**FLOAT_FIELDS, **INT_FIELDS}.items():
        reason = reason.when(~F.col("_t")[f].between(lo, hi), F.lit(f"range:{f}"))
    d = d.withColumn("reject_reason", reason)
    ok = F.col("reject_reason").isNull()
    return d.select(req_id, *keep, F.col("record_idx").cast("int"),
                    *[F.when(ok, F.col("_t")[f]).alias(f) for f in FIELDS], "reject_reason")


def valid_requests(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_requests(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNotNull()).select("request_id", "record_idx", "reject_reason")


def request_timestamp(df: DataFrame, name="timestamp") -> DataFrame:
    """Hour stamp of a request: dteday + hr."""
    return df.withColumn(name, F.to_timestamp_ntz(F.col("dteday").cast("string"))
                         + F.make_dt_interval(F.lit(0), F.col("hr")))


def persist_predictions(pred: DataFrame, observed: DataFrame, *, series="series_id", ts="timestamp",
                        value="prediction") -> DataFrame:
    """Predictions to history rows: NaN / NULL skipped, sqrt(max(p, 0)),
    never over an observed hour (left-anti join, J6)."""
    p = pred.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
    p = p.select(series, ts, F.when(F.col(value) >= 0, F.sqrt(F.col(value))).otherwise(F.lit(0.0))
                 .alias("cnt_transformed"))
    return write_predictions(p, observed, series=series, ts=ts)


def score_requests(valid: DataFrame, model, history: DataFrame, build_fn, lookback: int, *,
                   series="series_id", derive=None) -> DataFrame:
    """O3: request rows get history window features (J7, strict < request
    time), derived features (``derive``), then the fitted model predicts."""
    from .profile import serve_features
    r = request_timestamp(valid)
    if series not in r.columns:
        r = r.withColumn(series, F.lit("all"))
    if "row_id" not in r.columns:
        r = r.withColumn("row_id", F.col("request_id"))
    f = serve_features(r, history, build_fn, lookback, series=series)
    if derive is not None:
        f = derive(f)
    return model.predict(f, keep=("request_id", "record_idx", series, "timestamp"))
