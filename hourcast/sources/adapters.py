"""Adapters: the reference's input tables derived from the test tables.

They only reshape rows into the schemas the operators expect; no operator's
work happens here. Matching DuckDB views live in ``hourcast.registry.sqlviews``.

FIXED VALUES of the ``hourly`` adapter (the data covers January 2024):
holidays 2024-01-01 and 2024-01-15; season = 1 + (day_of_month - 1) div 8;
weathersit = 1 + (error events in the hour) mod 4; temp / atemp = value of the
first / last event of the hour divided by 100; hum = mean of props.k / 100;
windspeed = median value / 100; casual = signup events; registered = view,
click and purchase events; cnt = all events.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOLIDAYS = ("2024-01-01", "2024-01-15")
REGISTERED_TYPES = ("view", "click", "purchase")


def hour_of(col: str) -> Column:
    """Wall-clock hour start of a TIMESTAMP_NTZ column, in pure NTZ arithmetic
    (independent of the session time zone)."""
    from ..functions.exprs import hour_start
    return hour_start(col)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hour_aggs() -> list[Column]:
    et = F.col("event_type")
    return [
        F.min_by("value", "event_id").alias("_tmin"),
        F.max_by("value", "event_id").alias("_tmax"),
        F.avg(F.get_json_object("props", "$.k").cast("double")).alias("_k"),
        F.count_if(et == "error").alias("_err"),
        F.count_if(et == "signup").alias("casual"),
        F.count_if(et.isin(*REGISTERED_TYPES)).alias("registered"),
        F.count(F.lit(1)).alias("cnt"),
    ]


def _shape(g: DataFrame) -> DataFrame:
    h = F.col("timestamp")
    d = F.to_date(h)
    wd = (F.dayofweek(h) - 1).cast("int")
    hol = d.isin(*[F.lit(x).cast("date") for x in HOLIDAYS])
    return g.select(
        "series_id",
        F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'1970-01-01 00:00:00', timestamp)").alias("row_id"),
        "timestamp",
        d.alias("dteday"),
        (F.year(h) - 2011).cast("int").alias("yr"),
        F.month(h).cast("int").alias("mnth"),
        F.hour(h).cast("int").alias("hr"),
        wd.alias("weekday"),
        (F.lit(1) + F.floor((F.dayofmonth(h) - 1) / 8)).cast("int").alias("season"),
        hol.cast("int").alias("holiday"),
        (wd.between(1, 5) & ~hol).cast("int").alias("workingday"),
        (F.lit(1) + F.col("_err") % 4).cast("int").alias("weathersit"),
        (F.col("_tmin") / 100).alias("temp"),
        (F.col("_tmax") / 100).alias("atemp"),
        (F.col("_k") / 100).alias("hum"),
        (F.col("_med") / 100).alias("windspeed"),
        F.col("casual").cast("long"), F.col("registered").cast("long"),
        F.col("cnt").cast("long"),
    )


def _with_median(ev: DataFrame, keys: list) -> DataFrame:
    """Hourly aggregates plus the exact median of ``value`` per hour, in two
    scans of events: the first takes the aggregates and brackets the medians."""
    from ..plans.quantiles import group_quantiles
    hours, med = group_quantiles(ev, keys, "value", [0.5], extra=_hour_aggs())
    return hours.join(med.select(*keys, F.col("q").alias("_med")), keys, "left")


def materialize(df: DataFrame) -> DataFrame:
    """Write a derived input once (reliable checkpoint in the shared folder)
    so the several branches of a query plan read it instead of recomputing it."""
    from ..session import cut_lineage
    return cut_lineage(df)


def hourly(spark: SparkSession, sf_dir: str, *, materialized: bool = True) -> DataFrame:
    """One global hourly series (series_id 'all') in the canonical schema."""
    ev = table(spark, sf_dir, "events").withColumn("timestamp", hour_of("ts"))
    out = _shape(_with_median(ev, ["timestamp"]).withColumn("series_id", F.lit("all")))
    return materialize(out) if materialized else out


def hourly_by_type(spark: SparkSession, sf_dir: str, *, materialized: bool = True) -> DataFrame:
    """Five keyed series (one per event_type)."""
    ev = (table(spark, sf_dir, "events").withColumn("timestamp", hour_of("ts"))
          .withColumn("series_id", F.col("event_type")))
    out = _shape(_with_median(ev, ["series_id", "timestamp"]))
    return materialize(out) if materialized else out


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long daily series: orders per order date."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.to_date("o_orderdate").alias("dteday"))
            .agg(F.count(F.lit(1)).alias("cnt"), F.sum("o_totalprice").alias("total"))
            .select(F.lit("orders").alias("series_id"),
                    F.datediff("dteday", F.lit("1970-01-01").cast("date")).cast("long").alias("row_id"),
                    F.col("dteday").cast("timestamp_ntz").alias("timestamp"),
                    "dteday", "cnt", "total"))


DIRTY_COLS = ("instant", "dteday", "season", "yr", "mnth", "hr", "holiday", "weekday",
              "workingday", "weathersit", "temp", "atemp", "hum", "windspeed",
              "casual", "registered", "cnt", "mixed_type_col")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw all-string table with the reference's fault kinds injected.

    Doubles are written as fixed 6-decimal text. Faults are placed by a fixed
    rule on row_id: padding blanks, ' NAN ' text,
    empty-ish null tokens, hr=314, weathersit=11, yr=2.5, temp/atemp > 1.
    """
    h = hourly(spark, sf_dir)
    r = F.col("row_id")

    def txt(c):
        # doubles as fixed 6-decimal text (engine-independent formatting)
        return F.format_string("%.6f", F.col(c)) if c in ("temp", "atemp", "hum", "windspeed") \
            else F.col(c).cast("string")

    def fault(c, cond, token):
        return F.when(cond, F.lit(token)).otherwise(txt(c)).alias(c)

    return h.select(
        F.col("row_id").cast("string").alias("instant"),
        F.when(r % 97 == 5, F.lit("not a date")).otherwise(F.col("dteday").cast("string")).alias("dteday"),
        fault("season", r % 53 == 1, " NAN "),
        fault("yr", r % 211 == 3, "2.5"),
        fault("mnth", r % 59 == 2, "NA"),
        F.when(r % 89 == 7, F.lit("314")).otherwise(F.concat(F.lit(" "), F.col("hr").cast("string"), F.lit(" "))).alias("hr"),
        fault("holiday", r % 61 == 4, ""),
        fault("weekday", r % 67 == 6, "null"),
        fault("workingday", r % 71 == 8, "None"),
        F.when(r % 73 == 9, F.lit("11")).otherwise(F.col("weathersit").cast("string")).alias("weathersit"),
        fault("temp", r % 31 == 10, " NAN "),
        fault("atemp", r % 37 == 11, "N/A"),
        fault("hum", r % 41 == 12, " "),
        fault("windspeed", r % 43 == 13, "NULL"),
        fault("casual", r % 47 == 14, "NaN"),
        fault("registered", r % 79 == 15, ""),
        fault("cnt", r % 83 == 16, " NAN "),
        F.when(r % 10 == 0, F.lit(None)).when(r % 2 == 0, F.lit("abc"))
         .otherwise(r.cast("string")).alias("mixed_type_col"),
    )


def drift_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reference = events up to the middle day of the table, current = the rest."""
    ev = table(spark, sf_dir, "events")
    base = ev.select(F.to_date("ts").alias("d"), "value",
                     F.get_json_object("props", "$.k").cast("double").alias("k"), "event_type")
    ends = ev.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    middle = F.lit(None if ends[0] is None else ends[0] + (ends[1] - ends[0]) / 2).cast("date")
    return base.where(F.col("d") < middle).drop("d"), base.where(F.col("d") >= middle).drop("d")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests as JSON bodies built from hourly rows.

    Even rows: single ``{"features": {...}}``; odd rows: ``{"records": [...]}``
    with one flat and one wrapped record; every 50th row carries an unknown
    field (rejected), every 25th row a humidity outside [0, 1] (rejected).
    """
    h = hourly(spark, sf_dir)
    r = F.col("row_id")
    feats = F.struct(
        F.col("dteday").cast("string").alias("dteday"),
        F.least(F.col("temp"), F.lit(1.0)).alias("temp"), F.least(F.col("atemp"), F.lit(1.0)).alias("atemp"),
        F.when(r % 25 == 0, F.lit(1.5)).otherwise(F.col("hum")).alias("hum"),
        "windspeed", "season", "weathersit", "hr", "weekday", "holiday", "workingday")
    fj = F.to_json(feats)
    body = (F.when(r % 50 == 0, F.concat(F.lit('{"features":'), fj, F.lit(',"extra":1}')))
            .when(r % 2 == 0, F.concat(F.lit('{"features":'), fj, F.lit('}')))
            .otherwise(F.concat(F.lit('{"records":['), fj, F.lit(',{"features":'), fj, F.lit('}]}'))))
    return h.select(r.alias("request_id"), F.lit("all").alias("series_id"), "timestamp",
                    body.alias("body"))
