"""DuckDB forms of the adapters in ``hourcast.sources.adapters`` (oracle side)."""

_HOUR_AGGS = """
    arg_min(value, event_id) AS tmin, arg_max(value, event_id) AS tmax,
    avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS kk,
    median(value) AS med,
    count(*) FILTER (WHERE event_type = 'error') AS err,
    count(*) FILTER (WHERE event_type = 'signup') AS casual,
    count(*) FILTER (WHERE event_type IN ('view', 'click', 'purchase')) AS registered,
    count(*) AS cnt"""

_SHAPE = """
  SELECT series_id, date_diff('hour', TIMESTAMP '1970-01-01 00:00:00', h) AS row_id,
    h AS "timestamp", CAST(h AS DATE) AS dteday,
    CAST(year(h) - 2011 AS INTEGER) AS yr, CAST(month(h) AS INTEGER) AS mnth,
    CAST(hour(h) AS INTEGER) AS hr, CAST(dayofweek(h) AS INTEGER) AS weekday,
    CAST(1 + (day(h) - 1) // 8 AS INTEGER) AS season,
    CAST(CAST(h AS DATE) IN (DATE '2024-01-01', DATE '2024-01-15') AS INTEGER) AS holiday,
    CAST(dayofweek(h) BETWEEN 1 AND 5 AND CAST(h AS DATE) NOT IN (DATE '2024-01-01', DATE '2024-01-15') AS INTEGER) AS workingday,
    CAST(1 + err % 4 AS INTEGER) AS weathersit,
    tmin / 100 AS temp, tmax / 100 AS atemp, kk / 100 AS hum, med / 100 AS windspeed,
    CAST(casual AS BIGINT) AS casual, CAST(registered AS BIGINT) AS registered, CAST(cnt AS BIGINT) AS cnt
"""

VIEWS = {
    "hourly": f"""hourly AS ({_SHAPE}
  FROM (SELECT 'all' AS series_id, date_trunc('hour', ts) AS h, {_HOUR_AGGS}
        FROM events GROUP BY 2) g)""",
    "hourly_by_type": f"""hourly_by_type AS ({_SHAPE}
  FROM (SELECT event_type AS series_id, date_trunc('hour', ts) AS h, {_HOUR_AGGS}
        FROM events GROUP BY 1, 2) g)""",
    "daily_orders": """daily_orders AS (
  SELECT 'orders' AS series_id, date_diff('day', DATE '1970-01-01', d) AS row_id,
    CAST(d AS TIMESTAMP) AS "timestamp", d AS dteday, cnt, total
  FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS cnt, sum(o_totalprice) AS total
        FROM orders GROUP BY 1) g)""",
    "drift_ref": """drift_ref AS (
  SELECT value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type
  FROM events WHERE CAST(ts AS DATE) < (SELECT CAST(min(ts) AS DATE) + CAST((CAST(max(ts) AS DATE) - CAST(min(ts) AS DATE)) // 2 AS INTEGER) FROM events))""",
    "drift_cur": """drift_cur AS (
  SELECT value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type
  FROM events WHERE CAST(ts AS DATE) >= (SELECT CAST(min(ts) AS DATE) + CAST((CAST(max(ts) AS DATE) - CAST(min(ts) AS DATE)) // 2 AS INTEGER) FROM events))""",
}

_DEPS = {"dirty": ["hourly"]}


def cte(*names: str) -> str:
    """'WITH v1 AS (...), v2 AS (...)' for the named views (dependencies first)."""
    seen: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in seen:
            seen.append(n)
    for n in names:
        add(n)
    return "WITH " + ",\n".join(VIEWS[n] for n in seen)


def _fault(c: str, cond: str, token: str) -> str:
    txt = f"printf('%.6f', {c})" if c in ("temp", "atemp", "hum", "windspeed") else f"CAST({c} AS VARCHAR)"
    return f"CASE WHEN {cond} THEN '{token}' ELSE {txt} END AS {c}"


VIEWS["dirty"] = "dirty AS (\n  SELECT " + ",\n    ".join([
    "CAST(row_id AS VARCHAR) AS instant",
    "CASE WHEN row_id % 97 = 5 THEN 'not a date' ELSE CAST(dteday AS VARCHAR) END AS dteday",
    _fault("season", "row_id % 53 = 1", " NAN "),
    _fault("yr", "row_id % 211 = 3", "2.5"),
    _fault("mnth", "row_id % 59 = 2", "NA"),
    "CASE WHEN row_id % 89 = 7 THEN '314' ELSE ' ' || CAST(hr AS VARCHAR) || ' ' END AS hr",
    _fault("holiday", "row_id % 61 = 4", ""),
    _fault("weekday", "row_id % 67 = 6", "null"),
    _fault("workingday", "row_id % 71 = 8", "None"),
    "CASE WHEN row_id % 73 = 9 THEN '11' ELSE CAST(weathersit AS VARCHAR) END AS weathersit",
    _fault("temp", "row_id % 31 = 10", " NAN "),
    _fault("atemp", "row_id % 37 = 11", "N/A"),
    _fault("hum", "row_id % 41 = 12", " "),
    _fault("windspeed", "row_id % 43 = 13", "NULL"),
    _fault("casual", "row_id % 47 = 14", "NaN"),
    _fault("registered", "row_id % 79 = 15", ""),
    _fault("cnt", "row_id % 83 = 16", " NAN "),
    "CASE WHEN row_id % 10 = 0 THEN NULL WHEN row_id % 2 = 0 THEN 'abc' ELSE CAST(row_id AS VARCHAR) END AS mixed_type_col",
]) + "\n  FROM hourly)"


VIEWS["hsplit"] = """hsplit AS (
  SELECT *, CASE WHEN idx < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
                 WHEN idx < floor(n * CAST(0.7 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'val'
                 ELSE 'test' END AS split
  FROM (SELECT *, sqrt(CAST(cnt AS DOUBLE)) AS cnt_transformed,
          row_number() OVER (PARTITION BY series_id ORDER BY "timestamp", row_id) - 1 AS idx,
          count(*) OVER (PARTITION BY series_id) AS n
        FROM (SELECT series_id, row_id, "timestamp", dteday, yr, mnth, hr, weekday, season, holiday,
                workingday, weathersit, temp, atemp, hum, windspeed,
                CAST(CASE WHEN casual + registered <= cnt THEN casual WHEN cnt >= registered THEN cnt - registered ELSE casual END AS BIGINT) AS casual,
                CAST(CASE WHEN casual + registered <= cnt THEN registered WHEN cnt >= registered THEN registered
                          WHEN cnt >= casual THEN cnt - casual ELSE registered END AS BIGINT) AS registered,
                CAST(CASE WHEN casual + registered <= cnt THEN casual + registered WHEN cnt >= registered THEN cnt
                          WHEN cnt >= casual THEN cnt ELSE casual + registered END AS BIGINT) AS cnt
              FROM hourly) e) s)"""
_DEPS["hsplit"] = ["hourly"]

VIEWS["npred"] = """npred AS (
  SELECT * FROM (SELECT *, lag(cnt, 24) OVER (PARTITION BY series_id ORDER BY "timestamp", row_id) AS prediction
                 FROM hsplit) t WHERE prediction IS NOT NULL)"""
_DEPS["npred"] = ["hourly", "hsplit"]
