"""DuckDB text for the window features (oracle side of W1-W11)."""
from __future__ import annotations

W = "(PARTITION BY series_id ORDER BY \"timestamp\", row_id)"


def frame(lo: int, hi: int) -> str:
    lo_s = "CURRENT ROW" if lo == 0 else (f"{-lo} PRECEDING" if lo < 0 else f"{lo} FOLLOWING")
    hi_s = "CURRENT ROW" if hi == 0 else (f"{-hi} PRECEDING" if hi < 0 else f"{hi} FOLLOWING")
    return f"(PARTITION BY series_id ORDER BY \"timestamp\", row_id ROWS BETWEEN {lo_s} AND {hi_s})"


def roll_mean(c, n, mp=1, inc=True):
    fr = frame(-(n - 1), 0) if inc else frame(-n, -1)
    return f"CASE WHEN count({c}) OVER {fr} >= {mp} THEN avg({c}) OVER {fr} END"


def roll_std(c, n, mp=1, inc=True, fill=True):
    fr = frame(-(n - 1), 0) if inc else frame(-n, -1)
    e = f"CASE WHEN count({c}) OVER {fr} >= {mp} THEN stddev_samp({c}) OVER {fr} END"
    return f"coalesce({e}, 0)" if fill else e


def pct(c, k):
    p = f"lag({c}, {k}) OVER {W}"
    return (f"CASE WHEN {c} IS NULL OR {p} IS NULL THEN 0.0 WHEN {p} = 0 THEN CASE WHEN {c} = 0 THEN 0.0 "
            f"WHEN {c} > 0 THEN 'inf'::DOUBLE ELSE '-inf'::DOUBLE END ELSE {c} / {p} - 1 END")


def r6(expr, alias):
    return f"round(CAST({expr} AS DOUBLE), 6) + 0.0 AS {alias}"
