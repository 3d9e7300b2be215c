"""Query registry used by ``__spark_entry__``.

``@query(name, sql)`` registers a builder ``fn(spark, sf_dir) -> DataFrame``
and, when the operator is SQL-expressible, the DuckDB oracle SQL. Double
columns of registered results are rounded to 6 digits on both sides.
"""
from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.exprs import round_doubles

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None, *, rnd: bool = True):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return round_doubles(df) if rnd else df
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = (run, ieee_round_sql(sql) if sql else None)
        return fn
    return deco


def r6(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias}"


def ieee_round_sql(sql: str, digits: int = 6) -> str:
    """Rewrite every ``round(expr, 6)`` of an oracle SQL text into the
    engine-independent ``floor(x * 1e6 + 0.501) / 1e6`` form (see
    ``functions.exprs.ieee_round``)."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(key):k - 1]
        suffix = f", {digits}"
        if not inner.rstrip().endswith(suffix):
            out.append(sql[i:k])
            i = k
            continue
        e = ieee_round_sql(inner.rstrip()[:-len(suffix)], digits)
        e = f"CAST({e} AS DOUBLE)"
        s = f"{10 ** digits}.0"
        out.append(sql[i:j])
        out.append(f"(CASE WHEN abs({e}) < 1e12 THEN floor({e} * {s} + 0.501) / {s} ELSE {e} END)")
        i = k
