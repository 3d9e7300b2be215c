"""Registered queries: each name maps to a Spark builder and (when the
operator is SQL-expressible) an equivalent DuckDB oracle SQL string."""
import importlib

MODULES = ["q_core", "q_clean", "q_features", "q_joins", "q_prep", "q_eda", "q_stats", "q_eval", "q_models", "q_serving", "q_stream", "q_sources", "q_extras"]


def load_all():
    for m in MODULES:
        importlib.import_module(f"{__name__}.{m}")
