"""Query catalogue: name → (Spark builder, optional DuckDB oracle SQL).

Names follow ``<survey id>_<slug>``.  A query takes ``(spark, sf_dir)`` and
returns a lazy DataFrame over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from kiln.plans import (q_core, q_clean, q_windows, q_features, q_metrics, q_models, q_recsys,  # noqa: F401
                            q_scoring)
    from kiln.streaming import q_streaming  # noqa: F401
