"""Registry of named plans: a Spark builder plus an optional DuckDB oracle.

A plan builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables.  The oracle is an independent SQL text over the same
tables (DuckDB views), used only for correctness checks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Plan:
    name: str
    build: Builder
    oracle: str | None
    section: str


PLANS: dict[str, Plan] = {}


def plan(name: str, oracle: str | None = None, section: str = ""):
    """Decorator registering a plan builder under ``name``."""
    def deco(fn: Builder) -> Builder:
        if name in PLANS:
            raise ValueError(f"duplicate plan {name}")
        PLANS[name] = Plan(name, fn, oracle, section)
        return fn
    return deco


def load_all() -> dict[str, Plan]:
    # Importing the modules registers their plans.
    from bidscope.plans import (  # noqa: F401
        p_scans, p_rows, p_joins, p_aggs, p_windows, p_scalar, p_features,
        p_flags, p_inject, p_graph, p_eval, p_models, p_detect, p_retrieve, p_stream)
    return PLANS
