"""Registered queries: one per operator id, each with its DuckDB oracle.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables (or
views Spark derives from them). Its oracle is SQL over the same tables;
the body may refer to the views of ``views.oracle_prefix()`` and may start
with its own ``WITH`` list. ``sql=None`` marks operators SQL cannot state
(iterative fits, models, streams): they get a rows-only check and
invariant tests.
"""

from __future__ import annotations

from collections.abc import Callable

from .. import views

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def full_sql(body: str) -> str:
    body = body.strip()
    prefix = views.oracle_prefix()
    if body[:5].upper() == "WITH ":
        return prefix + ", " + body[5:]
    return prefix + body


def load_all() -> dict[str, tuple[Callable, str | None]]:
    # importing the modules fills REGISTRY
    from . import (q_telemetry, q_frames, q_profile, q_features, q_text,  # noqa: F401
                   q_stats, q_matrix, q_models, q_similarity, q_io, q_streaming)
    return REGISTRY
