"""Query registry: name -> (Spark callable, DuckDB oracle text or None).

Every query reads the driver tables under ``sf_dir`` (through the
``observations`` view) and returns a DataFrame; inexact doubles are
rounded to 6 places on both sides so that engines agree.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}
DIGITS = 6


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def rnd(c: str | Column, digits: int = DIGITS) -> Column:
    """Half-up rounding written as plain IEEE operations, so that both engines
    round a bit-identical double to the same result."""
    col = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return (F.floor(col.cast("double") * scale + 0.5).cast("double") / scale) + F.lit(0.0)


def sql_rnd(expr: str, digits: int = DIGITS) -> str:
    """DuckDB twin of ``rnd``."""
    scale = f"{float(10 ** digits)!r}"
    return f"(cast(floor(cast({expr} as double) * {scale} + 0.5) as double) / {scale} + 0.0)"


def sql_avg(expr: str) -> str:
    """DuckDB twin of ``exact_avg``: exact decimal sum over the count."""
    return f"(cast(sum(cast({expr} as decimal(38,12))) as double) / count({expr}))"


def sql_sum(expr: str) -> str:
    return f"cast(sum(cast({expr} as decimal(38,12))) as double)"


@dataclass
class Context:
    """Per-session, per-scale memo of the shared inputs (lazy DataFrames and
    the few scalar statistics), so queries do not redo each other's jobs."""
    spark: SparkSession
    sf_dir: str
    memo: dict = field(default_factory=dict)

    def get(self, key: str, build: Callable[[], object]):
        if key not in self.memo:
            self.memo[key] = build()
        return self.memo[key]


_CONTEXTS: dict[tuple[int, str], Context] = {}


def context(spark: SparkSession, sf_dir: str) -> Context:
    key = (id(spark), sf_dir.rstrip("/"))
    if key not in _CONTEXTS:
        _CONTEXTS[key] = Context(spark, sf_dir.rstrip("/"))
    return _CONTEXTS[key]


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    """Import every query module (they register on import)."""
    from demandflow.plans import (q_sources, q_scalar, q_clean_join, q_profile,  # noqa: F401
                                  q_encode, q_models, q_documented)
    return REGISTRY
