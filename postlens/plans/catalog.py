"""Registry of named queries.

computes it from the driver's tables (``fn(spark, sf_dir) -> DataFrame``)
and, where the result is SQL-expressible, the DuckDB statement that must
give the same rows (``oracle``). The statement may name stand-in fixtures
(``deliveries``, ``routes``...); their definitions are prefixed as CTEs.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from postlens.plans.fixture_sql import with_fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    key: str
    fn: QueryFn
    oracle: str | None
    section: str


REGISTRY: dict[str, Entry] = {}

# Modules whose import registers queries, in SURVEY §2 order.
PLAN_MODULES = (
    "postlens.plans.scans",
    "postlens.plans.sinks",
    "postlens.plans.columns",
    "postlens.plans.quality",
    "postlens.plans.joins",
    "postlens.plans.aggregates",
    "postlens.plans.marketing",
    "postlens.plans.windows",
    "postlens.plans.ordering",
    "postlens.plans.models",
)


def register(key: str, oracle: str | None = None, section: str = "") -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, fn, oracle, section)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    for mod in PLAN_MODULES:
        importlib.import_module(mod)
    return REGISTRY


def queries() -> dict[str, QueryFn]:
    return {k: e.fn for k, e in load_all().items()}


def oracle_sql() -> dict[str, str]:
    return {k: with_fixtures(e.oracle) for k, e in load_all().items() if e.oracle}
