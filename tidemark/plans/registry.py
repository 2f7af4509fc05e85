"""Every query of the library by name, with its oracle where SQL has one."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

MODULES = ("titres", "serology", "counting", "names", "rules", "matching", "trees", "control", "comparing", "numerics", "stores", "evidence", "styles", "scalars", "filters", "matcher", "joining", "treework")


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def keep(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE_SQL[fn.__name__] = oracle
        return fn

    return keep


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"tidemark.plans.{name}")
