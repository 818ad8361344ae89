"""Query registry: name -> (Spark callable, optional DuckDB-runnable SQL oracle)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    operators: str


REGISTRY: dict[str, Query] = {}


def register(name: str, operators: str, sql: str | None = None):
    """Decorator adding a ``(spark, sf_dir) -> DataFrame`` query."""
    def wrap(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, operators)
        return fn
    return wrap
