"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where the semantics are SQL-expressible, the DuckDB twin used as the
correctness oracle.  Double columns are rounded to 6 digits on both sides
(summation order differs between engines and partitionings).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    operators: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def register(name: str, operators: tuple[str, ...], sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, operators)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules fills the registry.
    from mound.plans import queries_core  # noqa: F401
    from mound.plans import queries_clean  # noqa: F401
    from mound.plans import queries_io  # noqa: F401
    from mound.plans import queries_model  # noqa: F401
    from mound.plans import queries_events  # noqa: F401

    return REGISTRY
