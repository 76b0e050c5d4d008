"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame``
and, where SQL can express it, the DuckDB oracle text with the same columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    build: Builder
    oracle: str | None
    step: int
    covers: str


QUERIES: dict[str, Query] = {}


def register(name: str, step: int, covers: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, oracle, step, covers)
        return fn
    return deco
