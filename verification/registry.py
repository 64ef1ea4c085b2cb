"""Query id -> (callable, SQL it must equal)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def check(sql: str):
    """Register the decorated query under its own name."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        ORACLE[fn.__name__] = sql
        return fn

    return register
