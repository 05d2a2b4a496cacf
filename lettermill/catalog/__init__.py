"""Registered queries: each operator over the given tables, with the SQL that
must give the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its reference SQL."""

    def register(run: Query) -> Query:
        REGISTRY[name] = Entry(run, sql)
        return run

    return register


def load_all() -> dict[str, Entry]:
    from lettermill.catalog import (  # noqa: F401
        buckets,
        changes,
        containers,
        dedup,
        identity,
        runs,
        state,
        streams,
    )

    return REGISTRY
