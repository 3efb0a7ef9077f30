"""Named queries: each is a plan over the supplied tables, most with a SQL statement to check it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    plan: Plan
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register the decorated plan under ``name``."""

    def add(plan: Plan) -> Plan:
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Query(plan, sql)
        return plan

    return add
