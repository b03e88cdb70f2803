"""Registry of runnable queries: a name, the inventory ids it covers, the plan and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    covers: tuple[str, ...]
    plan: Plan
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register the decorated plan under its function name."""

    def register(plan: Plan) -> Plan:
        name = plan.__name__
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        ENTRIES[name] = Entry(name, tuple(covers.split()), plan, sql)
        return plan

    return register
