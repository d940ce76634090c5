"""Derived inputs are written once per session to the shared folder and read by every query."""
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.plans.staging import stage
from lectern.session import fresh_path

_MADE: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf: str, name: str, build: Callable[[str], object]):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _MADE:
        _MADE[key] = build(fresh_path(spark, name))
    return _MADE[key]


def staged(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    return once(spark, sf, name, lambda path: stage(build(), path))


def with_ctes(ctes: dict[str, str], sql: str) -> str:
    """Prefix `sql` with the CTEs it needs, directly or through others, in definition order."""
    need, todo = set(), [sql]
    while todo:
        text = todo.pop()
        for name in ctes:
            if name not in need and re.search(rf"\b{name}\b", text):
                need.add(name)
                todo.append(ctes[name])
    body = ",\n".join(f"{n} AS ({ctes[n]})" for n in ctes if n in need)
    recursive = "RECURSIVE " if any(re.search(rf"\bFROM {n}\b", ctes[n]) for n in need) else ""
    return f"WITH {recursive}{body}\n{sql}" if body else sql


def flag_sql(check: str, rule: str, severity: str, subject: str, detail: str, rest: str) -> str:
    """Severity, subject and detail are SQL expressions; rest is everything from FROM on."""
    return (f"SELECT CAST(course_id AS VARCHAR) AS course_id, '{check}' AS check_name, '{rule}' AS rule, {severity} AS severity, "
            f"coalesce(CAST({subject} AS VARCHAR), '') AS subject, coalesce(CAST({detail} AS VARCHAR), '') AS detail {rest}")


def union_sql(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)
