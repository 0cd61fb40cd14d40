"""Acceptance queries: each runs the package over the given tables, beside SQL that says what
must come out."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


class Check(NamedTuple):
    run: Run
    sql: str


class Checks(dict[str, Check]):
    """Registry filled by ``@checks.add(sql)``; the function's name is the query's name."""

    def add(self, sql: str) -> Callable[[Run], Run]:
        def register(run: Run) -> Run:
            self[run.__name__] = Check(run, sql.strip())
            return run

        return register
