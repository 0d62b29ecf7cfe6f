"""Registry of runnable queries, each next to the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import apply_runtime_conf
from ..sources.tables import Tables, ansi_prelude, read_erp

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None):
    """Register a function of ``Tables``; ``check`` continues the WITH prelude.

    The text starts with SELECT, or with a comma when it brings its own CTEs.
    """

    def wrap(fn: Callable[[Tables], DataFrame]):
        name = fn.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            apply_runtime_conf(spark)
            return fn(read_erp(spark, folder))

        run.__name__ = name
        QUERIES[name] = run
        if check is not None:
            CHECKS[name] = f"{ansi_prelude()}\n{check.strip()}"
        return fn

    return wrap


def r4(expr: str) -> str:
    """SQL text of ``round_units``."""
    return f"(floor(({expr}) * 10000 + 0.5) / 10000)"


def xsum(expr: str) -> str:
    """SQL text of ``exact_sum``."""
    return f"CAST(round(SUM(CAST({expr} AS DECIMAL(28,10))), 4) AS DOUBLE)"
