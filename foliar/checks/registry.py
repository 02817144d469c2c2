"""Registry of checks: name -> (Spark job over the views, equivalent SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliar.checks.analog import Views, with_views
from foliar.session import configure

JOBS: dict[str, Callable[[Views], DataFrame]] = {}
SQL_TEXT: dict[str, str] = {}


def check(sql: str | None, *views: str, name: str | None = None):
    """Register a job with the SQL that must give the same rows."""

    def add(fn: Callable[[Views], DataFrame]):
        key = name or fn.__name__
        if key in JOBS:
            raise ValueError(f"{key} is registered twice")
        JOBS[key] = fn
        if sql is not None:
            SQL_TEXT[key] = with_views(sql, *views)
        return fn

    return add


def runner(key: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return JOBS[key](Views(spark, sf_dir.rstrip("/")))

    run.__name__ = key
    return run
