"""Registry of queries and of the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from riskloom.plans.views import Views, with_views
from riskloom.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
MODULES = ["q_base", "q_joins", "q_agg", "q_win", "q_std", "q_fun", "q_reg", "q_risk", "q_qal", "q_stream"]


def query(name: str, views: str = "", sql: str | None = None):
    """Register ``fn(views) -> DataFrame`` under ``name``; ``sql`` may use the named views."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(Views(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_views(views.split(), sql)
        return fn

    return add


def load() -> None:
    """Import every query module once."""
    for m in MODULES:
        import_module(f"riskloom.plans.{m}")
