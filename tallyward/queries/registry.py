"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyward.queries import views_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``views`` names the SQL views that ``sql`` reads."""

    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = views_sql.with_views(views.split(), sql)
        return run

    return add


def load_all() -> None:
    from tallyward.queries import (  # noqa: F401
        access,
        change_queries,
        gold_queries,
        layout_queries,
        quality_queries,
        report_queries,
        source_queries,
        stream_queries,
        synthetic_queries,
        text_queries,
    )
