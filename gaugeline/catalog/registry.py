"""All registered queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import features, reports

CATALOG = {**features.CATALOG, **reports.CATALOG}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in CATALOG.items() if sql is not None}
