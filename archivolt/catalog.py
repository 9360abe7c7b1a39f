"""Registry of the engine's queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from archivolt.plans import check_plans, keyword_plans, reader_plans, scoring_plans, structure_plans, text_plans, vocabulary_plans

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (keyword_plans, text_plans, vocabulary_plans, scoring_plans, check_plans, reader_plans, structure_plans)


def queries() -> dict[str, Query]:
    """Name to callable, over every plan module."""
    return {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """Name to DuckDB SQL, for the queries that SQL can express."""
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
