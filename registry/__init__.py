"""Every operator as a query over the given tables, with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tallywire.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only its rows can be checked."""

    def add(build: Query) -> Query:
        @wraps(build)
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(pin_utc(spark), sf_dir)

        QUERIES[name] = in_utc
        if sql is not None:
            ORACLE_SQL[name] = sql
        return in_utc

    return add


from registry import cleaning, counting, directories, retrieval, streams  # noqa: E402,F401
