"""The registry of queries: each a Spark function beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablelift.sources import read_source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query under ``name``."""

    def keep(function: Query) -> Query:
        QUERIES[name], SQL[name] = function, sql
        return function

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_source(spark, "parquet", {"path": f"{folder}/{name}.parquet"})


def views(spark: SparkSession, folder: str, *names: str) -> None:
    for name in names:
        table(spark, folder, name).createOrReplaceTempView(name)
