"""Sources by name. A source is a function that gives a DataFrame; nothing is read until a sink asks."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping
from functools import partial
from pathlib import PurePosixPath
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

from tablelift.sources.jdbc import count_jdbc, read_jdbc

_naming = threading.Lock()
DATABASES = ("oracle", "postgresql", "jdbc")
Source = Callable[[SparkSession, Mapping[str, Any], str | None, Mapping[str, Any] | None], DataFrame]


def run_query(spark: SparkSession, query: str, params: Mapping[str, Any] | None = None) -> DataFrame:
    """Any SQL over the session's tables and views; parameters are bound to ``:name`` markers."""
    return spark.sql(query, args=dict(params)) if params else spark.sql(query)


def _own_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` and views of its own."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    return session


def _read_files(file_format: str, spark, config, query, params) -> DataFrame:
    """Files; a query sees them as a view named after the file, in a session of its own.

    So sources that are read side by side cannot take each other's view, nor replace one of the user's. The query also
    sees the catalog's tables, but not the user's temporary views.
    """
    if query:
        spark = _own_session(spark)
    reader = spark.read.format(file_format).options(**(config.get("options") or {}))
    if config.get("schema"):
        reader = reader.schema(config["schema"])
    files = reader.load(config["path"])
    if not query:
        return files
    files.createOrReplaceTempView(config.get("view") or PurePosixPath(config["path"]).stem)
    return run_query(spark, query, params)


def _read_database(kind: str, spark, config, query, params) -> DataFrame:
    return read_jdbc(spark, kind, config, query, params)


def _read_table(spark, config, query, params) -> DataFrame:
    return run_query(spark, query, params) if query else spark.table(config["table"])


_sources: dict[str, Source] = {
    "oracle": partial(_read_database, "oracle"),
    "postgresql": partial(_read_database, "postgresql"),
    "jdbc": partial(_read_database, "jdbc"),
    "parquet": partial(_read_files, "parquet"),
    "orc": partial(_read_files, "orc"),
    "csv": partial(_read_files, "csv"),
    "json": partial(_read_files, "json"),
    "table": _read_table,
    "view": _read_table,
}


def options_of(config: Mapping[str, Any]) -> dict[str, str]:
    """A configuration as the options of a Python data source: its plain values, and those under ``options``."""
    plain = {k: v for k, v in config.items() if isinstance(v, (str, int, float, bool))}
    return {k: str(v) for k, v in {**plain, **(config.get("options") or {})}.items()}


def _read_data_source(kind: type[DataSource], spark, config, query, params) -> DataFrame:
    """A Python data source; a query sees it as a view named as the configuration or the source says, which is there while it is looked up.

    The class is known to this session alone, so the view cannot be in another; a view of that name that is there already is an error.
    """
    spark.dataSource.register(kind)
    reader = spark.read.format(kind.name()).options(**options_of(config))
    if config.get("schema"):
        reader = reader.schema(config["schema"])
    rows = reader.load()
    if not query:
        return rows
    view = config.get("view") or kind.name()
    with _naming:
        rows.createTempView(view)
        try:
            return run_query(spark, query, params)
        finally:
            spark.catalog.dropTempView(view)


def register_source(name: str, source: Source | type[DataSource]) -> None:
    """Add or replace a source; names are matched without regard to case.

    A source is a function, or a class of Spark's Python data source API, whose reader gives the partitions, takes the filters it can work off
    itself and yields Arrow batches.
    """
    if isinstance(source, type) and issubclass(source, DataSource):
        source = partial(_read_data_source, source)
    _sources[name.lower()] = source


def supported_sources() -> list[str]:
    return list(_sources)


def read_source(
    spark: SparkSession,
    name: str,
    config: Mapping[str, Any] | None = None,
    query: str | None = None,
    params: Mapping[str, Any] | None = None,
) -> DataFrame:
    """The rows of a source, as a lazy DataFrame."""
    if str(name).lower() not in _sources:
        raise ValueError(f"unknown source {name!r}; valid names: {', '.join(_sources)}")
    return _sources[name.lower()](spark, config or {}, query, params)


def column_names(df: DataFrame) -> list[str]:
    """The columns of a query, from its metadata alone."""
    return df.columns


def row_count(
    spark: SparkSession,
    name: str,
    config: Mapping[str, Any] | None = None,
    query: str | None = None,
    params: Mapping[str, Any] | None = None,
) -> int:
    """The rows of a source: counted inside a database, otherwise by a scan without columns."""
    if str(name).lower() in DATABASES:
        return count_jdbc(spark, name.lower(), config or {}, query, params)
    return read_source(spark, name, config, query, params).count()


def count_frame(df: DataFrame) -> DataFrame:
    """The row count of a query as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"))
