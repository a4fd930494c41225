"""Reading and addressing databases over JDBC."""

from __future__ import annotations

import decimal
import math
from collections.abc import Mapping, Sequence
from itertools import pairwise
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tablelift.sources.params import bind_params, sql_literal

# Default ports and how a URL is put together for each database.
DEFAULT_PORTS = {"oracle": 1521, "postgresql": 5432}
URLS = {
    "oracle": "jdbc:oracle:thin:@//{host}:{port}/{service}",
    "postgresql": "jdbc:postgresql://{host}:{port}/{database}",
}
DEFAULT_FETCH = 50_000


def jdbc_options(kind: str, config: Mapping[str, Any]) -> dict[str, str]:
    """Connection options from host, port and service or database, or from a ready ``url``."""
    url = config.get("url")
    if url is None:
        if kind not in URLS:
            raise ValueError("a jdbc connection needs a url")
        place = {"port": DEFAULT_PORTS[kind], "service": None, "database": None, **config}
        url = URLS[kind].format_map(place)
    options = {"url": url}
    for name in ("user", "password", "driver"):
        if config.get(name) is not None:
            options[name] = str(config[name])
    return options | {k: str(v) for k, v in (config.get("options") or {}).items()}


def table_expression(config: Mapping[str, Any], query: str | None, params: Mapping[str, Any] | None) -> str:
    """What to read: a query as a sub-query, or a table. No AS before the alias: not every database takes it."""
    return f"({bind_params(query, params)}) t" if query else f"{config['table']} t"


def bounds_question(expression: str, column: str) -> str:
    """A one-row sub-query for the least and greatest value of the partition column."""
    return f'(SELECT MIN(t."{column}") AS lo, MAX(t."{column}") AS hi FROM {expression}) b'


def count_question(expression: str) -> str:
    """A one-row sub-query for the number of rows."""
    return f"(SELECT COUNT(*) AS n FROM {expression}) c"


def quantile_question(expression: str, column: str, parts: int) -> str:
    """A sub-query for the greatest value of each of ``parts`` runs of like many rows, in the order of the partition column."""
    ranked = f'SELECT t."{column}" AS v, NTILE({parts}) OVER (ORDER BY t."{column}") AS part FROM {expression} WHERE t."{column}" IS NOT NULL'
    return f"(SELECT q.part AS part, MAX(q.v) AS hi FROM ({ranked}) q GROUP BY q.part) b"


def quantile_predicates(column: str, tops: Sequence[Any]) -> list[str]:
    """One condition for each part of a read: rows up to each of the ``tops``, and the rest. Every row meets exactly one, nulls the first.

    A value that fills several runs has one part. Without tops there is one part of all rows.
    """
    name, limits = f'"{column}"', [sql_literal(v) for v in sorted({v for v in tops if v is not None})[:-1]]
    if not limits:
        return ["1 = 1"]
    inner = [f"{name} > {low} AND {name} <= {high}" for low, high in pairwise(limits)]
    return [f"{name} <= {limits[0]} OR {name} IS NULL", *inner, f"{name} > {limits[-1]}"]


def actual_name(columns: Sequence[str], wanted: str) -> str:
    """A column as the database spells it; names are looked up without regard to case."""
    if wanted in columns:
        return wanted
    found = [name for name in columns if name.lower() == wanted.lower()]
    if len(found) != 1:
        raise ValueError(f"the partition column {wanted!r} is not one of {list(columns)}")
    return found[0]


def partition_options(column: str, low: Any, high: Any, parts: int) -> dict[str, str]:
    """How the read is cut into parallel parts; none if the table has no rows. Number bounds are whole."""
    if low is None or high is None:
        return {}
    if isinstance(low, (decimal.Decimal, float)):
        low, high = math.floor(low), math.ceil(high)
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(parts),
    }


def read_jdbc(
    spark: SparkSession, kind: str, config: Mapping[str, Any], query: str | None, params: Mapping[str, Any] | None
) -> DataFrame:
    """A query or table of a database, cut into ``num_partitions`` parallel reads on ``partition_column``.

    Without ``lower_bound`` and ``upper_bound`` the database is asked for them, which gives parts of equal stride. With ``balance:
    quantiles`` it is asked for the values that cut the rows into parts of like size, so that a column of uneven values does not leave most
    rows to one task. ``predicates`` gives the parts explicitly, one condition each. Filters and columns chosen later go into the database's
    own query.
    """
    options = {"fetchsize": str(config.get("batch_size") or DEFAULT_FETCH)} | jdbc_options(kind, config)
    expression = table_expression(config, query, params)
    balance = config.get("balance", "strides")
    if balance not in ("strides", "quantiles"):
        raise ValueError(f"balance must be 'strides' or 'quantiles', not {balance!r}")

    def by_predicates(predicates: Sequence[str]) -> DataFrame:
        properties = {k: v for k, v in options.items() if k != "url"}
        return spark.read.jdbc(options["url"], expression, predicates=list(predicates), properties=properties)

    if config.get("predicates"):
        return by_predicates(config["predicates"])
    reader = spark.read.format("jdbc").options(**options)
    whole = reader.option("dbtable", expression).load()
    if not config.get("partition_column"):
        return whole
    column = actual_name(whole.columns, config["partition_column"])
    count = int(config.get("num_partitions") or spark.conf.get("spark.sql.shuffle.partitions"))
    if balance == "quantiles":
        asked = reader.option("dbtable", quantile_question(expression, column, count)).load()
        return by_predicates(quantile_predicates(column, [row["hi"] for row in asked.toDF("part", "hi").collect()]))
    low, high = config.get("lower_bound"), config.get("upper_bound")
    if low is None or high is None:
        low, high = reader.option("dbtable", bounds_question(expression, column)).load().first()
    return reader.option("dbtable", expression).options(**partition_options(column, low, high, count)).load()


def count_jdbc(
    spark: SparkSession, kind: str, config: Mapping[str, Any], query: str | None, params: Mapping[str, Any] | None
) -> int:
    """The rows of a query or table, counted by the database."""
    asked = count_question(table_expression(config, query, params))
    return int(spark.read.format("jdbc").options(**jdbc_options(kind, config)).option("dbtable", asked).load().first()[0])
