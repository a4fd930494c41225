"""The kinds of target: files, catalog tables, databases and views."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import replace
from typing import Any, Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

from tablelift.operators.upsert import upsert
from tablelift.session import new_folder
from tablelift.sinks.versions import Mark, Part, Version, Versions
from tablelift.sources import options_of
from tablelift.sources.jdbc import jdbc_options, read_jdbc

DEFAULT_BATCH = 5_000


# SQL states of databases for a table that is not there, and Oracle's error number.
MISSING_TABLE_STATES = {"42P01", "42S02", "42X05", "42704"}
ORACLE_MISSING_TABLE = 942


def is_missing_table(error: BaseException) -> bool:
    """Whether an error of a database driver, or one of its causes, says that there is no such table."""
    cause = getattr(error, "_origin", None) or getattr(error, "java_exception", None) or error
    for _ in range(20):
        if cause is None:
            return False
        if hasattr(cause, "getSQLState"):
            try:
                state, number = cause.getSQLState(), cause.getErrorCode()
            except Exception:  # a Java error of another kind answers to every name, but not to a call
                state, number = None, None
            if state in MISSING_TABLE_STATES or number == ORACLE_MISSING_TABLE:
                return True
        cause = cause.getCause() if hasattr(cause, "getCause") else None
    return False


class Target(Protocol):
    """What a load needs of a target."""

    # A database converts values to its own column types; files and catalog tables are given them.
    casts_itself: bool

    def exists(self, spark: SparkSession, config: Mapping[str, Any], table: str) -> bool:
        """Whether the table is there."""

    def read(self, spark: SparkSession, config: Mapping[str, Any], table: str) -> DataFrame:
        """The table's rows."""

    def create(self, df: DataFrame, config: Mapping[str, Any], table: str) -> None:
        """Make the table from ``df``; a table that is there already is left as it is, and is an error."""

    def replace(self, df: DataFrame, config: Mapping[str, Any], table: str) -> None:
        """Make the table from ``df``, in place of any old one."""

    def append(self, df: DataFrame, config: Mapping[str, Any], table: str) -> None:
        """Add rows to the table."""

    def refill(self, df: DataFrame, config: Mapping[str, Any], table: str) -> None:
        """Replace the rows and keep the table's definition."""


def check_waves(found: Mapping[int, int], expected: Mapping[int, int]) -> None:
    """Refuse waves that do not have the rows expected of them."""
    wrong = sorted(wave for wave in found.keys() | expected.keys() if found.get(wave, 0) != expected.get(wave, 0))
    if wrong:
        told = f"wave {wrong[0]} gave {found.get(wrong[0], 0)} rows instead of {expected.get(wrong[0], 0)}"
        raise RuntimeError(f"{told}: the source has changed")


def _writer(df: DataFrame, config: Mapping[str, Any]):
    return df.write.options(**{k: str(v) for k, v in (config.get("options") or {}).items()})


class FileTarget:
    """One folder of files per table below ``path``, loaded by versions: see :mod:`tablelift.sinks.versions`.

    A load is seen as a whole or not at all, and readers keep the version they started with.
    """

    casts_itself = False

    def __init__(self, file_format: str):
        self.format = file_format

    def folder(self, config: Mapping[str, Any], table: str) -> str:
        return f"{str(config['path']).rstrip('/')}/{table}"

    def versions(self, spark, config, table) -> Versions:
        return Versions(spark, self.folder(config, table), self.format)

    def exists(self, spark, config, table) -> bool:
        return self.versions(spark, config, table).there()

    def read(self, spark, config, table) -> DataFrame:
        versions = self.versions(spark, config, table)
        version = versions.current()
        if version is None:
            return spark.read.format(self.format).load(versions.folder)
        return versions.read(version)

    def _load(self, df, config, table, change, check=None) -> None:
        """Write ``df`` and publish ``change(known version, part)``; what is not published is removed again."""
        versions = self.versions(df.sparkSession, config, table)
        part = versions.write(df, {k: str(v) for k, v in (config.get("options") or {}).items()})
        published = None
        try:
            if check:
                check()
            published = versions.commit(lambda known: change(known, part))
        finally:
            if published is None or part not in published.parts:
                versions.drop(part)

    def create(self, df, config, table) -> None:
        def made(known, part):
            if known is not None:
                raise FileExistsError(f"{self.folder(config, table)} already holds a table")
            return Version(1, df.schema.json(), (part,))

        self._load(df, config, table, made)

    def replace(self, df, config, table) -> None:
        self._load(df, config, table, lambda _, part: Version(1, df.schema.json(), (part,)))

    def refill(self, df, config, table) -> None:
        self._load(df, config, table, lambda known, part: Version(1, known.schema if known else df.schema.json(), (part,)))

    def append(self, df, config, table, mark: Mark | None = None, check: Callable[[], None] | None = None) -> bool:
        """Add rows. A write whose ``mark`` has arrived is left out, which the result tells; ``check`` may refuse the rows once they are written."""

        def added(known, part):
            known = known or Version(0, df.schema.json(), ())
            return None if mark in known.marks else known.with_part(part, mark)

        if mark is not None and mark in self.marks(df.sparkSession, config, table):
            return False
        self._load(df, config, table, added, check)
        return True

    def append_waves(self, df, config, table, by: str, waves: Mapping[int, tuple[int, Mark]]) -> Iterator[int]:
        """Add the rows of several waves, which the column ``by`` numbers, in one write; gives the number of each wave that has arrived.

        ``waves`` has the rows and the mark of each. Every wave becomes a version of its own. Other numbers of rows are refused before any row counts.
        """
        versions = self.versions(df.sparkSession, config, table)
        options = {k: str(v) for k, v in (config.get("options") or {}).items()}
        rows = df.repartition(min(len(waves), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), by)
        whole, parts = versions.write_each(rows, by, options)
        unnamed, known, schema = dict(parts), None, df.drop(by).schema.json()
        try:
            check_waves({wave: n for wave, (_, n) in parts.items()}, {wave: n for wave, (n, _) in waves.items()})
            for wave, (_, mark) in sorted(waves.items()):
                part = parts[wave][0]

                def added(newest, part=part, mark=mark):
                    newest = newest or Version(0, schema, ())
                    return None if mark in newest.marks else newest.with_part(part, mark)

                known = versions.commit(added, known)
                if known.parts[-1] is part:
                    del unnamed[wave]
                yield wave
        finally:
            for part in [whole] if len(unnamed) == len(parts) else [part for part, _ in unnamed.values()]:
                versions.drop(part)

    def marks(self, spark, config, table) -> frozenset[Mark]:
        """The marks of the writes that the table holds."""
        known = self.versions(spark, config, table).current()
        return known.marks if known else frozenset()

    def merge(self, changes, config, table, keys: Sequence[str], latest_by: str | None = None) -> None:
        """Upsert ``changes``, which can be read several times. Files without a changed key stay as they are; the rows of the others are written
        once, into the files of the next version."""
        versions = self.versions(changes.sparkSession, config, table)
        options = {k: str(v) for k, v in (config.get("options") or {}).items()}
        written: list[Part] = []

        def merged(known):
            parts, hit = versions.holding(known, changes, keys)
            paths = [f"{versions.folder}/{p.at}/{n}" if p.at else f"{versions.folder}/{n}" for p, names in zip(parts, hit, strict=True) for n in names]
            old = versions.read(known, paths) if paths else changes.limit(0)
            written.append(versions.write(upsert(old, changes, keys, latest_by), options))
            left = [replace(p, without=p.without | frozenset(names)) for p, names in zip(parts, hit, strict=True)]
            some = [p for p, names in zip(left, hit, strict=True) if not names or not p.at or versions.names(p)]
            return known.with_parts([*some, written[-1]])

        published = None
        try:
            published = versions.commit(merged)
        finally:
            for part in written:
                if published is None or part not in published.parts:
                    versions.drop(part)

    def clean(self, spark, config, table, keep: int = 1, unnamed_after_hours: float | None = None) -> int:
        """Remove the files that none of the last ``keep`` versions holds, and those that a lost load has left; returns how many."""
        return self.versions(spark, config, table).clean(keep, unnamed_after_hours)


class CatalogTarget:
    """A table of the session's catalog; ``format`` (default parquet) is used when it is created."""

    casts_itself = False

    def exists(self, spark, config, table) -> bool:
        return spark.catalog.tableExists(table)

    def read(self, spark, config, table) -> DataFrame:
        return spark.table(table)

    def _save(self, df, config, table, mode: str) -> None:
        _writer(df, config).format(config.get("format", "parquet")).mode(mode).saveAsTable(table)

    def create(self, df, config, table) -> None:
        self._save(df, config, table, "errorifexists")

    def replace(self, df, config, table) -> None:
        self._save(df, config, table, "overwrite")

    def append(self, df, config, table) -> None:
        _writer(df, config).insertInto(table)

    def append_waves(self, df, config, table, by: str, waves: Mapping[int, tuple[int, Mark]]) -> Iterator[int]:
        """Add the rows of several waves in one write; a catalog table keeps no marks."""
        seen, expected = Observation(), sum(n for n, _ in waves.values())
        self.append(df.observe(seen, F.count(F.lit(1)).alias("rows")).drop(by), config, table)
        if seen.get.get("rows", 0) != expected:
            raise RuntimeError(f"waves {min(waves)} to {max(waves)} gave {seen.get.get('rows', 0)} rows instead of {expected}: the source has changed")
        yield from sorted(waves)

    def refill(self, df, config, table) -> None:
        _writer(df, config).insertInto(table, overwrite=True)


class JdbcTarget:
    """A database table. Every task writes its partition in batches within one transaction.

    A task that dies after its commit is repeated by Spark, so rows can arrive twice if the table has
    no unique key; a chunked copy checks an unfinished part against the target's keys.
    """

    casts_itself = True

    def __init__(self, kind: str):
        self.kind = kind

    def _options(self, config, table) -> dict[str, str]:
        return {"dbtable": table, "batchsize": str(int(config.get("batch_size") or DEFAULT_BATCH))} | jdbc_options(
            self.kind, config
        )

    def exists(self, spark, config, table) -> bool:
        """Whether the table's columns can be looked up. Any error but "no such table" is raised."""
        try:
            self.read(spark, config, table)
        except Exception as error:
            if is_missing_table(error):
                return False
            raise
        return True

    def read(self, spark, config, table) -> DataFrame:
        """The table, in parallel parts if ``partition_column`` is set."""
        return read_jdbc(spark, self.kind, {**config, "table": table}, None, None)

    def _write(self, df, config, table, mode: str, **more: str) -> None:
        df.write.format("jdbc").options(**self._options(config, table), **more).mode(mode).save()

    def create(self, df, config, table) -> None:
        self._write(df, config, table, "errorifexists")

    def replace(self, df, config, table) -> None:
        self._write(df, config, table, "overwrite")

    def append(self, df, config, table) -> None:
        self._write(df, config, table, "append")

    def refill(self, df, config, table) -> None:
        cascade = {"cascadeTruncate": "true"} if self.kind == "postgresql" else {}
        self._write(df, config, table, "overwrite", truncate="true", **cascade)


class DataSourceTarget:
    """What a class of Spark's Python data source API writes to. Its writer's ``commit`` makes a load count.

    The class may say by a function ``exists(options)`` whether the table is there; otherwise it always is.
    """

    casts_itself = False

    def __init__(self, kind: type[DataSource]):
        self.kind = kind

    def _options(self, config, table) -> dict[str, str]:
        return options_of(config) | {"table": table}

    def exists(self, spark, config, table) -> bool:
        found = getattr(self.kind, "exists", None)
        return found(self._options(config, table)) if found else True

    def read(self, spark, config, table) -> DataFrame:
        spark.dataSource.register(self.kind)
        return spark.read.format(self.kind.name()).options(**self._options(config, table)).load()

    def _save(self, df, config, table, mode: str) -> None:
        df.sparkSession.dataSource.register(self.kind)
        df.write.format(self.kind.name()).options(**self._options(config, table)).mode(mode).save()

    def create(self, df, config, table) -> None:
        if getattr(self.kind, "exists", None) and self.exists(df.sparkSession, config, table):
            raise ValueError(f"{table} is there already")
        self._save(df, config, table, "append")

    def replace(self, df, config, table) -> None:
        self._save(df, config, table, "overwrite")

    def append(self, df, config, table) -> None:
        self._save(df, config, table, "append")

    def refill(self, df, config, table) -> None:
        self._save(df, config, table, "overwrite")


class ViewTarget:
    """A temporary view of the session over a written copy in the shared folder."""

    casts_itself = False

    def __init__(self):
        self._folders: dict[tuple[str, str], str] = {}

    def _known(self, spark, table) -> tuple[str, str]:
        return spark.sparkContext.applicationId, table.lower()

    def exists(self, spark, config, table) -> bool:
        return spark.catalog.tableExists(table)

    def read(self, spark, config, table) -> DataFrame:
        return spark.table(table)

    def create(self, df, config, table) -> None:
        if self.exists(df.sparkSession, config, table):
            raise ValueError(f"the view {table} is there already")
        self.replace(df, config, table)

    def replace(self, df, config, table) -> None:
        folder = new_folder(df.sparkSession, "view")
        df.write.parquet(folder)
        df.sparkSession.read.schema(df.schema).parquet(folder).createOrReplaceTempView(table)
        self._folders[self._known(df.sparkSession, table)] = folder

    def append(self, df, config, table) -> None:
        """Add rows to the view's own folder; a view made by someone else is copied into one first."""
        spark, known = df.sparkSession, self._known(df.sparkSession, table)
        if known not in self._folders:
            self.replace(spark.table(table), config, table)
        schema = spark.table(table).schema
        df.write.mode("append").parquet(self._folders[known])
        spark.read.schema(schema).parquet(self._folders[known]).createOrReplaceTempView(table)

    def refill(self, df, config, table) -> None:
        self.replace(df, config, table)
