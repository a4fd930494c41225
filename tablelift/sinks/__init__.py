"""Targets by name, and the load that cleans, maps, types and writes a DataFrame."""

from __future__ import annotations

import inspect
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

from tablelift.functions.names import clean_name
from tablelift.operators.columns import (
    cast_all_text,
    cast_for_target,
    map_columns,
    project_columns,
    standardize_columns,
)
from tablelift.operators.upsert import one_per_key, upsert
from tablelift.plans.settings import as_bool
from tablelift.session import stage
from tablelift.sinks.targets import CatalogTarget, DataSourceTarget, FileTarget, JdbcTarget, Target, ViewTarget
from tablelift.sinks.versions import Mark

MODES = ("insert", "upsert", "replace")

_targets: dict[str, Target] = {
    "postgresql": JdbcTarget("postgresql"),
    "postgres": JdbcTarget("postgresql"),
    "oracle": JdbcTarget("oracle"),
    "jdbc": JdbcTarget("jdbc"),
    "parquet": FileTarget("parquet"),
    "orc": FileTarget("orc"),
    "table": CatalogTarget(),
    "view": ViewTarget(),
}


def register_target(name: str, target: Target | type[DataSource]) -> None:
    """Add or replace a target, or a class of Spark's Python data source API; names are matched without regard to case."""
    if isinstance(target, type) and issubclass(target, DataSource):
        target = DataSourceTarget(target)
    _targets[name.lower()] = target


def supported_targets() -> list[str]:
    return list(_targets)


def find_target(name: str) -> Target:
    if str(name).lower() not in _targets:
        raise ValueError(f"unknown target {name!r}; valid names: {', '.join(_targets)}")
    return _targets[name.lower()]


def shape_for_load(df: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    """Clean and map the headers and bring the columns to target types, all in one projection.

    ``clean_names`` (default true), ``column_mapping``, and ``types``: ``typed`` (default) or ``text``.
    """
    if as_bool(config.get("clean_names", True)):
        df = standardize_columns(df)
    if config.get("column_mapping"):
        df = map_columns(df, config["column_mapping"])
    policy = config.get("types", "typed")
    if policy not in ("typed", "text"):
        raise ValueError(f"types must be 'typed' or 'text', not {policy!r}")
    return cast_all_text(df) if policy == "text" else cast_for_target(df)


def target_names(config: Mapping[str, Any], setting: str) -> list[str]:
    """The columns that a setting names, one or a list, as the target calls them: cleaned and mapped as the headers are."""
    given = config.get(setting) or []
    given = [given] if isinstance(given, str) else list(given)
    if not as_bool(config.get("clean_names", True)):
        names = given
    else:
        names = [clean_name(name) for name in given]
    mapping = {clean_name(old): clean_name(new) for old, new in (config.get("column_mapping") or {}).items()}
    return [mapping.get(clean_name(name), name) for name in names]


def fit_to(df: DataFrame, existing: DataFrame, cast: bool = True, fill: bool = True) -> DataFrame:
    """Columns in the target's order and types; a column that the target does not know is an error.

    With ``fill``, columns of the target that ``df`` lacks become null if they may be; a target that casts itself
    (``cast`` false) is given the named columns only and fills the others by its own defaults. Otherwise a missing
    column is an error.
    """
    extra = set(df.columns) - set(existing.columns)
    missing = {f.name for f in existing.schema.fields if f.name not in df.columns}
    fillable = missing if not cast else {f.name for f in existing.schema.fields if f.name in missing and f.nullable}
    if extra or missing - (fillable if fill else set()):
        raise ValueError(f"columns do not fit the target: missing {sorted(missing)}, unknown {sorted(extra)}")
    if not cast:
        return project_columns(df, [c for c in existing.columns if c not in missing])

    def value(field):
        return (F.lit(None) if field.name in missing else F.col(f"`{field.name}`")).cast(field.dataType).alias(field.name)

    return df.select(*[value(f) for f in existing.schema.fields])


def counted_write(df: DataFrame, write) -> int:
    """Run ``write`` on ``df`` and return the rows that went through it, without a second pass; 0 if it says False, which means none."""
    seen = Observation()
    if write(df.observe(seen, F.count(F.lit(1)).alias("rows"))) is False:
        return 0
    return seen.get.get("rows", 0)


def checked_append(df: DataFrame, place: Target, config: Mapping[str, Any], table: str, mark: Mark, expected: int) -> bool:
    """Append exactly ``expected`` rows under a mark; other numbers are refused before any row counts. Whether rows were written."""
    seen = Observation()

    def check() -> None:
        if seen.get.get("rows", 0) != expected:
            raise RuntimeError(f"{seen.get.get('rows', 0)} rows instead of {expected}: the source has changed")

    return place.append(df.observe(seen, F.count(F.lit(1)).alias("rows")), config, table, mark=mark, check=check)


def keeps_marks(place: Target) -> bool:
    """Whether a target's ``append`` takes the mark of a write that must not be repeated."""
    taken = inspect.signature(place.append).parameters
    return hasattr(place, "marks") and ("mark" in taken or any(p.kind is p.VAR_KEYWORD for p in taken.values()))


def takes_waves(place: Target) -> bool:
    """Whether a target takes several waves in one write: by ``append_waves``, unless a subclass has another ``append``."""

    def kind_with(name: str) -> type | None:
        return next((kind for kind in type(place).__mro__ if name in vars(kind)), None)

    return kind_with("append_waves") is not None and kind_with("append_waves") is kind_with("append")


def load(
    df: DataFrame,
    target: str,
    table: str,
    config: Mapping[str, Any] | None = None,
    mode: str = "insert",
) -> int:
    """Load ``df`` into ``table`` and return the rows loaded.

    ``insert`` appends, after emptying the table if ``truncate_before_load`` is set; ``replace`` puts
    a new table in its place; ``upsert`` merges by ``keys``. A missing table is created. An empty
    input leaves the target as it is, unless ``allow_empty`` is set.
    """
    config = config or {}
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; valid modes: {', '.join(MODES)}")
    place = find_target(target)
    spark = df.sparkSession
    shaped = shape_for_load(df, config)
    if mode == "upsert":
        return _load_upsert(shaped, place, config, table)
    emptying = mode == "replace" or as_bool(config.get("truncate_before_load", False))
    if emptying and not as_bool(config.get("allow_empty", False)) and df.isEmpty():
        return 0
    if mode == "replace":
        return counted_write(shaped, lambda rows: place.replace(rows, config, table))
    if not place.exists(spark, config, table):
        return counted_write(shaped, lambda rows: place.create(rows, config, table))
    fitted = fit_to(shaped, place.read(spark, config, table), cast=not place.casts_itself)
    if emptying:
        return counted_write(fitted, lambda rows: place.refill(rows, config, table))
    return counted_write(fitted, lambda rows: place.append(rows, config, table))


def _load_upsert(shaped: DataFrame, place: Target, config: Mapping[str, Any], table: str) -> int:
    """Work the changes out once and merge them; returns the rows given.

    A file target writes the files that hold a changed key anew, as its next version. Other targets are merged into a staged copy and
    refilled. The staged rows stay in the shared folder until its owner clears it: should the write to the target break off, they are all
    rows that were to be written.
    """
    keys = target_names(config, "keys")
    if not keys:
        raise ValueError("an upsert needs 'keys' in the load's config")
    spark, latest_by = shaped.sparkSession, next(iter(target_names(config, "latest_by")), None)
    there = place.exists(spark, config, table)
    changes = shaped if not there else fit_to(shaped, place.read(spark, config, table), fill=False)
    seen = Observation()
    changes = stage(changes.observe(seen, F.count(F.lit(1)).alias("rows")), "changes")
    rows = seen.get.get("rows", 0)
    if not there:
        place.create(one_per_key(changes, keys, latest_by), config, table)
    elif rows and hasattr(place, "merge"):
        place.merge(changes, config, table, keys, latest_by)
    elif rows:
        place.refill(stage(upsert(place.read(spark, config, table), changes, keys, latest_by), "upsert"), config, table)
    return rows
