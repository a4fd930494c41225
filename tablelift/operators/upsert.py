"""Merging new rows into a table by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def one_per_key(rows: DataFrame, keys: Sequence[str], latest_by: str | None = None) -> DataFrame:
    """One row per key: the one with the greatest ``latest_by``; without it a repeated key is an error.

    A null ``latest_by`` comes before all values. Equal ones are told apart by the remaining columns, in their
    order, so the choice is the same in every run.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    sortable = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    order = F.struct(*[F.col(f"`{c}`") for c in [latest_by, *sortable] if c])
    chosen = F.max_by(whole, order) if latest_by else F.any_value(whole)
    picked = rows.groupBy(*keys).agg(chosen.alias("_row"), F.count(F.lit(1)).alias("_times"))
    if latest_by is None:
        repeated = F.raise_error(F.lit(f"a key of {list(keys)} has several new rows"))
        picked = picked.withColumn("_row", F.when(F.col("_times") > 1, repeated).otherwise(F.col("_row")))
    return picked.select("_row.*")


def by_key(rows: DataFrame, others: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """The rows with (``left_semi``) or without (``left_anti``) their key among ``others``; here a null key equals a null key."""
    r, o = rows.alias("r"), others.select(*[F.col(f"`{k}`") for k in key]).alias("o")
    return r.join(o, [F.col(f"r.`{k}`").eqNullSafe(F.col(f"o.`{k}`")) for k in key], how)


def upsert(existing: DataFrame, changes: DataFrame, keys: Sequence[str], latest_by: str | None = None) -> DataFrame:
    """``existing`` with ``changes`` applied: new keys are added and for known keys the new row wins.

    A key with a null equals no other, so such rows stay and are added. They are spread by their
    other values, not sent to one task.
    """
    keys = list(keys)
    new = one_per_key(changes, keys, latest_by)
    incomplete = F.lit(False)
    for k in keys:
        incomplete = incomplete | F.col(f"`{k}`").isNull()
    hashable = [f for f in existing.schema.fields if isinstance(f.dataType, T.AtomicType)]
    plain = [F.col(f"`{f.name}`") for f in hashable if not isinstance(f.dataType, T.VariantType)]
    spread = F.when(incomplete, F.xxhash64(*plain)).otherwise(F.lit(0))
    known = new.select(*[F.col(f"`{k}`") for k in keys], F.lit(0).cast("bigint").alias("_spread"))
    kept = existing.withColumn("_spread", spread).join(known, [*keys, "_spread"], "left_anti")
    return kept.select(*existing.columns).unionByName(new.select(*existing.columns))
