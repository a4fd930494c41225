"""Key ranges: split points on the order columns that cut a table into ranges of like size.

They let a global order be worked on in parallel. A range is a function of the key alone, so it
does not change when a task is retried or partitions are merged, and rows move only for the
ranges a result needs. A sample of the keys and the row counts per range are all that reaches the
driver, both bounded by ``MAX_RANGES``.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import accumulate
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

MAX_RANGES = 50_000
SAMPLE_PER_RANGE = 20
RANGES_PER_SHUFFLE_PARTITION = 4
ROWS_PER_RANGE = 4_000_000
RANGE = "_range"
#: Characters or bytes of a text or binary key that a split point keeps: a split need not be a key, only lie between keys.
SPLIT_CHARS = 256


def array_value(spark: SparkSession, values: list, element: T.DataType) -> Column:
    """A short driver list as one array value, which a query works out once and every row shares."""
    table = pa.table({"held": pa.array([values], pa.list_(to_arrow_type(element)))})
    return spark.createDataFrame(table).select("held").scalar()


def not_above(bounds: str, key: str, most: int) -> Column:
    """How many of an ascending array column, of at most ``most`` values, are not above the key column."""
    steps = F.array(*[F.lit(2**level) for level in reversed(range(max(1, most.bit_length())))])

    def step_up(at: Column, step: Column) -> Column:
        reached = F.try_element_at(F.col(bounds), at + step) <= F.col(key)
        return at + F.when(reached, step).otherwise(0)

    return F.aggregate(steps, F.lit(0), step_up)


class OrderKey:
    """The order columns of a table in a form that can be compared, collected and turned into literals.

    A zoned timestamp is compared by its microseconds, which survive the way through the driver
    exactly. Nulls come first, as in Spark's sort.
    """

    def __init__(self, schema: T.StructType, columns: Sequence[str]):
        if not columns:
            raise ValueError("an order needs at least one column")
        self.names = list(columns)
        self.types = [schema[name].dataType for name in columns]
        self.columns = [F.col(f"`{name}`") for name in columns]
        self.single = len(self.names) == 1

    def _zoned(self, i: int) -> bool:
        return isinstance(self.types[i], T.TimestampType)

    def parts(self) -> list[Column]:
        return [
            (F.unix_micros(c) if self._zoned(i) else c).alias(f"k{i}") for i, c in enumerate(self.columns)
        ]

    def split_parts(self) -> list[Column]:
        """The parts as split points, long ones cut: what begins a key is not above it."""
        long = (T.StringType, T.BinaryType)
        return [
            (F.substring(part, 1, SPLIT_CHARS) if isinstance(kind, long) else part).alias(f"k{i}")
            for i, (part, kind) in enumerate(zip(self.parts(), self.types, strict=True))
        ]

    def value(self) -> Column:
        """One comparable value per row."""
        return self.parts()[0] if self.single else F.struct(*self.parts())

    def same_as_previous(self, window) -> Column:
        whole = F.struct(*self.parts())
        return F.lag(whole).over(window).eqNullSafe(whole)

    def _struct_type(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f"k{i}", T.LongType() if self._zoned(i) else t) for i, t in enumerate(self.types)]
        )

    def collected(self, rows: Iterable[Any]) -> list[tuple]:
        """Collected key rows as plain tuples; null keys cannot be split points."""
        keys = [tuple(row) for row in rows]
        return [key for key in keys if not (self.single and key[0] is None)]

    def array(self, spark: SparkSession, keys: Sequence[tuple]) -> Column:
        """The keys, which are in order, as one array value."""
        element = self._struct_type()
        if self.single:
            return array_value(spark, [key[0] for key in keys], element[0].dataType)
        named = [dict(zip(element.names, key, strict=True)) for key in keys]
        return array_value(spark, named, element)

    def literal(self, i: int, value: Any) -> Column:
        """One key part as a literal of the column's own type, so that a filter on it reaches the scan."""
        if self._zoned(i):
            return F.timestamp_micros(F.lit(value))
        if isinstance(value, datetime.datetime):
            value = value.isoformat(sep=" ")
        if isinstance(value, bytearray):
            value = bytes(value)
        return F.lit(value).cast(self.types[i])

    def _literals(self, key: tuple) -> Column:
        return F.struct(
            *[
                (F.lit(v).cast("bigint") if self._zoned(i) else self.literal(i, v)).alias(f"k{i}")
                for i, v in enumerate(key)
            ]
        )

    def between(self, low: tuple | None, high: tuple | None) -> Column:
        """``low <= key < high``; an open side is None. The part on the first column can be pushed down."""
        first, conditions = self.columns[0], []
        if low is not None and low[0] is not None:
            conditions.append(first >= self.literal(0, low[0]))
        if high is not None and high[0] is not None:
            limit = self.literal(0, high[0])
            under = first < limit if self.single else first <= limit
            conditions.append(under if low is not None and low[0] is not None else under | first.isNull())
        if not self.single:
            if low is not None:
                conditions.append(self.value() >= self._literals(low))
            if high is not None:
                conditions.append(self.value() < self._literals(high))
        everything = F.lit(True)
        for condition in conditions:
            everything = everything & condition
        return everything

    def position(self, df: DataFrame, keys: Sequence[tuple], name: str) -> DataFrame:
        """Add the number of ``keys`` that are not above the row's key, by a binary search.

        The search is one expression of fixed size, however many keys there are, so that filters on the result
        can be pushed through it. The keys are a column of their own first: a subquery cannot stand in a lambda.
        """
        if not keys:
            return df.withColumn(name, F.lit(0))
        searched = df.withColumns({"_bounds": self.array(df.sparkSession, keys), "_key": self.value()})
        return searched.withColumn(name, not_above("_bounds", "_key", len(keys))).drop("_bounds", "_key")


@dataclass(frozen=True)
class KeyRanges:
    """Split points (ascending) and the rows in each of the ``len(splits) + 1`` ranges."""

    key: OrderKey
    splits: list[tuple]
    rows: list[int]

    @property
    def total(self) -> int:
        return sum(self.rows)

    @property
    def first_index(self) -> list[int]:
        """Global index of each range's first row."""
        return [0, *accumulate(self.rows)][:-1]

    def assign(self, df: DataFrame) -> DataFrame:
        return self.key.position(df, self.splits, RANGE)

    def as_bytes(self) -> bytes:
        """The split points and counts, to be kept by a stored index."""
        kinds = self.key._struct_type()
        columns = {f.name: pa.array([s[i] for s in self.splits], to_arrow_type(f.dataType)) for i, f in enumerate(kinds.fields)}
        sink = pa.BufferOutputStream()
        told = pa.table(columns).replace_schema_metadata({"rows": json.dumps(self.rows), "names": json.dumps(self.key.names)})
        with pa.ipc.new_stream(sink, told.schema) as writer:
            writer.write_table(told)
        return sink.getvalue().to_pybytes()

    @staticmethod
    def from_bytes(schema: T.StructType, stored: bytes) -> KeyRanges:
        told = pa.ipc.open_stream(stored).read_all()
        names, rows = (json.loads(told.schema.metadata[k.encode()]) for k in ("names", "rows"))
        splits = list(zip(*[c.to_pylist() for c in told.columns], strict=True)) if told.num_columns else []
        return KeyRanges(OrderKey(schema, names), splits, rows)

    def holding(self, start: int, stop: int) -> tuple[tuple | None, tuple | None, int]:
        """Key limits of the ranges that hold rows ``start`` to ``stop``, and the index they begin at."""
        starts = self.first_index
        held = [i for i, at in enumerate(starts) if at < stop and at + self.rows[i] > start]
        if not held:
            return None, None, self.total
        low, high = held[0], held[-1]
        return (
            self.splits[low - 1] if low else None,
            self.splits[high] if high < len(self.splits) else None,
            starts[low],
        )


def range_count(spark: SparkSession, total: int) -> int:
    """How many ranges to cut: enough for the session's shuffle width and for the rows."""
    wide = RANGES_PER_SHUFFLE_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(2, min(MAX_RANGES, max(wide, total // ROWS_PER_RANGE)))


def key_sample(keys: DataFrame, total: int, wanted: int) -> DataFrame:
    """About ``wanted`` different keys: those whose hash falls in the lowest part of the hash values.

    The choice depends on the keys, not on partitioning, so a repeated task makes the same one.
    """
    if total > wanted:
        lowest = -(2**63) + int(2**64 * (wanted / total))
        keys = keys.filter(F.xxhash64(*keys.columns) < F.lit(lowest))
    return keys.distinct()


def find_ranges(df: DataFrame, order_by: Sequence[str], weight: str | None = None) -> KeyRanges:
    """Cut ``df`` into key ranges, from a count, a sample and a count per range over the order columns only.

    ``weight`` names a column to sum instead of counting rows.
    """
    spark, key = df.sparkSession, OrderKey(df.schema, order_by)
    keys = df.select(*key.parts())
    total = keys.count()
    wanted = range_count(spark, total)
    cut = df.select(*key.split_parts())
    sample = key_sample(cut, total, wanted * SAMPLE_PER_RANGE).orderBy(*cut.columns).collect()
    step = max(1, -(-len(sample) // wanted))
    splits = key.collected(sample[step::step])
    counted = F.sum(weight) if weight else F.count(F.lit(1))
    found = {
        row[RANGE]: row["rows"]
        for row in key.position(df, splits, RANGE).groupBy(RANGE).agg(counted.alias("rows")).collect()
    }
    return KeyRanges(key, splits, [found.get(i, 0) for i in range(len(splits) + 1)])
