"""Row indexes, chunks and pages over a defined order."""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate, takewhile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.plans.ranges import RANGE, KeyRanges, OrderKey, array_value, find_ranges, not_above
from tablelift.session import Folder, stage

# Copies of one row are written out in runs of at most this many per task.
COPIES_PER_RUN = 1_000_000
# A key range of more rows than this, and than four times the mean, holds ties that are split by the other columns.
TIED_ROWS = 200_000
INDEX = "_key_index"


def whole_part(value: Column, size: int) -> Column:
    """``value`` divided by ``size`` in whole numbers, exact for any size of table."""
    return F.call_function("div", value, F.lit(size).cast("bigint"))


def chunk_count(total: int, size: int) -> int:
    """Chunks needed for ``total`` rows."""
    if size < 1:
        raise ValueError(f"the chunk size must be at least 1, not {size}")
    return -(-total // size)


def chunk_plan(df: DataFrame, size: int) -> DataFrame:
    """One row per planned chunk: number, offset, size, rows in it, and the totals."""
    total = df.count()
    chunks = chunk_count(total, size)
    offset = F.col("id") * size
    return df.sparkSession.range(chunks).select(
        (F.col("id") + 1).alias("chunk_number"),
        offset.alias("chunk_offset"),
        F.lit(size).cast("bigint").alias("chunk_size"),
        F.least(F.lit(size).cast("bigint"), F.lit(total).cast("bigint") - offset).alias("chunk_rows"),
        F.lit(chunks).cast("bigint").alias("chunk_count"),
        F.lit(total).cast("bigint").alias("total_rows"),
    )


def with_row_index(
    df: DataFrame, order_by: Sequence[str], ties: str = "reject", name: str = "row_index"
) -> DataFrame:
    """Add the dense 0-based index of each row in the order of ``order_by``.

    ``ties="reject"`` (a unique key) makes equal keys an error at run time. ``ties="all_columns"``
    breaks them by the remaining columns. The table is cut into ranges by the named columns alone; only ranges in which few keys hold many
    rows are cut again by all columns. There, rows that are equal in all columns are counted once before
    anything is shuffled and written out again at the end, so a flood of copies stays spread out.
    """
    if ties == "reject":
        return _index_unique(df, find_ranges(df, order_by), name)
    if ties == "all_columns":
        return _index_ties(df, order_by, name)
    raise ValueError(f"ties must be 'reject' or 'all_columns', not {ties!r}")


def _start_of_range(spark: SparkSession, ranges: KeyRanges) -> Column:
    return F.element_at(array_value(spark, ranges.first_index, T.LongType()), F.col(RANGE) + 1)


def _index_unique(df: DataFrame, ranges: KeyRanges, name: str, keep_range: bool = False) -> DataFrame:
    window = Window.partitionBy(RANGE).orderBy(*ranges.key.columns)
    repeated = F.raise_error(F.lit(f"the order columns {ranges.key.names} are not unique"))
    index = F.when(ranges.key.same_as_previous(window), repeated).otherwise(
        _start_of_range(df.sparkSession, ranges) + F.row_number().over(window) - 1
    )
    indexed = ranges.assign(df).withColumn(name, index.cast("bigint"))
    return indexed if keep_range else indexed.drop(RANGE)


def _index_ties(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    ranges, spark = find_ranges(df, order_by), df.sparkSession
    order = [*order_by, *[c for c in df.columns if c not in order_by]]
    placed, start = ranges.assign(df), _start_of_range(spark, ranges)
    heavy = [i for i, n in enumerate(ranges.rows) if n > max(TIED_ROWS, 4 * ranges.total // len(ranges.rows))]
    window = Window.partitionBy(RANGE).orderBy(*[F.col(f"`{c}`") for c in order])
    index = (start + F.row_number().over(window) - 1).cast("bigint")
    if not heavy:
        return placed.withColumn(name, index).select(*df.columns, name)
    light = placed.filter(~F.col(RANGE).isin(heavy)).withColumn(name, index)
    tied = _index_copies(placed.filter(F.col(RANGE).isin(heavy)), [RANGE, *order], "_tied")
    # The rows of the other ranges come in between.
    apart = set(heavy)
    before = [0, *accumulate(0 if i in apart else n for i, n in enumerate(ranges.rows))]
    shift = F.element_at(array_value(spark, before[:-1], T.LongType()), F.col(RANGE) + 1)
    tied = tied.withColumn(name, (F.col("_tied") + shift).cast("bigint"))
    return light.select(*df.columns, name).unionByName(tied.select(*df.columns, name))


def _index_copies(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """The index of rows in the order of all columns, the first of which may be a range; ranges of their own are cut by the leading plain columns."""
    distinct = stage(df.withColumnRenamed(RANGE, "_outer").groupBy(*[c if c != RANGE else "_outer" for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies")))
    order = [c if c != RANGE else "_outer" for c in order]
    plain = list(takewhile(lambda c: isinstance(distinct.schema[c].dataType, T.AtomicType), order))
    ranges = find_ranges(distinct, plain, weight="_copies")
    window = Window.partitionBy(RANGE).orderBy(*[F.col(f"`{c}`") for c in order])
    before = F.sum("_copies").over(window.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_copies")
    first = ranges.assign(distinct).withColumn("_first", _start_of_range(df.sparkSession, ranges) + before)
    indexed = _split_runs(first.drop(RANGE)).withColumn(name, F.explode(F.sequence("_first", "_until")))
    return indexed.withColumnRenamed("_outer", RANGE).select(*df.columns, name)


def _split_runs(first: DataFrame) -> DataFrame:
    """Cut the copies of each row into runs and spread the runs over the tasks."""
    end = F.col("_first") + F.col("_copies") - 1
    starts = F.sequence(F.col("_first"), end, F.lit(COPIES_PER_RUN).cast("bigint"))
    width = int(first.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        first.withColumn("_end", end)
        .withColumn("_first", F.explode(starts))
        .repartition(width, "_first")
        .withColumn("_until", F.least(F.col("_first") + COPIES_PER_RUN - 1, F.col("_end")))
        .drop("_end")
    )


@dataclass(frozen=True)
class ChunkLimits:
    """The first key of every chunk after the first: chunks as key ranges of exactly ``size`` rows."""

    key: OrderKey
    size: int
    total: int
    starts: list[tuple]

    @property
    def chunks(self) -> int:
        return chunk_count(self.total, self.size)

    def rows_in(self, chunk: int) -> int:
        return min(self.size, self.total - (chunk - 1) * self.size)

    def number(self, df: DataFrame, name: str = "chunk_number") -> DataFrame:
        """Add the chunk number by a search in the limits; no row moves."""
        return self.key.position(df, self.starts, name).withColumn(name, (F.col(name) + 1).cast("bigint"))

    def limits_of(self, first: int, last: int) -> tuple[tuple | None, tuple | None]:
        """The keys from which and below which chunks ``first`` to ``last`` lie; None where a side is open."""
        return self.starts[first - 2] if first > 1 else None, self.starts[last - 1] if last < self.chunks else None

    def within(self, first: int, last: int) -> Column:
        """The rows of chunks ``first`` to ``last`` as a key predicate for the scan."""
        return self.key.between(*self.limits_of(first, last))


def chunk_limits(df: DataFrame, ranges: KeyRanges, size: int) -> ChunkLimits:
    """The chunk limits of ``df``; its key columns are sorted once, and only the limits are collected."""
    key, starts = ranges.key, []
    if chunk_count(ranges.total, size) > 1:
        indexed = _index_unique(df.select(*key.columns), ranges, "_index")
        openers = indexed.filter((F.col("_index") > 0) & (F.col("_index") % size == 0))
        rows = sorted(openers.select("_index", *key.parts()).collect(), key=lambda row: row["_index"])
        starts = [tuple(row)[1:] for row in rows]
    return ChunkLimits(key, size, ranges.total, starts)


def find_chunk_limits(df: DataFrame, order_by: Sequence[str], size: int) -> ChunkLimits:
    """The chunk limits of ``df``, from passes over its key columns only.

    The driver holds one key for each chunk: choose a size that leaves no more than some hundred thousand. To number
    rows by chunks of any size, use :func:`assign_chunks`, which holds none.
    """
    return chunk_limits(df, find_ranges(df, order_by), size)


def _number_by_range(df: DataFrame, ranges: KeyRanges, size: int, name: str) -> DataFrame:
    """Add the chunk number: rows search the chunk openers of their own key range.

    The openers of a range come as one array, at most a range's rows divided by ``size``, by a join on the range.
    """
    key = ranges.key
    indexed = _index_unique(df.select(*key.columns), ranges, "_index", keep_range=True)
    openers = indexed.filter((F.col("_index") > 0) & (F.col("_index") % size == 0))
    by_range = openers.groupBy(RANGE).agg(F.sort_array(F.collect_list(key.value())).alias("_openers"))
    starts = [max(0, first - 1) // size for first in ranges.first_index]
    before = F.element_at(array_value(df.sparkSession, starts, T.LongType()), F.col(RANGE) + 1)
    found = ranges.assign(df).withColumns({"_before": before, "_key": key.value()}).join(by_range, RANGE, "left")
    reached = not_above("_openers", "_key", max(ranges.rows, default=0) // size + 1)
    number = (F.col("_before") + reached + 1).cast("bigint")
    return found.withColumn(name, number).select(*df.columns, name)


def assign_chunks(
    df: DataFrame, order_by: Sequence[str], size: int, ties: str = "reject", name: str = "chunk_number"
) -> DataFrame:
    """Add the 1-based chunk number: row index divided by ``size``.

    With a unique key only the key columns are sorted, and the rows search the first keys of the chunks in their
    key range. Otherwise the number follows from the row index.
    """
    chunk_count(0, size)
    if ties == "reject":
        return _number_by_range(df, find_ranges(df, order_by), size, name)
    indexed = with_row_index(df, order_by, ties, "_index")
    return indexed.withColumn(name, whole_part(F.col("_index"), size) + 1).drop("_index")


def page(df: DataFrame, order_by: Sequence[str], offset: int, limit: int, index: KeyRanges | None = None) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in the order of a unique key.

    A page reads only the key ranges that hold it, so neither the driver nor one task sees the rows before it. Equal
    keys in these ranges are an error, whatever the offset. With a :func:`key_index` that is all it reads; without one, three passes over the
    keys make it first.
    """
    if offset < 0 or limit < 0:
        raise ValueError("offset and limit must not be negative")
    return _indexed_page(df, order_by, offset, offset + limit, index).drop("row_index")


def page_by_row_number(
    df: DataFrame, order_by: Sequence[str], after: int, up_to: int, index: KeyRanges | None = None
) -> DataFrame:
    """Rows whose 1-based number ``rn`` has ``after < rn <= up_to``; the number itself is dropped."""
    return _indexed_page(df, order_by, after, up_to, index).drop("row_index")


def slice_rows(df: DataFrame, order_by: Sequence[str], start: int, length: int, index: KeyRanges | None = None) -> DataFrame:
    """``length`` rows from index ``start``, with their ``row_index``."""
    return _indexed_page(df, order_by, start, start + length, index)


def _indexed_page(df: DataFrame, order_by: Sequence[str], start: int, stop: int, ranges: KeyRanges | None) -> DataFrame:
    if ranges is None:
        ranges = find_ranges(df, order_by)
    elif ranges.key.names != list(order_by):
        raise ValueError(f"the index is one of {ranges.key.names}, not of {list(order_by)}")
    low, high, first = ranges.holding(start, stop)
    held = df.filter(ranges.key.between(low, high)) if first < ranges.total else df.limit(0)
    index = F.col("row_index")
    return _index_unique(held, ranges, "row_index").filter((index >= start) & (index < stop))


def source_version(df: DataFrame) -> str:
    """Tells the files that a frame reads, with their sizes and times, from any others. A frame without files has none."""
    names = sorted(df.inputFiles())
    if not names:
        raise ValueError("the rows do not come from files; give the version of the source")
    place = Folder(df.sparkSession, names[0].rsplit("/", 1)[0])
    told = hashlib.sha256()
    for name in names:
        found = place.status(name)
        told.update(f"{name} {found.getLen()} {found.getModificationTime()}\n".encode())
    return told.hexdigest()


def key_index(df: DataFrame, order_by: Sequence[str], folder: str, version: str | None = None) -> KeyRanges:
    """A sparse index of a unique key for pages: split points and the rows between them, kept below ``folder``.

    It is made by three passes over the keys when it is not there for this ``version`` of the source, by default that of its files;
    afterwards no rows are read. Its size is bounded, whatever the table's.
    """
    told = hashlib.sha256(json.dumps([version or source_version(df), list(order_by)]).encode()).hexdigest()
    place, name = Folder(df.sparkSession, folder), f"{INDEX}-{told}"
    if place.exists(name):
        return KeyRanges.from_bytes(df.schema, base64.b64decode(place.text(name)))
    ranges = find_ranges(df, order_by)
    draft = f"{name}-{uuid.uuid4().hex}"
    place.put(draft, base64.b64encode(ranges.as_bytes()).decode())
    if not place.move(draft, name):  # made by someone else meanwhile
        place.delete(draft)
    return ranges


def page_sweep(df: DataFrame, order_by: Sequence[str], size: int) -> DataFrame:
    """All pages of a table in one partitioned read, each row with its ``page_number``."""
    return assign_chunks(df, order_by, size, name="page_number")


def union_chunks(chunks: Iterable[DataFrame]) -> DataFrame:
    """Chunks put back together, matched by column name."""
    return reduce(DataFrame.unionByName, chunks)
