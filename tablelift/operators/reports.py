"""Progress and quality reports as DataFrames. Everything is aggregated per chunk before it is ordered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelift.operators.chunks import whole_part
from tablelift.operators.control import OK, STARTED, ControlTable, latest_run
from tablelift.session import stage

CHUNKS_PER_BLOCK = 10_000
PROGRESS = (
    "run_id string, state string, chunks bigint, chunks_done bigint, rows bigint, percent double, seconds double, "
    "rows_per_second double, eta_seconds double"
)
# Seconds are summed as decimals, so the result does not depend on the order of the rows.
EXACT_SECONDS = "decimal(20,6)"


def running_total(
    df: DataFrame, value: str, name: str, order: str = "chunk_number", by: Sequence[str] = ()
) -> DataFrame:
    """Add the running total of ``value`` over a whole-number order column, for each of ``by`` if given.

    Blocks of the order column are summed first and only the block sums, one per ten thousand chunks,
    are put in one sequence; inside a block the totals run in parallel.
    """
    parts = [*by, "_block"]
    block = whole_part(F.col(order), CHUNKS_PER_BLOCK).alias("_block")
    sums = df.groupBy(*by, block).agg(F.sum(value).alias("_sum"))
    so_far = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*parts, F.coalesce(F.sum("_sum").over(so_far), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.withColumn("_block", block)
        .join(before, parts)
        .withColumn(name, F.col("_before") + F.sum(value).over(inside))
        .drop("_block", "_before")
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds between two timestamps of one kind, whatever the session's time zone."""
    return (end - start).cast("interval second").cast(EXACT_SECONDS).cast("double")


def chunk_counts(df: DataFrame, time: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Rows per chunk (of each of ``by``) and, with a time column, the seconds the chunk spans."""
    measures = [F.count(F.lit(1)).alias("rows")]
    if time:
        measures.append(seconds_between(F.min(time), F.max(time)).alias("seconds"))
    return df.groupBy(*by, "chunk_number").agg(*measures)


def copy_counts(control: ControlTable, name: str) -> DataFrame:
    """Rows and seconds of each finished chunk of the latest copy of that name, for :func:`chunk_report`.

    Chunks of one wave are written side by side; each is given its share, by rows, of the wave's seconds from STARTED to
    OK of the attempt that worked.
    """
    own = latest_run(control.history(), name)
    when = F.struct("updated_at", "status")
    ends = own.groupBy("chunk_number").agg(
        F.max_by("status", when).alias("status"),
        F.max_by("rows_loaded", when).alias("rows"),
        F.max("updated_at").alias("ended"),
        F.max(F.when(F.col("status") == STARTED, F.col("updated_at"))).alias("began"),
    )
    done = ends.filter(F.col("status") == OK)
    waves = done.groupBy("began", "ended").agg(F.sum("rows").alias("_rows"))
    share = seconds_between(F.col("began"), F.col("ended")) * F.try_divide(F.col("rows"), F.col("_rows"))
    return done.join(waves, ["began", "ended"]).select("chunk_number", "rows", share.alias("seconds"))


def copy_progress(control: ControlTable, name: str) -> DataFrame:
    """One row on the latest copy of that name, also while it runs: chunks and rows done, seconds so far, rows per second and seconds left.

    The seconds run from the first state to the last; nothing is left of a closed copy. No row if there was none.
    """
    latest = control.latest(name)
    if latest is None:
        return control.spark.createDataFrame([], PROGRESS)
    done = F.col("status") == OK
    seconds = seconds_between(F.min("created_at"), F.max("updated_at"))
    sums = control.of_run(latest["run_id"], name).agg(
        F.count_if(done).alias("chunks_done"), F.coalesce(F.sum(F.when(done, F.col("rows_loaded"))), F.lit(0)).alias("rows"), seconds.alias("seconds")
    )
    left = F.lit(0.0) if latest["closed"] else F.try_divide(F.col("seconds") * (F.lit(latest["chunks"]) - F.col("chunks_done")), F.col("chunks_done"))
    return sums.select(
        F.lit(latest["run_id"]).alias("run_id"),
        F.lit("closed" if latest["closed"] else "open").alias("state"),
        F.lit(latest["chunks"]).cast("bigint").alias("chunks"),
        "chunks_done",
        "rows",
        F.round(F.try_divide(F.col("chunks_done") * 100, F.lit(latest["chunks"])), 1).alias("percent"),
        "seconds",
        F.try_divide(F.col("rows").cast("double"), F.col("seconds")).alias("rows_per_second"),
        left.alias("eta_seconds"),
    )


def chunk_report(counts: DataFrame, size: int, by: Sequence[str] = ()) -> DataFrame:
    """Per chunk: rows, chunk size, offset, running total and percent of all rows; ``by`` names the table's columns.

    The counts are written down first: they are small, and what they come from is read only once.
    """
    counts = stage(counts, "counts")
    columns = counts.columns
    if by:
        totals = counts.groupBy(*by).agg(F.sum("rows").alias("total_rows"))
        counts, total = counts.join(totals, list(by)), F.col("total_rows")
    else:
        total = counts.agg(F.sum("rows")).scalar()
    return running_total(counts, "rows", "cumulative", by=by).select(
        *columns,
        F.lit(size).cast("bigint").alias("chunk_size"),
        ((F.col("chunk_number") - 1) * size).alias("chunk_offset"),
        "cumulative",
        total.alias("total_rows"),
        F.round(F.try_divide(F.col("cumulative") * 100, total), 1).alias("percent"),
    )


def chunk_eta(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Seconds left after each chunk, at the rate of all chunks so far (0 when no time has passed)."""
    exact = report.withColumn("_exact", F.col("seconds").cast(EXACT_SECONDS))
    timed = running_total(exact, "_exact", "elapsed", by=by).drop("_exact")
    timed = timed.withColumn("elapsed", F.col("elapsed").cast("double"))
    left = F.col("total_rows") - F.col("cumulative")
    rate = F.try_divide(F.col("cumulative").cast("double"), F.col("elapsed"))
    return timed.withColumn("eta_seconds", F.coalesce(F.try_divide(left.cast("double"), rate), F.lit(0.0)))


def throughput(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, seconds and rows per second of all chunks together; null when no time has passed."""
    seconds = F.sum(F.col("seconds").cast(EXACT_SECONDS)).cast("double")
    sums = counts.groupBy(*by).agg(F.sum("rows").alias("rows"), seconds.alias("seconds"))
    rate = F.try_divide(F.col("rows").cast("double"), F.col("seconds"))
    return sums.withColumn("rows_per_second", rate)


def reconcile_counts(expected: DataFrame, actual: DataFrame, keys: Sequence[str] = ("chunk_number",)) -> DataFrame:
    """Compare rows per key of source and target; both sides are counted before they meet."""
    keys = list(keys)
    left = expected.groupBy(*keys).agg(F.count(F.lit(1)).alias("expected_rows"))
    right = actual.groupBy(*keys).agg(F.count(F.lit(1)).alias("actual_rows"))
    nothing = F.lit(0).cast("bigint")
    return left.join(right, keys, "full_outer").select(
        *keys,
        F.coalesce("expected_rows", nothing).alias("expected_rows"),
        F.coalesce("actual_rows", nothing).alias("actual_rows"),
        F.coalesce("expected_rows", nothing).eqNullSafe(F.coalesce("actual_rows", nothing)).alias("matches"),
    )


def step_summary(steps: DataFrame) -> DataFrame:
    """Totals per kind of step: how many, how many failed, rows and seconds."""
    return steps.groupBy("step").agg(
        F.count(F.lit(1)).alias("steps"),
        F.sum((F.col("status") == "FAILED").cast("bigint")).alias("failed"),
        F.sum("rows").alias("rows"),
        F.sum("seconds").alias("seconds"),
    )
