"""Copying a table chunk by chunk, with a control table, so that a broken copy goes on where it stopped."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.operators.chunks import ChunkLimits, chunk_count, chunk_limits, whole_part
from tablelift.operators.control import ERROR, OK, STARTED, ControlTable
from tablelift.operators.upsert import by_key
from tablelift.plans.ranges import find_ranges
from tablelift.plans.settings import as_bool
from tablelift.session import has_files, new_folder, stage
from tablelift.sinks import checked_append, counted_write, find_target, fit_to, keeps_marks, shape_for_load, takes_waves
from tablelift.sinks.versions import Mark

# Rows that are committed together, unless told otherwise.
COMMIT_ROWS = 10_000_000
# Rows of a wave that one task lays out, about.
ROWS_PER_TASK = 1_000_000
# Small neighbouring waves that are written together: their rows and their number, at most.
GROUP_ROWS, GROUP_WAVES = 1_000_000, 1_000
WAVE = "_wave"


@dataclass(frozen=True)
class CopyResult:
    """What a chunked copy did."""

    run_id: str
    resumed: bool
    chunks: int
    chunks_done_before: int
    rows: int


@dataclass(frozen=True)
class _Waves:
    """Neighbouring chunks taken together; a wave is itself a chunk of the table, only larger."""

    limits: ChunkLimits
    size: int
    per_wave: int

    @property
    def chunks(self) -> int:
        return chunk_count(self.limits.total, self.size)

    def chunks_of(self, wave: int) -> tuple[int, int]:
        first = (wave - 1) * self.per_wave + 1
        return first, min(first + self.per_wave - 1, self.chunks)

    def mark(self, name: str, run_id: str, wave: int) -> Mark:
        """Tells a wave by its key limits and rows, so that one of another plan is another wave."""
        limits = self.limits.limits_of(wave, wave)
        told = hashlib.sha256(f"{self.limits.key.names} {limits} {self.limits.rows_in(wave)}".encode()).hexdigest()
        return Mark(name, run_id, told)


def copy_in_chunks(
    df: DataFrame,
    name: str,
    table: str,
    key: Sequence[str],
    size: int,
    control: ControlTable,
    target: str = "parquet",
    config: Mapping[str, Any] | None = None,
    waves: int | None = None,
    commit_rows: int = COMMIT_ROWS,
    staged: bool = False,
) -> CopyResult:
    """Copy ``df`` to ``table`` as chunks of ``size`` rows in the order of its unique ``key``.

    Chunks are key ranges. A wave of neighbouring chunks is one Spark job: its chunks are marked STARTED, its key
    limits go down to the scan, its rows go straight to the target without a shuffle, and then its chunks are marked
    OK. A wave is what is committed, and what is in question after a break: as many whole chunks as hold
    ``commit_rows`` rows (one at least), or, with ``waves``, an equal share of the chunks. The driver holds the limits
    of the waves.

    Small neighbouring waves, of ``GROUP_ROWS`` rows together at most, go in one job to a target that takes several: file targets, which commit
    each wave by itself, from a folder of its own (one shuffle brings its rows there), and catalog tables, where the waves of a job
    arrive together. After a break all of them are in question, each for itself.

    A source that is dear to work out, or whose files are not laid out by the key, can be ``staged``: it is worked out once, the keys of the
    staged rows give the limits, and one shuffle puts the rows of each wave in a folder of their own. A resumed copy goes on with the
    staged rows, whatever has become of the source.

    An open run of the same name is taken up again. A target that keeps marks tells which waves it holds, so that a resume
    reads none of its rows; a wave is there as a whole or not at all. Of other targets, and where the plan of the waves has changed, rows that
    arrived before the copy broke are found by their key, nulls included, and not copied again. Rows of the target that are not in ``df``
    do not count. The target is emptied only when a run starts afresh, and a fresh run refuses a target that already has some of its keys. A
    finished run is closed; the next call starts a new one. The chunk size of an open run cannot change.
    """
    config = config or {}
    place, spark = find_target(target), df.sparkSession
    there = place.exists(spark, config, table)
    shaped = shape_for_load(df, config)
    if there:
        shaped = fit_to(shaped, place.read(spark, config, table), cast=not place.casts_itself)
    source, held = shaped, _held_rows(control, name, shaped) if staged else None
    if staged:
        shaped = held if held is not None else stage(source, "copied")
    plan = _plan_waves(shaped, key, size, waves, commit_rows)
    run_id, done = _open_run(control, name, plan)
    resumed, run_id = run_id is not None, run_id or uuid.uuid4().hex
    if held is not None and not resumed:  # the held rows had all been copied, only the run was not closed
        shaped = stage(source, "copied")
        plan = _plan_waves(shaped, key, size, waves, commit_rows)
    laid = _lay_out(shaped, plan) if staged else None
    if not resumed:
        control.begin(run_id, name, size, plan.chunks, _folder_of(shaped) if staged else None)
    marked = keeps_marks(place)
    arrived: dict[int, int] = {}
    if there and resumed:
        arrived = _marked_waves(place, config, table, spark, plan, name, run_id, done) if marked else None
        if arrived is None:
            arrived = _rows_per_wave(shaped, place.read(spark, config, table), plan)
    elif there:
        _make_room(shaped, key, place, config, table)
    if not there:
        place.create(shaped.limit(0), config, table)
    skipped, left = 0, []
    for wave in range(1, plan.limits.chunks + 1):
        if wave in done and arrived.get(wave, 0) == plan.limits.rows_in(wave):
            skipped += len(range(*plan.chunks_of(wave))) + 1
        else:
            left.append(wave)

    def save(status: str, waves: list[int]) -> None:
        if waves:
            ranges = [plan.chunks_of(wave) for wave in waves]
            control.save_ranges(run_id, name, table, ranges, plan.size, plan.limits.total, status)

    for group in _groups(plan, left, arrived) if takes_waves(place) else [[wave] for wave in left]:
        wave, last = group[0], group[-1]
        rows = laid.read(*group) if laid else shaped.filter(plan.limits.within(wave, last))
        save(STARTED, group)
        if wave < last:
            due = {wave: (plan.limits.rows_in(wave), plan.mark(name, run_id, wave)) for wave in group}
            by, come = f"{WAVE}_{run_id}", set()
            try:
                for arriving in place.append_waves(plan.limits.number(rows, by), config, table, by, due):
                    come.add(arriving)
            finally:
                save(OK, [wave for wave in group if wave in come])
                save(ERROR, [wave for wave in group if wave not in come])
            continue
        expected = plan.limits.rows_in(wave)
        try:
            if arrived.get(wave) == expected:
                pass  # it broke off before the state was saved
            elif marked and not arrived.get(wave):
                checked_append(rows, place, config, table, plan.mark(name, run_id, wave), expected)
            else:
                if arrived.get(wave):
                    there_now = place.read(spark, config, table).filter(plan.limits.within(wave, wave))
                    rows = by_key(rows, there_now, key, "left_anti")
                    expected -= arrived[wave]
                appended = counted_write(rows, lambda wave_rows: place.append(wave_rows, config, table))
                if appended != expected:
                    raise RuntimeError(f"wave {wave} gave {appended} rows instead of {expected}: the source has changed")
        except Exception:
            save(ERROR, group)
            raise
        save(OK, group)
    control.finish(run_id)
    return CopyResult(run_id, resumed, plan.chunks, skipped, plan.limits.total)


def _groups(plan: _Waves, left: list[int], arrived: Mapping[int, int]) -> Iterator[list[int]]:
    """The waves that are left, neighbours of which nothing has arrived together up to ``GROUP_ROWS`` and ``GROUP_WAVES``."""
    group, rows = [], 0
    for wave in left:
        own = plan.limits.rows_in(wave)
        apart = arrived.get(wave) or arrived.get(wave - 1) or rows + own > GROUP_ROWS or len(group) == GROUP_WAVES
        if group and (apart or wave != group[-1] + 1):
            yield group
            group, rows = [], 0
        group.append(wave)
        rows += own
    if group:
        yield group


def _plan_waves(df: DataFrame, key: Sequence[str], size: int, waves: int | None, commit_rows: int) -> _Waves:
    ranges = find_ranges(df, key)
    chunks = chunk_count(ranges.total, size)
    per_wave = max(1, -(-chunks // waves) if waves else commit_rows // size)
    return _Waves(chunk_limits(df, ranges, size * per_wave), size, per_wave)


@dataclass(frozen=True)
class _Laid:
    """The rows of each wave in a folder of their own."""

    folder: str
    schema: T.StructType
    spark: SparkSession

    def read(self, *waves: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/{WAVE}={wave}" for wave in waves])


def _lay_out(rows: DataFrame, plan: _Waves) -> _Laid:
    """Put the rows of each wave in a folder, by one shuffle; the rows of a large wave are dealt to several tasks by their key."""
    spark, key = rows.sparkSession, plan.limits.key
    parts = -(-plan.size * plan.per_wave // ROWS_PER_TASK)
    dealt = plan.limits.number(rows, WAVE).withColumn("_part", F.pmod(F.xxhash64(*key.columns), F.lit(parts)))
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts)
    folder = new_folder(spark, "waves")
    dealt.repartition(width, WAVE, "_part").drop("_part").write.partitionBy(WAVE).parquet(folder)
    return _Laid(folder, rows.schema, spark)


def _folder_of(rows: DataFrame) -> str:
    """The folder of staged rows."""
    return rows.inputFiles()[0].rsplit("/", 1)[0]


def _held_rows(control: ControlTable, name: str, shaped: DataFrame) -> DataFrame | None:
    """The staged rows of the open run of this name, if it has any that fit."""
    latest = control.latest(name)
    if latest is None or latest["closed"] or not latest.get("staged") or not has_files(shaped.sparkSession, latest["staged"]):
        return None
    return shaped.sparkSession.read.schema(shaped.schema).parquet(latest["staged"])


def _make_room(shaped: DataFrame, key: Sequence[str], place, config: Mapping[str, Any], table: str) -> None:
    """Empty the target for a fresh run if asked to; otherwise see that none of the keys is there yet."""
    if as_bool(config.get("truncate_before_load", False)):
        place.refill(shaped.limit(0), config, table)
        return
    if not by_key(place.read(shaped.sparkSession, config, table), shaped, key, "left_semi").isEmpty():
        raise ValueError(f"{table} already has rows with these keys; set truncate_before_load to copy afresh")


def _marked_waves(place, config, table, spark, plan: _Waves, name: str, run_id: str, done: set[int]) -> dict[int, int] | None:
    """The rows of the waves that the target holds by its marks; None if its marks do not tell all of this plan's waves."""
    held = {mark for mark in place.marks(spark, config, table) if (mark.owner, mark.run) == (name, run_id)}
    waves = {plan.mark(name, run_id, wave): wave for wave in range(1, plan.limits.chunks + 1)}
    if not held or not held <= waves.keys() or not done <= {waves[mark] for mark in held}:
        return None
    return {waves[mark]: plan.limits.rows_in(waves[mark]) for mark in held}


def _rows_per_wave(source: DataFrame, target: DataFrame, plan: _Waves) -> dict[int, int]:
    """How many of the source's rows the target has, by their keys, for each wave."""
    key = plan.limits.key.names
    arrived = by_key(source.select(*key), target, key, "left_semi")
    counts = plan.limits.number(arrived, "wave").groupBy("wave").agg(F.count(F.lit(1)).alias("rows"))
    return {row["wave"]: row["rows"] for row in counts.collect()}


def _open_run(control: ControlTable, name: str, plan: _Waves) -> tuple[str | None, set[int]]:
    """The latest run of this name if it is unfinished, with the waves whose chunks are all OK. Only that run's states are read."""
    latest = control.latest(name)
    if latest is None or latest["closed"]:
        return None, set()
    states = control.of_run(latest["run_id"], name)
    wave = (whole_part(F.col("chunk_number") - 1, plan.per_wave) + 1).alias("wave")
    counts = states.groupBy(wave).agg(F.count_if(F.col("status") == OK).alias("good")).collect()
    if sum(row["good"] for row in counts) >= latest["chunks"]:
        control.finish(latest["run_id"])  # it broke off before that
        return None, set()
    if latest["size"] != plan.size:
        raise ValueError(f"{name} has an open run with chunks of {latest['size']} rows; it cannot go on with {plan.size}")
    done = {row["wave"] for row in counts if row["good"] == len(range(*plan.chunks_of(row["wave"]))) + 1}
    return latest["run_id"], done
