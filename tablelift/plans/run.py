"""Running a configuration of extractions, transforms and loads."""

from __future__ import annotations

import datetime
import os
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.operators.control import CHUNK_KEY, OK, ControlTable
from tablelift.plans.copy import copy_in_chunks
from tablelift.plans.settings import REPEATED, as_bool, as_size, check_config, expand_settings
from tablelift.session import shared_folder, stage
from tablelift.sinks import load, shape_for_load, supported_targets, target_names
from tablelift.sources import DATABASES, read_source, row_count, supported_sources
from tablelift.streaming import stream_load

Transform = Callable[[DataFrame], DataFrame]
STEP_SCHEMA = (
    "step string, name string, source string, table_name string, rows long, status string, error string, "
    "started_at timestamp, ended_at timestamp, seconds double"
)
# Extractions that run side by side, unless the configuration says otherwise.
PARALLEL = 4
MODES = ("batch", "chunked", "stream")
DONE, FAILED, SKIPPED = "OK", "FAILED", "SKIPPED"


class _Steps:
    """The outcome of each step; a step that fails is noted and the run goes on."""

    def __init__(self):
        self.rows: list[dict[str, Any]] = []

    def run(self, step: str, name: str, source: str, table: str | None, work: Callable[[], int]) -> dict[str, Any]:
        start = datetime.datetime.now(datetime.UTC)
        rows, status, error = 0, DONE, None
        try:
            rows = work()
        except Exception as problem:  # whatever a source or target raises must not stop the other steps
            status, error = FAILED, f"{type(problem).__name__}: {problem}"
        return self._note(step, name, source, table, rows, status, error, start)

    def skip(self, step: str, name: str, source: str, table: str | None, why: str) -> None:
        self._note(step, name, source, table, 0, SKIPPED, why, datetime.datetime.now(datetime.UTC))

    def _note(self, step, name, source, table, rows, status, error, start) -> dict[str, Any]:
        end = datetime.datetime.now(datetime.UTC)
        self.rows.append(
            {
                "step": step, "name": name, "source": source, "table_name": table, "rows": rows, "status": status,
                "error": error, "started_at": start, "ended_at": end, "seconds": (end - start).total_seconds(),
            }
        )
        return self.rows[-1]


def run_config(
    spark: SparkSession,
    config: Mapping[str, Any],
    transforms: Mapping[str, Transform] | None = None,
    values: Mapping[str, str] | None = None,
) -> DataFrame:
    """Run all extractions and loads and return one row per step.

    ``config`` holds ``extractions`` (name, source, config, query, params), ``loads`` (name, source,
    target, config, table, mode), ``transformations`` (enabled) and ``mode``: ``batch`` loads each
    table in one job, ``chunked`` copies it by :func:`copy_in_chunks` and can be resumed, ``stream`` loads the files of
    a ``parquet`` source that are new by :func:`stream_load`. ``parallel`` (default true) submits the jobs of several
    extractions at the same time, so that a small table does not wait for the last task of a large one; a number says
    how many. ``control_target`` (target, table, config) names a copy of the control table that is brought up to date at the end of a
    chunked or streamed run. ``${NAME}`` is filled from ``values``, by default the environment.

    Two extractions of one name are an error before anything runs; all other problems that ``problems`` would list
    fail or skip their own step.
    """
    config = expand_settings(dict(config), os.environ if values is None else values)
    mode = config.get("mode", "batch")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, not {mode!r}")
    found = check_config(config, supported_sources(), supported_targets())
    repeated = [name for name, problem in found if problem == REPEATED]
    if repeated:
        raise ValueError(f"extractions with the same name: {', '.join(repeated)}")
    loads = config.get("loads") or []
    extractions = config.get("extractions") or []
    names = {e.get("name", "unnamed") for e in extractions}
    active = as_bool((config.get("transformations") or {}).get("enabled", False))
    hooks = dict(transforms or {}) if active else {}
    steps = _Steps()
    for entry in loads:
        if entry.get("source") not in names:
            steps.skip("load", entry.get("name", "unnamed"), entry.get("source"), entry.get("table"),
                       f"the extraction {entry.get('source')!r} does not exist")

    def work(extraction) -> list[dict[str, Any]]:
        own = _Steps()
        _run_extraction(spark, config, mode, extraction, loads, hooks, own)
        return own.rows

    with ThreadPoolExecutor(_side_by_side(config.get("parallel", True))) as pool:
        for rows in pool.map(work, extractions):
            steps.rows += rows
    where = config.get("control_target")
    if where and mode != "batch":
        control = ControlTable(spark, _control_path(spark, config))
        steps.run("control", where["table"], "control", where["table"], lambda: publish_control(control, **where))
    return spark.createDataFrame(steps.rows, STEP_SCHEMA)


def publish_control(control: ControlTable, target: str, table: str, config: Mapping[str, Any] | None = None) -> int:
    """Bring a copy of the control table in a target up to date, a row for each run, extraction and chunk; returns the rows of the control table.

    So the states can be looked up beside the loaded tables, in a database for instance. Resuming does not read the copy.
    """
    return load(control.current(), target, table, {**(config or {}), "keys": CHUNK_KEY, "clean_names": False}, mode="upsert")


def _side_by_side(parallel: Any) -> int:
    """A flag, or a number of extractions."""
    if not isinstance(parallel, bool) and str(parallel).strip().isdigit() and int(parallel) > 1:
        return int(parallel)
    return PARALLEL if as_bool(parallel) else 1


def _run_extraction(spark, config, mode, extraction, loads, hooks, steps) -> None:
    """Build the extraction's frame and run its loads.

    One load of unchanged rows tells how many were extracted; otherwise they are counted.
    """
    name, kind = extraction.get("name", "unnamed"), extraction.get("source")
    wanted = [entry for entry in loads if entry.get("source") == name]
    told_by_load = len(wanted) == 1 and name not in hooks
    frames: list[DataFrame] = []
    if mode == "stream":
        _run_streams(spark, config, extraction, wanted, steps)
        return

    def extract() -> int:
        rows = read_source(spark, kind, extraction.get("config"), extraction.get("query"), extraction.get("params"))
        if len(wanted) > 1 and (extraction.get("query") or str(kind).lower() in DATABASES):
            # Several loads must see the same rows, and a query or a database is worked through once.
            rows = stage(rows, "extract")
        found = 0 if told_by_load else rows.count()
        frames.append(hooks[name](rows) if name in hooks else rows)
        return found

    extracted = steps.run("extract", name, kind, None, extract)
    for entry in wanted:
        label, table = entry.get("name", "unnamed"), entry.get("table")
        if not frames:
            steps.skip("load", label, name, table, "the extraction failed")
            continue
        outcome = steps.run("load", label, name, table, lambda e=entry: _load_one(config, mode, extraction, e, frames[0]))
        if told_by_load:
            extracted["rows"] = outcome["rows"] if outcome["status"] == DONE else _counted(spark, extraction)


def _run_streams(spark, config, extraction, wanted, steps) -> None:
    """Load the new files of an extraction into each of its targets; the extraction's rows are those of its first load.

    A load needs a ``checkpoint`` and a unique ``key`` in its config.
    """
    name, kind = extraction.get("name", "unnamed"), extraction.get("source")
    settings = extraction.get("config") or {}
    schemas: list[Any] = []

    def look() -> int:
        if str(kind).lower() != "parquet" or extraction.get("query"):
            raise ValueError("a stream reads new files of a parquet source, without a query")
        schemas.append(settings.get("schema") or spark.read.parquet(settings["path"]).schema)
        return 0

    extracted = steps.run("extract", name, kind, None, look)

    def loaded(entry) -> int:
        own = entry.get("config") or {}
        for needed in ("checkpoint", "key"):
            if not own.get(needed):
                raise ValueError(f"a streamed load needs {needed!r} in its config")
        label = entry.get("name", "unnamed")
        control = ControlTable(spark, _control_path(spark, config))
        before = _stream_rows(control, label)
        stream_load(
            spark, settings["path"], schemas[0], entry.get("target"), entry["table"], own["checkpoint"], control,
            target_names(own, "key"), own, name=label,
        )
        return _stream_rows(control, label) - before

    for number, entry in enumerate(wanted):
        if not schemas:
            steps.skip("load", entry.get("name", "unnamed"), name, entry.get("table"), "the extraction failed")
            continue
        outcome = steps.run("load", entry.get("name", "unnamed"), name, entry.get("table"), lambda e=entry: loaded(e))
        if number == 0:
            extracted["rows"] = outcome["rows"]


def _stream_rows(control: ControlTable, name: str) -> int:
    own = control.current().filter((F.col("extraction_name") == name) & (F.col("status") == OK))
    return own.agg(F.coalesce(F.sum("rows_loaded"), F.lit(0))).first()[0]


def _control_path(spark, config) -> str:
    return config.get("control_path") or f"{shared_folder(spark)}/tablelift/control"


def _counted(spark, extraction) -> int:
    """Rows of a source whose load failed; 0 if the source cannot be read either."""
    query, params = extraction.get("query"), extraction.get("params")
    try:
        return row_count(spark, extraction.get("source"), extraction.get("config"), query, params)
    except Exception:
        return 0


def _load_one(config, mode, extraction, entry, rows: DataFrame) -> int:
    if mode == "chunked":
        return _load_chunked(config, extraction, entry, rows)
    return load(rows, entry.get("target"), entry["table"], entry.get("config"), entry.get("mode", "insert"))


def _load_chunked(config, extraction, entry, rows: DataFrame) -> int:
    spark, settings = rows.sparkSession, entry.get("config") or {}
    key = target_names(settings, "chunk_key")
    if not key:
        raise ValueError("a chunked load needs a unique 'chunk_key' in its config")
    size = as_size((extraction.get("config") or {}).get("batch_size", 100_000), "batch_size")
    more = {n: as_size(settings[n], n) for n in ("waves", "commit_rows") if settings.get(n)}
    # A query or a database is worked out once; plain files are read wave by wave unless told otherwise.
    dear = bool(extraction.get("query")) or str(extraction.get("source")).lower() in DATABASES
    more["staged"] = as_bool(settings.get("staged", dear))
    done = copy_in_chunks(
        rows, entry.get("name", "unnamed"), entry["table"], key, size,
        ControlTable(spark, _control_path(spark, config)), entry.get("target"), settings, **more,
    )
    return done.rows


def problems(spark: SparkSession, config: Mapping[str, Any]) -> DataFrame:
    """The configuration's problems as rows, before anything runs.

    Besides what :func:`check_config` finds in the text, the headers of each extraction are looked up, and keys that a load names but would
    not have are told, as are headers that do not fit together. No rows are read.
    """
    found = check_config(config, supported_sources(), supported_targets())
    bad = {name for name, _ in found}
    extractions = {e.get("name", "unnamed"): e for e in config.get("extractions") or []}
    hooked = as_bool((config.get("transformations") or {}).get("enabled", False))  # a hook may change the headers
    for name, extraction in extractions.items():
        loads = [entry for entry in config.get("loads") or [] if entry.get("source") == name]
        if name in bad or hooked or not loads:
            continue
        try:
            rows = read_source(spark, extraction.get("source"), extraction.get("config"), extraction.get("query"), extraction.get("params"))
        except Exception as error:
            found.append((name, f"the source cannot be read: {type(error).__name__}"))
            continue
        for entry in loads:
            settings, label = entry.get("config") or {}, entry.get("name", "unnamed")
            try:
                columns = shape_for_load(rows, settings).columns
            except ValueError as error:
                found.append((label, str(error)))
                continue
            for setting in ("keys", "latest_by", "chunk_key", "key"):
                unknown = [n for n in target_names(settings, setting) if n not in columns]
                if unknown:
                    found.append((label, f"{setting}: no column {', '.join(unknown)}"))
    return spark.createDataFrame(found, "name string, problem string")


def run_summary(steps: DataFrame) -> DataFrame:
    """One row for a whole run: its status, seconds, and rows extracted and loaded."""
    failed = F.sum((F.col("status") == FAILED).cast("bigint"))
    good = F.sum((F.col("status") == DONE).cast("bigint"))
    status = F.when(failed == 0, "completed").when(good == 0, "failed").otherwise("partial")
    return steps.agg(
        status.alias("status"),
        F.count(F.lit(1)).alias("steps"),
        failed.alias("failed_steps"),
        F.sum(F.when(F.col("step") == "extract", F.col("rows")).otherwise(0)).alias("rows_extracted"),
        F.sum(F.when(F.col("step") == "load", F.col("rows")).otherwise(0)).alias("rows_loaded"),
        F.sum("seconds").alias("seconds"),
    )
