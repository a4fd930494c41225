"""The control table: one row per run, extraction and chunk, with its state.

Rows are only ever appended; :func:`current_status` folds the history to one row per chunk. Saving
the state of chunks so costs one small file instead of rewriting the table, and a writer that dies
half-way leaves the earlier states readable. A copy saves its waves as ranges of chunks, one line each without a
Spark job; the files of a run are folded as they grow, and closed runs are moved to an archive.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.session import Folder, make_folder

OK, ERROR, STARTED = "OK", "ERROR", "STARTED"
CHUNK_KEY = ["run_id", "extraction_name", "chunk_number"]
# The columns of the control table, with the run and the chunk size besides.
CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("extraction_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("chunk_number", T.LongType()),
        T.StructField("chunk_size", T.LongType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)


def upsert_control(control: DataFrame, changes: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Set new chunk states: a known chunk takes rows, state and time and keeps ``created_at`` and its table.

    ``changes`` has the control columns, one row per chunk.
    """
    keys = keys or CHUNK_KEY
    columns = control.columns
    old, new = control.alias("old"), changes.alias("new")
    joined = old.join(new, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys], "full_outer")
    kept = [*keys, "table_name", "created_at"]

    def chosen(name: str):
        first, second = ("old", "new") if name in kept else ("new", "old")
        return F.coalesce(F.col(f"{first}.{name}"), F.col(f"{second}.{name}")).alias(name)

    return joined.select(*[chosen(name) for name in columns])


def current_status(history: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per chunk from all states ever saved: the latest, with the first ``created_at`` and table."""
    keys = keys or CHUNK_KEY
    latest = [c for c in history.columns if c not in {*keys, "table_name", "created_at"}]
    folded = history.groupBy(*keys).agg(
        F.min_by("table_name", "updated_at").alias("table_name"),
        F.min("created_at").alias("created_at"),
        F.max_by(F.struct(*latest), F.struct(F.col("updated_at"), F.col("status") == OK)).alias("_latest"),
    )
    return folded.select(
        *[F.col(f"_latest.{c}").alias(c) if c in latest else F.col(c) for c in history.columns]
    )


def latest_run(control: DataFrame, extraction: str) -> DataFrame:
    """The chunks of an extraction's run that was started last."""
    own = control.filter(F.col("extraction_name") == extraction)
    started = own.groupBy("run_id").agg(F.min("created_at").alias("_started"))
    latest = started.agg(F.max_by("run_id", F.struct("_started", "run_id")).alias("run_id"))
    return own.join(latest, "run_id", "left_semi")


def last_chunk(control: DataFrame, extraction: str | None = None) -> DataFrame:
    """The highest chunk in state OK (0 if there is none): of one extraction, or one row for each."""
    finished = F.coalesce(F.max(F.when(F.col("status") == OK, F.col("chunk_number"))), F.lit(0).cast("bigint"))
    if extraction is None:
        return control.groupBy("extraction_name").agg(finished.alias("last_chunk"))
    return control.filter(F.col("extraction_name") == extraction).agg(finished.alias("last_chunk"))


def remaining_chunks(plan: DataFrame, control: DataFrame) -> DataFrame:
    """Planned chunks without an OK state, gaps included."""
    done = control.filter(F.col("status") == OK).select("chunk_number")
    return plan.join(done, "chunk_number", "left_anti")


# A state of neighbouring chunks; ``rows`` are those of a single chunk, null where they follow from the sizes.
RANGE_SCHEMA = (
    "run_id string, extraction_name string, table_name string, first_chunk long, last_chunk long, chunk_size long, "
    "total_rows long, rows long, status string, at long"
)
# Files of one run after which they are folded, and closed runs after which they are archived.
FOLD_AT, ARCHIVE_AT = 100, 100
LATEST, CLOSED, ARCHIVE, COVERED = "_latest", "_closed", "archive-", "_covered-"


def as_states(ranges: DataFrame) -> DataFrame:
    """Ranges of chunks as control rows; only the last chunk of a table is not full, and only finished chunks have rows."""
    left = F.col("total_rows") - (F.col("chunk_number") - 1) * F.col("chunk_size")
    full = F.greatest(F.least(F.col("chunk_size"), left), F.lit(0).cast("bigint"))
    at = F.timestamp_micros("at")
    values = {
        "rows_loaded": F.coalesce("rows", F.when(F.col("status") == OK, full).otherwise(0)), "created_at": at, "updated_at": at,
    }
    each = ranges.withColumn("chunk_number", F.explode(F.sequence("first_chunk", "last_chunk"))).withColumns(values)
    return each.select(*[F.col(f.name).cast(f.dataType) for f in CONTROL_SCHEMA.fields])


def folded(ranges: list[dict]) -> list[dict]:
    """Of each range of chunks its first state, its last one, and when it was started last."""
    kept: dict[tuple, dict[str, dict]] = {}
    for state in sorted(ranges, key=lambda r: (r["at"], r["status"] == OK)):
        own = kept.setdefault((state["run_id"], state["extraction_name"], state["first_chunk"], state["last_chunk"]), {})
        own.setdefault("first", state)
        own["last"] = state
        if state["status"] == STARTED:
            own["started"] = state
    out = []
    for own in kept.values():
        out += [state for k, state in enumerate(own.values()) if state not in list(own.values())[:k]]
    return out


class ControlTable:
    """Control rows kept as files below a folder.

    Every save writes a file of its own below the folder of its run, so that jobs which save at the same time do not
    meet, and the states of one run are found without listing those of others. A note for each extraction names its latest run.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        make_folder(spark, self.path)
        self.files = Folder(spark, self.path)
        self._saved: dict[str, int] = {}

    @staticmethod
    def _hashed(name: str) -> str:
        return hashlib.md5(name.encode(), usedforsecurity=False).hexdigest()

    def _run(self, run_id: str) -> str:
        """The name of a run's folder."""
        return f"run={self._hashed(run_id)}"

    # -- reading

    def _read(self, *folders: str) -> DataFrame:
        reader = self.spark.read.option("recursiveFileLookup", "true")
        rows = reader.schema(CONTROL_SCHEMA).option("pathGlobFilter", "*.parquet").parquet(*folders)
        ranges = reader.schema(RANGE_SCHEMA).option("pathGlobFilter", "*.json").json(list(folders))
        return rows.unionByName(as_states(ranges))

    def history(self) -> DataFrame:
        return self._read(self.path)

    def current(self) -> DataFrame:
        return current_status(self.history())

    def of_run(self, run_id: str, extraction: str) -> DataFrame:
        """The chunks of one run; only its folder is read, or the archive, and the filter reaches the scan."""
        names = [self._run(run_id)]
        if not self.files.exists(names[0]):
            names = [name for name in self.files.names() if name.startswith(ARCHIVE)]
        if not names:  # a run that has not begun
            names = [self._run(run_id)]
            make_folder(self.spark, f"{self.path}/{names[0]}")
        own = current_status(self._read(*[f"{self.path}/{name}" for name in names]))
        return own.filter((F.col("run_id") == run_id) & (F.col("extraction_name") == extraction))

    def status_of(self, run_id: str, extraction: str, chunk: int) -> str | None:
        """The state of one chunk, or None if it was never seen."""
        found = self.of_run(run_id, extraction).filter(F.col("chunk_number") == chunk).first()
        return found["status"] if found else None

    def last_chunk(self, extraction: str) -> int:
        """The highest chunk in state OK of the extraction's latest run; 0 if there is none."""
        return last_chunk(latest_run(self.current(), extraction), extraction).first()[0]

    # -- saving

    def save(self, run_id: str, chunks: DataFrame) -> None:
        """Append states of one run: ``chunks`` has the control columns but ``run_id`` and the two times."""
        now = F.current_timestamp()
        stamped = chunks.withColumns({"run_id": F.lit(run_id), "created_at": now, "updated_at": now})
        fitted = stamped.select(*[F.col(f.name).cast(f.dataType) for f in CONTROL_SCHEMA.fields])
        fitted.write.parquet(f"{self.path}/{self._run(run_id)}/{uuid.uuid4().hex}")

    def save_range(
        self, run_id: str, extraction: str, table: str, first: int, last: int, size: int, total: int, status: str = OK,
        rows: int | None = None,
    ) -> None:
        """Append one state for the chunks ``first`` to ``last`` of a table of ``total`` rows."""
        self.save_ranges(run_id, extraction, table, [(first, last)], size, total, status, rows)

    def save_ranges(
        self, run_id: str, extraction: str, table: str, ranges: list[tuple[int, int]], size: int, total: int, status: str = OK,
        rows: int | None = None,
    ) -> None:
        """Append one state, in one file, for each of several ranges of chunks."""
        at = time.time_ns() // 1000
        states = [
            {
                "run_id": run_id, "extraction_name": extraction, "table_name": table, "first_chunk": first, "last_chunk": last,
                "chunk_size": size, "total_rows": total, "rows": rows, "status": status, "at": at,
            }
            for first, last in ranges
        ]
        folder = self._run(run_id)
        self.files.put(f"{folder}/{at:020d}-{uuid.uuid4().hex}.json", "\n".join(map(json.dumps, states)))
        if folder not in self._saved:
            self._saved[folder] = len(self.files.names(folder))
        self._saved[folder] += 1
        if self._saved[folder] >= FOLD_AT:
            self._saved[folder] = self._fold(folder)

    def save_chunk(
        self, run_id: str, extraction: str, table: str, chunk: int, size: int, rows: int, status: str = OK
    ) -> None:
        self.save_range(run_id, extraction, table, chunk, chunk, size, rows, status, rows)

    def _fold(self, folder: str) -> int:
        """Put the states of a run into one file; returns how many files count as new from now on.

        The files that it covers stay until the next time, for readers that have listed them.
        """
        for note in [n for n in self.files.names(folder) if n.startswith(COVERED)]:
            for name in [*self.files.text(f"{folder}/{note}").split(), note]:
                self.files.delete(f"{folder}/{name}")
        states, covered = [], []
        for name in [n for n in self.files.names(folder) if n.endswith(".json")]:
            try:
                found = [json.loads(line) for line in self.files.text(f"{folder}/{name}").splitlines()]
            except ValueError:  # another job is writing it
                continue
            states += found
            covered.append(name)
        self.files.put(f"{folder}/{time.time_ns() // 1000:020d}-{uuid.uuid4().hex}.json", "\n".join(map(json.dumps, folded(states))))
        self.files.put(f"{folder}/{COVERED}{uuid.uuid4().hex}", "\n".join(covered))
        return 1

    # -- runs

    def begin(self, run_id: str, extraction: str, size: int, chunks: int, staged: str | None = None) -> None:
        """Note that this is the extraction's latest run, and where its rows are ``staged``."""
        make_folder(self.spark, f"{self.path}/{self._run(run_id)}")
        self.files.put(f"{LATEST}/{self._hashed(extraction)}", json.dumps({"run_id": run_id, "size": size, "chunks": chunks, "staged": staged}))

    def latest(self, extraction: str) -> dict | None:
        """``run_id, size, chunks, staged`` of the extraction's latest run and whether it is ``closed``; None if there is no note of it."""
        note = f"{LATEST}/{self._hashed(extraction)}"
        if not self.files.exists(note):
            return None
        found = json.loads(self.files.text(note))
        folder = self._run(found["run_id"])
        gone = not self.files.exists(folder)  # only closed runs are archived
        return found | {"closed": gone or self.files.exists(f"{folder}/{CLOSED}")}

    def finish(self, run_id: str) -> None:
        """Close a run. From time to time closed runs are moved to the archive."""
        self.files.put(f"{self._run(run_id)}/{CLOSED}", "")
        if sum(name.startswith("run=") for name in self.files.names()) >= ARCHIVE_AT:
            self.archive()

    def archive(self) -> int:
        """Put all closed runs into one table and remove their folders; returns how many.

        A state that is for a moment in both counts once. Readers that began before may have to read again.
        """
        runs = [name for name in self.files.names() if name.startswith("run=") and self.files.exists(f"{name}/{CLOSED}")]
        if runs:
            states = self._read(*[f"{self.path}/{name}" for name in runs])
            states.coalesce(1 + len(runs) // 1000).write.parquet(f"{self.path}/{ARCHIVE}{uuid.uuid4().hex}")
        for name in runs:
            self.files.delete(name, whole=True)
        return len(runs)
