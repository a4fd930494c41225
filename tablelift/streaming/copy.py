"""Copying a folder of files as a stream of micro-batches.

The checkpoint remembers which files are done, so every file is read once however often the copy is
broken off and started again. The last batch before a failure may be repeated; its rows are still in
the target exactly once. :func:`stream_copy` gives each batch a folder of its own, which a repeated
batch fills again. :func:`stream_load` writes to any target and knows its rows by a key.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource

from tablelift.operators.control import OK, STARTED, ControlTable
from tablelift.operators.upsert import by_key
from tablelift.sinks import counted_write, find_target, fit_to, keeps_marks, shape_for_load
from tablelift.sinks.versions import Mark

QUERY, BATCH = "copy_query", "copy_batch"
FILES_PER_BATCH = 1_000


def stream_copy(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    config: Mapping[str, Any] | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    control: ControlTable | None = None,
    name: str = "stream",
    chunk: Callable[[DataFrame], DataFrame] | None = None,
    before_write: Callable[[int], None] | None = None,
) -> int:
    """Copy all files that are new in ``source`` to ``target`` and stop; returns the number of batches.

    ``config`` takes the options of a load (``clean_names``, ``column_mapping``, ``types``). With a
    ``control`` table each batch saves its rows as one chunk, or as the chunks that ``chunk``, a
    function that adds ``chunk_number``, sees in it; :func:`stream_chunks` sums the chunks over the batches.
    ``before_write`` is called with the batch number before a batch is written. Each batch has a folder below that of
    its query, which the checkpoint names, so several sources can fill one target.
    """
    shaped = shape_for_load(_new_files(spark, source, schema, files_per_batch), config or {})

    def write(batch: DataFrame, number: int) -> None:
        if before_write:
            before_write(number)
        query = _query_id(batch.sparkSession, checkpoint)
        folder = f"{target}/{QUERY}={query}/{BATCH}={number}"
        batch.write.mode("overwrite").parquet(folder)
        if control is not None:
            written = batch.sparkSession.read.schema(batch.schema).parquet(folder)
            _save_state(control, written, name, target, query, number, chunk)

    return _run_to_end(shaped, write, checkpoint)


def stream_load(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    target: str,
    table: str,
    checkpoint: str,
    control: ControlTable,
    key: Sequence[str],
    config: Mapping[str, Any] | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    name: str = "stream",
) -> int:
    """Load all files that are new in ``source`` into a table of any target and stop; returns the batches.

    Each batch is a chunk of the control table. It is STARTED before its rows are written and OK
    afterwards; a batch that is repeated is left out if it is OK. If it only STARTED, a target that keeps marks
    tells whether it holds the batch; of others, the rows that arrived are found by their unique ``key``, null included, and not written again.
    """
    config = config or {}
    place = find_target(target)
    shaped = shape_for_load(_new_files(spark, source, schema, files_per_batch), config)

    def write(batch: DataFrame, number: int) -> None:
        session, chunk = batch.sparkSession, number + 1
        state = control.status_of(checkpoint, name, chunk)
        if state == OK:
            return
        if state is None:
            control.save_chunk(checkpoint, name, table, chunk, 0, 0, STARTED)
        there, mark = place.exists(session, config, table), Mark(f"stream {name} {checkpoint}", str(number))
        marked = keeps_marks(place)
        if marked and there and mark in place.marks(session, config, table):
            size = batch.count()  # it broke off before the state was saved
        else:
            if marked and not there:
                place.create(batch.limit(0), config, table)
            rows = batch
            if marked or there:
                rows = fit_to(batch, place.read(session, config, table), cast=not place.casts_itself)
            arrived = 0
            if there and state is not None:
                old = place.read(session, config, table)
                arrived = by_key(old, batch, key, "left_semi").count()
                rows = by_key(rows, old, key, "left_anti") if arrived else rows
            put = partial(place.append, mark=mark) if marked else place.append if there else place.create
            size = arrived + counted_write(rows, lambda batch_rows: put(batch_rows, config, table))
        control.save_chunk(checkpoint, name, table, chunk, size, size)

    return _run_to_end(shaped, write, checkpoint)


def stream_into(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    kind: type[DataSource],
    options: Mapping[str, Any],
    checkpoint: str,
    config: Mapping[str, Any] | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> int:
    """Load all files that are new in ``source`` into a Python data source and stop; returns the rows sent in this run.

    The class's stream writer gets the messages of a batch's tasks with the number of the batch in ``commit``. A batch that broke off is sent
    again under the same number, by which the writer must know it; see the tests for one that does.
    """
    spark.dataSource.register(kind)
    shaped = shape_for_load(_new_files(spark, source, schema, files_per_batch), config or {})
    query = (
        shaped.writeStream.format(kind.name())
        .options(**{k: str(v) for k, v in options.items()})
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(progress["numInputRows"] for progress in query.recentProgress)


def _new_files(spark: SparkSession, source: str, schema: T.StructType | str, files_per_batch: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)


def _run_to_end(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> int:
    """Work through everything that is there now and return the number of batches."""
    finished: list[int] = []

    def counted(batch: DataFrame, number: int) -> None:
        write(batch, number)
        finished.append(number)

    query = (
        stream.writeStream.foreachBatch(counted)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(finished)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the checkpoint gives its query."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _save_state(
    control: ControlTable, written: DataFrame, name: str, target: str, query: str, number: int, chunk
) -> None:
    """Save the chunks of one batch as a run of their own: a batch that is repeated replaces its own states only."""
    chunked = chunk(written) if chunk else written.withColumn("chunk_number", F.lit(number + 1).cast("bigint"))
    counts = chunked.groupBy("chunk_number").agg(F.count(F.lit(1)).alias("rows_loaded"))
    control.save(
        f"{query}/{number}",
        counts.select(
            F.lit(name).alias("extraction_name"),
            F.lit(target).alias("table_name"),
            "chunk_number",
            F.col("rows_loaded").alias("chunk_size"),
            "rows_loaded",
            F.lit(OK).alias("status"),
        ),
    )
    control.finish(f"{query}/{number}")


def stream_chunks(control: ControlTable, name: str = "stream") -> DataFrame:
    """``chunk_number, rows_loaded, status`` of a stream copy: the rows of each chunk over all batches."""
    own = control.current().filter((F.col("extraction_name") == name) & (F.col("status") == OK))
    return own.groupBy("chunk_number").agg(F.sum("rows_loaded").alias("rows_loaded"), F.max("status").alias("status"))


def copied_rows(spark: SparkSession, target: str) -> DataFrame:
    """The rows a stream copy has written, without the batch number."""
    return spark.read.parquet(target).drop(QUERY, BATCH)
