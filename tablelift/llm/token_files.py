"""Token ids in Parquet files that can be read in part.

A row is a document; ``ids`` is a list of 32-bit integers, beside small columns with the document's id, place and number of tokens. Files
are ranges of ``doc_id`` in ascending order. Lists are dictionary encoded, with delta encoding where a dictionary does not pay;
metadata columns are delta encoded. Small pages and row groups, with the page index that the writer adds, let a reader fetch single documents or metadata alone.
"""

from __future__ import annotations

import zlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablelift.llm.encode import END_ID, encode_column, tokenizer_path
from tablelift.llm.text import whole_text

WRITER = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",  # delta encodings
    "parquet.block.size": str(1 << 24),
    "parquet.page.size": str(1 << 17),
    "parquet.page.row.count.limit": "1000",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 18),
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#local_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}
COLUMNS = "doc_id bigint, part int, local_start bigint, n_tokens bigint, ids array<int>"


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, end_id: int | None = END_ID, parts: int | None = None) -> None:
    """Encode every whole text and write its ids, in ascending order of ``doc_id``, to a new ``folder``.

    ``docs`` has ``doc_id`` and ``text``; a null text counts as empty. Rows of one ``doc_id`` are put in order by their text; null ids come
    first. ``parts`` is the number of files, by default the number of shuffle partitions. ``local_start`` counts the ids before a
    document in its file.
    """
    from pyspark import TaskContext

    spark, path = docs.sparkSession, path or tokenizer_path()
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for row, ids, offsets in encode_column(batch.column(1), path, end_id):
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, n),
                        pa.array(np.full(n, part, np.int32)),
                        pa.array(offsets[:-1] + at),
                        pa.array(np.diff(offsets)),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32))),
                    ],
                    names=["doc_id", "part", "local_start", "n_tokens", "ids"],
                )
                at += len(ids)

    texts = docs.select("doc_id", whole_text().alias("text"))
    dealt = texts.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(run, COLUMNS).write.options(**WRITER).parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from files of ``write_tokens``; ``start`` counts the ids of all documents before.

    Selecting columns and filtering on ``doc_id`` reads only the pages concerned. The sums of the files, one row each, are the only thing
    that a task sees whole.
    """
    stored = spark.read.schema(COLUMNS).parquet(folder)
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    sums = sums.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    joined = stored.join(F.broadcast(sums), "part")  # one row for each file
    return joined.select("doc_id", (F.col("local_start") + F.col("ahead")).alias("start"), "n_tokens", "ids")


def with_crc32(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: the checksum of the ids as little-endian unsigned 32-bit numbers."""

    def run(batches):
        for batch in batches:
            column = batch.column(3)
            content = memoryview(column.values.to_numpy().astype("<i4", copy=False)).cast("B")
            offsets = (4 * column.offsets.to_numpy().astype(np.int64)).tolist()
            sums = [zlib.crc32(content[a:b]) for a, b in pairwise(offsets)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    kinds = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, kinds)
