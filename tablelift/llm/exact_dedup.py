"""Exact duplicates by an extendible-hash index on shared files. Built from DataFrame operations only.

The key of a text is a 64-bit hash of its normalised form. A directory of ``2^depth`` slots points to buckets: a bucket
that holds too many entries is split by one more bit of the key, which doubles the directory as far as needed
(``directory``). An owner task writes each bucket to the shared folder, entries sorted by key (``build_index``).
Groups are found before that, by grouping on key, digest and bytes; the index is written from the finished rows, and
where key and digest both clash a second grouping by the bytes tells texts apart. Copies are folded inside the tasks
that read them before anything is shuffled, so a text that a third of all rows repeat reaches its owner as one row
a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.llm.text import SPACES, only, whole_text
from tablelift.session import new_folder, stage

#: Entries of one bucket before it is split.
BUCKET_ENTRIES = 200_000
#: Bits of the directory at most: 65,536 slots. Beyond them buckets only grow.
DEEPEST = 16


def normalised(column: str | Column = "text") -> Column:
    """The text with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(whole_text(column), SPACES, " ")


def slot_of(key: Column, bits: int = DEEPEST) -> Column:
    """The leading bits of a key."""
    return F.shiftrightunsigned(key, 64 - bits).cast("int")


def directory(entries: DataFrame, capacity: int = BUCKET_ENTRIES, deepest: int = DEEPEST) -> DataFrame:
    """``slot, depth, bucket``: for each slot of ``deepest`` bits, the local depth and number of its bucket.

    A bucket is a key prefix of ``depth`` bits, the shortest with no more than ``capacity`` entries. Numbers follow the
    key order, so a run of neighbouring buckets is a range of keys. The table has at most ``2^deepest`` rows.
    """
    counts = entries.groupBy(slot_of(F.col("key"), deepest).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    levels = counts.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(deepest))))
    prefix = F.expr(f"shiftright(slot, {deepest} - depth)").alias("prefix")
    nodes = levels.groupBy("depth", prefix).agg(F.sum("n").alias("size"))
    fits = (F.col("size") <= capacity) | (F.col("depth") == deepest)
    split = nodes.where(~fits).select((F.col("depth") + 1).alias("depth"), F.explode(F.expr("array(2 * prefix, 2 * prefix + 1)")))
    split = split.select("depth", F.col("col").alias("prefix"))
    buckets = nodes.where(fits & (F.col("depth") == 0)).select("depth", "prefix")
    buckets = buckets.union(nodes.where(fits).join(split, ["depth", "prefix"], "left_semi").select("depth", "prefix"))
    first, last = (f"shiftleft(prefix + {k}, {deepest} - depth)" for k in (0, 1))
    slots = F.explode(F.expr(f"sequence({first}, {last} - 1)")).alias("slot")
    return buckets.select(slots, "depth", F.expr(first).alias("bucket"))


def build_index(entries: DataFrame, owners: int, capacity: int = BUCKET_ENTRIES, deepest: int = DEEPEST) -> DataFrame:
    """``entries`` (with ``key``) written to the shared folder, each bucket by its owner and sorted by key.

    Owners take ranges of buckets in key order. The directory that is sent to all tasks has at most ``2^deepest`` rows of
    12 bytes.
    """
    spark = entries.sparkSession
    table = stage(directory(entries, capacity, deepest), "directory")
    placed = entries.withColumn("slot", slot_of(F.col("key"), deepest)).join(F.broadcast(table), "slot").drop("slot")
    owner = F.floor(F.col("bucket").cast("bigint") * owners / (1 << deepest)).cast("int")
    folder = new_folder(spark, "hash_index")
    placed.repartitionById(owners, owner).sortWithinPartitions("bucket", "key").write.parquet(folder)
    return spark.read.parquet(folder)


def exact_duplicates(docs: DataFrame, key: Column | None = None, digest: Column | None = None, capacity: int = BUCKET_ENTRIES) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Only ``doc_id`` and ``text`` are read. Texts are equal when identical after replacing each run of white space by one
    space; null counts as empty, and empty texts are equal to each other. The smallest ``doc_id`` of a group stays
    (a null one never does, unless all are null). Rows that repeat both the ``doc_id`` and the text are all marked kept,
    as nothing tells them apart; ``group_size`` counts them all. An empty table gives an empty result.

    ``key`` and ``digest`` replace the hashes of the normalised text ``norm``; any columns will do, as texts are compared byte by byte.
    Then ``text_sha256`` is the given digest.
    """
    spark = docs.sparkSession
    owners = int(spark.conf.get("spark.sql.shuffle.partitions"))
    norm = only(docs, "doc_id", normalised().alias("norm"))
    keyed = norm.withColumn("key", F.xxhash64("norm") if key is None else key)
    keyed = keyed.withColumn("digest", F.unhex(F.sha2("norm", 256)) if digest is None else digest)
    # One row for each different text: grouping on the bytes themselves settles what is equal.
    texts = keyed.groupBy("key", "digest", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    entries = stage(texts.drop("norm"), "entries")
    index = build_index(entries, owners, capacity)
    chains = index.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("links"))
    # The bytes are needed once more only where neither key nor digest tells texts apart.
    longer = stage(chains.where("links > 1").select("key", "digest"), "chains")
    single = index.join(longer, ["key", "digest"], "left_anti")
    found = keyed.drop("norm").join(single.drop("bucket", "depth"), ["key", "digest"])
    if not longer.isEmpty():
        chained = keyed.join(longer, ["key", "digest"])
        of_text = chained.groupBy("norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        found = found.unionByName(chained.join(of_text, "norm").drop("norm"))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
