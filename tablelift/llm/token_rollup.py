"""Token totals by source, language and tokenizer version, kept by signed changes.

A batch of changes becomes one small table of signed totals, a row for each key, in a folder named after the batch. The folder is the
commit: a batch that was written completely is not written again, and one that was not counts for nothing and is replaced when it is
sent again. Totals are the sums over the committed batches, so nothing is read but what has changed; ``compact`` folds old
batches into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "version"]
SCHEMA = "source string, lang string, version string, docs bigint, tokens bigint"
BATCH = "batch="


class TokenRollup:
    """Totals in ``folder``, which all executors can reach. One writer at a time."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self):
        return self._path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def committed(self) -> list[str]:
        """The names of the batches that count, folded ones included."""
        found = set()
        for name in self._live():
            found.add(name)
            folds = f"{self.folder}/_folds/{name}"
            if self._files().exists(self._path(folds)):
                found |= {r.value for r in self.spark.read.text(folds).collect()}
        return sorted(found)

    def _has(self, name: str, mark: str) -> bool:
        return self._files().exists(self._path(f"{self.folder}/{BATCH}{name}/{mark}"))

    def _live(self) -> list[str]:
        files, top = self._files(), self._path(self.folder)
        if not files.exists(top):
            return []
        names = [e.getPath().getName() for e in files.listStatus(top)]
        return sorted(n.removeprefix(BATCH) for n in names if n.startswith(BATCH) and self._has(n.removeprefix(BATCH), "_SUCCESS"))

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit a batch of changes; False if a batch of that name is committed already.

        ``changes`` has ``change``, the keys ``source, lang, version`` and ``tokens``, and for ``revise`` also ``old_tokens``. An ``insert`` adds
        a document, a ``delete`` takes one away, a ``revise`` adds ``tokens - old_tokens``; other changes are an error. A null count
        is 0, and null keys are a group of their own. Repeated rows count each. A key whose sums are all 0 is not
        stored.
        """
        if not batch or set(batch) & set("/= "):
            raise ValueError("a batch needs a name without blanks, slashes and equal signs")
        if batch in self.committed():
            return False
        if "old_tokens" not in changes.columns:
            changes = changes.withColumn("old_tokens", F.lit(None).cast("bigint"))
        new, old = (F.coalesce(F.col(c).cast("bigint"), F.lit(0)) for c in ("tokens", "old_tokens"))
        kind = F.col("change")
        wrong = F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(kind, F.lit("null"))))
        docs = F.when(kind == "insert", 1).when(kind == "delete", -1).when(kind == "revise", 0).otherwise(wrong.cast("int"))
        tokens = F.when(kind == "insert", new).when(kind == "delete", -new).when(kind == "revise", new - old)
        sums = changes.groupBy(*[F.col(k).cast("string").alias(k) for k in KEYS]).agg(
            F.sum(docs).cast("bigint").alias("docs"), F.sum(tokens).alias("tokens")
        )
        self._write(batch, sums)
        return True

    def _write(self, batch: str, sums: DataFrame) -> None:
        full = sums.where("docs <> 0 or tokens <> 0").select(*KEYS, "docs", "tokens")
        full.write.mode("overwrite").parquet(f"{self.folder}/{BATCH}{batch}")

    def totals(self) -> DataFrame:
        """``source, lang, version, docs, tokens`` over all committed batches, without keys whose sums are 0."""
        return self._sum(self._live())

    def _sum(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], SCHEMA)
        stored = self.spark.read.schema(SCHEMA).parquet(*[f"{self.folder}/{BATCH}{n}" for n in names])
        sums = stored.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 or tokens <> 0")

    def compact(self, name: str) -> None:
        """Start a rollup's next folder, ``<folder>-<name>``, with all totals as one batch that remembers the names of those it folds.

        This object goes on with the new folder; the old one is left as it is.
        """
        names = self.committed()
        after = TokenRollup(self.spark, f"{self.folder}-{name}")
        remembered = self.spark.createDataFrame([(n,) for n in names], "value string")
        remembered.coalesce(1).write.mode("overwrite").text(f"{after.folder}/_folds/{name}")
        self.totals().write.mode("overwrite").parquet(f"{after.folder}/{BATCH}{name}")  # its end is the commit
        self.folder = after.folder


def count_changes(before: DataFrame, after: DataFrame, key: str = "doc_id") -> DataFrame:
    """The changes that lead from one counted table to another (``key, source, lang, version, tokens``).

    Rows only in ``after`` are inserts, rows only in ``before`` deletes; a new count under the same keys is a revision, and a document that moves to
    other keys is a delete and an insert. Documents are matched by ``key`` and must be unique in each table.
    """
    b, a = before.alias("b"), after.alias("a")
    joined = b.join(a, F.col(f"b.{key}") == F.col(f"a.{key}"), "full")
    here, there = F.col(f"b.{key}").isNotNull(), F.col(f"a.{key}").isNotNull()
    same = F.lit(True)
    for k in KEYS:
        same = same & F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}"))
    none = F.lit(None).cast("bigint")

    def row(kind, side, tokens, old):
        return F.struct(F.lit(kind).alias("change"), *[F.col(f"{side}.{k}").alias(k) for k in KEYS], tokens.alias("tokens"), old.alias("old_tokens"))

    out = F.col("b.tokens").cast("bigint")
    new = F.col("a.tokens").cast("bigint")
    changes = (
        F.when(here & there & same & new.eqNullSafe(out), F.array())
        .when(here & there & same, F.array(row("revise", "a", new, out)))
        .when(here & there, F.array(row("delete", "b", out, none), row("insert", "a", new, none)))
        .when(there, F.array(row("insert", "a", new, none)))
        .otherwise(F.array(row("delete", "b", out, none)))
    )
    return joined.select(F.explode(changes).alias("c")).select("c.*")
