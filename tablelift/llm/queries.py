"""The registered queries of the subpackage and, where SQL can express them, the SQL with the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.llm import language_id, quality
from tablelift.llm.centroids import centroid_clusters, clusters_sql
from tablelift.llm.encode import encode, with_token_counts
from tablelift.llm.exact_dedup import exact_duplicates
from tablelift.llm.filter_audit import AUDIT_SQL, audit_filters
from tablelift.llm.fingerprints import edited_fingerprints
from tablelift.llm.mixing import MIX_SQL, mix
from tablelift.llm.ngram_join import ngram_components
from tablelift.llm.packing import cut, pack
from tablelift.llm.substring_dedup import remove_repeated
from tablelift.llm.suffix_dedup import remove_repeats
from tablelift.llm.text import whole_text, word_count
from tablelift.llm.token_files import read_tokens, with_crc32, write_tokens
from tablelift.llm.token_rollup import TokenRollup
from tablelift.session import new_folder, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``."""

    def keep(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_ngram_join")
def ngram_join_query(spark, folder):
    return ngram_components(table(spark, folder, "documents"))


@query(
    "op2_exact_dedup",
    r"""
    WITH keyed AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
    )
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
    FROM keyed
    WINDOW same AS (PARTITION BY norm)
    """,
)
def exact_dedup_query(spark, folder):
    return exact_duplicates(table(spark, folder, "documents"))


@query("op8_fingerprints")
def fingerprints_query(spark, folder):
    found = edited_fingerprints(table(spark, folder, "documents"))
    return found.withColumn("edited_text", F.sha2("edited_text", 256)).withColumnRenamed("edited_text", "edited_sha256")


def by_four(n):
    return F.floor((n + 3) / 4).cast("bigint")


def change(kind, version, tokens, old=None):
    """Columns of a batch of changes from counted documents."""
    old = F.col(old) if old else F.lit(None).cast("bigint")
    return ["source", "lang", F.lit(kind).alias("change"), F.lit(version).alias("version"), F.col(tokens).alias("tokens"), old.alias("old_tokens")]


def rolled_up(spark, counted: DataFrame, version: str, exact: str) -> DataFrame:
    """Totals after four batches: words, a first estimate of ``version``, its revision, and words of every tenth document removed; one sent twice."""
    rollup = TokenRollup(spark, new_folder(spark, "rollup"))
    revision = counted.select(*change("revise", version, exact, "rough"))
    rollup.apply("1-words", counted.select(*change("insert", "words-1", "words")))
    rollup.apply("2-rough", counted.select(*change("insert", version, "rough")))
    rollup.apply("3-revised", revision)
    rollup.apply("4-removed", counted.where("doc_id % 10 = 3").select(*change("delete", "words-1", "words")))
    rollup.apply("3-revised", revision)
    return rollup.totals()


@query("op7_token_counts")
def token_counts_query(spark, folder):
    """Token totals of all documents by source, language and version: the words, and the tokenizer's ids with the end id.

    A token for every four bytes is the tokenizer's first estimate, which the revision replaces. A null text has no words and the end id
    alone; a null ``doc_id`` is no tenth document; null sources and languages are groups of their own. No documents give no rows.
    """
    docs = table(spark, folder, "documents").select(
        "doc_id", "source", "lang", "text", word_count().alias("words"), by_four(F.octet_length(whole_text())).alias("rough")
    )
    counted = stage(with_token_counts(docs, ["doc_id", "source", "lang", "words", "rough"]), "counted")
    return rolled_up(spark, counted, "word_bpe_49k", "n_tokens")


@query(
    "token_counts_plain",
    r"""
    WITH counted AS (
        SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
               octet_length(encode(coalesce(text, ''))) AS bytes
        FROM documents
    ),
    rows AS (
        SELECT source, lang, 'words-1' AS version, words AS tokens FROM counted WHERE doc_id IS NULL OR doc_id % 10 <> 3
        UNION ALL
        SELECT source, lang, 'bytes-4' AS version, (bytes + 3) // 4 AS tokens FROM counted
    )
    SELECT source, lang, version, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens FROM rows GROUP BY ALL
    """,
)
def token_counts_plain_query(spark, folder):
    """The same rollup with counts that SQL can express: a token for every four bytes, estimated from the characters first."""
    counted = stage(
        table(spark, folder, "documents").select(
            "doc_id",
            "source",
            "lang",
            word_count().alias("words"),
            by_four(F.length(whole_text())).alias("rough"),
            by_four(F.octet_length(whole_text())).alias("fine"),
        ),
        "counted",
    )
    return rolled_up(spark, counted, "bytes-4", "fine")


@query("op3_packing")
def packing_query(spark, folder):
    pieces = cut(encode(table(spark, folder, "documents"))).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(pieces)


@query("op4_token_files")
def token_files_query(spark, folder):
    files = new_folder(spark, "token_files")
    write_tokens(table(spark, folder, "documents"), files)
    return with_crc32(read_tokens(spark, files))


@query("op5_substring_dedup")
def substring_dedup_query(spark, folder):
    found = remove_repeated(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def remainder(n: int):
    """crc32 of the doc_id as text, modulo n; -1 without a doc_id, so that such a row is learnt from and never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % n, F.lit(-1).cast("bigint"))


@query("op6_language_id")
def language_id_query(spark, folder):
    docs = table(spark, folder, "documents")
    model = language_id.learn(docs, remainder(4) != 2)
    found = language_id.predict(docs, model)
    return found.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


@query("op9_mixing", MIX_SQL)
def mixing_query(spark, folder):
    return mix(table(spark, folder, "documents")).drop("source")


@query("op10_quality")
def quality_query(spark, folder):
    stats = stage(quality.document_statistics(table(spark, folder, "documents")), "statistics")
    model = quality.learn(stats, table(spark, folder, "labels"), remainder(3) != 1)
    found = quality.score(stats, model)
    return found.select("doc_id", (remainder(3) == 1).alias("held_out"), "score", "predicted")


@query("op11_filter_audit", AUDIT_SQL)
def filter_audit_query(spark, folder):
    return audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op12_suffix_dedup")
def suffix_dedup_query(spark, folder):
    found = remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_centroid_clusters", clusters_sql())
def centroid_clusters_query(spark, folder):
    return centroid_clusters(table(spark, folder, "embeddings"))
