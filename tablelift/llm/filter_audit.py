"""Interaction of filters: what each removes at each place of every order, by contractions of contingency tensors.

Filters are judged once, on the input. Documents are counted by part and by the combination of filters they fail, which for n filters
is a tensor of 2 x 2 x ... x 2 counts for each part. Whatever an order of filters does is then a sum over that tensor: along the axis
of each filter it takes those that pass, those that fail, or all. ``contract`` takes these sums for all orders and steps by one
``einsum`` each, so the documents are read once, however many orders there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.llm.text import WORD, whole_text
from tablelift.session import stage

#: Along the axis of a filter: index 0 holds what passes it, index 1 what fails.
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
#: What is counted of each combination: documents, good ones, toxic ones.
MEASURES = ("docs", "good", "toxic")
#: Parts whose tensors are contracted together.
PARTS_AT_ONCE = 64
#: Values that keep rows without a doc_id apart in the join with labels.
SPREAD = 1024
AUDIT = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
    "good_lost bigint, toxic_lost bigint, shapley bigint"
)


def text_failures(text: Column) -> dict[str, Column]:
    """The failure conditions that look at one text only, by the filter's letter.

    A: fewer than 200 words; B: fewer than half of the words are distinct; C: more than 2 % of the code points are A-Z; D: one of
    ``#$%&*|``. An empty text fails A alone.
    """
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("bigint") > 2 * F.length(text).cast("bigint"),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, code, docs, good, toxic``: documents by the filters they fail; filter A is the highest bit of ``code``, E the lowest.

    E fails a text that a smaller ``doc_id`` has too, told by SHA-256. The rows that leave the reading task hold the digest and four
    bits, not the text; equal rows are folded there. Rows of one text meet only as counts or by ``doc_id``, so copies do not meet in one task.
    """
    text = whole_text()
    code = sum(((fails).cast("int") * (1 << (4 - k)) for k, fails in enumerate(text_failures(text).values())), F.lit(0))
    digest = F.unhex(F.sha2(text, 256)).alias("digest")
    judged = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), digest, code.alias("code"))
    judged = judged.groupBy("doc_id", "part", "digest", "code").agg(F.count(F.lit(1)).alias("n"))
    judged = stage(judged, "judged")
    first = judged.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    rated = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(SPREAD))).otherwise(F.lit(0))
    rows = judged.withColumn("spread", spread).join(rated.withColumn("spread", F.lit(0).cast("bigint")), ["doc_id", "spread"], "left")
    rows = rows.join(first, ["digest", "doc_id"], "left")
    # A row without a doc_id follows nothing, and nothing follows it.
    again = F.col("is_first").isNull() & F.col("doc_id").isNotNull()
    n = F.col("n")
    return rows.groupBy("part", (F.col("code") + again.cast("int")).alias("code")).agg(
        F.sum(n).alias("docs"),
        F.sum(n * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(n * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def choices(filters: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Orders, the filter of each of their steps, and for each step what is kept and removed along each axis."""
    orders = ["".join(p) for p in permutations(filters)]
    own = np.array([[filters.index(f) for f in order] for order in orders]).ravel()
    kept = np.empty((len(own), len(filters), 2), np.int64)
    kept[:] = ALL
    removed = kept.copy()
    for row in range(len(own)):
        first = row - row % len(filters)
        kept[row, own[first : row + 1]] = PASS
        removed[row, own[first:row]] = PASS
        removed[row, own[row]] = FAIL
    return orders, own, kept, removed


def contract(tensor: np.ndarray, along: np.ndarray) -> np.ndarray:
    """Sums over a tensor ``(parts, measures, 2, ..., 2)`` for each row of ``along`` (rows, filters, 2): (parts, rows, measures)."""
    axes = "abcdefghijkl"[: along.shape[1]]
    spelled = f"pm{axes}," + ",".join(f"r{a}" for a in axes) + "->prm"
    return np.einsum(spelled, tensor, *np.moveaxis(along, 1, 0), optimize=True)


def interactions(counts: DataFrame, filters: str) -> DataFrame:
    """One row for each part, order of ``filters`` and step, in the columns of ``AUDIT``.

    ``counts`` has ``part, code, docs, good, toxic``. ``shapley`` is what the step's filter removes, summed over all orders at any step.
    A part's combinations are at most ``2 ** len(filters)`` rows; parts are handled by as many tasks as Spark deals them to.
    """
    orders, own, kept, removed = choices(filters)
    n, steps = len(filters), len(own)
    alone, failing = (np.empty((n, n, 2), np.int64) for _ in range(2))
    alone[:], failing[:] = PASS, ALL
    alone[np.arange(n), np.arange(n)] = failing[np.arange(n), np.arange(n)] = FAIL

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PARTS_AT_ONCE):
                few = batch.slice(at, PARTS_AT_ONCE)
                tensor = np.zeros((few.num_rows, len(MEASURES), 1 << n), np.int64)
                for p, cells in enumerate(few.column(1).to_pylist()):
                    for cell in cells:
                        tensor[p, :, cell["code"]] = [cell[m] for m in MEASURES]
                tensor = tensor.reshape(few.num_rows, len(MEASURES), *[2] * n)
                stays, goes = contract(tensor, kept)[:, :, 0], contract(tensor, removed)
                fails, only = (contract(tensor, along)[:, :, 0][:, own] for along in (failing, alone))
                of_filter = np.stack([goes[:, own == f, 0].sum(axis=1) for f in range(n)], axis=1)[:, own]
                columns = [stays, goes[:, :, 0], fails - goes[:, :, 0], only, goes[:, :, 1], goes[:, :, 2], of_filter]
                parts = few.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p for p in parts for _ in range(steps)], pa.string()),
                        pa.array([o for o in orders for _ in range(n)] * len(parts), pa.string()),
                        pa.array(np.tile(np.arange(steps) % n + 1, len(parts)).astype(np.int32)),
                        *[pa.array(np.ascontiguousarray(c).ravel()) for c in columns],
                    ],
                    names=[c.split()[0] for c in AUDIT.split(", ")],
                )

    cells = F.collect_list(F.struct("code", *MEASURES)).alias("cells")
    return counts.groupBy("part").agg(cells).mapInArrow(run, AUDIT)


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What filters A to E do to ``docs`` in each of their 120 orders: one row for each part, order and step.

    ``docs`` has ``doc_id, text, source`` and ``labels`` has ``doc_id, quality, toxic``; other columns are ignored. A part is a value of
    ``source``, null counting as the empty string; a null text counts as empty. A row without a ``doc_id`` never fails E, makes no other
    fail it, and has no label; rows of one ``doc_id`` and text do not fail E for one another. A document is good or toxic if any label row
    of its ``doc_id`` says so; null labels say nothing. An empty table gives an empty result.
    """
    return interactions(failure_counts(docs, labels), "ABCDE")


AUDIT_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
rated AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
judged AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS code
    FROM texts LEFT JOIN rated USING (doc_id)
),
counts AS (
    SELECT part, code, count(*) AS docs, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, code
),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(letter, bit)),
orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
),
steps AS (
    SELECT filter_order, step, bits[step] AS own, list_sum(bits[1:step]) - bits[step] AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
),
sums AS (
    SELECT part, filter_order, step, own,
           sum(CASE WHEN code & (before + own) = 0 THEN docs ELSE 0 END) AS kept,
           sum(CASE WHEN code & before = 0 AND code & own <> 0 THEN docs ELSE 0 END) AS removed,
           sum(CASE WHEN code & before <> 0 AND code & own <> 0 THEN docs ELSE 0 END) AS redundant,
           sum(CASE WHEN code = own THEN docs ELSE 0 END) AS unique_fails,
           sum(CASE WHEN code & before = 0 AND code & own <> 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN code & before = 0 AND code & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM counts, steps
    GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM sums
"""
