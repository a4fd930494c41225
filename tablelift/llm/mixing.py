"""Mixing sources to target weights by hash-random order and distributed prefix sums.

1. Every source gets a target: its weight's share of all sizes, but no more than ``most_epochs`` times its own size; what is over is
   shared again by weight among the others (``targets``).
2. Documents get a random key by hash. The key's leading digits cut each source into ranges of keys, so a source that holds most rows is
   spread over many ranges. Sizes are summed per range, then running sums over the ranges of a source, and then over
   the rows inside one range, give each document the size of all before it (``prefix_sums``).
3. A source takes all its documents as often as its target allows, and then those in front until the rest is met exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelift.llm.text import word_count
from tablelift.session import stage

#: Rows of one range of keys, about.
RANGE_ROWS = 50_000


def random_key(seed: int = 0) -> Column:
    """A random order of documents that any run, and any engine, makes alike."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def cyclic_weights(weights: tuple[int, ...] = (1, 2, 3)) -> Column:
    """Weights 1, 2, 3, repeating, by the place of the source (``place`` counts from 1)."""
    return F.get(F.array(*map(F.lit, weights)), F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int"))


def targets(sizes: DataFrame, weight: Column | None = None, most_epochs: int = 3) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row for each source.

    Sources are placed in order of code points, null last. A source is held at ``most_epochs`` times its size if its
    share would be more; sources are tried in the order in which growing shares reach that bound, which gives the same
    result as sharing the excess again and again. The windows below run over one row a source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    every = Window.partitionBy()
    placed = sizes.withColumn("place", F.row_number().over(by_name))
    placed = placed.withColumn("weight", cyclic_weights() if weight is None else weight)
    placed = placed.withColumn("bound", F.col("source_size") * most_epochs)
    reached = Window.orderBy(F.col("bound") / F.col("weight"), "place")
    before = reached.rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumns(
        {
            "held": F.coalesce(F.sum("bound").over(before), F.lit(0)),
            "open": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
            "total": F.sum("source_size").over(every),
        }
    )
    # The share of one unit of weight, if all sources before this one are held at their bounds and no other.
    summed = summed.withColumn("unit", (F.col("total") - F.col("held")) / F.col("open"))
    free = F.when(F.col("bound") >= F.col("unit") * F.col("weight"), F.col("unit"))
    summed = summed.withColumn("share", F.first(free, ignorenulls=True).over(every.orderBy(F.isnull(free), F.col("bound") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    held = F.col("share").isNull() | (F.col("bound") < F.col("share") * F.col("weight"))
    target = F.when(held, F.col("bound").cast("double")).otherwise(F.col("share") * F.col("weight"))
    return summed.select("source", "source_size", target.alias("target"))


def prefix_sums(rows: DataFrame, digits: int) -> DataFrame:
    """``rows`` (``source, key, doc_id, size``) with ``before``, the size of all rows of its source in front of it.

    The order is by key, then ``doc_id`` and size. Ranges are the first ``digits`` hexadecimal digits of the key.
    """
    ranged = rows.withColumn("range", F.substring("key", 1, digits))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("in_range"))
    over = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("in_range").over(over), F.lit(0))).drop("in_range")
    r, s = ranged.alias("r"), sums.alias("s")
    joined = r.join(s, F.col("r.source").eqNullSafe(F.col("s.source")) & (F.col("r.range") == F.col("s.range")))
    inside = Window.partitionBy("r.source", "r.range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return joined.select("r.*", before.alias("before")).drop("range")


def mix(docs: DataFrame, seed: int = 0, weight: Column | None = None, most_epochs: int = 3, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row of ``docs`` (``doc_id, source, text``).

    ``size`` is the number of words, 0 for a null or empty text. ``taken`` is how many of its words the mix takes, repeats
    counted; the document on which a source's budget ends gives only what is left of it. The taken words of a source are
    its target rounded down. A null source is one of its own, placed last. Rows that repeat a ``doc_id`` count each; the order among
    them does not change what is taken of their source. An empty table gives an empty result.
    """
    sized = stage(docs.select("doc_id", "source", word_count().alias("size"), random_key(seed).alias("key")), "sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    most = sizes.agg(F.max("rows")).first()[0] or 0
    digits = 1
    while most >> (4 * digits) > range_rows:
        digits += 1
    goals = stage(targets(sizes.select("source", "source_size"), weight, most_epochs), "targets")
    p, g = prefix_sums(sized, digits).alias("p"), goals.alias("g")
    joined = p.join(g, F.col("p.source").eqNullSafe(F.col("g.source")))
    budget = F.floor("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size")).cast("bigint")).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size") - F.col("before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return joined.select("doc_id", "p.source", "size", "source_size", "target", taken.cast("bigint").alias("taken"))


#: The same rows in SQL, for weights 1, 2, 3, three epochs and seed 0.
MIX_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
    FROM documents
),
summed AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
placed AS (
    SELECT *, 1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS weight, 3 * source_size AS bound
    FROM summed
),
tried AS (
    SELECT *, CAST((sum(source_size) OVER ()) - coalesce(sum(bound) OVER before, 0) AS DOUBLE)
              / CAST((sum(weight) OVER ()) - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS unit
    FROM placed
    WINDOW before AS (ORDER BY bound / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
shared AS (
    SELECT (SELECT unit FROM tried WHERE bound >= unit * weight ORDER BY bound / weight, source IS NULL, source LIMIT 1)
           AS share
),
goals AS (
    SELECT source, source_size,
           CASE WHEN share IS NULL OR bound < share * weight THEN CAST(bound AS DOUBLE) ELSE share * weight END AS target
    FROM placed, shared
),
ordered AS (
    SELECT s.doc_id, s.size, g.source_size, g.target, CAST(floor(g.target) AS BIGINT) AS budget,
           CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
    FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
),
turns AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM ordered)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM turns
"""
