"""Merkle-tree fingerprints of texts. Built from DataFrame operations only.

A text is cut into pieces that end at a line end or the end of a sentence, each of at most ``LONGEST`` characters, the leaves. A section is a
line of the text; a long line is cut further after leaves whose digest says so, which keeps sections in step on both sides of an edit. All
digests are SHA-256: a leaf's of its characters, a section's of its leaves' digests, the root's of the sections'. Equal roots mean
equal texts; where roots differ, ``differing`` goes down the branches that differ. Likeness is taken from two fingerprints alone.

A fingerprint is the text ``root:section=leaf,leaf;section=leaf,...`` in hexadecimal digits, the root whole, sections and leaves cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelift.llm.text import only, whole_text

LONGEST = 64
PARAGRAPH = rf"(?s).{{1,{LONGEST}}}?(?:[.!?,;|]\s|\n|$)|.{{1,{LONGEST}}}"
#: First digits of the digests of leaves that end a section: one leaf in eight.
ENDING = ("0", "8")
#: Hexadecimal digits of a section and a leaf in a fingerprint.
SECTION_DIGITS, LEAF_DIGITS = 16, 10
#: Rows that are put in order by one task, and ranges at most (their limits go to the driver, 8 bytes each).
RANGE_ROWS, MOST_RANGES = 1000, 10_000
LEAST_ID = -(1 << 63)


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of the text column as the column ``name``."""
    pieces, leaf, ends, tree, digests = (f"{name}_{k}" for k in ("pieces", "leaves", "ends", "sections", "digests"))
    df = df.withColumn(pieces, F.regexp_extract_all(F.col(text), F.lit(PARAGRAPH), F.lit(0)))
    df = df.withColumn(leaf, F.transform(F.col(pieces), lambda p: F.sha2(p, 256)))
    number = F.filter(
        F.sequence(F.lit(1), F.size(leaf)),
        lambda k: (k == F.size(leaf)) | F.substring(F.get(F.col(leaf), k - 1), 1, 1).isin(*ENDING) | F.endswith(F.get(F.col(pieces), k - 1), F.lit("\n")),
    )
    df = df.withColumn(ends, F.when(F.size(leaf) > 0, number).otherwise(F.array().cast("array<int>")))

    def own(end, k):
        start = F.when(k == 0, F.lit(1)).otherwise(F.get(F.col(ends), k - 1) + 1)
        return F.slice(F.col(leaf), start, end - start + 1)

    df = df.withColumn(tree, F.transform(F.col(ends), own))
    df = df.withColumn(digests, F.transform(F.col(tree), lambda s: F.sha2(F.array_join(s, ","), 256)))
    written = F.zip_with(
        F.col(digests), F.col(tree),
        lambda d, s: F.concat(
            F.substring(d, 1, SECTION_DIGITS), F.lit("="), F.array_join(F.transform(s, lambda x: F.substring(x, 1, LEAF_DIGITS)), ",")
        ),
    )
    root = F.sha2(F.array_join(F.col(digests), ","), 256)
    whole = F.concat(root, F.lit(":"), F.array_join(written, ";"))
    return df.withColumn(name, whole).drop(pieces, leaf, ends, tree, digests)


def leaves_of(fingerprint: Column) -> Column:
    """The different leaves that a fingerprint tells."""
    told = F.regexp_replace(F.element_at(F.split(fingerprint, ":"), 2), "[0-9a-f]*=", "")
    return F.array_distinct(F.filter(F.split(told, "[,;]"), lambda x: x != ""))


def likeness(a: Column, b: Column) -> Column:
    """Of two fingerprints: twice the leaves in both, over the number in each; 1 if both have none."""
    one, two = leaves_of(a), leaves_of(b)
    total = F.size(one) + F.size(two)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(one, two)) / total)


def differing(a: Column, b: Column) -> Column:
    """The paragraphs of fingerprint ``a`` under sections that ``b`` lacks, as ``[section digest, paragraph digest]``.

    Nothing if the roots agree; paragraphs that ``b`` has under another section are left out.
    """
    sections = lambda f: F.filter(F.split(F.element_at(F.split(f, ":"), 2), ";"), lambda s: s != "")
    paragraphs = lambda s: F.split(F.element_at(F.split(s, "="), 2), ",")
    own, other = F.array_except(sections(a), sections(b)), F.array_except(sections(b), sections(a))
    known = F.flatten(F.transform(other, paragraphs))
    found = F.transform(
        own,
        lambda s: F.transform(
            F.filter(paragraphs(s), lambda p: ~F.array_contains(known, p)),
            lambda p: F.array(F.element_at(F.split(s, "="), 1), p),
        ),
    )
    return F.flatten(found)


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n_chars, fingerprint`` for every row; a null text counts as empty."""
    own = docs.select("doc_id", whole_text().alias("text"))
    return with_fingerprint(own.withColumn("n_chars", F.length("text").cast("bigint")), "text", "fingerprint")


def position(value: Column, limits: list[int]) -> Column:
    """How many of the ascending ``limits`` are below the value, by binary search."""
    steps, step = [], 1
    while step <= len(limits):
        steps.insert(0, step)
        step *= 2
    table = F.array(*map(F.lit, limits)).cast("array<bigint>")

    def move(at, step):
        there = at + step
        return F.when((there <= len(limits)) & (F.get(table, there - 1) < value), there).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), move)


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """Rows in ranges of ``doc_id``, with a window that runs through each range in ascending order.

    The row before a range's first, which is the last of the range below, is in the range too, marked ``guest``; the range of
    the smallest ids has the row with the greatest instead. So one shuffle gives each row its neighbour, and no task gets more
    than its range. Ids that repeat are put in order by the hash of their text; a null id counts as the smallest.
    """
    keyed = docs.withColumn("order_id", F.coalesce("doc_id", F.lit(LEAST_ID)))
    rows = keyed.agg(F.count(F.lit(1))).first()[0]
    ranges = min(MOST_RANGES, max(1, rows // RANGE_ROWS))
    shares = [k / ranges for k in range(1, ranges + 1)]
    found = keyed.agg(F.percentile_approx("order_id", shares, 100 * ranges), F.max("order_id")).first()
    limits = sorted({*(found[0] or []), found[1] or 0})
    at = position(F.col("order_id"), limits)
    ends = F.get(F.array(*map(F.lit, limits)).cast("array<bigint>"), F.col("range")) == F.col("order_id")
    places = F.when(
        ends,
        F.array(
            F.struct(F.col("range").alias("range"), F.lit(False).alias("guest")),
            F.struct(((F.col("range") + 1) % len(limits)).alias("range"), F.lit(True).alias("guest")),
        ),
    ).otherwise(F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))))
    dealt = keyed.withColumn("range", at).withColumn("place", F.explode(places))
    dealt = dealt.select(*docs.columns, "order_id", "place.range", "place.guest").withColumn("tie", F.xxhash64("text"))
    return dealt, Window.partitionBy("range").orderBy(F.desc("guest"), "order_id", "tie")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of edited texts, with their likeness.

    Reads ``doc_id`` and ``text``. The edited text has the last half of its characters (rounded down) replaced by the first as
    many, or all, of the next document in descending order of ``doc_id``; after the last comes the first, so a single
    document is its own next. Returns ``doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited,
    near_next``. A null text counts as empty. Repeated ids follow each other by the hash of their text; a null id counts as
    the smallest. An empty table gives an empty result.
    """
    dealt, window = with_next(only(docs, "doc_id", whole_text().alias("text")))
    dealt = with_fingerprint(dealt.withColumn("next_text", F.lag("text").over(window)), "text", "fingerprint")
    dealt = dealt.withColumn("next_fingerprint", F.lag("fingerprint").over(window)).where("not guest")
    n = F.length("text")
    dealt = dealt.withColumn("n_chars", n.cast("bigint")).withColumn("half", F.floor(n / 2).cast("int"))
    kept = F.expr("substring(text, 1, n_chars - half)")
    dealt = dealt.withColumn("edited_text", F.concat(kept, F.expr("substring(next_text, 1, half)")))
    return with_fingerprint(dealt, "edited_text", "edited_fingerprint").select(
        "doc_id",
        "n_chars",
        "edited_text",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
