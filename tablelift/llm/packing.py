"""Packing of documents into sequences by column generation for the cutting-stock problem.

1. Documents are cut into pieces: full sequences, and one remainder. Full pieces are sequences of their own.
2. Remainders are counted by length. The histogram, of at most ``capacity`` rows, is all that the driver gets. It plans twice and takes the
   plan of fewer sequences: once with all lengths rounded up to ``GRID``, and once with pieces below ``SHORT`` at their exact lengths,
   which fill what the patterns of the others leave and then sequences of their own (``with_short``).
3. The driver solves the linear program "fewest sequences, every class covered" by the simplex method: the columns of the
   program are patterns (how many pieces of each class share a sequence), and a knapsack by dynamic programming finds the pattern that the
   duals price best (``fractional_patterns``). Whole parts of the solution are kept, the rest is placed first-fit.
4. Each pattern takes its pieces from the classes by rank. Ranks are numbers inside blocks of pieces plus the counts of the blocks before
   them, so no window holds a whole class.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelift.session import stage

CAPACITY = 4096
#: Tokens by which lengths are rounded up for the patterns.
GRID = 8
#: Pieces below this length, and a sixteenth of a sequence, are also planned by their exact lengths.
SHORT = 256
#: Pieces that are numbered together, about.
BLOCK_ROWS = 20_000
#: The simplex stops at this relative distance from the bound of the duals.
GAP = 1e-4


def knapsack(value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The best value of items of sizes 1, 2, ... within ``capacity``, each as often as wished, and their numbers."""
    best = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        k = min(c, len(value))
        gained = value[:k] + best[c - 1 :: -1][:k]
        at = int(gained.argmax())
        best[c] = max(best[c - 1], gained[at])
        last[c] = at + 1 if gained[at] > best[c - 1] else 0
    number, c = np.zeros(len(value), np.int64), capacity
    while c > 0:
        if last[c]:
            number[last[c] - 1] += 1
            c -= last[c]
        else:
            c -= 1
    return float(best[capacity]), number


def fractional_patterns(demand: np.ndarray, capacity: int, gap: float = GAP, most: int = 20_000) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often the linear program uses each. ``demand`` counts items of sizes 1, 2, ...

    The start uses each size alone. Every step adds the pattern with the best price and drops the one that it drives to zero, so the basis
    stays as large as the number of sizes. It ends where no pattern is priced above 1, or within ``gap`` of the bound
    "value over best price" (Farley's), or after ``most`` steps; any stop leaves patterns that cover the demand.
    """
    sizes = np.flatnonzero(demand) + 1
    if not len(sizes):
        return []
    value = np.zeros(int(sizes.max()))
    each = capacity // sizes
    inverse = np.diag(1.0 / each)
    basis = np.diag(each)
    use = demand[sizes - 1] / each
    ones = np.ones(len(sizes))
    for _ in range(most):
        dual = ones @ inverse
        value[:] = 0
        value[sizes - 1] = np.maximum(dual, 0)
        price, number = knapsack(value, capacity)
        if price <= 1 + max(gap, 1e-9):
            break
        column = number[sizes - 1]
        step = inverse @ column
        positive = step > 1e-10
        if not positive.any():
            break
        ratio = np.where(positive, use / np.where(positive, step, 1), np.inf)
        out = int(ratio.argmin())
        amount = ratio[out]
        use = np.maximum(use - amount * step, 0)
        use[out] = amount
        basis[:, out] = column
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
    out = []
    for k in np.flatnonzero(use > 1e-9):
        full = np.zeros(len(demand), np.int64)
        full[sizes - 1] = basis[:, k]
        out.append((full, float(use[k])))
    return out


def whole_patterns(demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often each is used, in whole numbers, taking every item exactly once."""
    left, out = demand.astype(np.int64).copy(), []
    for pattern, use in fractional_patterns(demand, capacity):
        used = pattern > 0
        times = min(int(use + 1e-6), int((left[used] // pattern[used]).min()))
        if times > 0:
            out.append((pattern, times))
            left -= times * pattern
    while left.any():  # first-fit, longest first: one pattern at a time, as often as it fits
        pattern, room = np.zeros(len(left), np.int64), capacity
        for size in range(len(left), 0, -1):
            take = min(int(left[size - 1]), room // size)
            pattern[size - 1] = take
            room -= take * size
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        out.append((pattern, times))
        left -= times * pattern
    return out


@dataclass(frozen=True)
class Plan:
    """Rows ``(size, rank_from, rank_to, per_sequence, first_sequence)`` and the number of sequences."""

    rows: list[tuple[int, int, int, int, int]]
    sequences: int


def with_short(patterns: list[tuple[np.ndarray, int]], short: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns of places, and how often each is used, that also take every short piece exactly once.

    ``patterns`` count items of sizes 1, 2, ... in grid steps, ``short`` pieces of lengths 1, 2, ... in tokens. The result counts short
    pieces first, then the items. The room that a pattern leaves is filled with short pieces, longest first.
    """
    left, out = short.astype(np.int64).copy(), []
    width = len(patterns[0][0]) if patterns else 0
    grid = capacity // width if width else 1
    own = [(pattern, times, capacity - grid * int(pattern @ np.arange(1, width + 1))) for pattern, times in patterns]
    for pattern, times, room in [*own, (np.zeros(width, np.int64), None, capacity)]:
        while left.any() if times is None else times:
            taken, rest = np.zeros(len(left), np.int64), room
            for size in np.flatnonzero(left)[::-1] + 1:
                taken[size - 1] = min(int(left[size - 1]), rest // size)
                rest -= int(taken[size - 1]) * int(size)
            used = taken > 0
            often = [times] if times is not None else []
            if used.any():
                often.append(int((left[used] // taken[used]).min()))
            out.append((np.concatenate([taken, pattern]), min(often)))
            left -= min(often) * taken
            times = None if times is None else times - min(often)
    return out


def assign(demand: np.ndarray, capacity: int, short: np.ndarray | None = None, grid: int = 1) -> Plan:
    """Which ranks of each size go to which sequences. With ``short``, its lengths are the first sizes, those of ``demand`` follow."""
    patterns = whole_patterns(demand, capacity)
    if short is not None:
        # Without longer items there is still a width to tell.
        patterns = with_short(patterns or [(np.zeros(len(demand), np.int64), 0)], short, capacity * grid)
    taken, rows, at = np.zeros(len(demand) + (0 if short is None else len(short)), np.int64), [], 0
    for pattern, times in patterns:
        for k in np.flatnonzero(pattern):
            count = int(pattern[k]) * times
            rows.append((int(k) + 1, int(taken[k]), int(taken[k]) + count, int(pattern[k]), at))
            taken[k] += count
        at += times
    return Plan(rows, at)


def planned(lengths: dict[int, int], capacity: int, grid: int, below: int) -> tuple[Plan, dict[int, int]]:
    """The plan with pieces shorter than ``below`` at their exact lengths, and the number of pieces of each size."""
    width, shorts = capacity // grid, max(0, below - 1)
    sizes = np.zeros(shorts + width, np.int64)
    for length, n in lengths.items():
        sizes[(length if length < below else shorts + -(-length // grid)) - 1] += n
    full, sizes[-1] = int(sizes[-1]), 0
    plan = assign(sizes[shorts:], width, sizes[:shorts] if shorts else None, grid)
    counts = {k + 1: int(n) for k, n in enumerate(sizes) if n}
    if full:
        plan = Plan([*plan.rows, (shorts + width, 0, full, 1, plan.sequences)], plan.sequences + full)
        counts[shorts + width] = full
    return plan, counts


def cut(tokens: DataFrame, capacity: int = CAPACITY, ids: str | None = "ids") -> DataFrame:
    """Pieces of at most ``capacity`` tokens: ``doc_id, start, length, doc_tokens``, and ``ids`` if there is such a column.

    ``tokens`` has ``doc_id, n_tokens`` and, packed as 32-bit numbers, ``ids``.
    """
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("n_tokens") - 1, F.lit(0)), F.lit(capacity).cast("bigint"))
    cuts = tokens.where("n_tokens > 0").withColumn("start", F.explode(starts))
    length = F.least(F.lit(capacity), F.col("n_tokens") - F.col("start")).cast("bigint")
    columns = ["doc_id", "start", length.alias("length"), F.col("n_tokens").alias("doc_tokens")]
    if ids:
        part = F.substring(F.col(ids), (F.col("start") * 4 + 1).cast("int"), (length * 4).cast("int"))
        columns.append(part.alias("ids"))
    return cuts.select(*columns)


def pack(pieces: DataFrame, capacity: int = CAPACITY, grid: int = GRID, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``pieces`` has ``doc_id, start, length`` with lengths from 1 to ``capacity``; further columns are carried along. Each piece gets one place;
    inside a sequence, offsets run without gaps from 0. Pieces of equal length are ranked by a hash of their document,
    then by ``doc_id`` and ``start``; pieces equal in all of these are interchangeable. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    kept = stage(pieces.withColumn("turn", F.xxhash64("doc_id", "start")), "pieces")
    lengths = {r.length: r.n for r in kept.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    below = min(SHORT, capacity // 16)
    tried = [0, below] if any(n < below for n in lengths) else [0]
    plans = [(planned(lengths, capacity, grid, k), k) for k in tried]
    (plan, histogram), below = min(plans, key=lambda p: p[0][0].sequences)
    rows = plan.rows
    size = F.ceil(F.col("length") / grid) + max(0, below - 1)
    kept = kept.withColumn("size", F.when(F.col("length") < below, F.col("length")).otherwise(size).cast("int"))
    # At most a row for each size of each pattern: bounded by the histogram, not by the pieces.
    table = spark.createDataFrame(rows, "size int, rank_from bigint, rank_to bigint, per_sequence bigint, first_sequence bigint")
    ranked = with_rank(kept, histogram, block_rows)
    r, t = ranked.alias("r"), F.broadcast(table).alias("t")
    inside = (F.col("r.size") == F.col("t.size")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    number = (F.col("first_sequence") + F.floor((F.col("rank") - F.col("rank_from")) / F.col("per_sequence"))).cast("bigint")
    placed = r.join(t, inside).select("r.*", number.alias("sequence_id"))
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(order), F.lit(0)).cast("bigint")
    return placed.withColumn("offset", offset).drop("size", "rank")


def with_rank(kept: DataFrame, histogram: dict[int, int], block_rows: int) -> DataFrame:
    """``kept`` with ``rank``, the place of each piece among those of its size, from 0."""
    blocks = max([1, *(-(-n // block_rows) for n in histogram.values())])
    bits = max(0, (blocks - 1).bit_length())
    block = F.expr(f"shiftrightunsigned(turn, {64 - bits})") if bits else F.lit(0).cast("bigint")
    # Top bits of a signed hash, as ascending numbers from 0.
    kept = kept.withColumn("block", block)
    counts = kept.groupBy("size", "block").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("size", "block", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    own = Window.partitionBy("size", "block").orderBy("turn", "doc_id", "start")
    joined = kept.join(counts, ["size", "block"])
    rank = F.col("ahead") + F.row_number().over(own) - 1
    return joined.withColumn("rank", rank).drop("block", "ahead", "turn")


def padding(capacity: int = CAPACITY) -> Column:
    """The share of all places that are padding: an aggregate over placed pieces."""
    return 1 - F.sum("length") / (F.count_distinct("sequence_id") * capacity)


def sequences(placed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """``sequence_id, n_tokens, ids``: the packed ids of each sequence, padded to ``capacity`` unless at a power of two.

    ``placed`` has ``sequence_id, offset, length, ids``. A sequence has at most ``capacity`` pieces.
    """
    joined = F.expr("reduce(array_sort(collect_list(struct(offset, ids))), cast('' as binary), (a, x) -> concat(a, x.ids))")
    filled = placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
    whole = F.expr("(n_tokens & (n_tokens - 1)) = 0")
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), (F.lit(capacity) - F.col("n_tokens")).cast("int")))
    return filled.withColumn("ids", F.when(whole, F.col("ids")).otherwise(F.concat("ids", pad)))
