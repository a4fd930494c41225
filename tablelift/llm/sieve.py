"""A filter of fixed size that spares rows a shuffle which they would not survive."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the filter, as a power of two (2 MB); it goes to every task whatever the input.
FILTER_BITS = 24
#: Values a task remembers, about 100 bytes each.
MOST_SEEN = 1 << 18


def filled(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The filter for the 64-bit numbers of a one-column frame, as words of 64 bits."""
    slot = F.pmod(F.col(hashes.columns[0]), F.lit(1 << bits))
    words = hashes.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word"))
    table = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros((1 << bits) // 64, np.int64)
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return out


def sieve(rows: DataFrame, column: str, hashes: DataFrame, once: bool = False) -> DataFrame:
    """The rows whose 64-bit ``column`` may be among ``hashes``; none that is among them is lost.

    The more hashes, the more other rows pass; a join must drop them. With ``once``, later rows of a value are
    dropped too, inside each batch, and inside each task unless it has met more than ``MOST_SEEN`` values.
    """
    shared = rows.sparkSession.sparkContext.broadcast(filled(hashes))
    at = rows.columns.index(column)

    def run(batches):
        table, seen = shared.value, set()
        for batch in batches:
            values = batch.column(at).to_numpy()
            slot = values & (len(table) * 64 - 1)
            chosen = np.flatnonzero((table[slot >> 6] >> (slot & 63)) & 1)
            if once and len(chosen):
                new, first = np.unique(values[chosen], return_index=True)
                unseen = np.array([v not in seen for v in new.tolist()], bool)
                chosen = np.sort(chosen[first[unseen]])
                if len(seen) < MOST_SEEN:
                    seen.update(new[unseen].tolist())
            if len(chosen):
                yield batch.take(pa.array(chosen))

    return rows.mapInArrow(run, rows.schema)
