"""Words, word hashes and shared SQL expressions.

White space is ``[\\x20\\x09-\\x0D]`` throughout. The byte helpers work on whole Arrow buffers with numpy, so a
task spends nanoseconds per byte and never builds a Python string per word.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SEGMENT = 1 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)


def whole_text(column: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def word_count(column: str | Column = "text") -> Column:
    return F.regexp_count(whole_text(column), F.lit(WORD)).cast("bigint")


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns of the input; columns of other names cannot clash with what an operator adds."""
    return df.select(*names)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values(lower: bool) -> np.ndarray:
    """A 64-bit number for each byte; capital A-Z count as their small letters if ``lower``."""
    values = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * ODD)
    if lower:
        values[65:91] = values[97:123]
    return values


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of an odd number and of its inverse, modulo 2^64."""
    inverse = np.uint64(pow(int(ODD), -1, 1 << 64))
    out = []
    for base in (ODD, inverse):
        row = np.full(n + 1, base, np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


def space_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


class Words:
    """Finds and hashes the words of UTF-8 texts."""

    def __init__(self, lower: bool):
        self.values, self.space = byte_values(lower), space_table()
        self.up, self.down = powers(SEGMENT + 1)

    def _segment(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of the words; ``cuts`` are places no word may cross."""
        n = len(data)
        up, down = (self.up, self.down) if n < len(self.up) else powers(n + 1)  # long ones are not kept
        space = self.space[data]
        before = np.empty(n + 1, bool)
        before[0], before[1:] = True, space
        after = np.empty(n + 1, bool)
        after[:-1], after[-1] = space, True
        cuts = cuts[(cuts > 0) & (cuts < n)]
        before[cuts] = True
        starts = np.flatnonzero(before[:-1] & ~space)
        edge = after[1:].copy()
        edge[cuts - 1] = True
        ends = np.flatnonzero(edge & ~space) + 1
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum(self.values[data] * up[:n], out=total[1:])
        hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        return starts, ends, hashes

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of all words, and the first word of each text (one more at the end).

        ``offsets`` are where the texts start, and the end. Long runs are worked off in segments that end at white
        space or between texts.
        """
        parts, at, n = [], 0, len(data)
        while at < n:
            end = min(n, at + SEGMENT)
            if end < n:
                back = np.flatnonzero(self.space[data[at:end]])
                if len(back):
                    end = at + int(back[-1]) + 1
                else:
                    while end < n and not self.space[data[end]]:
                        end += 1
            starts, ends, hashes = self._segment(data[at:end], offsets[(offsets > at) & (offsets < end)] - at)
            parts.append((starts + at, ends + at, hashes))
            at = end
        if not parts:
            empty = np.zeros(0, np.int64)
            return empty, empty, empty.astype(np.uint64), np.zeros(len(offsets), np.int64)
        starts, ends, hashes = (np.concatenate([p[k] for p in parts]) for k in range(3))
        return starts, ends, hashes, np.searchsorted(starts, offsets)


def runs_of_rows(column: pa.Array, limit: int = SEGMENT) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts of an Arrow column in runs of about ``limit`` bytes: first row, bytes, offsets of the texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, content = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` neighbouring words (the word itself counts for its place)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = (out ^ (out >> np.uint64(29))) * ODD + hashes[k : k + n]
    return mix(out)


def whole(hashes: np.ndarray) -> int:
    """One hash for a whole sequence of words, of any length below a window."""
    out = np.uint64(len(hashes) + 0x51)
    with np.errstate(over="ignore"):
        for h in hashes:
            out = (out ^ (out >> np.uint64(29))) * ODD + h
        return int(mix(np.array([out], np.uint64))[0])


def once(name: str, make):
    """``make()``, kept for all later tasks of this Python worker."""
    kept = sys.modules.setdefault("tablelift_worker_cache", types.ModuleType("tablelift_worker_cache")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]
