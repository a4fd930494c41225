"""Removal of repeated byte strings: maximal repeats from enhanced suffix arrays, as intervals of common prefixes.

A window is ``size`` bytes of one text. Its anchor is the least hash of a seed of ``SEED`` bytes in it, the first one of equals; equal
windows have equal anchors at the same place. Windows are so dealt out by the value of their anchor, and all places where a window
starts meet in one bucket.

1. ``stretches`` cuts each text into stretches of consecutive windows with one anchor value. A stretch goes on as a few numbers and a
   digest of its bytes. A value that occurs once cannot hold a repeated window.
2. Equal stretches are folded: one stands for all and carries how many there are. A bucket of one stretch, in which the anchor does not
   occur again, has no two suffixes that share a window: it is a repeat as a whole if it is in several places. Of all other stretches,
   the bytes are fetched from one text.
3. ``common_prefixes`` builds, for each bucket, the suffix array of its stretches with the common prefixes of neighbours: ranks of
   blocks of 7, 14, ..., 448 bytes by doubling, a stretch's end being less than any byte.
4. ``maximal_repeats`` scans it with a stack. Suffixes with a common prefix of ``size`` bytes or more form intervals, one inside the
   other. If all members of an interval come after the same byte, the repeat goes on to the left and the interval of the longer string
   tells all; an interval whose members differ there, or start a stretch, is a maximal repeat, with all its occurrences.
5. Buckets of many stretches are salted. What occurs once in its salt is told by digests of its windows, counted across salts.
6. The occurrences of all repeats become spans of the texts that hold them, and are cut out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.sieve import sieve
from tablelift.llm.text import byte_values, mix, powers, runs_of_rows, whole_text
from tablelift.session import stage

SEED = 64
#: Bytes of the first block that is ranked; the others double it.
BASE = 7
LEVELS = 7
#: A stretch is no longer than all levels together can compare.
LONGEST = BASE * ((1 << LEVELS) - 1)
#: Bytes of text worked on at a time in a task.
RUN = 1 << 20
#: Bits of a place in a run of texts.
PLACE_BITS = np.uint64(24)
#: Bytes of the stretches of one bucket that are sorted together; more are dealt out by salt. Also what a task gathers from small buckets.
BUCKET_BYTES = 1 << 20
STRETCHES = "doc_id bigint, ref bigint, m bigint, start bigint, n int, digest binary, again boolean"
FOUND = "m bigint, digest binary, at int, length int, grp binary, parent binary, kind int"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values, by prefix and suffix minima of blocks."""
    n = len(values) - width + 1
    full = -(-len(values) // width) * width
    padded = np.full(full, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


class Cutter:
    """Cuts runs of texts into stretches."""

    def __init__(self, size: int, seed: int):
        self.size, self.seed = size, seed
        self.values = byte_values(lower=False)
        self.up, self.down = powers(RUN + size)

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Text, first window, windows, anchor value of each stretch of texts that lie side by side; whether its anchor occurs again in it.

        ``offsets`` are where the texts start, and the end.
        """
        n, width = len(data), self.size - self.seed + 1
        if n < self.size:
            return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, np.uint64, bool))
        if n >= len(self.up):
            self.up, self.down = powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[:n], out=total[1:])
        seeds = mix((total[self.seed :] - total[: -self.seed]) * self.down[: n - self.seed + 1])
        # The upper bits of the seed decide, then the place.
        least = sliding_least((seeds >> PLACE_BITS << PLACE_BITS) | np.arange(len(seeds), dtype=np.uint64), width)
        anchor = (least & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
        value = seeds[anchor]
        # Windows that no text holds whole lie between texts.
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(value)]
        inside = np.arange(len(value)) + self.size <= offsets[1:][text]
        moved = np.ones(len(value), bool)
        moved[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
        starts = np.flatnonzero(moved & inside)
        # Windows of one text come before those across its end, so a stretch ends where the next begins or at the text's last window.
        lasts = offsets[1:][text[starts]] - self.size + 1
        ends = np.minimum(np.append(starts[1:], len(value)), lasts)
        jumps = np.concatenate([[0], np.cumsum(anchor[1:] != anchor[:-1])])
        again = jumps[ends - 1] > jumps[starts]
        most = LONGEST - self.size + 1
        pieces = -(-(ends - starts) // most)
        first = np.repeat(starts, pieces) + most * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        last = np.minimum(first + most, np.repeat(ends, pieces))
        again = np.repeat(again | (pieces > 1), pieces)
        return text[first], first, last - first, value[first], again


def digest_of(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def stretches(docs: DataFrame, size: int, seed: int) -> DataFrame:
    """The stretches of all texts. ``docs`` has ``doc_id, text, ref``."""

    def run(batches):
        cutter = Cutter(size, seed)
        for batch in batches:
            for first, data, offsets in runs_of_rows(batch.column(1), RUN):
                # A text longer than a run is cut piece by piece, with the windows across a border in the earlier piece.
                for at in range(0, max(len(data), 1), RUN) if len(offsets) == 2 else [0]:
                    piece = data[at : at + RUN + size - 1] if len(offsets) == 2 else data
                    edges = np.array([0, len(piece)]) if len(offsets) == 2 else offsets
                    text, start, n, m, again = cutter.cut(piece, edges)
                    if not len(text):
                        continue
                    raw = piece.tobytes()
                    ends = start + n + size - 1
                    digests = [digest_of(raw[a:b]) for a, b in zip(start.tolist(), ends.tolist(), strict=True)]
                    rows = pa.array(first + text)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(rows),
                            batch.column(2).take(rows),
                            pa.array(m.astype(np.int64)),
                            pa.array(start - edges[text] + at),
                            pa.array(n.astype(np.int32)),
                            pa.array(digests, pa.binary()),
                            pa.array(again),
                        ],
                        names=["doc_id", "ref", "m", "start", "n", "digest", "again"],
                    )

    return docs.select("doc_id", "text", "ref").mapInArrow(run, STRETCHES)


def with_bytes(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``wanted`` (``doc_id, ref, m, digest, times, salts, start, n``) as ``m, digest, times, salts, bytes``: the bytes of each stretch."""

    def run(batches):
        for batch in batches:
            places = batch.column(1)
            for k, text in enumerate(batch.column(0).cast(pa.large_binary())):
                raw = text.as_buffer()
                found = places[k].values
                starts, ns = (found.field(c).to_numpy() for c in ("start", "n"))
                cut = [raw[a:b].to_pybytes() for a, b in zip(starts.tolist(), (starts + ns + size - 1).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*[found.field(c) for c in ("m", "digest", "times", "salts")], pa.array(cut, pa.binary())],
                    names=["m", "digest", "times", "salts", "bytes"],
                )

    by_doc = wanted.groupBy("doc_id", "ref").agg(F.collect_list(F.struct("m", "digest", "times", "salts", "start", "n")).alias("places"))
    d, w = sieve(docs, "ref", wanted.select("ref"), once=True).alias("d"), by_doc.alias("w")
    joined = d.join(w, (F.col("d.ref") == F.col("w.ref")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")))
    kinds = "m bigint, digest binary, times bigint, salts int, bytes binary"
    return joined.select("d.text", "w.places").mapInArrow(run, kinds)


def ranked(keys: np.ndarray) -> np.ndarray:
    """Dense ranks from 1 on, in the order of the keys."""
    order = np.argsort(keys)
    steps = np.empty(len(keys), np.int64)
    held = keys[order]
    steps[:1] = 1
    np.cumsum(held[1:] != held[:-1], out=steps[1:])
    steps[1:] += 1
    out = np.empty(len(keys), np.int64)
    out[order] = steps
    return out


def common_prefixes(strings: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The enhanced suffix array of the window starts of ``strings``: owner, place, byte before, bytes left, common prefix with the one before.

    Suffixes are sorted by their bytes up to the end of their string, the end being less than any byte. A common prefix below ``size`` is
    told as 0. The byte before the start of a string is told as a value of its own.
    """
    data = np.frombuffer(b"".join(strings), np.uint8)
    lengths = np.array([len(s) for s in strings])
    ends = np.cumsum(lengths)
    begins, total = ends - lengths, len(data)
    owner = np.repeat(np.arange(len(strings)), lengths)
    left = ends[owner] - np.arange(total)  # bytes from here to the end of the string
    padded = np.concatenate([data, np.zeros(BASE, np.uint8)]).astype(np.uint64)
    key = np.minimum(left, BASE).astype(np.uint64)
    for k in range(BASE):
        key |= np.where(left > k, padded[k : k + total], np.uint64(0)) << np.uint64(8 * (BASE - k))
    levels = [ranked(key)]
    for level in range(1, LEVELS + 1):
        half = BASE << (level - 1)
        ranks = levels[-1]
        after = np.zeros(total, np.int64)
        if total > half:
            np.copyto(after[:-half], ranks[half:], where=left[:-half] > half)
        key = ranks << 32 | after
        if level < LEVELS:
            levels.append(ranked(key))
    starts = np.flatnonzero(left >= size)
    order = starts[np.argsort(key[starts], kind="stable")]
    one, two = order[:-1], order[1:]
    # A window is covered by two blocks of the largest level in it, from its start and up to its end.
    level = max(k for k in range(LEVELS) if BASE << k <= size)
    shift = size - (BASE << level)
    long = levels[level][one] == levels[level][two]
    long &= levels[level][one + shift] == levels[level][two + shift]
    common = np.zeros(len(order), np.int64)
    at = np.flatnonzero(long)
    x, y = one[at], two[at]
    room, length = np.minimum(left[x], left[y]), np.zeros(len(at), np.int64)
    for level in range(LEVELS - 1, -1, -1):
        width = BASE << level
        fits = np.flatnonzero(room - length >= width)
        same = fits[levels[level][x[fits] + length[fits]] == levels[level][y[fits] + length[fits]]]
        length[same] += width
    for _ in range(BASE - 1):
        fits = np.flatnonzero(room > length)
        same = data[x[fits] + length[fits]] == data[y[fits] + length[fits]]
        going = np.zeros(len(at), bool)
        going[fits[same]] = True
        room = np.where(going, room, length)
        length += going
    common[at + 1] = length
    place = order - begins[owner[order]]
    before = np.where(place > 0, data[order - 1].astype(np.int64), -1 - owner[order])
    return owner[order], place, before, left[order], common


def maximal_repeats(
    owner: np.ndarray, before: np.ndarray, left: np.ndarray, common: np.ndarray, times: np.ndarray
) -> list[tuple[int, int, int, list[int]]]:
    """The maximal repeats of an enhanced suffix array: length, parent, one member and the own members of each.

    ``common`` is 0 below the length asked for; ``times`` tells in how many places a string is. Members are numbers of suffixes, the
    parent is the number of the repeat around this one, -1 where there is none. The occurrences of a repeat are its own members and those
    of all repeats inside it, so that each is told once.
    """
    heads = np.flatnonzero(common == 0)
    if not len(heads):
        return []
    ends = np.append(heads[1:], len(common))
    # Where all suffixes with a common window come after one byte, so do those of every interval inside.
    open_runs = (ends - heads > 1) & (np.maximum.reduceat(before, heads) != np.minimum.reduceat(before, heads))
    open_runs |= (ends - heads == 1) & (before[heads] < 0) & (times[owner[heads]] > 1)
    out: list[list] = []

    def finish(interval):
        """What an interval hands to the one around it: the byte before it (None: they differ), members, repeats inside."""
        length, byte, members, inside = interval
        if byte is not None:
            return byte, members, inside
        for child in inside:
            out[child][1] = len(out)
        out.append([length, -1, members[0] if members else out[inside[0]][2], list(dict.fromkeys(members))])
        return None, [], [len(out) - 1]

    def add(interval, part):
        byte, members, inside = part
        if interval[1] != byte:
            interval[1] = None
        for at, new in ((2, members), (3, inside)):
            if len(interval[at]) < len(new):
                interval[at], new = new, interval[at]
            interval[at] += new

    for a, b in zip(heads[open_runs].tolist(), ends[open_runs].tolist(), strict=True):
        rows = []
        for k, byte, shared, room, n in zip(
            range(a, b), before[a:b].tolist(), common[a:b].tolist(), left[a:b].tolist(), times[owner[a:b]].tolist(), strict=True
        ):
            rows.append((k, byte, shared))
            if n > 1:  # as if the string were there twice; where it starts, the bytes before it may differ
                rows.append((k, byte if byte >= 0 else (byte, "again"), room))
        stack: list[list] = []
        for at, (k, byte, shared) in enumerate(rows):
            part = None
            while stack and stack[-1][0] > shared:
                part = finish(stack.pop())
                if stack and stack[-1][0] >= shared:
                    add(stack[-1], part)
                    part = None
            if part and shared:
                stack.append([shared, *part])
            following = rows[at + 1][2] if at + 1 < len(rows) else 0
            if following > shared:
                stack.append([following, byte, [k], []])
            elif stack:
                add(stack[-1], (byte, [k], []))
        while stack:
            part = finish(stack.pop())
            if stack:
                add(stack[-1], part)
    return [tuple(x) for x in out]


def bucket_repeats(kmers: DataFrame, size: int, parts: int, bucket_bytes: int) -> DataFrame:
    """The repeats of all buckets, in the columns of ``FOUND``: one row for each occurrence in a stretch, told by its smallest repeat.

    Of salted buckets there are also the windows that occur once in their salt (``kind`` 1) and, without a stretch, one row for each
    window that repeats in it (2).
    """

    def told(rows):
        ms, digests, times, salts, strings = zip(*rows, strict=True)
        owner, place, before, left, common = common_prefixes(strings, size)
        times, salted = np.array(times), np.array(salts) > 1
        out = []
        found = maximal_repeats(owner, before, left, common, times)

        def content(k, length):
            return digest_of(strings[owner[k]][place[k] : place[k] + length])

        groups = [content(k, length) for length, _, k, _ in found]
        for (length, parent, _, members), group in zip(found, groups, strict=True):
            for k in members:
                x = owner[k]
                out.append((ms[x], digests[x], place[k], length, group, groups[parent] if parent >= 0 else None, 0))
        if salted.any():
            following = np.append(common[1:], 0)
            single = (common == 0) & (following == 0) & (times[owner] == 1)
            of_salted = salted[owner]
            for k in np.flatnonzero(single & of_salted).tolist():
                out.append((ms[owner[k]], digests[owner[k]], place[k], size, content(k, size), None, 1))
            for k in np.flatnonzero(~single & (common == 0) & of_salted).tolist():
                out.append((ms[owner[k]], None, 0, 0, content(k, size), None, 2))
        columns = list(zip(*out, strict=True)) or [[]] * 7
        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in FOUND.split(", ")]
        )

    def run(batches):
        rows, held, key, last = [], 0, None, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("m", "digest", "times", "salts", "bytes", "salt")), strict=True):
                if (row[0], row[1]) == last:  # rows that repeat a doc_id and its text
                    continue
                last = row[0], row[1]
                if key != (row[0], row[5]) and held >= bucket_bytes:
                    yield told(rows)
                    rows, held = [], 0
                key = row[0], row[5]
                rows.append(row[:5])
                held += len(row[4])
        if rows:
            yield told(rows)

    salted = kmers.withColumn("salt", F.pmod(F.xxhash64("digest"), "salts").cast("int"))
    return salted.repartition(parts, "m", "salt").sortWithinPartitions("m", "salt", "digest").mapInArrow(run, FOUND)


def find_repeats(docs: DataFrame, size: int, seed: int, bucket_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The stretches of anchors that occur again, and the repeats in them. ``docs`` has ``doc_id, text`` and ``ref``, a hash of both."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = stage(stretches(docs, size, seed), "stretches")
    shared = every.groupBy("m").agg(F.count(F.lit(1)).alias("times"), F.max("again").alias("again"))
    shared = stage(shared.where("times > 1 or again").select("m"), "shared")
    wanted = stage(sieve(every, "m", shared).join(shared, "m", "left_semi"), "wanted")
    folded = wanted.groupBy("m", "digest").agg(
        F.count(F.lit(1)).alias("times"), F.max("again").alias("again"), F.min(F.struct("doc_id", "ref", "start", "n")).alias("first")
    )
    folded = stage(folded.select("m", "digest", "times", "again", "first.*"), "folded")
    salts = F.ceil(F.sum(F.col("n") + F.lit(size - 1)) / bucket_bytes).cast("int").alias("salts")
    buckets = folded.groupBy("m").agg(F.count(F.lit(1)).alias("stretches"), F.max("again").alias("again"), salts)
    buckets = stage(buckets.where("stretches > 1 or again").select("m", "salts"), "buckets")
    dealt = folded.drop("again").join(buckets, "m")
    found = stage(bucket_repeats(with_bytes(docs, dealt, size), size, parts, bucket_bytes), "repeats")
    whole = folded.join(buckets, "m", "left_anti").where("times > 1").select(
        "m", "digest", F.lit(0).alias("at"), (F.col("n") + F.lit(size - 1)).alias("length"), F.col("digest").alias("grp"), F.lit(None).cast("binary").alias("parent")
    )
    # At most one row a salt has a stretch: a window met twice in one salt is settled there.
    across = found.where("kind > 0").groupBy("m", "grp").agg(
        F.count(F.lit(1)).alias("salts"),
        F.collect_list(F.when(F.col("kind") == 1, F.struct("digest", "at", "length"))).alias("places"),
        F.max(F.col("kind") == 2).alias("known"),
    )
    across = across.where("salts > 1 or known").select("m", "grp", F.explode("places").alias("p"))
    across = across.select("m", "p.*", "grp", F.lit(None).cast("binary").alias("parent"))
    return wanted, found.where("kind = 0").drop("kind").unionByName(across).unionByName(whole)


def referenced(docs: DataFrame) -> DataFrame:
    texts = docs.select("doc_id", whole_text().alias("text"))
    return texts.withColumn("ref", F.xxhash64("doc_id", "text"))


def repeat_groups(docs: DataFrame, size: int = 400, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``grp, parent, length, doc_id, start``: every occurrence of every maximal repeat, told by the smallest repeat that holds it.

    A repeat is known by the digest of its bytes; ``parent`` is the repeat around it, whose occurrences are its own and those of all
    repeats inside. Repeats are told within stretches: a longer one shows as one for each of its anchors.
    """
    wanted, found = find_repeats(referenced(docs), size, seed, bucket_bytes)
    joined = wanted.join(found, ["m", "digest"])
    return joined.select("grp", "parent", "length", "doc_id", (F.col("start") + F.col("at")).alias("start"))


def remove_repeats(docs: DataFrame, size: int = 400, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept`` for every row of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    A text counts as its UTF-8 bytes, null as empty. Every byte is removed that a string of ``size`` bytes covers which also starts
    anywhere else, in another text or the same, overlaps included; matches never cross texts, and are judged on the input. ``spans`` are the
    maximal removed runs as ``(start, length)``, ``kept`` the remaining bytes, which need not be UTF-8. Shorter texts lose nothing; all
    copies of a text, and repeated rows, lose all of it. Null or repeated ``doc_id`` are rows of their own. An empty table gives an empty
    result. ``seed`` and ``bucket_bytes`` do not change the result.
    """
    if not BASE <= seed <= size <= (LONGEST + 1) // 2:
        raise ValueError(f"size must be from the seed's {seed} to {(LONGEST + 1) // 2} bytes, the seed {BASE} at least")
    texts = referenced(docs)
    wanted, found = find_repeats(texts, size, seed, bucket_bytes)
    of_stretch = found.groupBy("m", "digest").agg(F.collect_list(F.struct("at", "length")).alias("found"))
    shifted = F.transform("found", lambda x: F.struct((F.col("start") + x["at"]).alias("start"), x["length"].alias("length")))
    of_text = wanted.join(of_stretch, ["m", "digest"]).select("doc_id", "ref", shifted.alias("spans"))
    of_text = of_text.groupBy("doc_id", "ref").agg(F.flatten(F.collect_list("spans")).alias("spans"))

    def run(batches):
        for batch in batches:
            sizes, gone, numbers, spans, kept = [], [], [], [], []
            for text, places in zip(batch.column(1).cast(pa.large_binary()), batch.column(2), strict=True):
                raw = text.as_py()
                starts, lengths = merged(places)
                left, at = [], 0
                for s, n in zip(starts.tolist(), lengths.tolist(), strict=True):
                    left.append(raw[at:s])
                    at = s + n
                left.append(raw[at:])
                sizes.append(len(raw))
                gone.append(int(lengths.sum()))
                numbers.append(len(starts))
                spans.append([{"start": s, "length": n} for s, n in zip(starts.tolist(), lengths.tolist(), strict=True)])
                kept.append(b"".join(left))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, pa.int64()) for x in (sizes, gone, numbers)], pa.array(spans, kind), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
            )

    d, r = texts.alias("d"), of_text.alias("r")
    joined = d.join(r, (F.col("d.ref") == F.col("r.ref")) & F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")), "left")
    kinds = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start bigint, length bigint>>, kept binary"
    return joined.select("d.doc_id", "d.text", "r.spans").mapInArrow(run, kinds)


def merged(places: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal runs that spans cover together."""
    if not places.is_valid or not len(places):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, lengths = (places.values.field(c).to_numpy().astype(np.int64) for c in ("start", "length"))
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(starts[order] + lengths[order])
    opens = np.concatenate([[True], starts[1:] > reach[:-1]])
    heads = np.flatnonzero(opens)
    return starts[heads], reach[np.append(heads[1:], len(starts)) - 1] - starts[heads]
