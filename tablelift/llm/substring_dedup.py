"""Removal of repeated passages: windows of words that occur elsewhere, found by super-k-mers.

A window is ``size`` consecutive words. Its minimiser is the least hash among the ``SEED``-word runs in it; consecutive windows with
one minimiser form a super-k-mer, and equal windows always have equal minimisers.

1. ``super_kmers`` cuts every document and sends ``(minimiser, document, start, windows)``: a few bytes for about 14 windows. A minimiser
   that occurs once cannot hold a repeated window, and goes no further. Of equal texts, one document stands for all.
2. ``packed`` sends each remaining super-k-mer to its bucket as one string of its words. Buckets of frequent minimisers are salted
   by document.
3. ``count_windows`` sorts the windows of each minimiser by their words and reports those that occur again. In a salted bucket a window
   that occurs once is reported by a digest of 128 bits, and the digests are counted across the salts.
4. The reported windows of a document become ranges of words, which are cut from its text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.sieve import sieve
from tablelift.llm.text import Words, runs_of_rows, whole_text, windows
from tablelift.session import stage

SEED = 8
#: Windows of one minimiser that are counted together; more are dealt out by salt.
BUCKET_PART = 1 << 16
#: Windows of one super-k-mer; longer ones, as in texts that repeat one word, are cut there.
MOST_WINDOWS = 512
SUPER = "doc_id bigint, th bigint, digest binary, m bigint, start bigint, n int, again boolean"
#: More windows than a text has.
ALL_WINDOWS = 1 << 30


def cut_super_kmers(hashes: np.ndarray, size: int, seed: int) -> tuple[np.ndarray, ...]:
    """Of each super-k-mer of one document: minimiser, first window, windows, whether the minimiser occurs again in it."""
    runs = windows(hashes, seed)
    width = size - seed + 1
    least = np.lib.stride_tricks.sliding_window_view(runs, width).min(axis=1)
    change = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    starts = np.union1d(change, np.arange(0, len(least), MOST_WINDOWS))
    seen, times = np.unique(runs, return_counts=True)
    again = np.isin(least[starts], seen[times > 1])
    return least[starts], starts, np.diff(starts, append=len(least)), again


def super_kmers(docs: DataFrame, size: int, seed: int) -> DataFrame:
    """The super-k-mers of all documents; the first of each document carries the digest of the text."""

    def run(batches):
        words = Words(lower=False)
        for batch in batches:
            ids, hashes_of_text = (batch.column(k).fill_null(0).to_numpy() for k in (0, 2))
            null_ids = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            for first, data, offsets in runs_of_rows(batch.column(1)):
                _, _, hashes, place = words.of(data, offsets)
                rows, parts = [], []
                for k in range(len(offsets) - 1):
                    if place[k + 1] - place[k] >= size:
                        parts.append(cut_super_kmers(hashes[place[k] : place[k + 1]], size, seed))
                        rows.append(np.full(len(parts[-1][0]), first + k))
                if rows:
                    row = np.concatenate(rows)
                    m, start, n, again = (np.concatenate([p[j] for p in parts]) for j in range(4))
                    digests = batch.column(3).take(pa.array(np.where(start == 0, row, -1), pa.int64(), mask=start > 0))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[row], pa.int64(), mask=null_ids[row]),
                            pa.array(hashes_of_text[row]),
                            digests,
                            pa.array(m.astype(np.int64)),
                            pa.array(start),
                            pa.array(n.astype(np.int32)),
                            pa.array(again),
                        ],
                        names=["doc_id", "th", "digest", "m", "start", "n", "again"],
                    )

    digest = F.unhex(F.sha2("text", 256))
    return docs.select("doc_id", "text", "th", digest.alias("digest")).mapInArrow(run, SUPER)


def packed(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The ``wanted`` super-k-mers, each with its words as one ``string`` joined by single spaces."""

    def run(batches):
        words = Words(lower=False)
        for batch in batches:
            places = batch.column("kmers")
            for first, data, offsets in runs_of_rows(batch.column("text")):
                starts, ends, _, place = words.of(data, offsets)
                raw = data.tobytes()
                out = []
                for k in range(len(offsets) - 1):
                    a, b = int(place[k]), int(place[k + 1])
                    own = [raw[x:y] for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)]
                    doc, th = batch.column("doc_id")[first + k].as_py(), batch.column("th")[first + k].as_py()
                    for kmer in places[first + k].as_py():
                        s, n = kmer["start"], kmer["n"]
                        text = b" ".join(own[s : s + n + size - 1])
                        out.append((doc, th, kmer["m"], kmer["salts"], s, text))
                if out:
                    columns = list(zip(*out, strict=True))
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                        names=["doc_id", "th", "m", "salts", "start", "string"],
                    )

    by_doc = wanted.groupBy("doc_id", "th").agg(F.collect_list(F.struct("m", "salts", "start", "n")).alias("kmers"))
    d, w = sieve(docs, "th", wanted.select("th")).alias("d"), by_doc.alias("w")
    joined = d.join(w, (F.col("d.th") == F.col("w.th")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")))
    joined = joined.select("d.doc_id", "d.th", "d.text", "w.kmers")
    return joined.mapInArrow(run, "doc_id bigint, th bigint, m bigint, salts int, start bigint, string binary")


def count_windows(kmers: DataFrame, size: int, parts: int) -> DataFrame:
    """``doc_id, th, start, n, digest``: runs of repeated windows, and the digests of those yet to be counted across salts.

    A row with a digest stands for one window: ``n`` is 0 and there is no document where it is already known to repeat.
    """
    names = ["doc_id", "th", "start", "n", "digest"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def repeated(rows, salts):
        """Of one minimiser (or one salt of it): sorted windows next to an equal one."""
        spans, owner, number = [], [], []
        for r, (_, _, _, text) in enumerate(rows):
            gaps = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
            begins = [0, *(gaps + 1).tolist()]
            ends = [*gaps.tolist(), len(text)]
            for k in range(len(begins) - size + 1):
                spans.append(text[begins[k] : ends[k + size - 1]])
                owner.append(r)
                number.append(k)
        order = sorted(range(len(spans)), key=spans.__getitem__)
        again: dict[int, list[int]] = {}
        out = []
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and spans[order[end]] == spans[order[at]]:
                end += 1
            if end - at > 1:
                for x in order[at:end]:
                    again.setdefault(owner[x], []).append(number[x])
                if salts > 1:
                    out.append((None, None, None, 0, hashlib.blake2b(spans[order[at]], digest_size=16).digest()))
            elif salts > 1:
                x = order[at]
                doc, th, start, _ = rows[owner[x]]
                digest = hashlib.blake2b(spans[x], digest_size=16).digest()
                out.append((doc, th, start + number[x], 1, digest))
            at = end
        for r, found in again.items():
            found = np.sort(found)
            doc, th, start, _ = rows[r]
            for run in np.split(found, np.flatnonzero(np.diff(found) > 1) + 1):
                out.append((doc, th, start + int(run[0]), len(run), None))
        return out

    def run(batches):
        rows, key = [], None
        for batch in batches:
            out = []
            m, salt = batch.column("m").to_numpy(), batch.column("salt").to_numpy()
            doc, th, start = (batch.column(c).to_pylist() for c in ("doc_id", "th", "start"))
            salts, text = batch.column("salts").to_numpy(), batch.column("string").to_pylist()
            for k in range(batch.num_rows):
                if key != (m[k], salt[k]):
                    if rows:
                        out += repeated(rows, key_salts)
                    rows, key, key_salts = [], (m[k], salt[k]), salts[k]
                rows.append((doc[k], th[k], start[k], text[k]))
            yield emit(out)
        if rows:
            yield emit(repeated(rows, key_salts))

    def emit(out):
        columns = list(zip(*out, strict=True)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    salted = kmers.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), "salts").cast("int"))
    dealt = salted.repartition(parts, "m", "salt").sortWithinPartitions("m", "salt")
    return dealt.mapInArrow(run, "doc_id bigint, th bigint, start bigint, n int, digest binary")


def repeated_windows(docs: DataFrame, size: int, seed: int = SEED, part: int = BUCKET_PART) -> DataFrame:
    """``doc_id, th, ranges``: for each document with windows that occur elsewhere, ``(start, n)`` of their runs.

    ``docs`` has ``doc_id``, ``text`` and ``th``, the hash of the text.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = stage(super_kmers(docs, size, seed), "super_kmers")
    # All windows of a text that has copies are repeated; its first document stands for it from here on.
    heads = found.where("start = 0").select("doc_id", "th", "digest")
    texts = heads.groupBy("digest").agg(F.min(F.struct("doc_id", "th")).alias("first"), F.count(F.lit(1)).alias("copies"))
    copied = heads.join(texts.where("copies > 1"), "digest")
    copied = stage(copied.select("doc_id", "th", F.struct("doc_id", "th").eqNullSafe(F.col("first")).alias("stands")), "copies")
    # A minimiser of one text only cannot hold a repeated window, unless it occurs twice in one super-k-mer.
    shared = found.groupBy("m").agg(
        F.sum("n").alias("times"), F.min("th").alias("low"), F.max("th").alias("high"), F.max("again").alias("again")
    )
    shared = shared.where("low <> high or again").select("m", F.ceil(F.col("times") / part).cast("int").alias("salts"))
    shared = stage(shared, "shared")
    wanted = sieve(found.select("doc_id", "th", "m", "start", "n"), "m", shared.select("m")).join(shared, "m")
    w, c = wanted.alias("w"), copied.where("not stands").select("doc_id", "th").distinct().alias("c")
    wanted = w.join(c, (F.col("w.th") == F.col("c.th")) & F.col("w.doc_id").eqNullSafe(F.col("c.doc_id")), "left_anti")
    wanted = stage(wanted.select("doc_id", "th", "m", "salts", "start", "n"), "wanted")
    counted = stage(count_windows(packed(docs, wanted, size), size, parts), "windows")
    open_ones = counted.where("digest is not null").groupBy("digest")
    # At most one row a salt has a document: a window met twice in one salt is settled there.
    across = open_ones.agg(
        F.count(F.lit(1)).alias("salts"),
        F.collect_list(F.when(F.col("n") > 0, F.struct("doc_id", "th", "start", "n"))).alias("where"),
        F.max(F.col("n") == 0).alias("known"),
    )
    across = across.where("salts > 1 or known").select(F.explode("where").alias("w")).select("w.*")
    whole = copied.select("doc_id", "th", F.lit(0).cast("bigint").alias("start"), F.lit(ALL_WINDOWS).alias("n"))
    ranges = counted.where("digest is null").drop("digest").union(across).union(whole.distinct())
    return ranges.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))


def remove_repeated(docs: DataFrame, size: int = 35, seed: int = SEED, part: int = BUCKET_PART) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for every row of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    Words are runs without white space, unchanged. Every word is removed that is covered by a window of ``size`` words which also
    starts anywhere else, in another document or the same; windows are judged on the input. The kept words are joined by single spaces. A
    null text has no words; texts shorter than a window lose nothing; all copies of a repeated text, and repeated rows, lose all their
    windows. ``part`` sets how many windows of one minimiser are counted together, and does not change the result.
    """
    if not 1 <= seed <= size:
        raise ValueError("the seed must have from one word to a window's words")
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("th", F.xxhash64("text"))
    ranges = repeated_windows(texts, size, seed, part)

    def run(batches):
        for batch in batches:
            found, ids = batch.column("ranges"), batch.column("doc_id")
            total, gone, kept = [], [], []
            for k, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                words = text.split()
                keep = np.ones(len(words) + 1, bool)
                for r in found[k].as_py() or ():
                    keep[r["start"] : r["start"] + r["n"] + size - 1] = False
                left = [w for w, stays in zip(words, keep.tolist(), strict=False) if stays]
                total.append(len(words))
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    d, r = texts.alias("d"), ranges.alias("r")
    joined = d.join(r, (F.col("d.th") == F.col("r.th")) & F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")), "left")
    joined = joined.select("d.doc_id", "d.text", "r.ranges")
    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
