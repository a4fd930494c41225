"""Token ids of whole texts by a public tokenizer file.

The tokenizer's normaliser and splitter never join characters across white space, so a text is encoded word by word. Words of plain letters,
digits and marks are split into pieces here as the tokenizer would split them, all others stay whole. The ids of a piece are kept for the
next time it occurs. Pieces are found, told apart by their 64-bit hashes and put together to ids for a whole run of texts at a time; only
pieces that are new to a worker are looked at one by one: plain ones go to the tokenizer's model, words left whole to the tokenizer. Pieces
too long to be worth keeping are not told by their hash but encoded each time. The tests compare with the encoding of whole texts.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablelift.llm.text import SEGMENT, byte_values, mix, once, powers, runs_of_rows, space_table, whole_text

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Pieces whose ids a worker keeps; then it starts afresh. About 150 bytes each.
KEPT_PIECES = 400_000
#: Longer pieces are not kept.
LONG_PIECE = 64
# The tokenizer makes text small and splits it into runs of letters, single digits and runs of other marks. An apostrophe may begin
# a piece of its own, so words that have one are left to the tokenizer, as are words with characters beyond those below and special tokens.
LETTER_LEAD, NO_LETTERS, LAST_CAPITAL = 0xC3, (0x97, 0xB7), 0x9E  # À to ÿ in UTF-8, without the signs of multiplication and division
PLAIN_SMALL = [chr(k) for k in [*range(0x21, 0x7F), *range(0xDF, 0xF7), *range(0xF8, 0x100)]]
SPACE, LETTER, DIGIT, MARK, ODD, WHOLE = range(6)


def byte_classes() -> np.ndarray:
    """The class of each byte once capitals are small."""
    table = np.full(256, ODD, np.uint8)
    table[space_table()] = SPACE
    table[0x21:0x7F] = MARK
    table[ord("a") : ord("z") + 1] = LETTER
    table[ord("0") : ord("9") + 1] = DIGIT
    table[ord("'")] = ODD
    return table


class Pieces:
    """Finds and hashes the pieces of UTF-8 texts."""

    def __init__(self):
        self.classes, self.values, self.whole_values = byte_classes(), byte_values(lower=False), mix(byte_values(lower=False))
        self.small = np.arange(256, dtype=np.uint8)
        self.small[ord("A") : ord("Z") + 1] += 32
        self.up, self.down = powers(SEGMENT + 1)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Starts, ends and hashes of the pieces, whether each is a whole word, and the first piece of each text (one more at the end)."""
        n = len(data)
        if n >= len(self.up):
            self.up, self.down = powers(n + 1)
        small = self.small[data]
        kind = self.classes[small]
        lead = np.flatnonzero(data == LETTER_LEAD)
        after = data[lead + 1]
        letter = (after != NO_LETTERS[0]) & (after != NO_LETTERS[1])
        lead, after = lead[letter], after[letter]
        kind[lead] = kind[lead + 1] = LETTER
        small[lead[after <= LAST_CAPITAL] + 1] += 32
        special = np.flatnonzero(data[:-1] == ord("<"))
        kind[special[data[special + 1] == ord("|")]] = ODD
        cut = np.zeros(n + 1, bool)  # places that no piece crosses
        cut[offsets] = True
        cut[0] = cut[n] = True
        values = self.values[small]
        odd = np.flatnonzero(kind == ODD)
        if len(odd):
            space = kind == SPACE
            edge = cut.copy()
            edge[1:n] |= space[1:] != space[:-1]
            edges = np.flatnonzero(edge)
            words = np.unique(np.searchsorted(edges, odd, "right") - 1)
            change = np.zeros(n + 1, np.int8)
            change[edges[words]] += 1
            change[edges[words + 1]] -= 1
            inside = np.flatnonzero(np.cumsum(change[:n], dtype=np.int8))
            kind[inside] = WHOLE
            values[inside] = self.whole_values[data[inside]]
        cut[1:n] |= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        edges = np.flatnonzero(cut)
        starts, ends = edges[:-1], edges[1:]
        real = kind[starts] != SPACE
        starts, ends = starts[real], ends[real]
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        values *= self.up[:n]
        np.cumsum(values, out=total[1:])
        hashes = mix((total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
        return starts, ends, hashes, kind[starts] == WHOLE, np.searchsorted(starts, offsets)


class Encoder:
    """Keeps the ids of pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = Pieces()
        self.kept: dict[int, bytes] = {}
        self.bytes_of = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in PLAIN_SMALL}

    def ids_of(self, pieces: list[bytes], whole: list[bool]) -> list[bytes]:
        """The packed ids of pieces and whole words."""
        out = [b""] * len(pieces)
        odd = [k for k, is_whole in enumerate(whole) if is_whole]
        found = self.tokenizer.encode_batch_fast([pieces[k].decode() for k in odd], add_special_tokens=False)
        for k, encoding in zip(odd, found, strict=True):
            out[k] = np.array(encoding.ids, "<u4").tobytes()
        for k, piece in enumerate(pieces):
            if not whole[k]:
                tokens = self.tokenizer.model.tokenize(piece.decode().lower().translate(self.bytes_of))
                out[k] = np.array([t.id for t in tokens], "<u4").tobytes()
        return out

    def flat(self, data: np.ndarray, offsets: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts that lie side by side in ``data``, one after the other, and where those of each text start, and the end."""
        starts, ends, hashes, whole, place = self.pieces.of(data, offsets)
        long = np.flatnonzero(ends - starts > LONG_PIECE)
        hashes[long] = np.arange(len(long), dtype=np.uint64)  # told by their place; a hash as small is as likely as any clash of two
        different, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.kept) + len(different) > KEPT_PIECES:
            self.kept = {}
        names = different.tolist()
        found = list(map(self.kept.get, names))
        found[: len(long)] = [None] * len(long)  # the smallest numbers
        new = [k for k, ids in enumerate(found) if ids is None]
        at = first[new]
        spelled = [data[a:b].tobytes() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
        for k, ids in zip(new, self.ids_of(spelled, whole[at].tolist()), strict=True):
            found[k] = ids
            if k >= len(long):
                self.kept[names[k]] = ids
        found.append(b"" if end_id is None else np.array([end_id], "<u4").tobytes())
        which = np.insert(which, place[1:], len(found) - 1)  # the end of each text as one more piece
        pool = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        heads = np.cumsum(sizes) - sizes
        n = sizes[which]
        ends = np.cumsum(n)
        ids = pool[np.repeat(heads[which] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        last = place[1:] + np.arange(1, len(offsets))  # pieces up to the end of each text, with those ends
        return ids, np.concatenate([[0], np.concatenate([[0], ends])[last]])

    def of_long(self, data: np.ndarray, end_id: int | None) -> Iterator[np.ndarray]:
        """The ids of one text, piece by piece; a piece ends at white space."""
        space, at = space_table(), 0
        while at < len(data):
            end = at + SEGMENT
            while end < len(data) and not (back := np.flatnonzero(space[data[at:end]])).size:
                end += SEGMENT
            end = at + int(back[-1]) + 1 if end < len(data) else len(data)
            yield self.flat(data[at:end], np.array([0, end - at]), None)[0]
            at = end
        if end_id is not None:
            yield np.array([end_id], np.uint32)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str) -> Encoder:
    return once(f"encoder {path}", lambda: Encoder(path))


def encode_column(column: pa.Array, path: str, end_id: int | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The ids of an Arrow column of texts, about a megabyte of text at a time: first row, ids one after the other, and where each row's start, and the end."""
    own = encoder(path)
    for row, data, offsets in runs_of_rows(column):
        if len(offsets) == 2 and len(data) > SEGMENT:
            ids = np.concatenate([np.zeros(0, np.uint32), *own.of_long(data, end_id)])
            yield row, ids, np.array([0, len(ids)])
        else:
            yield row, *own.flat(data, offsets, end_id)


def encode(docs: DataFrame, path: str | None = None, end_id: int | None = END_ID) -> DataFrame:
    """``doc_id, ids, n_tokens``: the ids of every whole text and the end id, packed as 32-bit numbers.

    A null text counts as empty and gives the end id alone. ``path`` is a tokenizer file that every executor can read.
    """
    path = path or tokenizer_path()

    def run(batches):
        for batch in batches:
            for row, ids, offsets in encode_column(batch.column(1), path, end_id):
                n = len(offsets) - 1
                places, content = pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))
                packed = pa.Array.from_buffers(pa.binary(), n, [None, places, content])
                sizes = pa.array(np.diff(offsets).astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, n), packed, sizes], names=["doc_id", "ids", "n_tokens"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, "doc_id bigint, ids binary, n_tokens bigint")


def with_token_counts(docs: DataFrame, columns: list[str], path: str | None = None, end_id: int | None = END_ID) -> DataFrame:
    """``columns`` of every row and ``n_tokens``, the number of ids of its whole text; null and empty texts have the end id alone."""
    path = path or tokenizer_path()
    kept = docs.select(*columns, whole_text().alias("_text"))

    def run(batches):
        for batch in batches:
            for row, _, offsets in encode_column(batch.column(len(columns)), path, end_id):
                few = batch.slice(row, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays([*few.columns[:-1], pa.array(np.diff(offsets).astype(np.int64))], names=[*columns, "n_tokens"])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields[:-1], T.StructField("n_tokens", T.LongType())]))
