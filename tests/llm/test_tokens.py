import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablelift.llm import encode as encoding
from tablelift.llm.encode import END_ID, encode, tokenizer_path
from tablelift.llm.packing import assign, cut, knapsack, pack, padding, sequences, whole_patterns
from tablelift.llm.token_files import read_tokens, with_crc32, write_tokens
from tablelift.session import new_folder


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [END_ID]


def unpacked(value):
    return np.frombuffer(value, "<u4").tolist()


AWKWARD = [
    "it's we'LL  I'd <|endoftext|> a<|startoftext|>b",
    "é ́e 가 ﬁ İstanbul ΑΣ ς",
    "tabs\tand\x0bodd\x0cbreaks\x85next\xa0non line　wide\x1cfs",
    "numbers 12345 a1b2 ¼ ٣ !!!???... —–-",
    "﻿bom ​zero ‍ joiner 👩‍👩‍👧 🇩🇪",
]


def test_words_give_the_ids_of_whole_texts(docs_of, whole):
    df = docs_of(AWKWARD + [None, "", " \n"])
    for row, text in zip(encode(df).orderBy("doc_id").collect(), [*AWKWARD, None, "", " \n"], strict=True):
        assert unpacked(row.ids) == whole(text), text


def test_documents_have_the_ids_of_whole_texts(spark, small, whole):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = encode(docs).collect()
    assert len(found) == len(texts)
    for row in found:
        assert unpacked(row.ids) == whole(texts[row.doc_id])
        assert row.n_tokens == len(row.ids) // 4


def test_a_full_store_of_words_starts_afresh(monkeypatch):
    monkeypatch.setattr(encoding, "KEPT_PIECES", 3)
    own = encoding.Encoder(tokenizer_path())
    for text in [b"a b c", b"d e a b", b"a"]:
        ids = own.tokenizer.encode(text.decode(), add_special_tokens=False).ids
        assert own.flat(np.frombuffer(text, np.uint8), np.array([0, len(text)]), None)[0].tolist() == ids


def test_random_strings_give_the_ids_of_whole_texts(whole):
    rng = random.Random(17)
    parts = ["It's", "we'LL", "''s", "\"'t", "x'y", "ÀÉß×÷ÿ", "Ã", "é", "e\u0301", "<|", "<|endoftext|>", "<", "|", "12", "a1B2", "--", "漢", "\x00", "\x7f", "Zoë's", "ÿÀ9", " ", "\n", "\t", "\x85", "\xa0", "ŉ", "ſ", "K"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000)]
    found = []
    for _, ids, offsets in encoding.encode_column(pa.array(texts), tokenizer_path(), END_ID):
        found += [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]
    assert found == [whole(t) for t in texts]


def test_runs_and_long_words(whole):
    """Texts side by side, empty ones, words too long to keep, one text of several pieces."""
    texts = ["", "one two", " ", "x" * 65 + " one " + "y" * 300 + " " + "x" * 65, "é" * 40 + " <|endoftext|>" * 3, "", "two\n"]
    texts += ["long " * 5 + "w" * 1_200_000 + " word " * 250_000 + "é" * 700_000, "last one", "", ""]
    column = pa.array(["cut off", *texts])[1:]
    found = []
    for row, ids, offsets in encoding.encode_column(column, tokenizer_path(), END_ID):
        assert row == len(found)
        found += [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]
    assert found == [whole(t) for t in texts]


def test_files_round_trip(odd, spark, whole):
    folder = new_folder(spark, "files")
    write_tokens(odd, folder, parts=3)
    rows = read_tokens(spark, folder).collect()
    rows.sort(key=lambda r: r.start)
    texts = defaultdict(list)
    for r in odd.collect():
        texts[r.doc_id].append(r.text or "")
    at, before = 0, None
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.doc_id is None or before is None or r.doc_id >= before
        own = [t for t in texts[r.doc_id] if whole(t) == r.ids]
        assert own
        texts[r.doc_id].remove(own[0])
        at, before = at + r.n_tokens, r.doc_id
    assert not any(texts.values())
    for a in with_crc32(read_tokens(spark, folder)).collect():
        b = next(r for r in rows if r.start == a.start)
        assert a.ids_crc32 == zlib.crc32(np.array(b.ids, "<u4").tobytes())


def test_files_can_be_read_in_part(spark, small):
    folder = new_folder(spark, "files")
    write_tokens(spark.read.parquet(f"{small}/documents.parquet"), folder, parts=2)
    wanted = read_tokens(spark, folder).where("doc_id = 7").select("doc_id", "n_tokens")
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1]
    assert wanted.count() == 1
    import pyarrow.parquet as pq

    for name in spark.read.parquet(folder).inputFiles():
        group = pq.ParquetFile(name.removeprefix("file://")).metadata.row_group(0)
        columns = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
        for plain in ("doc_id", "local_start", "n_tokens"):
            assert columns[plain].has_column_index and "DELTA_BINARY_PACKED" in columns[plain].encodings
        assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings


def test_no_files(none, spark):
    folder = new_folder(spark, "files")
    write_tokens(none, folder)
    assert read_tokens(spark, folder).count() == 0


def test_knapsack_by_brute_force():
    value = np.array([0.2, 0.55, 0.6, 1.3])
    best, number = knapsack(value, 7)
    assert best == pytest.approx(1.3 + 0.6) or best == pytest.approx(1.3 + 0.55 + 0.2)
    assert number @ value == pytest.approx(best) and number @ np.arange(1, 5) <= 7


@pytest.mark.parametrize("seed", range(5))
def test_patterns_take_every_item_once_with_few_sequences(seed):
    draw = np.random.default_rng(seed)
    demand = draw.integers(0, [3, 40, 400, 5000, 2][seed], 64)
    patterns = whole_patterns(demand, 64)
    total = sum(times * pattern for pattern, times in patterns)
    assert (total == demand).all()
    assert all(pattern @ np.arange(1, 65) <= 64 for pattern, _ in patterns)
    least = -(-int(demand @ np.arange(1, 65)) // 64)
    assert assign(demand, 64).sequences <= max(least * 1.03, least + 6) + (demand[32:].sum() > least * 0.9) * least


def check_places(pieces, capacity):
    docs, filled = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append((p.start, p.length, p.doc_tokens))
        filled[p.sequence_id].append((p.offset, p.length))
    for parts in docs.values():
        at = 0
        for start, length, total in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == total
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(filled) == list(range(len(filled)))
    return filled


def test_documents_are_packed_with_little_padding(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    placed = pack(cut(encode(docs)))
    filled = check_places(placed.collect(), 4096)
    tokens = sum(n for parts in filled.values() for _, n in parts)
    assert 1 - tokens / (4096 * len(filled)) < 0.05
    assert placed.agg(padding()).first()[0] == pytest.approx(1 - tokens / (4096 * len(filled)))


def test_blocks_and_other_sizes(spark):
    tokens = spark.range(3000).select(F.col("id").alias("doc_id"), F.pmod(F.hash("id"), F.lit(90)).cast("bigint").alias("n_tokens"))
    placed = pack(cut(tokens, 64, ids=None), 64, grid=4, block_rows=10).collect()
    filled = check_places(placed, 64)
    assert 1 - sum(p.length for p in placed) / (64 * len(filled)) < 0.06


@pytest.mark.parametrize("length, pieces, least", [(1, 512, 1), (1, 5000, 2), (10, 4090, 10), (9, 4550, 10)])
def test_short_pieces_are_packed_by_their_exact_lengths(spark, length, pieces, least):
    tokens = spark.range(pieces).select(F.col("id").alias("doc_id"), F.lit(length).cast("bigint").alias("n_tokens"))
    assert len(check_places(pack(cut(tokens, ids=None)).collect(), 4096)) == least


def test_short_pieces_fill_the_room_of_longer_ones(spark):
    # 300 pieces of 4000 leave 96 places each, which 9 pieces of 10 and one of 6 fill.
    length = F.when(F.col("id") < 300, 4000).when(F.col("id") < 3000, 10).otherwise(6)
    tokens = spark.range(3300).select(F.col("id").alias("doc_id"), length.cast("bigint").alias("n_tokens"))
    assert len(check_places(pack(cut(tokens, ids=None)).collect(), 4096)) == 300


def test_sequences_hold_the_ids_of_their_pieces(odd, spark):
    tokens = encode(odd.dropDuplicates(["doc_id"]))
    placed = pack(cut(tokens))
    whole_ids = {r.doc_id: unpacked(r.ids) for r in tokens.collect()}
    expected = defaultdict(list)
    for p in sorted(placed.collect(), key=lambda p: (p.sequence_id, p.offset)):
        expected[p.sequence_id] += whole_ids[p.doc_id][p.start : p.start + p.length]
    got = sequences(placed).collect()
    assert len(got) == len(expected)
    for r in got:
        ids = unpacked(r.ids)
        assert ids[: r.n_tokens] == expected[r.sequence_id] and not any(ids[r.n_tokens :])
        assert len(ids) == 4096 or len(ids) == r.n_tokens and r.n_tokens & (r.n_tokens - 1) == 0


def test_odd_and_no_pieces(odd, none):
    assert len(pack(cut(encode(odd))).collect()) >= odd.count()
    assert pack(cut(encode(none))).collect() == []
