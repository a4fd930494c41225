import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tablelift.llm import fingerprints, mixing
from tablelift.llm.encode import encode, tokenizer_path
from tablelift.llm.fingerprints import differing, document_fingerprints, edited_fingerprints
from tablelift.llm.mixing import mix
from tablelift.llm.queries import QUERIES, SQL
from tablelift.llm.token_rollup import TokenRollup, count_changes
from tablelift.session import new_folder
from llm.test_exact_dedup import norm
from llm.test_ngram_join import brute
from tools.compare import compare, connect

# Fingerprints


def plain_edits(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (doc, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out[doc] = (len(text), hashlib.sha256(edited.encode()).hexdigest())
    return out


@pytest.mark.parametrize("range_rows", [1, 7, 1000])
def test_edits_take_the_next_document(docs_of, range_rows, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", range_rows)
    rows = [(3 * k % 101, f"Text {k}. " * (k % 9) + "é🙂" * (k % 4)) for k in range(50)]
    rows[4] = (rows[4][0], None)
    found = edited_fingerprints(docs_of(rows)).collect()
    assert {r.doc_id: (r.n_chars, hashlib.sha256(r.edited_text.encode()).hexdigest()) for r in found} == plain_edits(rows)
    assert len(found) == len(rows)


def plain_tree(text):
    """Root, printed form and printed leaves of a text."""
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    sections, own = [], []
    for piece in re.findall(fingerprints.PARAGRAPH, text):
        own.append(sha(piece))
        if own[-1][0] in fingerprints.ENDING or piece.endswith("\n"):
            sections.append(own)
            own = []
    sections += [own] if own else []
    digests = [sha(",".join(s)) for s in sections]
    printed = [f"{d[:16]}=" + ",".join(x[:10] for x in s) for d, s in zip(digests, sections, strict=True)]
    return f"{sha(','.join(digests))}:{';'.join(printed)}", {x[:10] for s in sections for x in s}


def plain_likeness(one, two):
    return 2 * len(one & two) / (len(one) + len(two)) if one or two else 1.0


def test_tree_and_likeness_by_a_plain_version(spark, small, odd):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows = [(k, t) for k, t in enumerate([*texts, "", None, "\n", "one line\nand another\n", "a, b; c | d"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(edited_fingerprints(docs).collect(), key=lambda r: -r.doc_id)
    for k, r in enumerate(found):
        own, following = (plain_tree(rows[found[j % len(found)].doc_id][1] or "") for j in (k, k + 1))
        edited = plain_tree(r.edited_text)
        assert (r.fingerprint, r.edited_fingerprint) == (own[0], edited[0])
        assert r.near_edited == pytest.approx(plain_likeness(own[1], edited[1]))
        assert r.near_next == pytest.approx(plain_likeness(own[1], following[1]))


def test_fingerprints_of_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    expected = plain_edits(list(texts.items()))
    found = {r.doc_id: r for r in edited_fingerprints(docs).collect()}
    prints = defaultdict(set)
    for doc, r in found.items():
        prints[texts[doc]].add(r.fingerprint)
        prints[r.edited_text].add(r.edited_fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert hashlib.sha256(r.edited_text.encode()).hexdigest() == expected[doc][1]
    assert all(len(p) == 1 for p in prints.values())
    assert len({p for x in prints.values() for p in x}) == len(prints)
    long = [r for r in found.values() if r.n_chars > 2000]
    assert sum(r.near_edited for r in long) / len(long) > 0.3
    assert sum(r.near_next for r in long) / len(long) < 0.1


def test_paragraphs_cover_the_text(docs_of):
    texts = ["One. Two two! Three\nfour, five", "x" * 500, "", "\n\n\n", "a" * 64 + ". b", "é" * 65]
    rows = docs_of(texts).select("text", F.regexp_extract_all("text", F.lit(fingerprints.PARAGRAPH), F.lit(0)).alias("p")).collect()
    for r in rows:
        assert "".join(r.p) == r.text and all(0 < len(p) <= fingerprints.LONGEST + 2 for p in r.p)


def test_an_edit_is_located(docs_of):
    text = " ".join(f"Sentence number {k} says {k * k}." for k in range(200))
    df = document_fingerprints(docs_of([text, text.replace("number 100 ", "number one hundred ")]))
    a, b = (r.fingerprint for r in df.orderBy("doc_id").collect())
    assert a.split(":")[0] != b.split(":")[0]
    both = df.sparkSession.createDataFrame([(a, b)], "a string, b string")
    changed = both.select(differing(F.col("a"), F.col("b")).alias("x"), differing(F.col("a"), F.col("a")).alias("same")).first()
    assert 1 <= len(changed.x) <= 2 and changed.same == []


def test_fingerprints_of_odd_and_no_rows(odd, none, docs_of):
    found = edited_fingerprints(odd).collect()
    assert len(found) == odd.count()
    assert edited_fingerprints(none).collect() == []
    (only,) = edited_fingerprints(docs_of(["just one text"])).collect()
    assert only.edited_text == "just onjust o" and only.near_next == 1.0


# Token counts


def test_token_counts_by_a_plain_version(spark, odd, none, tmp_path):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    for number, docs in enumerate((odd, none)):
        docs.write.parquet(f"{tmp_path}/{number}/documents.parquet")
        expected = defaultdict(lambda: [0, 0])
        for r in docs.collect():
            text = r.text or ""
            counts = {"word_bpe_49k": len(tokenizer.encode(text, add_special_tokens=False).ids) + 1}
            if r.doc_id is None or r.doc_id % 10 != 3:
                counts["words-1"] = len(re.findall(r"[^\x20\x09-\x0D]+", text))
            for version, n in counts.items():
                total = expected[r.source, r.lang, version]
                total[0] += 1
                total[1] += n
        found = QUERIES["op7_token_counts"](spark, f"{tmp_path}/{number}").collect()
        assert {(r.source, r.lang, r.version): [r.docs, r.tokens] for r in found} == dict(expected)


def test_held_out_is_never_null(spark, odd, small, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{small}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("op6_language_id", "op10_quality"):
        found = QUERIES[name](spark, str(tmp_path))
        assert found.where("held_out is null or score is null").count() == 0
        assert {r.held_out for r in found.where("doc_id is null").collect()} == {False}


# Mixing


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, held = sum(sizes.values()), set()
    while True:
        open_ones = [s for s in names if s not in held]
        rest = total - sum(3 * sizes[s] for s in held)
        share = rest / max(1, sum(weight[s] for s in open_ones))
        over = [s for s in open_ones if share * weight[s] > 3 * sizes[s]]
        if not over:
            return {s: 3 * sizes[s] if s in held else share * weight[s] for s in names}
        held |= set(over)


@pytest.mark.parametrize("range_rows", [3, 50_000])
def test_mix_meets_its_targets(docs_of, range_rows):
    counts = {"b": 30, None: 5, "a": 1, "é": 4, "Z": 200, "empty": 2}
    rows = []
    for source, n in counts.items():
        rows += [(len(rows) + k, "" if source == "empty" else "w " * (1 + k % 13), "en", source) for k in range(n)]
    found = mix(docs_of(rows), range_rows=range_rows).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    goals = plain_targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goals[r.source])
    for source, goal in goals.items():
        assert goal - 1.001 <= taken[source] <= goal + 1e-6
    again = mix(docs_of(rows[::-1]), range_rows=7).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, again), key=repr)


def test_mix_of_odd_and_no_rows(odd, none):
    assert len(mix(odd).collect()) == odd.count()
    assert mix(none).collect() == []
    assert mixing.targets(none.selectExpr("source", "n_chars AS source_size")).collect() == []


# Token counts


def test_batches_count_once(spark):
    rollup = TokenRollup(spark, new_folder(spark, "rollup"))
    kinds = "change string, source string, lang string, version string, tokens bigint, old_tokens bigint, docs string"
    first = spark.createDataFrame(
        [("insert", "a", "en", "1", 10, None, "x"), ("insert", "a", "en", "1", 5, None, "x"), ("insert", None, None, "1", None, None, "x")], kinds
    )
    second = spark.createDataFrame([("revise", "a", "en", "1", 7, 5, "x"), ("delete", None, None, "1", 0, None, "x")], kinds)
    assert rollup.totals().collect() == []
    assert rollup.apply("b1", first) and rollup.apply("b2", second) and not rollup.apply("b1", first)
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "1", 2, 17)]
    rollup.compact("folded")
    assert rollup.committed() == ["b1", "b2", "folded"] and not rollup.apply("b2", second)
    assert rollup.apply("b3", first.limit(0))
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "1", 2, 17)]


def test_a_broken_batch_counts_for_nothing(spark):
    folder = new_folder(spark, "rollup")
    rollup = TokenRollup(spark, folder)
    row = spark.createDataFrame([("insert", "a", "en", "1", 3)], "change string, source string, lang string, version string, tokens bigint")
    row.selectExpr("source", "lang", "version", "1L AS docs", "tokens").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{folder}/batch=b1")
    assert rollup.totals().collect() == [] and rollup.committed() == []
    assert rollup.apply("b1", row)
    assert rollup.totals().first().tokens == 3
    with pytest.raises(Exception, match="unknown change"):
        rollup.apply("b2", row.withColumn("change", F.lit("odd")))
    with pytest.raises(ValueError):
        rollup.apply("a/b", row)
    assert rollup.committed() == ["b1"]


def test_changes_between_tables(spark):
    kinds = "doc_id bigint, source string, lang string, version string, tokens bigint"
    before = spark.createDataFrame([(1, "a", "en", "1", 4), (2, "a", None, "1", 4), (3, "b", "en", "1", 9), (5, "c", "en", "1", 1)], kinds)
    after = spark.createDataFrame([(1, "a", "en", "1", 6), (2, "b", None, "1", 4), (4, "b", "en", "1", 2), (5, "c", "en", "1", 1)], kinds)
    rollup, other = (TokenRollup(spark, new_folder(spark, "rollup")) for _ in range(2))
    rollup.apply("1", before.withColumn("change", F.lit("insert")))
    rollup.apply("2", count_changes(before, after))
    other.apply("1", after.withColumn("change", F.lit("insert")))
    assert count_changes(before, after).count() == 5
    assert sorted(map(tuple, rollup.totals().collect()), key=repr) == sorted(map(tuple, other.totals().collect()), key=repr)


# Queries and the pipeline


@pytest.mark.parametrize("name", SQL)
def test_query_agrees_with_sql(spark, small, name):
    assert compare(spark, connect(small), small, name) == []


def test_one_query_for_each_operator():
    numbers = [re.match(r"op(\d+)_", n) for n in QUERIES]
    assert sorted(int(n[1]) for n in numbers if n) == list(range(1, 14))


def test_pipeline_stage_by_stage(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, at = docs.columns, {}
    for name, function in corpus_pipeline.STAGES:
        folder = new_folder(spark, name)
        function(spark, docs, small).write.parquet(folder)
        before, docs = docs, spark.read.parquet(folder)
        at[name] = (before.collect(), docs.collect())
        assert name == "packing" or docs.columns == columns
    before, after = at["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    assert all(r in before for r in after) and len(after) < len(before)
    right = [(r.doc_id in kept) == bool(labels[r.doc_id]) for r in before if r.doc_id in labels]
    assert sum(right) > 0.85 * len(right)

    before, after = at["exact_dedup"]
    least = {}
    for r in sorted(before, key=lambda r: r.doc_id):
        least.setdefault(norm(r.text), r)
    assert sorted(after) == sorted(least.values())

    before, after = at["ngram_join"]
    heads = {d for d, _, c in brute([(r.doc_id, r.text) for r in before]) if d == c}
    assert sorted(after) == sorted(r for r in before if r.doc_id in heads)

    before, after = at["mixing"]
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r.source] += len(r.text.split())
    for r in after:
        taken[r.source] += len(r.text.split())
    longest = max(len(r.text.split()) for r in before)
    for source, goal in plain_targets(sizes).items():
        assert abs(taken[source] - goal) <= longest / 2 + 1
    times = defaultdict(int)
    for r in after:
        times[r] += 1
    assert set(times) <= set(before) and max(times.values()) <= 3

    before, after = at["packing"]
    assert sum(r.length for r in after if r.start == 0) > 0
    once = {}
    for r in after:
        once.setdefault((r.doc_id, r.start), r)
    assert {r.doc_id for r in before} == {r.doc_id for r in after}
    assert sum(1 for r in after if r.start == 0) == len(before)
    places = defaultdict(int)
    for r in after:
        places[r.sequence_id] += r.length
    assert max(places.values()) <= 4096


def test_pipeline_stages_take_odd_and_no_rows(spark, odd, none, small):
    texts = {(r.doc_id, r.text) for r in odd.collect()}
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, none, small).count() == 0
        found = function(spark, odd, small)
        if name == "packing":
            assert found.agg(F.sum("length")).first()[0] == encode(odd).agg(F.sum("n_tokens")).first()[0]
            continue
        kept = [(r.doc_id, r.text) for r in found.collect()]
        assert found.columns == odd.columns and set(kept) <= texts
        if name == "exact_dedup":
            assert sorted(norm(t) for _, t in kept) == sorted({norm(t) for _, t in texts})


def test_the_whole_pipeline(spark, small):
    """Each stage by a plain version of its rule, on what the one before it kept."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = {r.doc_id: r.text for r in corpus_pipeline.good_quality(spark, docs, small).collect()}
    first = {}
    for doc in sorted(kept):
        first.setdefault(norm(kept[doc]), doc)
    unique = sorted(first.values())
    alone = [doc for doc, _, component in brute([(doc, kept[doc]) for doc in unique]) if component == doc]
    pieces = corpus_pipeline.run(spark, small).collect()
    assert 0 < len(alone) < len(unique) < len(kept) and {p.doc_id for p in pieces} <= set(alone)
    by_source = {r.doc_id: r.source for r in docs.collect()}
    assert {by_source[p.doc_id] for p in pieces} == {by_source[doc] for doc in alone}
    ends = defaultdict(int)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == ends[p.sequence_id]
        ends[p.sequence_id] += p.length
    assert max(ends.values()) <= 4096
    whole = {r.doc_id: r.n_tokens for r in encode(docs).collect()}
    taken = defaultdict(int)
    for p in pieces:
        taken[p.doc_id] += p.length
    assert all(taken[doc] % whole[doc] == 0 and taken[doc] <= 3 * whole[doc] for doc in taken)
