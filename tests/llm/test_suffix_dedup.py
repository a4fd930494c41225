import random
from collections import defaultdict

import numpy as np
import pytest

from tablelift.llm.suffix_dedup import Cutter, common_prefixes, maximal_repeats, remove_repeats, repeat_groups, sliding_least


def plain(rows, size):
    """Every window of every text, looked up."""
    texts = [(t or "").encode() for _, t, *_ in rows]
    times = defaultdict(int)
    for t in texts:
        for k in range(len(t) - size + 1):
            times[t[k : k + size]] += 1
    out = []
    for (doc, *_), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - size + 1):
            if times[t[k : k + size]] > 1:
                gone[k : k + size] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((doc, len(t), int(gone.sum()), runs, bytes(b for b, g in zip(t, gone.tolist(), strict=False) if not g)))
    return sorted(out, key=repr)


def found(df):
    rows = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), r.spans) for r in df.collect()]
    for _, n_bytes, n_removed, n_spans, kept, spans in rows:
        assert n_removed == sum(s.length for s in spans) == n_bytes - len(kept) and n_spans == len(spans)
    return sorted((r[:5] for r in rows), key=repr)


def corpus(rng, letters="abcd "):
    def text(n):
        return "".join(rng.choice(letters) for _ in range(n))

    shared = [text(n) for n in (15, 20, 21, 40, 90, 300)]
    rows = [(k, text(rng.randrange(400))) for k in range(30)]
    for k in range(30, 90):
        middle = rng.choice(shared)
        cut = rng.randrange(len(middle))
        rows.append((k, text(rng.randrange(60)) + middle[cut // 2 :] + text(rng.randrange(60)) + rng.choice(shared) + text(3)))
    rows += [(k, rng.choice(shared) + text(50)) for k in range(90, 130)]  # one start, different ends
    rows += [(200, "x" * 3000), (201, "ab" * 1000), (202, "x" * 19), (203, "é漢🙂" * 30), (204, shared[5] * 3)]
    return rows


def test_least_of_neighbours():
    rng = np.random.default_rng(1)
    for n, width in [(1, 1), (10, 10), (11, 3), (1000, 37), (64, 8)]:
        values = rng.integers(0, 50, n).astype(np.uint64)
        assert sliding_least(values, width).tolist() == [int(values[k : k + width].min()) for k in range(n - width + 1)]


def test_stretches_hold_every_window_once():
    rng = random.Random(3)
    texts = [t.encode() for _, t in corpus(rng)] + [b"", b"q" * 5000]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    cutter = Cutter(20, 7)
    text, start, n, value, again = cutter.cut(data, offsets)
    held = defaultdict(list)
    for k, s, m, v, more in zip(text.tolist(), start.tolist(), n.tolist(), value.tolist(), again.tolist(), strict=True):
        own = [bytes(data[at : at + 20]) for at in range(s, s + m)]
        assert len(set(own)) == len(own) or more
        for at, window in zip(range(s, s + m), own, strict=True):
            assert offsets[k] <= at and at + 20 <= offsets[k + 1]
            held[window].append((at, v))
    assert sorted(at for places in held.values() for at, _ in places) == [
        int(offsets[k]) + at for k, t in enumerate(texts) for at in range(len(t) - 19)
    ]
    assert all(len({v for _, v in places}) == 1 for places in held.values())


def strings_of(rng, letters):
    shared = ["".join(rng.choice(letters) for _ in range(n)) for n in (30, 60, 200)]
    out = [rng.choice(shared)[rng.randrange(20) :] + "".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(40)]
    return [s.encode() for s in out if len(s) >= 20]


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "\x00a"])
def test_suffix_array_and_prefixes(letters):
    strings = strings_of(random.Random(len(letters)), letters)
    owner, place, before, left, common = common_prefixes(strings, 20)
    suffixes = [strings[o][p:] for o, p in zip(owner, place, strict=True)]
    assert suffixes == sorted(s[p:] for s in strings for p in range(len(s) - 19))
    assert left.tolist() == [len(s) for s in suffixes]
    for k in range(1, len(suffixes)):
        one, two = suffixes[k - 1], suffixes[k]
        same = next((n for n, (x, y) in enumerate(zip(one, two, strict=False)) if x != y), min(len(one), len(two)))
        assert common[k] == (same if same >= 20 else 0)
    assert [b if b >= 0 else None for b in before.tolist()] == [strings[o][p - 1] if p else None for o, p in zip(owner, place, strict=True)]


@pytest.mark.parametrize("letters, copies", [("ab", 1), ("abcdefgh", 1), ("abc", 3)])
def test_maximal_repeats_by_their_definition(letters, copies):
    """Every string whose occurrences differ before or start a string, and which no longer string holds in all its places."""
    rng = random.Random(copies)
    strings = sorted(set(strings_of(rng, letters)))
    times = np.array([rng.randrange(1, copies + 1) for _ in strings])
    owner, place, before, left, common = common_prefixes(strings, 20)
    repeats = maximal_repeats(owner, before, left, common, times)
    whole = [set(members) for *_, members in repeats]
    for number in range(len(repeats)):  # inner ones come first
        if repeats[number][1] >= 0:
            assert repeats[number][1] > number
            whole[repeats[number][1]] |= whole[number]
    told = {}
    for (length, _, member, _), places in zip(repeats, whole, strict=True):
        content = strings[owner[member]][place[member] : place[member] + length]
        assert content not in told
        told[content] = {(int(owner[k]), int(place[k])) for k in places}
    expected = defaultdict(set)
    for o, s in enumerate(strings):
        for p in range(len(s)):
            for e in range(p + 20, len(s) + 1):
                expected[s[p:e]].add((o, p))
    good = {}
    for content, places in expected.items():
        copies_of = sum(times[o] for o, _ in places)
        # A place at the end or start of its string differs from all others, its own copies included.
        after = [strings[o][p + len(content)] if p + len(content) < len(strings[o]) else (o, p) for o, p in places]
        ahead = [strings[o][p - 1] if p else (o, p) for o, p in places]
        closed, opened = (len(set(x)) > 1 or isinstance(x[0], tuple) for x in (after, ahead))
        if copies_of > 1 and closed and opened:
            good[content] = places
    assert told == good and len(good) > 20


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 300])
def test_as_every_window_looked_up(spark, docs_of, bucket_bytes):
    rows = corpus(random.Random(5))
    docs = docs_of(rows).repartition(4)
    assert found(remove_repeats(docs, 20, 7, bucket_bytes)) == plain(rows, 20)


def test_production_size(spark, docs_of):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(500)]
    passage = " ".join(rng.choice(words) for _ in range(300))
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(300)))) for k in range(20)]
    rows += [(k, f"{k} {k * 7} " + passage[k:] + f" end {k}") for k in range(20, 40)]
    rows += [(50, passage[:399]), (51, passage[:400]), (52, passage[300:900] + "é" * 300 + passage[300:900])]
    assert found(remove_repeats(docs_of(rows))) == plain(rows, 400)


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(remove_repeats(odd)) == plain(rows, 400)


def test_hot_copies_and_long_texts(spark, docs_of):
    rng = random.Random(11)
    long = "".join(rng.choice("abcdefgh ") for _ in range(1_300_000))
    hot = "".join(rng.choice("abcdefgh ") for _ in range(1000))
    rows = [(1, long), (2, long[1_048_000:1_049_500]), *[(k, hot) for k in range(10, 40)], (40, hot), (40, hot)]
    got = {(r[0], r[1]): r[2:4] for r in found(remove_repeats(docs_of(rows)))}
    assert got[1, 1_300_000] == (1500, 1) and got[2, 1500] == (1500, 1)
    assert got[10, 1000] == got[40, 1000] == (1000, 1)


def test_groups_tell_all_occurrences(spark, docs_of):
    shared = "the quick brown fox jumps over the lazy dog"
    rows = [(1, "A" + shared + "1"), (2, "B" + shared + "2"), (3, "C" + shared[:30] + "3")]
    groups = repeat_groups(docs_of(rows), 20, 7).collect()
    texts = dict(rows)
    of_group = defaultdict(set)
    for g in groups:
        of_group[bytes(g.grp)].add(texts[g.doc_id][g.start : g.start + g.length])
    assert all(len(contents) == 1 for contents in of_group.values())
    assert {g.doc_id for g in groups} == {1, 2, 3}


def test_empty_and_parameters(spark, none, docs_of):
    assert found(remove_repeats(none)) == []
    assert found(remove_repeats(docs_of([(1, "short"), (2, None)]))) == [(1, 5, 0, 0, b"short"), (2, 0, 0, 0, b"")]
    with pytest.raises(ValueError):
        remove_repeats(none, size=500)
    with pytest.raises(ValueError):
        remove_repeats(none, size=20, seed=5)
