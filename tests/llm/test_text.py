import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablelift.llm import text as module
from tablelift.llm.text import Words, runs_of_rows

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def found(texts, lower=False):
    words = Words(lower)
    out = []
    for _, data, offsets in runs_of_rows(pa.array(texts, pa.string()), 50):
        starts, ends, hashes, place = words.of(data, offsets)
        for k in range(len(offsets) - 1):
            span = range(int(place[k]), int(place[k + 1]))
            out.append([(data[starts[w] : ends[w]].tobytes(), int(hashes[w])) for w in span])
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\t\n\x0b\x1c\xa0漢🙂", max_size=40)), max_size=8))
def test_words_and_hashes(texts):
    got = found(texts)
    assert [[w for w, _ in row] for row in got] == [WORD.findall((t or "").encode()) for t in texts]
    by_hash, by_word = {}, {}
    for word, number in (x for row in got for x in row):
        assert by_hash.setdefault(number, word) == word
        assert by_word.setdefault(word, number) == number


def test_small_letters_are_those_of_ascii_only():
    rows = found(["Ab É", "aB é"], lower=True)
    assert rows[0][0][1] == rows[1][0][1]
    assert rows[0][1][1] != rows[1][1][1]


@pytest.mark.parametrize("segment", [7, 64, 1 << 20])
def test_segments_do_not_change_the_result(segment, monkeypatch):
    monkeypatch.setattr(module, "SEGMENT", segment)
    draw = random.Random(1)
    texts = ["".join(draw.choice("abc  \n") for _ in range(draw.choice([0, 5, 300]))) for _ in range(30)] + ["q" * 500]
    small = found(texts)
    monkeypatch.undo()
    assert small == found(texts)


def test_windows_depend_on_order():
    h = np.array([1, 2, 3, 2, 1, 1, 2, 3], np.uint64)
    w = module.windows(h, 3)
    assert len(w) == 6 and w[0] == w[5] and len(set(w.tolist())) == 5
    assert len(module.windows(h, 9)) == 0
