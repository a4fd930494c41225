import re
from itertools import permutations

from tablelift.llm.filter_audit import audit_filters

COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
LABELS = "doc_id bigint, quality int, toxic int, code string"


def plain(rows, labels):
    """Every order applied to the documents, filter by filter."""
    good = {d for d, quality, _ in labels if d is not None and quality == 1}
    toxic = {d for d, _, toxic in labels if d is not None and toxic == 1}
    docs = []
    for doc, text, *more in rows:
        text, part = text or "", (more[1] if len(more) > 1 else "s") or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": any(c in text for c in "#$%&*|"),
            "E": doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, *_ in rows),
        }
        docs.append((doc, part, {f for f, bad in fails.items() if bad}))
    out = {}
    for part in {p for _, p, _ in docs}:
        own = [(d, f) for d, p, f in docs if p == part]
        taken = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                taken[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(letter in f for _, f in own) - len(gone),
                    sum(f == {letter} for _, f in own),
                    sum(d in good for d, _ in gone),
                    sum(d in toxic for d, _ in gone),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(taken[order[step - 1]])
    return {(*key, *values) for key, values in out.items()}


def found(spark, docs, labels):
    rated = spark.createDataFrame([(*row, "x") for row in labels], LABELS)
    df = audit_filters(docs.selectExpr("*", "'x' AS code", "'x' AS part", "'x' AS n"), rated)
    assert df.columns == COLUMNS
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_every_order_as_applied(spark, docs_of):
    prose = " ".join(f"word{k}" for k in range(250))
    rows = [
        (1, prose, "en", "a"),
        (2, prose, "en", "b"),
        (3, prose + " #", "en", "a"),
        (4, "ABC " * 300, "en", "a"),
        (5, "abc " * 300, "en", "a"),
        (6, "ABC " * 300, "en", "a"),
        (7, "short", "en", "b"),
        (8, "short", "en", "b"),
        (9, prose.upper() + "|", "en", "b"),
        *[(10 + k, "a hot text that a third of all rows repeat", "en", "ab"[k % 2]) for k in range(9)],
    ]
    labels = [(1, 1, 0), (2, 1, 1), (3, 1, 0), (4, 0, 1), (5, 0, 0), (8, 1, 0), (11, 1, 1), (99, 1, 1)]
    assert found(spark, docs_of(rows), labels) == plain(rows, labels)


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in odd.collect()]
    labels = [(None, 1, 1), (2, None, None), (6, 1, None), (6, 0, 1), (-3, 1, 0)]
    assert found(spark, odd, labels) == plain(rows, labels)


def test_filters_that_fail_on_a_half(docs_of, spark):
    """At the thresholds: 200 words, half of them distinct, 2 % capitals."""
    half = " ".join(f"w{k}" for k in range(100)) + " " + " ".join(f"w{k}" for k in range(100))
    less = " ".join(f"w{k}" for k in range(99)) + " x x" + " ".join(f" w{k}" for k in range(99))
    rows = [(1, half), (2, less), (3, "AB" + "c" * 98), (4, "ABC" + "c" * 97), (5, " ".join(["w"] * 199))]
    assert found(spark, docs_of(rows), []) == plain(rows, [])


def test_empty(spark, none):
    assert found(spark, none, [(1, 1, 1)]) == set()
