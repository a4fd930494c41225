import pytest

KINDS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs_of(spark):
    """A documents table from texts, ``(doc_id, text)`` or ``(doc_id, text, lang, source)``, with extra columns of awkward names."""

    def make(rows):
        full = []
        for k, row in enumerate(rows):
            row = (k, row) if isinstance(row, str) or row is None else tuple(row)
            doc, text, lang, source = (*row, *(("en", "s") if len(row) == 2 else ()))
            full.append((doc, text, lang, source, len(text or "")))
        df = spark.createDataFrame(full, KINDS)
        for name in ("size", "key", "rank", "score", "th", "block", "range", "ids", "guest", "label", "grp"):
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


ODD = [
    (None, None),
    (None, "no id here but some words in it"),
    (1, None, None, None),
    (2, "", None, "b"),
    (3, " \t\n "),
    (4, "one"),
    (5, "One"),
    (6, "one two three four five six"),
    (6, "one two three four five six"),
    (6, "another text of the same number"),
    (7, "ONE two\tthree  four five six"),
    (8, "Ünïcödé wörds 漢字 emoji 🙂 and é"),
    (9, "... !!! ???"),
    (10, "word " * 30_000),
    (11, "x" * 200_000),
    (12, " ".join(f"w{k}" for k in range(40_000))),
    (-3, "one two three four five six"),
]


@pytest.fixture
def odd(docs_of):
    return docs_of(ODD)


@pytest.fixture
def none(docs_of):
    return docs_of([])
