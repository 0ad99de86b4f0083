"""Fixtures of the tests beside this file, imported by each of them."""

import pytest

SMALL = "/root/testdata/sf0.001"

ODD = [
    # doc_id, text, lang, source
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \t\n\r ", "en", None),
    (4, "one two", "en", "a"),
    (5, "One two", None, "b"),
    (6, "the quick brown fox jumps over the lazy dog again and again and again. " * 4, "en", "a"),
    (7, "the quick brown fox jumps over the lazy dog again and again and again. " * 4, "en", "b"),
    (7, "the quick brown fox jumps over the lazy dog again and again and again. " * 4, "en", "b"),
    (7, "another text altogether, under the same id, that says something else entirely", "en", "c"),
    (None, "the quick brown fox jumps over the lazy dog again and again and again. " * 4, "en", "c"),
    (None, "a text without an id that nobody else has written before in this little table", "fr", "c"),
    (8, "é" * 60 + " ñandú ü 漢字 ́x don't 'S 12½ \x1c\x85    ퟿", "es", "d"),
    (9, "x" * 3000, "xx", "d"),
    (10, "!!! *** ### &&& $$$ %%% |||", "en", "d"),
    (11, "a b c a b c a b c a b c", "en", "e"),
    (12, "line one here\nline two here\n\nline one here\n line one here", "en", "e"),
    (13, "<s>[INST] control [/INST]</s> \\ \\\\ <|endoftext|>", "en", "f"),
    (14, " ".join(f"w{i % 700}" for i in range(20000)), "en", "f"),
]


def frame(spark, rows=ODD, extra=True):
    """The odd rows as a documents table, with columns whose names operators use inside."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(*r, None if r[1] is None else len(r[1])) for r in rows]
    if extra:
        schema += ", n int, node string, dig string, key double, spans string, n_words string, rank int, kept string"
        rows = [(*r, 1, "n", "d", 0.5, None, "w", 3, "k") for r in rows]
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def odd(spark):
    return frame(spark)


@pytest.fixture
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def small(spark):
    """A real table of 200 documents, as a list of rows too."""
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    return df, [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]
