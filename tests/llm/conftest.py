import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, n: int, words: int = 400) -> str:
    r = random.Random(seed)
    stock = ["".join(r.choice("abcdeéilnorstuü") for _ in range(r.randrange(2, 9))) for _ in range(words)]
    out = []
    for i in range(n):
        out.append(r.choice(stock) + ("." if i % 9 == 8 else "") + ("\n" if i % 27 == 26 else " "))
    return "".join(out)


def changed(text: str, at: int, word: str) -> str:
    w = text.split(" ")
    w[at] = word
    return " ".join(w)


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text): empty and tiny texts, copies, near copies, repeats, non-ASCII, one long text."""
    a, b, c = prose(1, 120), prose(2, 80), prose(3, 90)
    texts = [
        None, "", " \n\t \n", "one", "One two THREE", "one two three", a, a, changed(a, 40, "other"), changed(a, 10, "another"), b, b + "\n" + c, c,
        "a " * 200, "line that is long enough to be compared here\n" * 3, "line that is long enough to be compared hero\nshort\nshort",
        "lime that is long enough to be compared hero!\n\nΣΟΦΟΣ İstanbul 😀 <|endoftext|> don't", prose(9, 3000, 2000), prose(10, 60) + "\r\n" + prose(10, 60),
        "#*$ " * 60, "12345 !!! ---", "no other line is like this one, which ends in ab\nno other line is like this one, which ends in ba",
    ]
    return list(enumerate(texts))


def frame(spark, rows):
    langs = ["en", "de", None]
    return spark.createDataFrame([(d, t, langs[(d or 0) % 3], ["x", "y", None][(d or 0) % 3], len(t or "")) for d, t in rows], DOCS)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: frame(spark, rows)
