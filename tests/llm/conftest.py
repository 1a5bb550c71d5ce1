import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _id string, _th string, g string, shard string, size string, start string"


def make_docs(spark, rows):
    """Rows (doc_id, text[, lang, source]) as a documents table with clashing extra columns."""
    full = []
    for r in rows:
        i, t, lang, src = (*r, "en", "s0")[:4] if len(r) == 2 else r
        full.append((i, t, lang, src, len(t) if t else 0, "x", "x", "x", "x", "x", "x"))
    return spark.createDataFrame(full, DOCS)


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    words = ["".join(rng.choice(["th", "an", "er", "on", "in", "es", "ra", "lo"]) for _ in range(rng.randint(1, 4))) for _ in range(vocabulary)]
    return " ".join(rng.choice(words) for _ in range(n))


def odd_rows():
    """Null and empty texts, null and repeated ids, repeated rows, a very long text."""
    return [
        (None, "a text without an id that is long enough to be a text"),
        (1, None), (2, ""), (3, "   \n "), (4, "word"), (4, "word"), (5, "!!! ???"),
        (6, prose(6, 300)), (6, prose(61, 50)), (7, prose(6, 300)), (8, prose(8, 30_000)), (9, "a\u0000b \U0001F600 漢字かな"),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return make_docs(spark, odd_rows())


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
