import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, draw double, kept boolean, hash string"


@pytest.fixture(scope="session")
def frame(spark):
    """A table of documents with columns whose names clash with those of the operators."""

    def make(texts, langs=None, sources=None, ids=None):
        n = len(texts)
        rows = [(ids[k] if ids else k, t, langs[k] if langs else "en", sources[k] if sources else "s", None if t is None else len(t), 7, 0.5, False, "x") for k, t in enumerate(texts)]
        assert len(rows) == n
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def prose():
    """Seeded words that make texts."""

    def make(n, seed=0, vocabulary=400):
        r = random.Random(seed)
        words = ["".join(r.choices("etaoinshrdlu", k=r.randint(2, 8))) for _ in range(vocabulary)]
        return " ".join(r.choices(words, k=n))

    return make
