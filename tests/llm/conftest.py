import random

import pytest

WORDS = (
    "the of and to in is that it was for on with as be by this are at from river stone window garden "
    "letter number paper market yellow quiet sudden morning evening winter summer bridge forest engine"
).split()


@pytest.fixture
def prose():
    """Deterministic text of n words; ``seed`` tells texts apart."""

    def make(n: int, seed: int) -> str:
        rng = random.Random(seed)
        return " ".join(rng.choice(WORDS) + (str(rng.randrange(50)) if rng.random() < 0.3 else "") for _ in range(n))

    return make


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n_words string"


@pytest.fixture
def documents(spark):
    """Rows (id, text[, lang]) as documents with columns whose names clash with results."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), 0.5, "x") for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make
