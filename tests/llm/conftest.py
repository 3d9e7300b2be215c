import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Builds documents from (doc_id, text) or (doc_id, text, source) rows."""
    def build(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)
    return build


@pytest.fixture
def words():
    """Random words from a small vocabulary, the same on every run."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]
    return lambda n, seed: [random.Random(seed + k * 7919).choice(vocabulary) for k in range(n)]
