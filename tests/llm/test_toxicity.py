import random

import numpy as np

from hourcast.llm import toxicity
from .conftest import SCHEMA


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("lmnoprstaeiou", k=rng.randint(3, 9))) for _ in range(300)]
    bad = ["gruffian", "blorkhead", "snivelling", "wretchful"]
    rows, labels = [], []
    for i in range(n):
        own = rng.choices(plain, k=rng.randint(5, 80))
        toxic = rng.random() < 0.2
        for _ in range(rng.randint(1, 3) if toxic else 0):
            own[rng.randrange(len(own))] = rng.choice(bad)
        rows.append((i, " ".join(own)))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    return rows, labels, bad


def run(spark, docs, rows, labels):
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return toxicity.score(docs(rows), table).collect()


def test_held_out_accuracy(spark, docs):
    rows, labels, bad = corpus()
    odd = [(5000, None), (5001, ""), (5002, "x " * 30_000 + "gruffian"), (None, "blorkhead you gruffian")]
    got = {r.doc_id: r.score for r in run(spark, docs, rows + odd, labels + [(None, 1, 1), (7, 1, None), (8000, 1, 1)])}
    assert len(got) == len(rows) + len(odd) and all(0 <= s <= 1 for s in got.values())
    held = [(any(w in bad for w in t.split()), got[i] >= 0.7) for i, t in rows if i % 3 == 0]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert got[5000] == got[5001] < 0.3 and got[None] > 0.7


def test_score_depends_on_text_only(spark, docs):
    rows, labels, _ = corpus(300)
    twice = rows + [(9000 + i, t) for i, t in rows] + rows[:3]
    got = run(spark, docs, twice, labels)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id % 9000, set()).add(r.score)
    assert len(got) == len(twice) and all(len(s) == 1 for s in by_id.values())


def test_nearest_equals_all_pairs():
    rng = np.random.default_rng(2)
    size = 60
    vectors = sorted({tuple(sorted(rng.choice(size, rng.integers(1, 9), replace=False).tolist())) for _ in range(500)})
    idf = rng.uniform(0.5, 5, size)
    n = len(vectors)
    index = toxicity.Index(vectors, np.ones(n), rng.integers(0, 2, n).astype(float), list(range(n)), idf)
    for _ in range(200):
        q = tuple(sorted(rng.choice(size, rng.integers(1, 9), replace=False).tolist()))
        dense = np.zeros(size)
        dense[list(q)] = idf[list(q)]
        want = np.sort(index.rows @ dense / np.linalg.norm(dense))[::-1][:25]
        score, where = index.nearest(q)
        assert np.allclose(score, want[want > 0][:len(score)]) and len(score) == min(25, (want > 0).sum())


def test_monotone_fit():
    x, y = np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 1.0, 0.0, 1.0])
    knots, values = toxicity.monotone(x, y, np.ones(4))
    assert (np.diff(values) > 0).all() and values.tolist() == [0.0, 0.5, 1.0]


def test_without_labels(spark, docs):
    rows, labels, _ = corpus(60)
    assert {r.score for r in run(spark, docs, rows, [])} == {0.0}
    assert {r.score for r in run(spark, docs, rows, [(1, 1, 1), (2, 1, 1)])} == {1.0}
    assert toxicity.score(spark.createDataFrame([], SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect() == []


def test_index_is_sparse():
    """Thousands of examples over many terms: posting lists, no dense matrix."""
    rng = np.random.default_rng(3)
    n, size = 500, 50_000
    vectors = sorted({tuple(np.unique(np.append(rng.integers(0, size, 30), rng.integers(0, 40, 10))).tolist()) for _ in range(n)})
    idf = rng.uniform(0.5, 5, size)
    index = toxicity.Index(vectors, np.ones(n), np.zeros(n), list(range(n)), idf)
    assert max(x.size for x in vars(index).values() if isinstance(x, np.ndarray)) <= size + 1
    unit = [{t: idf[t] / np.linalg.norm(idf[list(v)]) for t in v} for v in vectors]
    for q in range(0, n, 25):
        want = sorted((sum(unit[q][t] * u[t] for t in unit[q].keys() & u.keys()) for u in unit), reverse=True)[:25]
        assert np.allclose(index.nearest(vectors[q])[0], [x for x in want if x > 0])
