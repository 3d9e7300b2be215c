import random

import numpy as np
import pytest

from hourcast.llm import trie_join
from .conftest import SCHEMA
from .test_near_dedup import brute, variants


def found(table, **more):
    return {r.id: (r.n_shingles, r.component) for r in trie_join.similar_sets(table, **more).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(docs, words, seed):
    rows = variants(words, seed)
    assert found(docs(rows, 5), chunk=9000, cells=1 << 16, segment=1 << 13) == brute(rows, 80)


def test_other_thresholds(docs, words):
    rows = variants(words, 3, groups=12)
    for percent in (50, 95, 100):
        assert found(docs(rows, 3), percent=percent) == brute(rows, percent)


def test_large_group_of_near_copies(docs, words):
    """Copies with changed words, a hot exact copy, and a template that many
    texts share to less than the threshold."""
    rng, base, rows = random.Random(5), words(120, 99), []
    for i in range(80):
        own = list(base)
        for _ in range(rng.randint(1, 5)):
            own[rng.randrange(len(own))] = f"new{i}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(base)) for i in range(60)]
    rows += [(2000 + i, " ".join(base[:90] + words(40, 7000 + i))) for i in range(40)]
    assert found(docs(rows, 6), chunk=20_000) == brute(rows, 80)


def test_traverse_equals_set_arithmetic():
    rng = np.random.default_rng(3)
    for _ in range(40):
        order = rng.permutation(400).astype(np.int64)  # a global order of n-grams
        base = np.flatnonzero(rng.random(400) < 0.3)
        sets = [np.setxor1d(base, rng.choice(400, rng.integers(0, 40))) for _ in range(30)]
        sets = [order[s] for s in sets if len(s)]
        probe = order[base]
        want = [i for i, s in enumerate(sets) if 100 * (b := len(np.intersect1d(s, probe))) >= 80 * (len(s) + len(probe) - b)]
        assert sorted(trie_join.traverse(probe, sets, 80)) == want


def test_small_tries_give_the_same(docs, words, monkeypatch):
    monkeypatch.setattr(trie_join, "TRIE", 500)
    monkeypatch.setattr(trie_join, "TASK", 1500)
    rows = variants(words, 4, groups=10)
    assert found(docs(rows, 4)) == brute(rows, 80)


def test_null_and_repeated_ids_and_extra_columns(docs):
    text = "some text with more than five words in it"
    table = docs([(4, text), (4, text), (9, text), (None, text), (None, "other"), (7, ""), (8, None)])
    table = table.withColumnRenamed("lang", "grams").withColumnRenamed("source", "chunk")
    out = sorted(((r.id, r.n_shingles, r.component) for r in trie_join.similar_sets(table).collect()), key=str)
    assert out == sorted([(4, 5, 4), (4, 5, 4), (9, 5, 4), (None, 5, 4), (None, 1, None), (7, 0, 7), (8, 0, 8)], key=str)


def test_empty(spark):
    assert trie_join.similar_sets(spark.createDataFrame([], SCHEMA)).collect() == []


def test_short_sequences_differ_from_shingles(docs):
    rows = [(1, "a b c"), (2, "A  b\nc"), (3, "a b c d"), (4, "a b"), (5, "a b c d e")]
    assert found(docs(rows)) == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 4), 5: (1, 5)}
