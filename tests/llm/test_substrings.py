import random

import pytest

from hourcast.llm import common, substrings
from .conftest import SCHEMA


def brute(rows, width):
    last, words, first = float("inf"), {}, {}
    table = [(last if i is None else i, (t or "").encode().split()) for i, t in rows]
    for i, w in table:
        for s in range(len(w) - width + 1):
            k = tuple(w[s:s + width])
            first[k] = min(first.get(k, (last, last)), (i, s))
    out = []
    for (doc, _), (i, w) in zip(rows, table):
        gone = set()
        for s in range(len(w) - width + 1):
            if first[tuple(w[s:s + width])] < (i, s):
                gone |= set(range(s, s + width))
        out.append((doc, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def corpus(words, seed):
    rng = random.Random(seed)
    passages = [words(rng.randint(5, 60), 50 + k) for k in range(6)]
    rows = []
    for i in range(60):
        own = []
        for _ in range(rng.randint(0, 5)):
            own += rng.choice(passages) if rng.random() < 0.5 else words(rng.randint(1, 40), seed * 991 + i * 31 + len(own))
        rows.append((i, rng.choice([" ", "\n", "\t  "]).join(own)))
    rows += [(100 + k, rows[k][1]) for k in range(10)]  # exact copies
    rows += [(200, None), (201, ""), (202, "w " * 3000), (203, "é ü " * 200), (None, rows[3][1]), (204, "a\x85b c " * 30)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width,cells,segment,chunk", [(20, None, substrings.SEGMENT, substrings.CHUNK), (5, None, 4096, 3000),
                                                       (5, 256, 64, 2000), (1, 64, 64, 5000)])
def test_equals_brute_force(docs, words, width, cells, segment, chunk):
    """Also with a sketch so small that nearly every window looks repeated."""
    rows = corpus(words, width)
    got = substrings.remove_repeats(docs(rows, 4), width=width, cells=cells, segment=segment, chunk=chunk).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, width)


def test_hot_passage(docs, words):
    """A passage in every document costs one row per chunk, and stays once."""
    passage = words(30, 1)
    rows = [(i, " ".join(words(10, 1000 + i) + passage + words(10, 5000 + i))) for i in range(200)]
    got = substrings.remove_repeats(docs(rows, 4), chunk=8000).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 20)
    assert sum(r.n_removed >= 30 for r in got) == 199


def test_rows_with_equal_id(docs, words):
    text = " ".join(words(40, 3))
    got = substrings.remove_repeats(docs([(1, text), (1, text), (1, text + " more"), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (1, 0), (2, 40)]


def test_empty(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_packed_cells_round_trip():
    import numpy as np
    for cells in ([], [0], [5], [0, 1, 2 ** 22 - 1], sorted(random.Random(1).sample(range(2 ** 22), 1000))):
        cells = np.array(cells, np.uint32)
        assert (common.unpack_gaps(common.pack_gaps(cells)) == cells).all()


def test_packed_longs_round_trip():
    import numpy as np
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        a = rng.integers(-2**63, 2**63 - 1, n)
        b = np.sort(rng.integers(0, 2**40, n))
        assert (common.unpack_longs(common.pack_longs(a, b), 2) == np.stack([a, b])).all()
