import hashlib
import random
from zlib import crc32

import numpy as np
import pytest

from hourcast.llm import runs
from hourcast.llm.queries import QUERIES
from .conftest import SCHEMA


def brute(words, least=24, exponent=3):
    """All maximal runs by their definition: every period, every stretch."""
    n, out = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                out.setdefault((i, j - i + q), q)  # smaller periods come first
            i = max(j, i) + 1
    return sorted((s, l, q) for (s, l), q in out.items() if not any(
        q % p == 0 and all(words[k] == words[k + p] for k in range(s, s + l - p)) for p in range(1, q)))


def planted(doc, words):
    h = crc32(str(doc).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc, text):
    words = planted(doc, (text or "").encode().split())
    found = brute(words)
    gone = {i for s, l, q in found for i in range(s + q, s + l)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None,) * 3
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{l},{q}\n" for s, l, q in found).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("seed", range(6))
def test_sequences_of_few_words(seed):
    rng = random.Random(seed)
    for _ in range(60):
        out = []
        while len(out) < rng.choice([10, 40, 120, 200]):
            unit = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(1, 12))]
            out += (unit * rng.randint(1, 9))[:rng.randint(1, 70)]
        for least, exponent in ((24, 3), (4, 2), (9, 3)):
            assert runs.find_runs(np.array(out), least, exponent) == brute(out, least, exponent)


def test_nested_and_overlapping_runs():
    unit = [1] * 30 + [2]
    out = runs.find_runs(np.array(unit * 4))
    assert out == brute(unit * 4)
    assert (0, 124, 31) in out and (0, 30, 1) in out and len(out) == 5


def test_long_text_of_one_word():
    assert runs.find_runs(np.zeros(30_000, np.int64)) == [(0, 30_000, 1)]
    two = np.array([0] * 9000 + [1] + [0] * 9000)
    assert runs.find_runs(two) == [(0, 9000, 1), (9001, 9000, 1)]


def test_positions_stay_ordered():
    rng, held = random.Random(3), runs.Positions(50_000)
    seen = {50_000}
    for x in rng.sample(range(50_000), 9000):
        below, above = held.add(x)
        seen.add(x)
        if x % 97 == 0:
            assert below == max((y for y in seen if y < x), default=None)
            assert above == min((y for y in seen if y > x), default=None)
    assert list(held) == sorted(seen)


def test_query_equals_brute_force(spark, docs, words, tmp_path):
    rows = [(i, " ".join(words(random.Random(i).choice([0, 1, 20, 60, 150]), i))) for i in range(160)]
    loop = words(7, 5)
    rows += [(1000, " ".join(loop * 5)), (1000, " ".join(loop * 5)), (1001, "\n".join(loop * 3)), (1002, None), (1003, ""),
             (1004, " \t"), (1005, "x " * 24), (1006, "x " * 23), (1007, "é " * 40 + "a b " * 30)]
    docs(rows, 4).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(i, *expected(i, t)) for i, t in rows], key=str)
    assert sum(r[1] > 0 for r in got) > 8


def test_null_id_extra_columns_and_empty_table(spark, docs):
    table = docs([(None, "a " * 30)]).withColumnRenamed("lang", "runs").withColumnRenamed("source", "best")
    assert [(r.doc_id, [tuple(x) for x in r.runs], r.best, r.text) for r in runs.collapse_runs(table).collect()] == [
        (None, [(0, 30, 1)], 0, "a")]
    assert [r.text for r in runs.plant_runs(table).collect()] == ["a " * 30]
    assert runs.collapse_runs(runs.plant_runs(spark.createDataFrame([], SCHEMA))).collect() == []
