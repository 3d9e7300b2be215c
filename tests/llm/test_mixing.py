import random
import re

import pytest
from pyspark.sql import functions as F

from hourcast.llm import mixing
from hourcast.llm.common import count_words
from .conftest import SCHEMA


def brute_targets(sizes, weights=(1, 2, 3), limit=3):
    """Share by weight; full sources stop; the rest is shared again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, rest, free = {}, float(sum(sizes.values())), set(names)
    while free:
        level = rest / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] >= limit * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        for s in full:
            target[s] = float(limit * sizes[s])
            rest -= target[s]
        free -= full
    return target


def rows(n, seed):
    rng = random.Random(seed)
    sources = ["b", "a", "Z", "é", None, "tiny", "void"] + ["hot"] * 5
    out = []
    for i in range(n):
        s = rng.choice(sources)
        if s == "tiny" and rng.random() < 0.8:
            s = "hot"
        text = None if s == "void" else " ".join(["w"] * int(rng.lognormvariate(3, 1)))
        out.append((i, text, s))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken(docs, seed):
    table = rows(3000, seed)
    got = mixing.mix(docs(table), count_words(F.col("text"))).collect()
    size = {}
    for _, t, s in table:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want, taken = brute_targets(size), {}
    assert len(got) == len(table)
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source])
        assert 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.copies * r["size"]
    for s in size:
        assert abs(taken[s] - want[s]) <= 0.05 * want[s] + 3 * 200


def test_copies_differ_by_one_and_sum_to_the_expected(docs):
    """Systematic sampling: floor or ceiling of the expectation, sum within one."""
    got = mixing.mix(docs(rows(2000, 5)), count_words(F.col("text"))).collect()
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        e = own[0].target / own[0].source_size if own[0].source_size else 0
        assert all(abs(r.copies - e) < 1 for r in own)
        assert abs(sum(r.copies for r in own) - e * len(own)) <= 1 + 1e-6


def test_partitioning_does_not_matter(docs):
    table = rows(500, 9)
    runs = [sorted((r.doc_id, r.copies) for r in mixing.mix(docs(table, p), F.length(F.coalesce("text", F.lit("")))).collect()) for p in (1, 8)]
    assert runs[0] == runs[1]


def test_mixture_repeats_rows(docs):
    table = docs(rows(400, 3)).withColumnRenamed("lang", "size").withColumnRenamed("n_chars", "copies")
    out = mixing.mixture(table)
    assert out.columns == table.columns
    want = {r.doc_id: r._copies for r in mixing.mix(table, count_words(F.col("text"))).collect() if r._copies}
    got = {r.doc_id: r["n"] for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert got == want


def test_empty_and_wordless(spark, docs):
    assert mixing.mixture(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [(r.copies, r.target) for r in mixing.mix(docs([(1, None, None), (1, None, None)]), count_words(F.col("text"))).collect()] == [(0, 0.0)] * 2
