import hashlib
from collections import defaultdict

import pytest

from hourcast.llm import exact_dedup
from .conftest import SCHEMA

ROWS = [(1, "a b"), (5, "a b"), (3, "a b"), (2, "a b "), (4, None), (6, ""), (None, "x"), (7, "x"), (None, "only"), (None, "only"),
        (8, "é"), (9, "é"), (10, "A b"), (11, "w " * 30_000), (12, "w " * 30_000)]


def brute(rows, pick):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        own = groups[t or ""]
        ids = [x for x in own if x is not None]
        out.append((i, pick(ids) if ids else None, len(own), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("partitions", [1, 7, 20])
def test_equals_grouping(docs, keep, partitions):
    found = exact_dedup.duplicates(docs(ROWS, partitions), keep=keep).collect()
    got = sorted(((r.id, r.keep_id, r["size"], bytes(r.sha256).hex()) for r in found), key=str)
    assert got == brute(ROWS, max if keep == "max" else min)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({t or "" for _, t in ROWS})
    assert all(r.id == r.keep_id for r in kept)


def test_repeated_rows_leave_one(docs):
    found = exact_dedup.duplicates(docs([(1, "a")] * 50 + [(2, "a")] * 3, 9), keep="max").collect()
    assert [r["size"] for r in found] == [53] * 53 and [r.id for r in found if r.kept] == [2]


def test_drop_keeps_columns_and_clashing_names(spark, docs):
    rows = [(1, "a", 5, "z"), (2, "a", 6, "z"), (3, None, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, rid long, run string")
    out = exact_dedup.drop_duplicates(table, keep="max")
    assert out.columns == table.columns
    assert sorted(map(tuple, out.collect())) == [rows[1], rows[2]]


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.duplicates(empty).collect() == []
    assert exact_dedup.drop_duplicates(empty).collect() == []


def test_no_python_in_plan(docs):
    plan = exact_dedup.tree_merge(exact_dedup.digests(docs(ROWS)), "max")._jdf.queryExecution().toString()
    assert "Python" not in plan.split("Physical Plan")[1].replace("ExistingRDD", "") or "InPandas" not in plan


def test_group_size_is_bounded_by_the_fan_in(docs):
    """However many rows share a text, a run brings one entry per digest."""
    from pyspark.sql import functions as F
    table = exact_dedup.digests(docs([(i, "same") for i in range(400)], 16)).withColumn("size", F.lit(1).cast("long"))
    runs = exact_dedup.merge(table, "min")
    assert runs.count() == runs.select("run").distinct().count()
