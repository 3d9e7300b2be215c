import pytest

import corpus_pipeline
from hourcast.llm import near_dedup, packing, quality
from hourcast.llm.common import documents
from .test_near_dedup import brute, variants

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's rows, written and read again like the driver does."""
    docs, out = documents(spark, SF), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp(name) / "rows")
        before = docs
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = (before, docs)
    return out


def test_columns(spark, stages):
    columns = documents(spark, SF).columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mix_sources", "pack_sequences"]
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == columns


def test_each_stage_decides(stages):
    ids = {n: [sorted(r.doc_id for r in t.select("doc_id").collect()) for t in pair] for n, pair in stages.items()}
    before, after = stages["quality_rules"]
    assert ids["quality_rules"][1] == sorted(r.doc_id for r in quality.assess(before).filter("kept").collect())
    before, after = stages["exact_dedup"]
    last = {}
    for r in before.collect():
        last[r.text] = max(r.doc_id, last.get(r.text, -1))
    assert ids["exact_dedup"][1] == sorted(last.values())
    before, _ = stages["near_dedup"]
    found = near_dedup.near_duplicates(before).collect()
    assert ids["near_dedup"][1] == sorted(r.id for r in found if r.id == r.component)
    assert set(ids["mix_sources"][1]) <= set(ids["mix_sources"][0])
    before, pieces = stages["pack_sequences"]
    tokens = {}
    for p in pieces.collect():
        tokens.setdefault(p.doc_id, [p.doc_tokens, 0])[1] += p.length
    copies = {i: ids["pack_sequences"][0].count(i) for i in tokens}
    assert all(n == copies[i] * own for i, (own, n) in tokens.items())
    assert set(tokens) == set(ids["pack_sequences"][0])


def test_run_equals_the_stages(spark, stages):
    key = lambda t: sorted((r.doc_id, r.doc_tokens) for r in t.select("doc_id", "doc_tokens").filter("start = 0").collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(stages["pack_sequences"][1])
    assert packing.CAPACITY == 2048


def test_near_stage_links_from_80_percent(spark, docs, words):
    rows = variants(words, 1)
    kept = lambda percent: sorted(i for i, (_, c) in brute(rows, percent).items() if i == c)
    assert kept(80) != kept(85)
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs(rows), SF).collect()) == kept(80)
