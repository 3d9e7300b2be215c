import re
from collections import Counter

from hourcast.llm import quality
from .conftest import SCHEMA

GOOD = [f"This is plain text number {k} with several ordinary words in it, written so that nothing repeats. "
        f"Another sentence {k * 7} follows here and says something different about subject {k + 1000}. "
        f"Finally there comes item {k * 13} of a longer story, which ends the paragraph quietly. "
        f"People went home by train {k + 5}, cooked dinner for friends, then read books until midnight came." for k in range(60)]
BAD = [re.sub(r"(\w+)", r"\1***", t) for t in GOOD[:6]] + [t.upper() for t in GOOD[6:12]] + [t.replace(" ", " | ") for t in GOOD[12:18]]
ODD = [None, "", " \t\n\x0b\x0c\r ", "one", "a b c a b c", "x y z x y z x y", "l1 a\nl1 a\n\n\n l1 a\nl1 a", "a b  c", "#*$%&|<>",
       "w w w w w", "the the the", "\n".join(["same line here"] * 60), "word " * 40_000, "é𝄞 ü𝄞"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered |= {i, i + 1, i + 2}
    n, rep = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), rep, n < 50 or 100 * rep > 50 * n)


def test_measures_equal_brute_force(docs):
    rows = list(enumerate(ODD + GOOD[:5] + BAD))
    got = {r.doc_id: tuple(r[m] for m in quality.MEASURES) + (r.base_failed,) for r in quality.assess(docs(rows)).collect()}
    assert got == {i: brute(t) for i, t in rows}


def test_verdicts(docs):
    rows = list(enumerate(GOOD + BAD))
    found = quality.assess(docs(rows)).collect()
    kept = {r.doc_id for r in found if r.kept}
    assert kept >= set(range(len(GOOD)))
    assert not kept & set(range(len(GOOD), len(rows)))
    assert all(0 <= r.posterior <= 1 for r in found)


def test_keep_good_is_the_same_decision(spark, docs):
    table = docs(list(enumerate(GOOD + BAD + ODD))).withColumnRenamed("n_chars", "n_words").withColumnRenamed("lang", "votes")
    out = quality.keep_good(table)
    assert out.columns == table.columns
    found = quality.assess(table).filter("kept").select("doc_id")
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in found.collect()}


def test_empty_and_one_row(spark, docs):
    assert quality.assess(spark.createDataFrame([], SCHEMA)).collect() == []
    assert quality.keep_good(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.kept for r in quality.assess(docs([(1, None)])).collect()] == [False]


def test_em_finds_accuracies(spark):
    """Rules with planted rates: EM comes near them from the same start."""
    import random
    rng = random.Random(3)
    rules = [quality.Rule(f"r{k}", v, "true", g, b) for k, (v, g, b) in enumerate(
        [(-1, 0.02, 0.3), (-1, 0.02, 0.3), (1, 0.9, 0.6), (1, 0.9, 0.6), (-1, 0.02, 0.3)])]
    true = [(0.01, 0.6), (0.05, 0.5), (0.95, 0.2), (0.85, 0.3), (0.02, 0.7)]
    count = Counter()
    for _ in range(20_000):
        good = rng.random() < 0.7
        count["".join("1" if rng.random() < r[0 if good else 1] else "0" for r in true)] += 1
    model = quality.fit(spark.createDataFrame(list(count.items()), "votes string, n long"), rules)
    assert abs(model.prior - 0.7) < 0.05
    for (g, b), (tg, tb) in zip(model.rates, true):
        assert abs(g - tg) < 0.06 and abs(b - tb) < 0.15
    assert all(a > 0.5 for a in model.accuracy(rules).values())
