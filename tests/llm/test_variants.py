import random
import re
from collections import Counter
from zlib import crc32

from hourcast.llm import variants
from hourcast.llm.queries import QUERIES
from .conftest import SCHEMA


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def words_of(rows, planted=31):
    out = Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = crc32(f"{'' if doc is None else doc}:{w}".encode())
            if planted and h % planted == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                out[w] += 1
    return {w: n for w, n in out.items() if n >= 2}


def expected(count):
    table = {}
    for w, n in count.items():
        others = sorted((-m, x) for x, m in count.items() if near(w, x))
        good = others and -others[0][0] >= 10 * n
        table[w] = (n, len(others), others[0][1] if good else None, -others[0][0] if good else None)

    def root(w):
        return root(table[w][2]) if table[w][2] else w
    return {w: (form, root(w), n, k, m) for w, (n, k, form, m) in table.items()}


def corpus(seed, docs=60):
    rng = random.Random(seed)
    base = ["".join(rng.choices(["an", "er", "th", "in", "ö", "s", "×", "ll"], k=rng.randint(4, 9))) for _ in range(60)]
    rows = []
    for i in range(docs):
        out = []
        for _ in range(120):
            w = base[min(int(rng.expovariate(0.08)), 59)]
            if rng.random() < 0.2:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("anex") + w[k:], w[:k] + rng.choice("anex") + w[k + 1:]])
            out.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "-", "1", "Ā"]).join(out)))
    return rows


def test_query_equals_all_pairs(spark, docs, tmp_path):
    rows = corpus(1) + [(500, None), (501, ""), (None, "Variante VARIANTE variantes"), (7, "straÿenname straÿenname "), (7, "x" * 5000)]
    rows += [(600 + i, "chainword " * 50 + "chainwords " * 4 + "chainwordsx " * (i < 2)) for i in range(8)]
    docs(rows, 4).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.word: tuple(r)[1:] for r in QUERIES["op12_spelling_variants"](spark, str(tmp_path)).collect()}
    assert got == expected(words_of(rows))
    assert any(r[0] and r[1] != r[0] for r in got.values())  # a chain of forms


def test_every_near_pair_shares_a_signature():
    rng = random.Random(4)
    for _ in range(300):
        w = "".join(rng.choices("aabcdeé", k=rng.randint(7, 14)))
        k = rng.randrange(len(w))
        for x in (w[:k] + w[k + 1:], w[:k] + "z" + w[k:], w[:k] + "z" + w[k + 1:], w[:k] + "a" + w[k:]):
            if x != w:
                keys = [{r: set(row) for r, row in ((r, k[i].tolist()) for r, k in variants.signatures([a.encode("latin-1") for a in (w, x)]))}
                        for i in (0, 1)]
                assert keys[0][0] & keys[1][0] or keys[0][1] & keys[1][2] or keys[0][2] & keys[1][1]


def test_ties_go_to_the_smaller_word(spark):
    rows = [("wordsaa", 50), ("wordsab", 50), ("wordsac", 5), ("wordsad", 3), ("alonealone", 9)]
    out = {r.word: r for r in variants.group_variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert out["wordsac"].form == out["wordsad"].form == "wordsaa" and out["wordsaa"].form is None
    assert (out["alonealone"].n_near, out["alonealone"].root, out["alonealone"].form_n) == (0, "alonealone", None)


def test_hot_word_empty_table_and_extra_columns(spark, docs):
    rows = [(i, "repeated " * 200) for i in range(30)]
    table = docs(rows).withColumnRenamed("lang", "word").withColumnRenamed("source", "n")
    assert [tuple(r) for r in variants.count_letters_runs(table).collect()] == [("repeated", 6000)]
    assert variants.group_variants(variants.count_letters_runs(spark.createDataFrame([], SCHEMA))).collect() == []
