import random
import zlib

import numpy as np
import pytest

from hourcast.llm import packing
from hourcast.llm.queries import tokenizer_file
from .conftest import SCHEMA


def total_cost(cuts, place, cost, capacity):
    total, last = 0.0, 0
    for j in cuts:
        size = place[j] - last
        assert size <= capacity
        total += cost[j] + packing.SEQUENCE + (0 if size & (size - 1) == 0 else capacity - size)
        last = place[j]
    return total


@pytest.mark.parametrize("seed", range(6))
def test_cuts_are_the_cheapest(seed):
    rng, capacity = np.random.default_rng(seed), 16
    place = np.concatenate([[0], np.cumsum(rng.integers(1, 9, 60))])
    cost = rng.choice([0.0, 2.0, 9.0], len(place))
    best = [0.0] + [np.inf] * 60
    for j in range(1, 61):
        for i in range(j):
            size = place[j] - place[i]
            if size <= capacity:
                pad = 0 if size & (size - 1) == 0 else capacity - size
                best[j] = min(best[j], best[i] + pad + cost[j] + packing.SEQUENCE)
    cuts = packing.cut(place, cost, capacity)
    assert cuts[-1] == 60
    assert total_cost(cuts, place, cost, capacity) == pytest.approx(best[60])


def check(rows, pieces, capacity=2048, plain=False):
    """Every id lies in one piece; sequences are gapless; ids equal the tokenizer's."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_file())
    tokenizer.encode_special_tokens = plain
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], np.uint32) for i, t in rows}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert zlib.crc32(ids[p.doc_id][p.start:p.start + p.length].tobytes()) == p.ids_crc32
        assert p.doc_tokens == len(ids[p.doc_id]) and p.length > 0
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans, wanted in [(by_doc[i], len(ids[i])) for i in ids] + [(s, None) for s in by_sequence.values()]:
        at = 0
        for a, n in sorted(spans):
            assert a == at
            at += n
        assert wanted is None and at <= capacity or at == wanted
    return by_sequence


def test_pieces_cover_documents(docs, words):
    rng = random.Random(1)
    odd = [None, "", "İstanbul ΣΑΣ ﬁ é é  x y \x1c z", "<|endoftext|> a<|startoftext|>b", "no end " * 9000, "don't we'll I'D 12345 !!?.",
           "𝄞 日本語テキスト", "A.B.C. d! e? f... g", "x" * 5000]
    rows = list(enumerate(odd + [" ".join(words(rng.randint(1, 900), k)).replace("a", "a. ") for k in range(60)]))
    pieces = packing.piece_digests(packing.pack(docs(rows, 2), tokenizer_file(), block=4000)).collect()
    sequences = check(rows, pieces)
    size = [sum(n for _, n in s) for s in sequences.values()]
    padding = sum(2048 - n for n in size if n & (n - 1))
    assert padding < 0.1 * sum(size)


def test_special_strings():
    """The call of the contract gives special ids; ``plain`` takes them as text."""
    from tokenizers import Tokenizer
    text = "<|endoftext|> a<|startoftext|>b word<|endoftext|>."
    tokenizer = Tokenizer.from_file(tokenizer_file())
    assert packing.Encoder(tokenizer_file())(text.encode()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    tokenizer.encode_special_tokens = True
    assert packing.Encoder(tokenizer_file(), plain=True)(text.encode()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert packing.Encoder(tokenizer_file())(b"<|endoftext|> a<|startoftext|>b").tolist() == [49407, 320, 49406, 321]


def test_words_apart_equal_the_whole_text():
    from tokenizers import Tokenizer
    tokenizer, encode = Tokenizer.from_file(tokenizer_file()), packing.Encoder(tokenizer_file())
    assert encode.apart and encode.fold
    marks, rng = ["", ".", ",", "...", "!?", "'s", "'ll.", ";:", "-x", "’", "é.", "1.", ".5"], random.Random(2)
    text = " ".join(rng.choice(["Word", "word", "IT", "don", "a", "ABC", "I"]) + rng.choice(marks) for _ in range(3000))
    assert encode(text.encode()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_order_is_kept_within_a_sequence(docs):
    rows = [(k, "some words here. " * 30) for k in range(50)]
    pieces = packing.pack(docs(rows, 1), tokenizer_file()).collect()
    assert len({p.sequence_id for p in pieces}) > 1
    stored = [(p.sequence_id, p.offset) for p in pieces]
    assert stored == sorted(stored)


def test_repeated_rows_and_empty(spark, docs):
    pieces = packing.pack(docs([(1, "a b."), (1, "a b."), (None, None)], 1), tokenizer_file()).collect()
    assert sorted((p.doc_id is None, p.doc_tokens) for p in pieces) == [(False, 4), (False, 4), (True, 1)]
    assert packing.pack(spark.createDataFrame([], SCHEMA), tokenizer_file()).collect() == []


def test_cache_limit_does_not_change_ids():
    texts = [b"one two three four", b"five six one two", b"seven"] * 3
    small, large = packing.Encoder(tokenizer_file(), limit=3), packing.Encoder(tokenizer_file())
    assert all((small(t) == large(t)).all() for t in texts)
