"""Spelling variants by PartEnum signatures over letter multisets.

A word's letters are a binary vector with one dimension per (letter, occurrence).
Words that differ by one replaced letter have vectors at Hamming distance 2, by
one inserted letter at distance 1.

1. Words are counted: runs of letters per document, added up per task first.
2. Partition and enumerate: a hash deals the dimensions into parts. At distance k
   at most k parts differ, so of all ways to leave out k parts one leaves equal
   rests; each rest is a signature. Words of equal length leave out 2 of 4 parts
   (6 signatures), words one letter apart in length 1 of 3. Multisets alone are no
   selective key for words built of the same syllables, so every signature is
   refined by the half of the word that one edit cannot touch (it lies in the
   first half or in the second), which splits hot signatures without loss.
3. Signatures are equi-joined and each pair is verified by its edit distance.
4. A word's form is its most frequent near word if that occurs ``ratio`` times as
   often; roots follow by pointer jumping (each round doubles the steps).

Defined cases: a null text has no words; a null id counts as empty text where ids
choose planted deletions. Ties between forms go to the smaller word in code-point
order. Repeated rows count each. Without words the result is empty.
"""
from __future__ import annotations

from collections import Counter
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, discard, materialize, mix64, word_hashes

LEAST, OFTEN, RATIO = 7, 2, 10
SAME_PARTS, NEXT_PARTS = 4, 3
#: distinct words that a task counts before it passes them on
HELD = 1 << 19
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
#: Latin-1 bytes: A-Z lower-cased, a-z and U+00C0-U+00FF kept, all else a space
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))

#: role: 0 for pairs of equal length, 1 the shorter and 2 the longer of a pair
SIGNED = "key long, role byte, word string, n long"


def _counted(least: int, planted: int):
    def run(batches):
        held: Counter = Counter()

        def rows():
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()),
                                              pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for whole in batches:
            for batch in batches_of(whole, "text"):
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    words = [w for w in (text or "").encode("latin-1", "replace").translate(_LETTERS).split() if len(w) >= least]
                    if planted:
                        base = crc32(b":" if doc is None else b"%d:" % doc)
                        for k, w in enumerate(words):
                            h = crc32(w if w.isascii() else w.decode("latin-1").encode(), base)
                            if h % planted == 0:
                                words[k] = w[:h % len(w)] + w[h % len(w) + 1:]
                        words = [w for w in words if len(w) >= least]
                    held.update(words)
                if len(held) >= HELD:
                    yield rows()
        yield rows()
    return run


def count_letters_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST,
                       often: int = OFTEN, planted: int = 0) -> DataFrame:
    """(word, n): lower-cased runs of at least ``least`` letters that occur
    ``often`` times. With ``planted``, the crc32 h of ``<id>:<run>`` drops the
    letter h mod length of a run wherever ``planted`` divides h."""
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = body.mapInArrow(_counted(least, planted), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= often)


def _salt(k: int, which: int) -> np.uint64:
    return np.uint64((k + 1) * int(_ODD[which]) % 2**64)


def _rests(words: list[bytes], parts: int, leave: int) -> np.ndarray:
    """Hash of each word's vector without each choice of ``leave`` parts."""
    size = np.array([len(w) for w in words])
    letter = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    row = np.repeat(np.arange(len(words)), size)
    order = np.lexsort((letter, row))
    row, letter = row[order], letter[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (letter[1:] != letter[:-1])
    place = np.arange(len(row))
    occurrence = place - np.maximum.accumulate(np.where(new, place, 0))
    element = mix64((occurrence << 8 | letter).astype(np.uint64) + _ODD[0])
    part = (mix64(element + _ODD[1]) % np.uint64(parts)).astype(np.int64)
    sums = np.zeros((len(words), parts), np.uint64)
    np.add.at(sums, (row, part), element)
    total = sums.sum(axis=1, dtype=np.uint64)
    out = []
    for k, gone in enumerate(combinations(range(parts), leave)):
        rest = total - sums[:, list(gone)].sum(axis=1, dtype=np.uint64)
        out.append(mix64(rest + _salt(k, 2)))
    return np.stack(out, axis=1)


def signatures(words: list[bytes]) -> list[tuple[int, np.ndarray]]:
    """(role, keys) with one row of keys per word; two words at edit distance
    one share a key of roles 0 and 0, or of roles 1 and 2."""
    size = np.array([len(w) for w in words], np.uint64)

    def halves(shorter):
        """Hashes of what precedes and what follows the middle of the shorter."""
        first = [w[:k // 2] for w, k in zip(words, shorter.tolist())]
        last = [w[len(w) - (k - k // 2):] for w, k in zip(words, shorter.tolist())]
        return [mix64(word_hashes(h) + _salt(k, 3)) for k, h in enumerate((first, last))]

    def keys(rests, half, shorter, kind):
        base = [mix64(h + shorter * _ODD[1] + np.uint64(kind)) for h in half]
        return np.concatenate([mix64(rests + b[:, None]) for b in base], axis=1).view(np.int64)

    if not words:
        return []
    own, less = halves(size), halves(size - np.uint64(1))
    even, odd = _rests(words, SAME_PARTS, 2), _rests(words, NEXT_PARTS, 1)
    return [(0, keys(even, own, size, 0)), (1, keys(odd, own, size, 1)), (2, keys(odd, less, size - np.uint64(1), 1))]


def _signed(batches):
    for whole in batches:
        for at in range(0, whole.num_rows, 1 << 14):
            batch = whole.slice(at, 1 << 14)
            words = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            for role, keys in signatures(words):
                own = np.repeat(np.arange(len(words)), keys.shape[1])
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys.ravel()), pa.array(np.full(keys.size, role, np.int8)),
                    batch.column(0).take(pa.array(own)), batch.column(1).take(pa.array(own))], ["key", "role", "word", "n"])


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all words at edit distance one, both ways."""
    signed = words.select("word", "n").mapInArrow(_signed, SIGNED).repartition("key")
    a, b = signed.alias("a"), signed.alias("b")
    meet = F.expr("a.key = b.key AND (a.role = 0 AND a.word < b.word OR a.role = 1 AND b.role = 2) "
                  "AND levenshtein(a.word, b.word, 1) = 1")
    pairs = a.join(b, meet).select(F.col("a.word").alias("x"), F.col("a.n").alias("nx"),
                                   F.col("b.word").alias("y"), F.col("b.n").alias("ny")).distinct()
    ways = F.array(F.struct(F.col("x").alias("word"), F.col("y").alias("near"), F.col("ny").alias("near_n")),
                   F.struct(F.col("y").alias("word"), F.col("x").alias("near"), F.col("nx").alias("near_n")))
    return pairs.select(F.inline(ways))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last one. A form is
    more frequent than its word, so there is no cycle."""
    state = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = materialize(state.join(ahead, "root", "left"), "roots")
        discard(state)
        if step.filter(F.col("beyond").isNotNull()).limit(1).count() == 0:
            return step.select("word", "root")
        state = materialize(step.select("word", F.coalesce("beyond", "root").alias("root")), "roots")
        discard(step)


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n and root for (word, n)."""
    words = materialize(words, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = F.col("n_near").isNotNull() & (-F.col("best.less") >= ratio * F.col("n"))
    table = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"))
    table = materialize(table, "variants")
    discard(words)
    last = roots(table.filter(F.col("form").isNotNull()))
    return table.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
