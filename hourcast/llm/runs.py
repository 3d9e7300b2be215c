"""Periodic runs of words by descending-LCP Kruskal.

A run is a stretch of words with smallest period q (words q apart are equal),
at least ``max(min_length, exponent * q)`` words long, that no neighbouring word
extends. All runs of a text, nested and overlapping ones too, are found by

1. sorting the suffixes of its word sequence (prefix doubling, all levels kept)
   and taking the LCP of neighbours from those levels;
2. uniting suffix classes by decreasing LCP with union-find. Each class keeps its
   positions in order, and the smaller class goes into the larger one;
3. seeding a run wherever two positions become neighbours in a class at level l
   and at a distance d <= l: the d + l words from the first one on have smallest
   period d (a smaller one had put a position between them at a higher level) and
   end there. It is a run if no word before it continues the period.

Runs this long need an LCP of ``min_length - min_length // exponent`` at least, so
only texts that repeat a window of that many words (told by hashes, for a whole
batch at once) are sorted, and only such LCPs are united. The work is m log m in
the words m of repeated windows. Texts need no exchange; a text is one unit.

Defined cases: a null text has no words and no runs. Repeated rows are separate
documents, a null id stays null, other columns are not read. An empty table gives
an empty result.
"""
from __future__ import annotations

from bisect import bisect_left
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, mix64, utf8

MIN_LENGTH, EXPONENT = 24, 3
#: positions that one list of an ordered set holds
LOAD = 1024
_ODD = np.uint64(0x9E3779B97F4A7C15)

FOUND = "doc_id long, runs array<struct<start:long,length:long,period:long>>, best int, text string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Positions:
    """An ordered set of positions, in lists short enough to insert into."""

    __slots__ = ("parts", "tops", "size")

    def __init__(self, first: int):
        self.parts, self.tops, self.size = [[first]], [first], 1

    def __iter__(self):
        for part in self.parts:
            yield from part

    def add(self, x: int):
        """Insert ``x``; returns its neighbours below and above (or None)."""
        k = min(bisect_left(self.tops, x), len(self.tops) - 1)
        part = self.parts[k]
        at = bisect_left(part, x)
        below = part[at - 1] if at else self.parts[k - 1][-1] if k else None
        above = part[at] if at < len(part) else None
        part.insert(at, x)
        self.tops[k] = part[-1]
        self.size += 1
        if len(part) > 2 * LOAD:
            self.parts[k:k + 1] = [part[:LOAD], part[LOAD:]]
            self.tops[k:k + 1] = [part[LOAD - 1], part[-1]]
        return below, above


def suffix_levels(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of the 1, 2, 4, ... words from each position, until all differ."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    levels, k = [rank], 1
    while rank.max() < n - 1:
        after = np.zeros(n, np.int64)
        after[:n - k] = rank[k:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        levels.append(rank)
        k *= 2
    return levels


def neighbours(ids: np.ndarray):
    """(a, b, lcp) of neighbouring suffixes in sorted order."""
    levels = suffix_levels(ids)
    order = np.empty(len(ids), np.int64)
    order[levels[-1]] = np.arange(len(ids))
    a, b = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        # ranks are equal only where 2**k words follow both
        rank = np.append(levels[k], np.array([-1]))
        x, y = rank[np.minimum(a + lcp, len(ids))], rank[np.minimum(b + lcp, len(ids))]
        lcp += ((x == y) & (x >= 0)).astype(np.int64) << k
    return order[:-1], order[1:], lcp


def least_lcp(min_length: int, exponent: int) -> int:
    """The smallest length minus period that a run can have."""
    q = min_length // exponent
    return min(min_length - q, (exponent - 1) * (q + 1))


def find_runs(ids: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """All runs of a sequence as (start, length, period), by start and period."""
    least = least_lcp(min_length, exponent)
    if len(ids) <= least:
        return []
    a, b, lcp = neighbours(ids)
    order = np.flatnonzero(lcp >= least)
    order = order[np.argsort(-lcp[order], kind="stable")]
    word = ids.tolist()
    parent: dict[int, int] = {}
    held: dict[int, Positions] = {}
    runs = []

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def seed(x, y, level):
        d = y - x
        if d <= level and d + level >= max(min_length, exponent * d) and (x == 0 or word[x - 1] != word[y - 1]):
            runs.append((x, d + level, d))

    for x, y, level in zip(a[order].tolist(), b[order].tolist(), lcp[order].tolist()):
        big, small = find(x), find(y)
        into, add = held.get(big) or Positions(big), held.get(small) or Positions(small)
        if into.size < add.size:
            big, small, into, add = small, big, add, into
        parent[small] = big
        held.pop(small, None)
        held[big] = into
        own = list(add)
        for k, p in enumerate(own):
            below, above = into.add(p)
            # a neighbour from the own class is no new one
            if below is not None and (k == 0 or below != own[k - 1]):
                seed(below, p, level)
            if above is not None and (k + 1 == len(own) or above < own[k + 1]):
                seed(p, above, level)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def repeats_window(ids: np.ndarray, edges: np.ndarray, width: int) -> np.ndarray:
    """Which of the texts (their words lie between ``edges``) hold some window
    of ``width`` words twice, by hashes: never False where one does."""
    size = 1 << (width.bit_length() - 1)  # a window of fewer words repeats with it
    h = mix64(ids.astype(np.uint64) + _ODD)
    k = 1
    while k < size:
        h = mix64(h[:-k] * _ODD + h[k:]) if len(h) > k else h[:0]
        k *= 2
    doc = np.repeat(np.arange(len(edges) - 1), np.maximum(np.diff(edges) - size + 1, 0))
    first = np.cumsum(np.maximum(np.diff(edges) - size + 1, 0)) - np.maximum(np.diff(edges) - size + 1, 0)
    start = edges[doc] + np.arange(len(doc)) - first[doc]
    key = mix64(h[start] ^ mix64(doc.astype(np.uint64) + _ODD))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(edges) - 1, bool)
    out[doc[order[1:][same]]] = True
    return out


def strongest(runs) -> int | None:
    """Index of the run with the greatest length / period; ties: the smallest
    start, then the smallest period."""
    if not runs:
        return None
    return min(range(len(runs)), key=lambda k: (-Fraction(runs[k][1], runs[k][2]), runs[k][0], runs[k][2]))


def collapse(words: list[bytes], runs) -> list[bytes]:
    """The words that no run holds after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [w for w, c in zip(words, np.cumsum(change).tolist()) if c == 0]


def _scan(min_length: int, exponent: int):
    def run(batches):
        for whole in batches:
            for batch in batches_of(whole, "text"):
                texts = [t.split() for t in utf8(batch.column(1))]
                edges = np.cumsum([0] + [len(t) for t in texts])
                ids = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode().indices.to_numpy()
                found = [[] for _ in texts]
                for k in np.flatnonzero(repeats_window(ids, edges, least_lcp(min_length, exponent))).tolist():
                    found[k] = find_runs(ids[edges[k]:edges[k + 1]], min_length, exponent)
                body = [b" ".join(collapse(t, r) if r else t).decode() for t, r in zip(texts, found)]
                flat = [dict(zip(("start", "length", "period"), r)) for rs in found for r in rs]
                at = pa.array(np.cumsum([0] + [len(rs) for rs in found]), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.ListArray.from_arrays(at, pa.array(flat, _RUN)),
                    pa.array([strongest(rs) for rs in found], pa.int32()), pa.array(body, pa.string()),
                ], ["doc_id", "runs", "best", "text"])
    return run


def collapse_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """doc_id, runs (by start, then period), best (index of the run of the
    greatest exponent, null without runs) and the text without repetitions."""
    if exponent < 2 or min_length < 2:
        raise ValueError("min_length and exponent must be 2 or more")
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return body.mapInArrow(_scan(min_length, exponent), FOUND)


def plant_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text) with a periodic tail in about every tenth document.

    With h = crc32 of the decimal id, g = h div 10 and n words: where 10 divides h,
    the words from a = g mod n on repeat the p = 1 + (n - a) div (3 + g mod 8)
    words that begin there. A null id or text stays as it is.
    """
    from .common import WORD
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    split = body.withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary"))).withColumn(
        "w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    cut = (split.withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
           .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
           .withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)").cast("int")))
    tail = F.expr("slice(flatten(array_repeat(slice(w, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)")
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.concat(F.expr("slice(w, 1, a)"), tail), " "))
                      .otherwise(F.col("text")).alias("text"))
