"""Toxicity by the nearest labelled examples under cosine of selected terms.

Terms are words and word beginnings (4 to 8 letters, so that compounds of one
stem meet), each with "at least k times". The vocabulary is the ``VOCABULARY``
terms most tied to toxicity in a bounded sample of labelled rows (``SAMPLE`` of
each class, by hash); document frequencies count all documents. This is not the
plain TF-IDF of all words: a vector holds idf or 0, and neighbours are the exact
ones among these vectors. TF-IDF over all words finds far fewer toxic texts
(README); what it costs is that a text without any of the terms has no evidence.

The examples are those of the sample: an index of at most 2 * SAMPLE vectors,
equal ones merged, whatever the corpus. It is sparse and kept in blocks of
``BLOCK`` examples; a term's posting list holds its largest weight in each block
that has it. For a text, the lists of its terms give a bound on every block;
blocks are scored exactly from the best bound down until
the bound falls below the k-th best score, so the neighbours are the exact ones.
Votes are weighted by distance; leaving each example out once gives the map
from votes to calibrated scores (monotone, fitted on the sample).

Every document is scored from its text alone. Defined cases: a null text is
empty; texts without any term get the score of the examples without any. With no
usable labels, or labels of one class only, the score is the share of toxic
labels (0 without labels). Rows may repeat. An empty table gives an empty result.
"""
from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

SAMPLE = 3000
VOCABULARY = 400
#: terms in fewer sampled rows are left out
LEAST_ROWS = 5
PREFIXES = (4, 5, 6, 7, 8)
TIMES = (1, 2, 3, 5)
NEIGHBOURS, BLOCK = 25, 32
_WORD = re.compile(r"[^\W\d_]+")


def stems(word: str) -> list[str]:
    """The word itself, marked by its end, and its beginnings."""
    return [word[:n] for n in PREFIXES if len(word) > n] + [word + "$"]


def _terms_of(text: str) -> list[str]:
    count: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.lower())).items():
        for stem in stems(word):
            count[stem] += n
    return [f"{stem} {k}" for stem, n in count.items() for k in TIMES if n >= k]


def _sampled_terms(batches):
    for b in batches:
        for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            own = _terms_of(text or "")
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([toxic] * len(own), pa.int32())], ["term", "toxic"])


def choose_sample(labels: DataFrame, usable=None, sample: int = SAMPLE):
    """(ids and labels of the sample, rows of each class among all usable labels)."""
    usable = F.lit(True) if usable is None else usable
    rows = labels.filter(usable & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    totals = {r[0]: r[1] for r in rows.groupBy("toxic").agg(F.count("*")).collect()}
    pick = lambda c: rows.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    ids = pick(0).union(pick(1)).dropDuplicates(["doc_id"])
    return ids, totals


def vocabulary(sampled: DataFrame, size: int = VOCABULARY) -> list[str]:
    """Terms of the sample (toxic, text) most tied to the toxic class."""
    n = {r[0]: r[1] for r in sampled.groupBy("toxic").agg(F.count("*")).collect()}
    if not n.get(0) or not n.get(1):
        return []
    table = (sampled.select("toxic", "text").mapInArrow(_sampled_terms, "term string, toxic int")
             .groupBy("term").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).filter(F.col("n") >= LEAST_ROWS))
    p1, p0 = F.col("t") / n[1], (F.col("n") - F.col("t")) / n[0]
    spread = (p1 + p0) / 2
    table = table.withColumn("tie", (p1 - p0) * (p1 - p0) / (spread * (1 - spread) + 1e-9)).filter(p1 > p0)
    return sorted(r[0] for r in table.orderBy(F.desc("tie"), "term").limit(size).collect())


def _vectors(terms: list[str], limit: int = 500_000):
    place: dict[str, list] = {}
    for i, term in enumerate(terms):
        stem, times = term.rsplit(" ", 1)
        place.setdefault(stem, []).append((int(times), i))

    def run(batches):
        known: dict[str, tuple] = {}
        for b in batches:
            out = []
            for text in b.column(1).to_pylist():
                count: Counter = Counter()
                for word in _WORD.findall((text or "").lower()):
                    hits = known.get(word)
                    if hits is None:
                        if len(known) >= limit:
                            known.clear()
                        hits = known[word] = tuple(s for s in stems(word) if s in place)
                    if hits:
                        count.update(hits)
                out.append(sorted(i for stem, n in count.items() for k, i in place[stem] if n >= k))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "terms"])
    return run


def _frequency(batches):
    """Documents of the partition that hold each term."""
    total: Counter = Counter()
    for b in batches:
        total.update(b.column(0).flatten().to_pylist())
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], ["t", "n"])


class Index:
    """Block-max inverted index over the merged example vectors, all sparse."""

    def __init__(self, vectors: list[tuple], weight: np.ndarray, toxic: np.ndarray, ids: list, idf: np.ndarray, block: int = BLOCK):
        """``weight`` and ``toxic``: rows and toxic rows that each vector stands for."""
        order = sorted(range(len(vectors)), key=lambda i: vectors[i])  # like beside like: tight blocks
        self.idf, self.block = idf, block
        self.weight, self.toxic, self.ids = weight[order], toxic[order], [ids[i] for i in order]
        self.edges = np.concatenate([[0], np.cumsum([len(vectors[i]) for i in order])]).astype(np.int64)
        self.terms = np.fromiter((t for i in order for t in vectors[i]), np.int64, self.edges[-1])
        row = np.repeat(np.arange(len(order)), np.diff(self.edges))
        self.values = idf[self.terms]
        self.values /= np.sqrt(np.bincount(row, self.values ** 2, len(order)))[row]
        # a term's posting list: the blocks that hold it, with its largest weight there
        blocks = -(-len(order) // block)
        cell = self.terms * blocks + row // block
        by = np.argsort(cell, kind="stable")
        first = np.flatnonzero(np.diff(cell[by], prepend=-1))
        self.blocks = blocks
        self.post_max = np.maximum.reduceat(self.values[by], first) if len(by) else np.empty(0)
        self.post_block = cell[by][first] % max(blocks, 1)
        self.post = np.searchsorted(cell[by][first] // max(blocks, 1), np.arange(len(idf) + 1))
        self._query = np.zeros(len(idf))

    @property
    def rows(self) -> np.ndarray:
        """The vectors as a dense matrix (small indexes only)."""
        out = np.zeros((len(self.ids), len(self.idf)))
        out[np.repeat(np.arange(len(self.ids)), np.diff(self.edges)), self.terms] = self.values
        return out

    def bounds(self, own: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The highest similarity that each block can reach."""
        length = self.post[own + 1] - self.post[own]
        at = np.repeat(self.post[own] - np.cumsum(length) + length, length) + np.arange(length.sum())
        return np.bincount(self.post_block[at], self.post_max[at] * np.repeat(q, length), self.blocks)

    def nearest(self, terms: tuple, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """(similarity, example) of the k nearest examples that share a term."""
        own = np.array(terms, np.int64)
        q = self.idf[own] / np.linalg.norm(self.idf[own])
        bound = self.bounds(own, q)
        self._query[own] = q
        found, where = np.empty(0), np.empty(0, int)
        for b in np.argsort(-bound, kind="stable"):
            # a little slack: bound and score add up in different orders
            if bound[b] <= 0 or len(found) >= k and bound[b] < found[-1] - 1e-9:
                break
            s, e = int(b) * self.block, min((int(b) + 1) * self.block, len(self.ids))
            x, y = self.edges[s], self.edges[e]
            score = np.add.reduceat(self.values[x:y] * self._query[self.terms[x:y]], self.edges[s:e] - x)
            found, where = np.append(found, score), np.append(where, np.arange(s, e))
            best = np.lexsort((where, -found))[:k]
            found, where = found[best], where[best]
        self._query[own] = 0
        some = found > 0
        return found[some], where[some]

    def vote(self, terms: tuple, left_out: int | None = None, k: int = NEIGHBOURS):
        """(toxic share of the distance-weighted votes, nearest example ids)."""
        score, where = self.nearest(terms, k)
        weight, toxic = self.weight[where].copy(), self.toxic[where].copy()
        if left_out is not None:
            weight, toxic = self._without(where, weight, toxic, left_out)
        pull = 1 / (0.02 + np.maximum(1 - score, 0))
        prior = self.toxic.sum() / self.weight.sum()
        share = (prior + (pull * toxic).sum()) / (1 + (pull * weight).sum())
        return float(share), [self.ids[i] for i in where[:3]]

    @staticmethod
    def _without(where, weight, toxic, left_out):
        """Votes without one row of example ``left_out[0]`` (class, row weight)."""
        own, is_toxic, row = left_out
        at = where == own
        return np.maximum(weight - at * row, 0), np.maximum(toxic - at * row * is_toxic, 0)


def monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising function nearest to y (pool adjacent violators)."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # weight, sum of y, sum of x
    for i in order:
        pools.append([w[i], w[i] * y[i], w[i] * x[i]])
        while len(pools) > 1 and pools[-2][1] / pools[-2][0] >= pools[-1][1] / pools[-1][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[2] / p[0] for p in pools]), np.array([p[1] / p[0] for p in pools])


class Scorer:
    """Scores term vectors; holds the index, the calibration and the share of
    toxic examples among those without terms."""

    def __init__(self, index: Index | None, knots, empty: float):
        self.index, self.knots, self.empty = index, knots, empty

    def __call__(self, terms: tuple):
        if self.index is None or not terms:
            return self.empty, []
        vote, ids = self.index.vote(terms)
        return self.calibrated(vote), ids

    def calibrated(self, vote: float) -> float:
        # the calibration, with a little of the vote itself so that ties are rare
        fit = float(np.interp(vote, *self.knots))
        return min(1.0, max(0.0, 0.98 * fit + 0.02 * vote))


def fit(examples: list[tuple], totals: dict[int, int], documents: int, frequency: dict[int, int], size: int) -> Scorer:
    """``examples``: (doc_id, toxic, terms) of the sample."""
    every = sum(totals.values())
    prior = totals.get(1, 0) / every if every else 0.0
    if not size or not examples:
        return Scorer(None, None, prior)
    n = Counter(t for _, t, _ in examples)
    row = {c: totals[c] / n[c] for c in n}  # the sample has as many of both classes; the labels have not
    idf = np.array([np.log((documents + 1) / (frequency.get(i, 0) + 1)) + 1 for i in range(size)])
    groups: dict[tuple, list] = {}
    for doc, toxic, terms in examples:
        own = groups.setdefault(tuple(terms), [0.0, 0.0, []])
        own[0] += row[toxic]
        own[1] += row[toxic] * toxic
        own[2].append(doc)
    none = groups.pop((), [0.0, 0.0, []])
    empty = (none[1] + prior) / (none[0] + 1)
    if not groups:
        return Scorer(None, None, empty)
    keys = sorted(groups)
    index = Index(keys, np.array([groups[k][0] for k in keys]), np.array([groups[k][1] for k in keys]),
                  [min(groups[k][2]) for k in keys], idf)
    place = {k: i for i, k in enumerate(keys)}
    cells = Counter((tuple(terms), toxic) for _, toxic, terms in examples if terms)
    points = sorted(cells)
    vote = np.array([index.vote(k, (place[k], t, row[t]))[0] for k, t in points])
    weight = np.array([cells[p] * row[p[1]] for p in points])
    return Scorer(index, monotone(vote, np.array([float(t) for _, t in points]), weight), empty)


SCORES = "doc_id long, score double, evidence array<long>"


def _score(shared):
    def run(batches):
        scorer, known = shared.value, {}
        for b in batches:
            out = []
            for terms in b.column(1).to_pylist():
                key = tuple(terms)
                if key not in known:
                    if len(known) > 200_000:
                        known.clear()
                    known[key] = scorer(key)
                out.append(known[key])
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([x[0] for x in out], pa.float64()), pa.array([x[1] for x in out], pa.list_(pa.int64()))],
                ["doc_id", "score", "evidence"])
    return run


def score(docs: DataFrame, labels: DataFrame, usable=None, text: str = "text", doc_id: str = "doc_id",
          sample: int = SAMPLE, size: int = VOCABULARY) -> DataFrame:
    """doc_id, score in [0, 1] and the nearest examples' ids for every row.

    ``labels`` has doc_id and toxic; only rows where ``usable`` (all by default) holds count.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ids, totals = choose_sample(labels, usable, sample)
    ids = materialize(ids.coalesce(1), "sample-ids")  # at most 2 * sample rows
    sampled = materialize(rows.join(F.broadcast(ids), "doc_id").select("toxic", "text"), "sample")
    terms = vocabulary(sampled, size)
    vectors = materialize(rows.mapInArrow(_vectors(terms), "doc_id long, terms array<int>"), "vectors")
    documents = vectors.count()
    counted = vectors.select("terms").mapInArrow(_frequency, "t int, n long")
    frequency = {r[0]: r[1] for r in counted.groupBy("t").agg(F.sum("n")).collect()}
    examples = [(r[0], r[1], tuple(r[2])) for r in
                vectors.join(F.broadcast(ids), "doc_id").select("doc_id", "toxic", "terms").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(fit(sorted(examples), totals, documents, frequency, len(terms)))
    return vectors.mapInArrow(_score(shared), SCORES)
