"""Packing token streams into sequences by order-preserving dynamic programming.

Documents keep their order within an input partition. Their tokens form a line;
a sequence is a stretch of at most ``capacity`` tokens, cut at a document end
(free), a sentence end (penalty) or, where neither is near, anywhere (higher
penalty). The cheapest cuts minimise padding plus penalties:

    best[j] = penalty[j] + min over i of best[i] + padding(place[j] - place[i])

Padding is ``capacity`` minus the length, so the minimum over all i inside the
window is the smallest best[i] + place[i], kept in a monotone queue. Lengths
that are a power of two need no padding; their (few) exact predecessors are
looked up besides. Each sequence costs a little, so that short ones stay rare. The line is cut into blocks of about ``BLOCK`` tokens; the
last sequence of a block is taken back and starts the next block.

Token ids: a word's ids do not depend on its neighbours (the vocabulary drops
white space and never joins across it), so each distinct word is encoded once
per worker by the tokenizer and looked up after that.

Defined cases: a null text is empty and has only the closing id. Documents may
be longer than any sequence or block. Repeated rows are separate documents. An
empty table gives an empty result. One partition pads at most one sequence more
than its line needs, whatever the number of documents.
"""
from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8

CAPACITY = 2048
END_ID = 1
#: tokens that one run of the dynamic program covers, and distinct words kept
BLOCK, CACHE = 1 << 18, 400_000
#: cost of a cut, and of one more sequence, in tokens of padding
DOC_END, SENTENCE_END, ANYWHERE = 0.0, 2.0, 64.0
SEQUENCE = 32.0

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Recent(dict):
    """The entries used last: when ``limit`` is reached they become the older
    ones, which stay at hand for one more round and return when used again."""

    def __init__(self, limit: int):
        self.limit, self.older = limit, {}

    def take(self, keys: set) -> set:
        """Make room for ``keys`` and bring older ones back; returns the rest."""
        missing = {k for k in keys if k not in self}
        if len(self) + len(missing) > self.limit:
            self.older = dict(self)
            self.clear()
            missing = keys
        back = {k for k in missing if k in self.older}
        self.update((k, self.older[k]) for k in back)
        return missing - back


class Encoder:
    """Token ids of texts by a tokenizers file, a word at a time.

    Words seen lately come from a table of at most ``limit`` words. Where the
    tokenizer keeps letters apart from punctuation, a word of ASCII letters and
    the marks that follow it are encoded apart, and once for upper and lower case
    where it folds them. ``plain`` treats the tokenizer's special strings as
    ordinary text; by default they are its special ids.
    """

    MARKS = b".,;:!?"

    def __init__(self, path: str, limit: int = CACHE, plain: bool = False):
        import json
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.words, self.parts = Recent(limit), Recent(2 * limit)
        with open(path, encoding="utf-8") as f:
            about = json.load(f)
        steps = lambda x, many: [y for y in (x.get(many, [x]) if x else [])]
        self.fold = any(x["type"] == "Lowercase" for x in steps(about["normalizer"], "normalizers"))
        self.apart = any(x["type"] == "Split" and {r"[\p{L}]+", r"[^\s\p{L}\p{N}]+"} <= set(x["pattern"].get("Regex", "").split("|"))
                         for x in steps(about["pre_tokenizer"], "pretokenizers"))
        # a special string that may stand between words, and its id
        marks = [x for x in about["added_tokens"] if x["special"] and not (x["lstrip"] or x["rstrip"] or x["normalized"] or x["single_word"])]
        self.between = (marks[0]["content"], marks[0]["id"]) if marks and not plain else None
        size = self.tokenizer.get_vocab_size()
        ends = [(self.tokenizer.id_to_token(i) or "").removesuffix("</w>") for i in range(size)]
        self.sentence_end = np.array([bool(t) and set(t) <= set(".!?") for t in ends])

    def _split(self, word: bytes) -> tuple[bytes, bytes]:
        """(word, marks) to encode apart; marks may be empty."""
        core = word.rstrip(self.MARKS) if self.apart else word
        if not core.isalpha():  # of bytes: ASCII letters only
            return word, b""
        return (core.lower() if self.fold else core), word[len(core):]

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word: of one string with a special string between the words,
        cut at its id, unless the words hold that one themselves."""
        if self.between:
            text, mark = self.between
            ids = np.array(self.tokenizer.encode(text.join(words), add_special_tokens=False).ids, np.uint32)
            ends = np.append(np.flatnonzero(ids == mark), len(ids))
            if len(ends) == len(words):
                data, edge = ids.tobytes(), (4 * ends).tolist()
                return [data[a:b] for a, b in zip([0] + [e + 4 for e in edge], edge)]
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in found]

    def _learn(self, words: set) -> None:
        split = {w: self._split(w) for w in self.words.take(words)}
        fresh = list(self.parts.take({p for pair in split.values() for p in pair}))
        for i in range(0, len(fresh), 512):
            self.parts.update(zip(fresh[i:i + 512], self._encode([w.decode() for w in fresh[i:i + 512]])))
        self.words.update((w, self.parts[a] + self.parts[b]) for w, (a, b) in split.items())

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.split()
        found = list(map(self.words.get, words))
        at, missing = -1, []
        for _ in range(found.count(None)):
            at = found.index(None, at + 1)
            missing.append(at)
        if missing:
            self._learn({words[k] for k in missing})
            for k in missing:
                found[k] = self.words[words[k]]
        return np.frombuffer(b"".join(found), np.uint32)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, plain: bool = False) -> Encoder:
    """One encoder per worker, file and treatment of special strings."""
    if (path, plain) not in _ENCODERS:
        _ENCODERS[path, plain] = Encoder(path, plain=plain)
    return _ENCODERS[path, plain]


def cut(place: np.ndarray, penalty: np.ndarray, capacity: int = CAPACITY) -> list[int]:
    """Indexes into ``place`` of the cheapest cuts, the last one included.

    ``place`` rises from 0 in steps of at most ``capacity``; ``penalty[j]`` is
    the cost of a cut there. Padding is 0 for lengths that are powers of two.
    """
    at, cost = place.tolist(), penalty.tolist()
    powers = [1 << k for k in range(capacity.bit_length()) if 1 << k < capacity]
    # exact predecessors: for each power, the index whose place is that much before, or -1
    exact = []
    for p in powers:
        index = np.searchsorted(place, place - p)
        index[place[np.minimum(index, len(place) - 1)] != place - p] = -1
        exact.append(index)
    exact = np.stack(exact, axis=1)
    row, power = np.nonzero(exact >= 0)
    begun, before = np.searchsorted(row, np.arange(len(at) + 1)).tolist(), exact[row, power].tolist()
    best, back = [0.0] * len(at), [-1] * len(at)
    queue = deque([(0.0, 0)])  # (best + place, index), rising
    for j in range(1, len(at)):
        here = at[j]
        while at[queue[0][1]] < here - capacity:
            queue.popleft()
        least, origin = queue[0]
        least += capacity - here
        for i in before[begun[j]:begun[j + 1]]:
            if best[i] < least:
                least, origin = best[i], i
        least += cost[j] + SEQUENCE
        best[j], back[j] = least, origin
        key = least + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], len(at) - 1
    while j > 0:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def places(ids: np.ndarray, ends: np.ndarray, doc_ends: np.ndarray, capacity: int):
    """Where the line may be cut: (place, penalty), from 0 to its end."""
    cost = np.full(len(ids) + 1, np.inf, np.float64)
    # a cut follows the last of consecutive closing marks
    stops = ends[ids]
    last = np.flatnonzero(stops & ~np.append(stops[1:], False)) + 1
    cost[last] = SENTENCE_END
    cost[doc_ends] = DOC_END
    cost[0] = 0.0
    kept = np.flatnonzero(np.isfinite(cost))
    if kept[-1] != len(ids):
        kept = np.append(kept, len(ids))
        cost[len(ids)] = ANYWHERE
    # stretches without any mark: cuts anywhere, spaced so that sequences fill up
    gaps = np.flatnonzero(np.diff(kept) > capacity // 8)
    if len(gaps):
        more = np.concatenate([np.arange(kept[g] + 1, kept[g + 1]) for g in gaps])
        cost[more] = ANYWHERE
        kept = np.flatnonzero(np.isfinite(cost))
    return kept, cost[kept]


def _pack(path: str, capacity: int, block: int, plain: bool = False):
    def run(batches):
        from pyspark import TaskContext
        encode = encoder(path, plain)
        sequence = TaskContext.get().partitionId() << 33
        line: list = []   # (doc_id, start, ids, doc_tokens) not yet packed
        held = 0

        def flush(final):
            """Pack the line; unless final, take the last sequence back."""
            nonlocal line, held, sequence
            ids = np.concatenate([x[2] for x in line])
            edges = np.cumsum([len(x[2]) for x in line])
            whole = [e for e, x in zip(edges.tolist(), line) if x[1] + len(x[2]) == x[3]]
            place, cost = places(ids, encode.sentence_end, np.array(whole, np.int64), capacity)
            cuts = place[cut(place, cost, capacity)].tolist()
            if not final and len(cuts) > 1:
                cuts.pop()
            out, rest, k, at, begun = [], [], 0, 0, 0
            for doc, start, own, total in line:
                done = 0
                while done < len(own):
                    if k == len(cuts):
                        rest.append((doc, start + done, own[done:], total))
                        break
                    size = min(len(own) - done, cuts[k] - at)
                    out.append((doc, start + done, size, own[done:done + size].tobytes(), total, sequence, at - begun))
                    done, at = done + size, at + size
                    if at == cuts[k]:
                        k, sequence, begun = k + 1, sequence + 1, at
            line, held = rest, sum(len(x[2]) for x in rest)
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                ids = np.append(encode(text), np.uint32(END_ID))
                line.append((doc, 0, ids, len(ids)))
                held += len(ids)
                if held >= block:
                    yield _rows(flush(False))
        if line:
            yield _rows(flush(True))
    return run


def _rows(out):
    names = [x.split()[0] for x in PIECES.split(", ")]
    kinds = [pa.binary() if n == "ids" else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def pack(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id",
         capacity: int = CAPACITY, block: int = BLOCK, plain: bool = False) -> DataFrame:
    """One row per piece of a document, with its token ids (little-endian
    unsigned 32-bit) and its place in a sequence. Needs no shuffle. ``plain``
    makes special strings of the tokenizer in a text ordinary text."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_pack(tokenizer, capacity, block, plain), PIECES)


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
