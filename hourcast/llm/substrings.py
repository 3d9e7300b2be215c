"""Removal of repeated passages: windows of ``width`` words seen earlier go.

A window is ``width`` consecutive words of one document. Words covered by a
window whose words also start earlier -- in a document with a smaller id, or
earlier in the same one -- are removed. Windows are judged on the input.

1. Documents are dealt into chunks of about ``CHUNK`` bytes by a hash. Each
   chunk makes its own count-min sketch of its windows, stored as the cells
   that are not zero, cut into segments.
2. Sketches are merged segment by segment: the counts of all chunks add up, so
   a cell's sum is never below the true count of any window in it. Back to each
   chunk goes one bit for each of its own cells: two or more, or not.
3. Second pass: a window goes on only if all its cells (one per sketch row) say
   two or more -- no repeated window can fail that. Within a chunk all but the
   earliest equal window are settled at once; the earliest ones are grouped by a
   96-bit digest of their words, and every one after the first is repeated. They
   travel packed, one row per chunk and range of digests.
   A window that stands in a third of all documents costs one row per chunk.
4. Repeated windows go back to their chunk, where the covered words are cut.

The sketch grows with the text (about 6 cells per word and row), a segment has a
fixed number of cells and a chunk a fixed size, so no task's memory grows with
the corpus and nothing is broadcast. The documents are exchanged once; the
three steps on chunks read the same exchange.

Defined cases: a null text has no words; fewer than ``width`` words have no
window. A null id counts as larger than all others. Of rows with equal id and
text none is earlier than the other. An empty table gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, pack_gaps, pack_longs, unpack_gaps, unpack_longs, utf8, word_hashes

WIDTH = 20
CHUNK = 8 << 20
ROWS = 2
SEGMENT = 1 << 22
_LAST = np.iinfo(np.int64).max
_MUL = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

SKETCH = "segment int, chunk int, seen binary, many binary"
MASK = "chunk int, segment int, mask binary"
#: windows: 12 digest bytes each, then ids and places; settled: place of the
#: first window of a run and how many follow
FOUND = "bucket int, chunk int, windows binary, settled binary"
GONE = "chunk int, places binary, settled binary"
KEPT = "doc_id long, n_words long, n_removed long, text string"


def windows(words: np.ndarray, width: int, k: int) -> np.ndarray:
    """64-bit hashes of all windows over word hashes; k picks the function."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    own = mix64(words + _MUL[k]) if k else words
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = out * _MUL[k] + own[j:j + n]
    return mix64(out)


def _rows_of(docs: pa.Table):
    """(ids, texts, order) of a chunk. A null id sorts last; ``order`` lists the
    rows by id and text, so that a row has the same number in every step."""
    ids = docs.column(1).combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False)
    texts = utf8(docs.column(2).combine_chunks())
    order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))
    return ids[order], [texts[i] for i in order], order


def _cells(hashes: np.ndarray, row: int, cells: int) -> np.ndarray:
    return mix64(hashes + np.uint64(row + 1) * _MUL[1]) & np.uint64(cells - 1)


def _sketch(width: int, cells: int, segment: int):
    def run(docs: pa.Table) -> pa.Table:
        chunk = docs.column(0)[0].as_py()
        hashes = [windows(word_hashes(t.split()), width, 0) for t in utf8(docs.column(2).combine_chunks())]
        every = np.concatenate(hashes)
        out = []
        for row in range(ROWS):
            found, times = np.unique(_cells(every, row, cells), return_counts=True)
            part, own = found // np.uint64(segment), (found % np.uint64(segment)).astype(np.uint32)
            edges = np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1) if len(part) else part))
            for a, b in zip(edges, [*edges[1:], len(part)]):
                twice = times[a:b] > 1
                out.append((row * (cells // segment) + int(part[a]), chunk, pack_gaps(own[a:b]), pack_gaps(own[a:b][twice])))
        return _table(out, SKETCH)
    return run


def _table(rows, schema: str) -> pa.Table:
    names, kinds = zip(*[x.split() for x in schema.split(", ")])
    kind = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.Table.from_arrays([pa.array(c, kind[k]) for c, k in zip(columns, kinds)], list(names))


def _merge(segment: int):
    def run(part: pa.Table) -> pa.Table:
        total = np.zeros(segment, np.uint8)
        seen = [unpack_gaps(x) for x in part.column(2).to_pylist()]
        for own, many in zip(seen, part.column(3).to_pylist()):
            for cells in (own, unpack_gaps(many)):
                total[cells] += total[cells] < 200  # 2 or more is all that is asked
        masks = [np.packbits(total[own] >= 2).tobytes() for own in seen]
        return pa.Table.from_arrays([part.column(1), part.column(0), pa.array(masks, pa.binary())], ["chunk", "segment", "mask"])
    return run


def _repeated(every: np.ndarray, masks: pa.Table, cells: int, segment: int) -> np.ndarray:
    """Which windows the merged sketch counts at least twice."""
    bits = {s: np.frombuffer(m, np.uint8) for s, m in zip(masks.column(1).to_pylist(), masks.column(2).to_pylist())}
    out = np.ones(len(every), bool)
    for row in range(ROWS):
        found, where = np.unique(_cells(every, row, cells), return_inverse=True)
        part, size = np.unique(found // np.uint64(segment), return_counts=True)
        base = row * (cells // segment)
        answer = [np.unpackbits(bits[base + int(p)], count=int(n)) for p, n in zip(part, size)]
        if answer:
            out &= np.concatenate(answer).astype(bool)[where]
    return out


def _candidates(width: int, cells: int, segment: int, buckets: int):
    def run(docs: pa.Table, masks: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _table([], FOUND)
        ids, texts, _ = _rows_of(docs)
        words = [word_hashes(t.split()) for t in texts]
        first = [windows(w, width, 0) for w in words]
        size = [len(x) for x in first]
        kept = np.flatnonzero(_repeated(np.concatenate(first), masks, cells, segment))
        hi = np.concatenate(first)[kept]
        lo = (np.concatenate([windows(w, width, 1) for w in words])[kept] >> np.uint64(32)).astype(np.uint32)
        row = np.repeat(np.arange(len(ids)), size)[kept]
        start = kept - np.repeat(np.cumsum(size) - size, size)[kept]
        # the earliest of equal windows stands for them; later ones are settled
        order = np.lexsort((row, start, ids[row], lo, hi))
        hi, lo, row, start = hi[order], lo[order], row[order], start[order]
        own = ids[row]
        head = np.ones(len(hi), bool)
        head[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        lead = np.maximum.accumulate(np.where(head, np.arange(len(hi)), 0))
        later = (own > own[lead]) | (start > start[lead])
        stand = ~later  # with equal id and start in another row: stands for itself
        # settled windows as runs of starts of one row: (first start, how many more)
        back = np.lexsort((start[later], row[later]))
        srow, sstart = row[later][back], start[later][back]
        new = np.ones(len(srow), bool)
        new[1:] = (srow[1:] != srow[:-1]) | (sstart[1:] != sstart[:-1] + 1)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(srow)) - 1 if len(begin) else begin
        srow, sstart, more = srow[begin], sstart[begin], sstart[end] - sstart[begin]
        place = lambda r, s: r.astype(np.int64) << 32 | s.astype(np.int64)
        # in document order, which compresses ids and places
        still = np.flatnonzero(stand)[np.lexsort((start[stand], row[stand]))]
        bucket = _share(hi[still], buckets)
        chunk = docs.column(0)[0].as_py()
        out = [(k, chunk, _pack_windows(hi[own_], lo[own_], own[own_], place(row[own_], start[own_])), b"")
               for k, own_ in ((k, still[where]) for k, where in _dealt(bucket))]
        if len(srow):  # settled runs meet no others
            out.append((chunk % buckets, chunk, b"", pack_longs(place(srow, sstart), more)))
        return _table(out, FOUND)
    return run


def _share(hi: np.ndarray, buckets: int) -> np.ndarray:
    """Which of ``buckets`` equal ranges of digests each one lies in."""
    return ((hi >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _dealt(bucket: np.ndarray):
    """(bucket, its indexes in order) for every bucket that occurs."""
    order = np.argsort(bucket, kind="stable")
    begin = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for a, b in zip(begin, [*begin[1:], len(order)]):
        yield int(bucket[order[a]]), order[a:b]


def _pack_windows(hi, lo, ids, places) -> bytes:
    return len(hi).to_bytes(4, "little") + hi.tobytes() + lo.tobytes() + pack_longs(ids, places)


def _unpack_windows(data: bytes):
    n = int.from_bytes(data[:4], "little")
    ids, places = unpack_longs(data[4 + 12 * n:], 2)
    return np.frombuffer(data, np.uint64, n, 4), np.frombuffer(data, np.uint32, n, 4 + 8 * n), ids, places


def _judge(part: pa.Table) -> pa.Table:
    """Of the windows of one range of digests, those that are not the first of
    their words go back to their chunks."""
    out = [(c, b"", s) for c, s in zip(part.column(1).to_pylist(), part.column(3).to_pylist()) if s]
    held = [(c, _unpack_windows(w)) for c, w in zip(part.column(1).to_pylist(), part.column(2).to_pylist()) if w]
    if held:
        hi, lo, ids, places = (np.concatenate([h[k] for _, h in held]) for k in range(4))
        chunk = np.repeat([c for c, _ in held], [len(h[0]) for _, h in held])
        start = places & 0xFFFFFFFF
        order = np.lexsort((start, ids, lo, hi))
        head = np.ones(len(order), bool)
        head[1:] = (hi[order][1:] != hi[order][:-1]) | (lo[order][1:] != lo[order][:-1])
        lead = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
        gone = order[(ids[order] != ids[lead]) | (start[order] != start[lead])]
        out += [(c, pack_longs(np.sort(places[gone[where]])), b"") for c, where in _dealt(chunk[gone])]
    return _table(out, GONE)


def _finish(width: int):
    def run(docs: pa.Table, gone: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _table([], KEPT)
        _, texts, order = _rows_of(docs)
        single = np.concatenate([unpack_longs(x, 1) for x in gone.column(1).to_pylist()] or [np.empty((1, 0), np.int64)], axis=1)
        runs = np.concatenate([unpack_longs(x, 2) for x in gone.column(2).to_pylist()] or [np.empty((2, 0), np.int64)], axis=1)
        place = np.concatenate([single[0], runs[0]])
        more = np.concatenate([np.zeros(single.shape[1], np.int64), runs[1]])
        by_row = np.argsort(place >> 32, kind="stable")
        place, more = place[by_row], more[by_row]
        edges = np.searchsorted(place >> 32, np.arange(len(texts) + 1))
        names = docs.column(1).to_pylist()
        out = []
        for row, (i, text) in enumerate(zip(order, texts)):
            kept = words = text.split()
            a, b = edges[row], edges[row + 1]
            if b > a:
                start = place[a:b] & 0xFFFFFFFF
                change = np.zeros(len(words) + 1, np.int32)
                np.add.at(change, start, 1)
                np.add.at(change, start + more[a:b] + width, -1)
                kept = [w for w, c in zip(words, np.cumsum(change).tolist()) if c == 0]
            out.append((names[i], len(words), len(words) - len(kept), b" ".join(kept).decode()))
        return _table(out, KEPT)
    return run


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH,
                   chunk: int = CHUNK, cells: int | None = None, segment: int = SEGMENT) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words (joined by one space).

    ``cells`` per sketch row is a power of two, by default the next one above
    the bytes of all texts.
    """
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    total = body.agg(F.sum(F.octet_length("text"))).first()[0] or 1
    if cells is None:
        cells = 1 << max(16, int(total - 1).bit_length())
    segment = min(segment, cells)
    chunks = -(-total // chunk)
    rows = body.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk"), "doc_id", "text")
    per_chunk = rows.groupBy("chunk")
    sketch = per_chunk.applyInArrow(_sketch(width, cells, segment), SKETCH)
    masks = sketch.groupBy("segment").applyInArrow(_merge(segment), MASK)
    buckets = max(1, -(-2 * total // chunk))  # a range holds the windows of half a chunk's bytes at most on average
    found = per_chunk.cogroup(masks.groupBy("chunk")).applyInArrow(_candidates(width, cells, segment, buckets), FOUND)
    gone = found.groupBy("bucket").applyInArrow(_judge, GONE)
    return per_chunk.cogroup(gone.groupBy("chunk")).applyInArrow(_finish(width), KEPT)
