"""Jaccard join of n-gram sets with prefix trees.

A document's set holds its distinct 5-word shingles (A-Z lower-cased); with fewer
words its whole sequence is the only element. Sets link at ``percent`` / 100 or
more; rows of equal sets form one class, whatever their number.

1. Global order: by how many texts hold an n-gram (a one-row count sketch, merged
   by segments, never below the true count), then by hash. A set whose n-grams are
   counted once in more than 1 - percent/100 of the cases links with no other.
2. Prefixes: two linked sets share one of the first n - ceil(percent * n / 100) + 1
   n-grams in that order, so only sets that meet in a prefix n-gram are joined.
   Rare ones come first: an n-gram of a million texts is in the prefix of a text
   only if nearly all of the text is that common.
3. Every prefix n-gram has a hub, the member that shares most. Each set probes its
   two best hubs; then only sets that share a prefix n-gram but still lie in
   different components are joined, so a group of near copies costs one probe per
   member and no link between components is lost. Where two sets first meet bounds
   what they can share by what is left of both, and a bitmap of parities bounds it
   too; pairs that cannot reach the threshold are not joined.
4. Prefix tree: the sets that one probe meets are stored in a trie in the global
   order, common n-grams first. The traversal adds up the overlap on shared paths
   once and leaves a subtree when the rest of the probe or of the subtree's sets is
   too short for the overlap that its sizes need. What is left is the exact overlap.
   A probe with many sets gets several bounded tries in several tasks.

Defined cases: a null text has no words; such documents and empty ones are linked
with nothing and name themselves. A null id never names a component that has
another id. Repeated rows stay separate rows of one class. An empty table gives an
empty result; other columns are not read. Texts may be of any length.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, join_back, materialize, mix64, pack_gaps, unpack_gaps, utf8, word_hashes
from .components import components

SHINGLE, PERCENT = 5, 80
CHUNK = 8 << 20
SEGMENT = 1 << 22
#: n-grams that the sets of one trie hold, and one task's tries
TRIE, TASK = 1 << 19, 1 << 21
HUBS = 2
PARITY = 1024
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]

SKETCH = "segment int, chunk int, cells binary"
MASK = "chunk int, segment int, counts binary"
ROWS = "id long, set_key binary, n long, run int, rare int, parity array<long>, grams array<long>"


def grams(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's n-grams."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    if len(h) < SHINGLE:  # zeros stand for the missing words, the length tells them from real ones
        h = np.concatenate([h, np.full(SHINGLE - len(h), len(h), np.uint64)])
    n = len(h) - SHINGLE + 1
    out = h[:n] * _ODD[0]
    for k in range(1, SHINGLE):
        out = mix64(out) + h[k:k + n] * _ODD[k]
    if len(words) < SHINGLE:
        out = out ^ np.uint64(len(words))
    return np.unique(mix64(out))


def _key(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _chunk_sets(docs: pa.Table):
    """(ids, keys, sets by key) of a chunk; the sets in the order of their keys."""
    sets, keys = {}, []
    for text in utf8(docs.column(2).combine_chunks()):
        own = grams(text)
        keys.append(_key(own))
        if len(own):
            sets[keys[-1]] = own
    return docs.column(1).to_pylist(), keys, dict(sorted(sets.items()))


def _cells(sets, cells: int) -> np.ndarray:
    every = np.concatenate([*sets, np.empty(0, np.uint64)])
    return mix64(every + _ODD[1]) & np.uint64(cells - 1)


def _sketch(cells: int, segment: int):
    def run(docs: pa.Table) -> pa.Table:
        chunk = docs.column(0)[0].as_py()
        found = np.sort(_cells(_chunk_sets(docs)[2].values(), cells))
        part, own = (found // np.uint64(segment)).astype(np.int64), (found % np.uint64(segment)).astype(np.uint32)
        begin = np.flatnonzero(np.diff(part, prepend=-1))
        packed = [pack_gaps(own[a:b]) for a, b in zip(begin, [*begin[1:], len(own)])]
        return pa.Table.from_arrays([pa.array(part[begin], pa.int32()), pa.array([chunk] * len(begin), pa.int32()),
                                     pa.array(packed, pa.binary())], ["segment", "chunk", "cells"])
    return run


def _merge(segment: int):
    def run(part: pa.Table) -> pa.Table:
        total = np.zeros(segment, np.int32)
        held = [unpack_gaps(x) for x in part.column(2).to_pylist()]
        for own in held:
            cell, times = np.unique(own, return_counts=True)
            total[cell] += times.astype(np.int32)
        counts = [np.minimum(total[own], 255).astype(np.uint8).tobytes() for own in held]
        return pa.Table.from_arrays([part.column(1), part.column(0), pa.array(counts, pa.binary())], ["chunk", "segment", "counts"])
    return run


def overlap_needed(n: int, percent: int) -> int:
    """Common n-grams that a link of a set of ``n`` needs at least."""
    return -(-percent * n // 100)


def parity(own: np.ndarray) -> list[int]:
    """One bit per bucket of n-grams: whether an odd number of them falls there."""
    odd = np.bincount(own.view(np.uint64) % np.uint64(PARITY), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _ordered(cells: int, percent: int):
    def run(docs: pa.Table, merged: pa.Table) -> pa.Table:
        ids, keys, sets = _chunk_sets(docs)
        where = np.argsort(_cells(sets.values(), cells), kind="stable")
        count = np.empty(len(where), np.uint8)
        parts = sorted(zip(merged.column(1).to_pylist(), merged.column(2).to_pylist()))
        count[where] = np.frombuffer(b"".join(x for _, x in parts), np.uint8)
        kept, at = {}, 0
        for key, own in sets.items():
            held = count[at:at + len(own)]
            at += len(own)
            rare = int((held < 2).sum())
            if len(own) - rare >= overlap_needed(len(own), percent):
                kept[key] = (rare, own[np.lexsort((own, held))].view(np.int64))
        run_ = docs.column(0)[0].as_py() if docs.num_rows else 0
        carried = [kept.pop(k, None) for k in keys]  # the first row of a set brings it along
        size = np.array([0 if c is None else len(c[1]) for c in carried], np.int64)
        lists = pa.LargeListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int64()),
            pa.array(np.concatenate([c[1] for c in carried if c] or [np.empty(0, np.int64)])),
            mask=pa.array([c is None for c in carried], pa.bool_()))
        return pa.Table.from_arrays([
            pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array([len(sets.get(k, ())) for k in keys], pa.int64()),
            pa.array([run_] * len(keys), pa.int32()), pa.array([c and c[0] for c in carried], pa.int32()),
            pa.array([c and parity(c[1]) for c in carried], pa.list_(pa.int64())), lists.cast(pa.list_(pa.int64()))], [x.split()[0] for x in ROWS.split(", ")])
    return run


def traverse(probe: np.ndarray, stored: list[np.ndarray], percent: int) -> list[int]:
    """Indexes of the stored sets that reach the threshold with ``probe``.

    All sets are in the same order. ``stored`` is sorted into a trie whose paths
    are the common beginnings; a node is a range of sets, a depth, the overlap so
    far and how much of the probe is used up.
    """
    order = np.argsort(probe)
    lookup = probe[order]
    rank = sorted(range(len(stored)), key=lambda i: stored[i].tobytes())
    sets = [stored[i] for i in rank]
    size = np.array([len(s) for s in sets], np.int64)
    need = -(-percent * (size + len(probe)) // (100 + percent))
    links, stack = [], [(0, len(sets), 0, 0, 0)]
    while stack:
        lo, hi, depth, overlap, used = stack.pop()
        first, last = sets[lo], sets[hi - 1]
        end = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:end] != last[depth:end])
        if len(differ):
            end = depth + int(differ[0])
        label = first[depth:end]
        at = np.minimum(np.searchsorted(lookup, label), len(lookup) - 1)
        met = order[at[lookup[at] == label]]
        if len(met):
            overlap, used = overlap + len(met), int(met[-1]) + 1
        rest = np.minimum(size[lo:hi] - end, len(probe) - used)
        alive = overlap + rest >= need[lo:hi]
        if not alive.any():
            continue
        done = size[lo:hi] == end
        links += [rank[lo + k] for k in np.flatnonzero(done & (overlap >= need[lo:hi])).tolist()]
        # sets that end here sort first; the others split by their next n-gram
        begin = lo + int(done.sum())
        while begin < hi:
            step = sets[begin][end]
            a, b = begin + 1, hi  # sorted as bytes, equal ones are neighbours
            while a < b and sets[a][end] == step:
                a += 1
            if alive[begin - lo:a - lo].any():
                stack.append((begin, a, end, overlap, used))
            begin = a
    return links


def _probe(percent: int):
    def run(probes: pa.Table, stored: pa.Table) -> pa.Table:
        lists = lambda t, c: [np.asarray(x)[::-1] for x in _lists(t.column(c).combine_chunks())]
        held: dict = {}
        for k, key in enumerate(zip(stored.column(1).to_pylist(), stored.column(2).to_pylist())):
            held.setdefault(key, []).append(k)
        sets, other = lists(stored, 4), stored.column(3).to_pylist()
        out = []
        for key, probe in zip(zip(probes.column(1).to_pylist(), probes.column(2).to_pylist()), lists(probes, 3)):
            own = held.get(key, [])
            out += [(key[0], other[own[i]]) for i in traverse(probe, [sets[i] for i in own], percent)]
        a, b = zip(*out) if out else ((), ())
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _lists(column) -> list[np.ndarray]:
    edges, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[a:b] for a, b in zip(edges, edges[1:])]


def trie_join(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that reach the threshold. ``sets`` has cid, n and grams in
    the global order. The sets that probe a meets are dealt into tries of about
    ``TRIE`` n-grams, the tries into tasks of about ``TASK``."""
    sized = pairs.join(sets.select(F.col("cid").alias("b"), "n"), "b")
    tries = (sized.groupBy("a").agg(F.sum("n").alias("total"))
             .select("a", F.ceil(F.col("total") / TRIE).alias("tries"), "total"))
    whole = tries.agg(F.sum("total")).first()[0] or 0
    tasks = max(1, -(-whole // TASK))
    dealt = pairs.join(tries, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("tries")).alias("trie"))
    dealt = materialize(dealt.withColumn("task", F.pmod(F.xxhash64("a", "trie"), F.lit(tasks))), "dealt")
    own = sets.select(F.col("cid").alias("a"), F.col("grams").alias("probe"))
    probes = dealt.select("task", "a", "trie").distinct().join(own, "a").select("task", "a", "trie", "probe")
    # all columns of the second side get names of their own: both come from the same tables
    stored = (dealt.select(F.col("task").alias("slot"), F.col("a").alias("for_a"), F.col("trie").alias("for_trie"), F.col("b").alias("cid"))
              .join(sets.select("cid", F.col("grams").alias("held")), "cid")
              .select("slot", "for_a", "for_trie", F.col("cid").alias("b"), "held"))
    links = probes.groupBy("task").cogroup(stored.groupBy("slot")).applyInArrow(_probe(percent), "a long, b long")
    out = materialize(links, "trie-links")
    discard(dealt)
    return out


def _sets(docs: DataFrame, text: str, doc_id: str, percent: int, chunk: int, cells: int | None, segment: int) -> DataFrame:
    """(id, set_key, n, run, rare, parity, grams): a row per document; the first row of a
    set in its chunk brings the n-grams in global order if it can link at all."""
    body = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    total = body.agg(F.sum(F.octet_length("text"))).first()[0] or 1
    if cells is None:  # some three cells per word
        cells = 1 << max(16, int(total // 2).bit_length())
    segment = min(segment, cells)
    rows = body.select(F.pmod(F.xxhash64("id", "text"), F.lit(-(-total // chunk))).cast("int").alias("chunk"), "id", "text")
    per_chunk = rows.groupBy("chunk")
    merged = per_chunk.applyInArrow(_sketch(cells, segment), SKETCH).groupBy("segment").applyInArrow(_merge(segment), MASK)
    return per_chunk.cogroup(merged.groupBy("chunk")).applyInArrow(_ordered(cells, percent), ROWS)


def similar_sets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT,
                 chunk: int = CHUNK, cells: int | None = None, segment: int = SEGMENT) -> DataFrame:
    """id, n_shingles and component (its smallest id), one row per row of ``docs``."""
    table = materialize(_sets(docs, text, doc_id, percent, chunk, cells, segment), "sets")
    carried = table.filter(F.col("grams").isNotNull())
    # a set that several chunks bring is taken from one of them
    chosen = carried.groupBy("set_key").agg(F.min("run").alias("run"))
    classes = materialize(carried.join(chosen, ["set_key", "run"]).select("set_key", "n", "rare", "parity", "grams")
                          .withColumn("cid", F.monotonically_increasing_id()), "classes")
    reach = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("long") + 1
    prefix = F.slice("grams", F.col("rare") + 1, F.greatest(reach - F.col("rare"), F.lit(0)).cast("int"))
    # left: n-grams from this one on, which is all that sets that first meet here can share
    keys = (classes.select("cid", "n", "rare", F.posexplode(prefix).alias("place", "gram"))
            .select("cid", "n", (F.col("n") - F.col("rare") - F.col("place")).alias("left"), "gram"))
    often = keys.groupBy("gram").agg(F.count("*").alias("c")).filter("c > 1")
    shared = materialize(keys.join(often, "gram"), "shared")
    weight = shared.groupBy("cid").agg(F.sum("c").alias("w"))
    hubs = (shared.join(weight, "cid").groupBy("gram").agg(F.max(F.struct("w", "cid", "n")).alias("hub"))
            .select("gram", F.col("hub.cid").alias("a"), F.col("hub.n").alias("na")))
    fits = lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y)
    tries = (shared.join(hubs, "gram").filter((F.col("a") != F.col("cid")) & fits(F.col("na"), F.col("n")))
             .groupBy("a", F.col("cid").alias("b")).agg(F.count("*").alias("common")))
    place = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("common"), "a"))
    first = materialize(tries.withColumn("place", place).filter(F.col("place") <= HUBS).select("a", "b"), "hubs")
    links = trie_join(first, classes, percent)
    comp = materialize(components(links), "components")
    # n-grams whose sets lie in several components: the pairs across them
    named = materialize(shared.join(comp.withColumnRenamed("node", "cid"), "cid", "left")
                        .withColumn("component", F.coalesce("component", "cid")), "named")
    mixed = named.groupBy("gram").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x != y").select("gram")
    several = materialize(named.join(mixed, "gram", "left_semi").join(classes.select("cid", "parity"), "cid")
                          .select("gram", "cid", "n", "left", "component", "parity"), "several")
    side = lambda x: several.select("gram", *[F.col(c).alias(k + x) for c, k in (
        ("cid", ""), ("n", "n"), ("left", "l"), ("component", "c"), ("parity", "p"))])
    common = F.least("la", "lb")
    # parities that differ are n-grams that only one of the two sets has
    differ = sum((F.bit_count(F.col("pa")[k].bitwiseXOR(F.col("pb")[k])) for k in range(1, PARITY // 64)),
                 F.bit_count(F.col("pa")[0].bitwiseXOR(F.col("pb")[0])))
    both = F.col("na") + F.col("nb")
    across = (side("a").join(side("b"), "gram")
              .filter((F.col("ca") != F.col("cb")) & (F.col("a") < F.col("b")) & (100 * common >= percent * (both - common))
                      & ((100 + percent) * (both - differ) >= 2 * percent * both))
              .select("a", "b").distinct())
    tested = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = materialize(across.join(tested, ["a", "b"], "left_anti"), "across")
    more = trie_join(rest, classes, percent)
    final = materialize(components(comp.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)), "components")
    # from component back to set: the smallest id of all its sets
    heads = table.filter("n > 0").groupBy("set_key").agg(F.min("id").alias("head"))
    owned = (classes.select("set_key", "cid").join(final.withColumnRenamed("node", "cid"), "cid").select("set_key", "component")
             .join(heads, "set_key"))
    least = owned.groupBy("component").agg(F.min("head").alias("least"))
    linked = owned.join(least, "component").select("set_key", "least")
    members = materialize(heads.join(linked, "set_key", "left").select("set_key", F.coalesce("least", "head").alias("component")), "members")
    discard(classes, shared, first, links, comp, named, several, rest, more, final)
    rows = table.select("id", "set_key", "n", "run")
    found = join_back(rows.filter("n > 0"), members, ["set_key"], "run").select("id", F.col("n").alias("n_shingles"), "component")
    return found.union(rows.filter("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component")))
