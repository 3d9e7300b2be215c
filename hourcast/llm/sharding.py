"""Sharding over fixed virtual slots.

Records hash into ``slots`` virtual slots by their text, so equal texts share a
shard. Bytes are added up per slot; a versioned table says which shard holds
which slot. Version 0 deals slots out in turn; rebalancing edits it: slots move
from the fullest to the emptiest shard until no move brings the two closer.
Adding a shard moves slots into the new shard only.

One parameter says how heavy a text may be: with ``heaviest`` (a part of a shard's
share of all bytes, 1/2 by default) the copies of a heavier text are dealt out by
record, so that sizes stay near equal whatever the data (there are fewer than
shards / heaviest such texts); ``heaviest=None`` keeps equal texts together always,
and shards are then as even as their heaviest text allows. What reaches the driver
is one row per slot, a number fixed beforehand.

Rows are numbered from 0 in their shard: slot by slot, inside a slot by one of
``BLOCKS`` hash blocks, and by id inside a block. Offsets come from a table of
slots * BLOCKS counts, so a slot of many copies is numbered by many tasks.

Defined cases: a null text has no bytes (size 1, crc of nothing); null ids come
first in their slot. Repeated rows are separate records. An empty table gives an
empty result and leaves version 0 as it is.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, scratch

SLOTS, BLOCKS = 4096, 16


@dataclass(frozen=True)
class SlotMap:
    """One version of the slot-to-shard map."""
    version: int
    shards: int
    owner: tuple

    @staticmethod
    def start(shards: int, slots: int = SLOTS) -> SlotMap:
        return SlotMap(0, shards, tuple(k % shards for k in range(slots)))

    def rebalance(self, size: dict[int, int]) -> SlotMap:
        """The next version: moves that bring the fullest and emptiest closer."""
        owner, held, load = self._state(size)
        while True:
            full, empty = max(load, key=load.get), min(load, key=load.get)
            gap = load[full] - load[empty]
            fit = [k for k in held[full] if 0 < size.get(k, 0) < gap]
            if not fit:
                break
            k = min(fit, key=lambda k: (abs(gap - 2 * size[k]), k))
            if abs(gap - 2 * size[k]) >= gap:
                break
            self._move(k, full, empty, owner, held, load, size)
        return SlotMap(self.version + 1, self.shards, tuple(owner))

    def grow(self, size: dict[int, int]) -> SlotMap:
        """The next version with one more shard; slots move into it only."""
        owner, held, load = self._state(size)
        new = self.shards
        held[new], load[new] = set(), 0
        while True:
            full = max(load, key=load.get)
            gap = load[full] - load[new]
            fit = [k for k in held[full] if 0 < size.get(k, 0) < gap] if full != new else []
            if not fit:
                break
            k = min(fit, key=lambda k: (abs(gap - 2 * size[k]), k))
            self._move(k, full, new, owner, held, load, size)
        return SlotMap(self.version + 1, self.shards + 1, tuple(owner))

    def _state(self, size):
        held = {s: set() for s in range(self.shards)}
        for k, s in enumerate(self.owner):
            held[s].add(k)
        return list(self.owner), held, {s: sum(size.get(k, 0) for k in own) for s, own in held.items()}

    @staticmethod
    def _move(k, a, b, owner, held, load, size):
        owner[k] = b
        held[a].discard(k)
        held[b].add(k)
        load[a] -= size[k]
        load[b] += size[k]

    def save(self, spark: SparkSession, path: str) -> None:
        """Append this version to the map table."""
        rows = [(self.version, self.shards, k, s) for k, s in enumerate(self.owner)]
        spark.createDataFrame(rows, "version int, shards int, slot int, shard int").coalesce(1).write.mode("append").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """A version of the map table, the latest by default."""
        table = spark.read.parquet(path)
        if version is None:
            version = table.agg(F.max("version")).first()[0]
        rows = table.filter(F.col("version") == version).orderBy("slot").collect()
        return SlotMap(version, rows[0]["shards"], tuple(r["shard"] for r in rows))


def records(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(id, size, crc, text_hash) of every row, written once."""
    body = F.coalesce(F.col(text), F.lit(""))
    return materialize(docs.select(F.col(doc_id).alias("id"), (F.octet_length(body) + 1).cast("long").alias("size"),
                                   F.crc32(body.cast("binary")).alias("crc"), F.xxhash64(body).alias("text_hash")), "records")


def with_slots(table: DataFrame, shards: int, slots: int = SLOTS, heaviest: float | None = 0.5) -> DataFrame:
    """Adds virtual_slot: by text, or by record for texts above ``heaviest``."""
    heavy = []
    if heaviest is not None:
        total = table.agg(F.sum("size")).first()[0] or 0
        heavy = [r[0] for r in table.groupBy("text_hash").agg(F.sum("size").alias("s"))
                 .filter(F.col("s") * shards > heaviest * total).select("text_hash").collect()]
    spread = F.xxhash64(F.col("id"), F.col("text_hash"))
    key = F.when(F.col("text_hash").isin(heavy), spread).otherwise(F.col("text_hash")) if heavy else F.col("text_hash")
    return table.withColumn("virtual_slot", F.pmod(key, F.lit(slots)).cast("int"))


def shard(docs: DataFrame, shards: int, text: str = "text", doc_id: str = "doc_id", slots: int = SLOTS,
          map_path: str | None = None, heaviest: float | None = 0.5) -> DataFrame:
    """id, size, crc, shard, slot (place in the shard), virtual_slot, map_version.

    The map table at ``map_path`` (a fresh one in the shared folder by default)
    gets version 0 if it is new, and the edited version.
    """
    spark = docs.sparkSession
    table = with_slots(records(docs, text, doc_id), shards, slots, heaviest)
    table = table.withColumn("block", F.pmod(F.xxhash64("id", "text_hash", F.lit(1)), F.lit(BLOCKS)).cast("int"))
    cells = materialize(table.groupBy("virtual_slot", "block").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "cells")
    sums = cells.groupBy("virtual_slot").agg(F.sum("size"), F.sum("n")).collect()
    size, count = {r[0]: r[1] for r in sums}, {r[0]: r[2] for r in sums}
    if map_path is None:
        map_path = scratch(spark, "slot-map")
        SlotMap.start(shards, slots).save(spark, map_path)
    edited = SlotMap.load(spark, map_path).rebalance(size)
    edited.save(spark, map_path)
    # first place of every slot in its shard
    base, rows = [0] * edited.shards, []
    for k, s in enumerate(edited.owner):
        rows.append((k, s, base[s], edited.version))
        base[s] += count.get(k, 0)
    places = spark.createDataFrame(rows, "virtual_slot int, shard int, base long, map_version int")
    ahead = Window.partitionBy("virtual_slot").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("base") + F.coalesce(F.sum("n").over(ahead), F.lit(0))
    places = cells.join(F.broadcast(places), "virtual_slot").select("virtual_slot", "block", "shard", begin.alias("base"), "map_version")
    inside = Window.partitionBy("virtual_slot", "block").orderBy("id", "text_hash")
    # at most slots * BLOCKS rows, whatever the corpus
    return (table.withColumn("place", F.row_number().over(inside) - 1).join(F.broadcast(places), ["virtual_slot", "block"])
            .select("id", "size", "crc", "shard", (F.col("base") + F.col("place")).alias("slot"), "virtual_slot", "map_version"))
