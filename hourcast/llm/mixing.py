"""Mixing sources to target weights by systematic sampling.

Targets: each source gets its weight's share of all sizes, at most ``limit``
times its own size; what a source cannot take is shared again by weight until
none is above (one level for all: target = min(limit * size, level * weight)).

Copies: every document of a source has the same expected number of copies,
target / size. With r documents before it, a document's interval on the
source's line is [r * e, (r + 1) * e); shifted by one random offset per source,
it is emitted once per integer inside. Documents stand in order of size class
(8 per octave) and hash, so that every size class gets its share and the words
taken come near the target. The running number r comes from counts per block
(source, size class, hash block) plus a row number inside the block, so a hot
source is spread over all tasks.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order; a source without any words takes nothing. Repeated rows are
separate documents. Results depend on rows and seed only, not on partitions.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import count_words, fresh, materialize

WEIGHTS = (1, 2, 3)
#: hash blocks per source and size class; a window sorts one block
BLOCKS = 256


def targets(totals: DataFrame, weights=WEIGHTS, limit: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row each.

    The level at which the sizes are used up lies between two neighbours in the
    order of limit * size / weight: below it sources are full, above it they
    share what is left by weight. Runs on one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    table = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")))
    every, cap = Window.partitionBy(), F.lit(limit) * F.col("source_size")
    fill = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    table = (table.withColumn("total", F.sum("source_size").over(every))
             .withColumn("full", F.coalesce(F.sum(cap).over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("open", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))))
    level = (F.col("total") - F.col("full")) / F.col("open")
    # the first source that is not full sets the level for all after it; later ones give less
    table = table.withColumn("level", F.max(F.when(cap >= level * F.col("weight"), level)).over(every))
    share = F.col("level") * F.col("weight")
    return table.select("source", "source_size", F.when(share >= cap, cap.cast("double")).otherwise(share).alias("target"))


def offset(source: Column, seed: int) -> Column:
    """One number in [0, 1) per source and seed."""
    word = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.concat(F.lit("s"), source), F.lit("")), F.lit(seed)), 11)
    return word / F.lit(float(2 ** 53))


def mix(docs: DataFrame, size: Column, source: str = "source", weights=WEIGHTS, limit: int = 3, seed: int = 0) -> DataFrame:
    """``docs`` with size, source_size, target and copies (0 or more).

    ``size`` is an expression on the row. The added columns get fresh names,
    in this order, at the end.
    """
    inner = [f"c{i}" for i in range(len(docs.columns))]  # any column name may clash with a helper's
    out = docs.select(*[F.col(f"`{c}`").alias(i) for c, i in zip(docs.columns, inner)],
                      size.cast("long").alias("size"), F.col(f"`{source}`").alias("source"))
    # a key that is never null: window and join below then share one exchange
    out = (out.withColumn("key", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")))
           .withColumn("mark", F.xxhash64(F.lit(seed), *inner))
           .withColumn("class", F.floor(8 * F.log2(F.col("size") + F.lit(1))).cast("int"))
           .withColumn("block", F.pmod("mark", F.lit(BLOCKS)).cast("int")))
    cell = ["key", "class", "block"]
    counts = materialize(out.groupBy(*cell, "source").agg(F.count("*").alias("n"), F.sum("size").alias("s")), "mix")
    before = Window.partitionBy("key").orderBy("class", "block").rowsBetween(Window.unboundedPreceding, -1)
    goal = targets(counts.groupBy("source").agg(F.sum("s").alias("source_size")), weights, limit)
    blocks = (counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).alias("b")
              .join(goal.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source")))
              .select(*cell, "before", "source_size", "target"))
    out = out.withColumn("place", F.row_number().over(Window.partitionBy(*cell).orderBy("mark")) - 1)
    out = out.join(blocks, cell)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = F.col("before") + F.col("place")
    line = lambda r: F.floor(r * expected + offset(F.col("source"), seed))
    return out.select(*inner, "size", "source_size", "target", (line(at + 1) - line(at)).cast("int").alias("copies")).toDF(
        *docs.columns, *fresh(docs, "size", "source_size", "target", "copies"))


def mixture(docs: DataFrame, text: str = "text", source: str = "source", weights=WEIGHTS, limit: int = 3, seed: int = 0) -> DataFrame:
    """``docs`` as the mix takes them: rows repeated, or left out; same columns."""
    out = mix(docs, count_words(F.col(text)), source, weights, limit, seed)
    copies = out.columns[-1]
    repeated = F.explode(F.sequence(F.lit(1), F.col(copies)))
    return out.filter(F.col(copies) > 0).withColumn(copies, repeated).select(*[F.col(f"`{c}`") for c in docs.columns])
