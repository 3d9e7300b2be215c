"""Exact duplicates by a tree merge of sorted digest runs (DataFrame only).

Every input partition is one *run*: its rows as (digest, SHA-256, byte length)
with the identifier to keep and a count. Rounds follow a binomial tree: in
each, ``2**bits`` neighbouring runs meet (run number shifted right), are sorted
by digest and merged; of entries whose digest, SHA-256 and length all agree the
best identifier is retained and the counts are added. After the last round one
run is left -- in the sense of one run *number*: its rows stay dealt out by
digest over all tasks. A merge group never has more than ``2**bits`` entries,
however many rows share a text, as each run brings one entry per digest.

Defined cases: a null text counts as empty; all empty texts are equal. A null
identifier is kept only in a group without any other. Rows that repeat both
identifier and text count as separate rows of the group, and exactly one of
them stays. An empty table gives an empty result. Other columns are untouched
and may have any name.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, join_back, materialize, pick_rows, sha256

KEY = ["digest", "sha256", "n_bytes"]


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(run, rid, id, digest, sha256, n_bytes) per row; rid numbers the rows."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.spark_partition_id().cast("long").alias("run"), F.monotonically_increasing_id().alias("rid"),
        F.col(doc_id).alias("id"), F.xxhash64(body).alias("digest"), sha256(text).alias("sha256"),
        F.octet_length(body).cast("long").alias("n_bytes"))


def _best(keep: str):
    """Order in which the first entry is the one to keep."""
    return [F.col("id").desc_nulls_last() if keep == "max" else F.col("id").asc_nulls_last(), F.col("rid").asc()]


def merge(entries: DataFrame, keep: str) -> DataFrame:
    """Sort the entries of equal run numbers by digest and keep one each."""
    group = Window.partitionBy("run", *KEY)
    return (entries.withColumn("size", F.sum("size").over(group))
            .withColumn("place", F.row_number().over(group.orderBy(*_best(keep))))
            .filter("place = 1").drop("place"))


def tree_merge(table: DataFrame, keep: str = "min", bits: int = 3) -> DataFrame:
    """One row per text: (digest, sha256, n_bytes, keep_id, keep_rid, size).

    ``table`` has the columns of :func:`digests`; ``keep`` is min or max.
    """
    if keep not in ("min", "max"):
        raise ValueError(f"keep must be min or max, not {keep!r}")
    # within a partition, repeated texts fold before anything is exchanged
    runs = merge(table.withColumn("size", F.lit(1).cast("long")), keep)
    last = table.agg(F.max("run")).first()[0] or 0
    while last:
        last >>= bits
        runs = merge(runs.withColumn("run", F.shiftright("run", bits)), keep)
    return runs.select(*KEY, F.col("id").alias("keep_id"), F.col("rid").alias("keep_rid"), "size")


def duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "min") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, size of its group, kept, sha256."""
    table = materialize(digests(docs, text, doc_id), "digests")
    found = join_back(table, tree_merge(table, keep), KEY, "run")
    return found.select("id", "keep_id", "size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "sha256")


#: names of rows to leave out that are sent to every executor (some 16 MB)
SENT = 200_000


def drop_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "min") -> DataFrame:
    """``docs`` with one row of each group of equal texts; same columns.

    Rows are named by (id, SHA-256). Only the names that go are joined with the
    texts: broadcast while they are few (counted first), by a sorted join beyond.
    Of names that several rows bear one row is picked.
    """
    table = materialize(digests(docs, text, doc_id), "digests")
    winners = tree_merge(table, keep).select(F.col("keep_id").alias("id"), "sha256", F.lit(True).alias("stays"))
    names = table.groupBy("id", "sha256").agg(F.count("*").alias("rows"))
    same = lambda c: F.col(f"names.{c}").eqNullSafe(F.col(f"winners.{c}"))
    left = (names.alias("names").join(winners.alias("winners"), same("id") & same("sha256"), "left")
            .select("names.id", "names.sha256", "rows", "stays"))
    # rows that bear the name of a row that stays alone need no join
    others = materialize(left.filter(F.col("stays").isNull() | (F.col("rows") > 1)), "others")
    sent = F.broadcast if others.count() <= SENT else lambda t: t
    sha, key = fresh(docs, "p_sha", "p_key")
    keyed = docs.withColumn(sha, sha256(text)).withColumn(key, F.col(doc_id))
    named = sent(others.select(F.col("sha256").alias(sha), F.col("id").alias(f"{key}_2")))
    alone = keyed.join(named, [F.col(key).eqNullSafe(F.col(f"{key}_2")), keyed[sha] == named[sha]], "left_anti")
    several = others.filter(F.col("stays")).select("id", "sha256")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return alone.select(*columns).union(pick_rows(docs, several, text, doc_id).select(*columns))
