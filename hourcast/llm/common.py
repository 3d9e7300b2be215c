"""Shared pieces of the training-data operators.

Words are maximal runs of characters other than space and U+0009-U+000D.
Python's ``bytes.split()`` splits on exactly these six characters, so the
Arrow operators split UTF-8 bytes and agree with the regular expressions.
"""
from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage, fixes what non-deterministic columns (row ids) were, and
    keeps column pruning for every later read.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete written tables that no later plan reads."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def sha256(text: str):
    """SHA-256 of a text column as 32 bytes, null counting as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def pick_rows(docs: DataFrame, chosen: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The rows of ``docs`` that ``chosen`` names by (id, sha256), one for each.

    Adds the other columns of ``chosen``. Rows are told apart by what they hold,
    not by numbers, so ``docs`` need not be written again. Join and row number
    need the same partitioning, so the texts move once.
    """
    extra = [c for c in chosen.columns if c not in ("id", "sha256")]
    sha, key, place = fresh(docs, "p_sha", "p_key", "p_place")
    name = lambda c: F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(c).cast("string")))
    keyed = docs.withColumn(sha, sha256(text)).withColumn(key, name(doc_id))
    named = chosen.select(F.col("sha256").alias(sha), name("id").alias(key), *extra)
    out = keyed.join(named, [sha, key])
    out = out.withColumn(place, F.row_number().over(Window.partitionBy(sha, key).orderBy(sha))).filter(F.col(place) == 1)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *extra)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Helper column names that do not clash with those of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def join_back(rows: DataFrame, groups: DataFrame, key: list[str], run: str) -> DataFrame:
    """Attach one row per ``key`` of ``groups`` to every row of ``rows``.

    A key may hold a third of all rows. Only the distinct (run, key) pairs are
    joined with the groups, so a hot key costs one row per run there; the rows
    then join on (run, key), which spreads a hot key over all runs.
    """
    carried = rows.select(run, *key).distinct().join(groups, key)
    return rows.join(carried, [run, *key])


def batches_of(batch: pa.RecordBatch, text: str, limit: int = 1 << 23):
    """Slices of ``batch`` with at most ``limit`` bytes of text each (one row
    at least), so that what numpy holds at a time stays small."""
    size = np.cumsum(text_bytes(batch.column(batch.schema.get_field_index(text))))
    start = 0
    while start < batch.num_rows:
        base = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def text_bytes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null becomes empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 (public domain): a bijection on 64 bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def pack_gaps(cells: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as compressed gaps, byte planes apart."""
    gaps = np.diff(cells, prepend=np.uint32(0)).astype("<u4")
    planes = gaps.view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(planes).to_bytes(4, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def unpack_gaps(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:4], "little")
    planes = pa.decompress(data[4:], size, codec="zstd", asbytes=True) if size else b""
    planes = np.frombuffer(planes, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def pack_longs(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers of one length as compressed differences, byte
    planes apart; small where neighbours resemble each other."""
    if not len(columns[0]):
        return b""
    gaps = np.diff(np.stack(columns).astype("<i8"), axis=1, prepend=0)
    planes = np.ascontiguousarray(gaps).view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1).tobytes()
    return len(columns[0]).to_bytes(4, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack_longs(data: bytes, columns: int) -> np.ndarray:
    """The columns of :func:`pack_longs`, one row each."""
    if not data:
        return np.empty((columns, 0), np.int64)
    n = int.from_bytes(data[:4], "little")
    planes = np.frombuffer(pa.decompress(data[4:], 8 * n * columns, codec="zstd", asbytes=True), np.uint8)
    gaps = np.ascontiguousarray(planes.reshape(columns, 8, n).transpose(0, 2, 1)).view("<i8").reshape(columns, n)
    return np.cumsum(gaps, axis=1)


def count_words(text):
    """Number of words of a text column, null counting as no text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
