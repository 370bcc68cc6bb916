"""Helpers shared by the training-data operators: shared scratch tables, tables, batches."""

from __future__ import annotations

import gc
import pickle
import uuid
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixpoint import Scratch

#: Rows and bytes that a Python worker gets at once (a text is never divided).
ROWS_PER_BATCH, BYTES_PER_BATCH = 512, 16 << 20
#: Bytes of a row group, which a task holds while it writes or reads one.
BYTES_PER_GROUP = 16 << 20


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded rows and bytes, for the session from now on, so that long texts fit in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))


def small_tables(spark: SparkSession) -> None:
    """Parquet is read in batches of few rows and written in small row groups, for the session from now on, so that tasks which carry whole texts share a heap of 1 GB.

    By default a task reads 4096 texts at once and collects 128 MB before it writes. Smaller settings stay.
    """
    hadoop = spark._jsc.hadoopConfiguration()
    for name, most in (("spark.sql.parquet.columnarReaderBatchSize", ROWS_PER_BATCH), ("parquet.block.size", BYTES_PER_GROUP)):
        known = spark.conf.get(name, None) or hadoop.get(name)
        spark.conf.set(name, str(min(int(known or most), most)))


def fixed_tasks(spark: SparkSession) -> None:
    """Files are dealt to tasks by their sizes alone, for the session from now on: executors that come or go between passes change nothing."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        known = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
        spark.conf.set("spark.sql.files.minPartitionNum", known or str(spark.sparkContext.defaultParallelism))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the open scope's folder, which is shared, and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{Scratch.current(spark).folder}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete a table made by materialize()."""
    path = getattr(df, "_scratch_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def partitions_for(docs: DataFrame, chars: int) -> int:
    """Shuffle partitions for docs' texts: so many characters in each, about, and no fewer than the session's."""
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // chars)


def by_bucket(sent: DataFrame, n: int) -> DataFrame:
    """Each of n buckets, numbered from 0, to a partition of its own: dealt by hash, several would meet in one."""
    return sent.repartitionById(n, F.col("bucket"))


def one_row_each(rows: DataFrame) -> DataFrame:
    """Of the rows of one doc_id the one with the smallest hash of its text."""
    rest = F.min_by(F.struct(*(c for c in rows.columns if c != "doc_id")), F.xxhash64("text")).alias("one")
    return rows.groupBy("doc_id").agg(rest).select("doc_id", "one.*")


def within(rows: DataFrame, column: str, most: int) -> list[dict]:
    """Rows (doc_id, ...), one for each id of a bounded sample, by hash of the id, as long as a column's bytes stay within a bound.

    The sizes come first, so no more than that is ever sent to the driver.
    """
    rows = materialize(rows, "sample")
    chosen, room = [], most
    for r in rows.select("doc_id", F.octet_length(column).alias("size"), F.xxhash64("doc_id").alias("h")).orderBy("h").collect():  # a row of three numbers for each id
        room -= r["size"] or 0
        if room < 0:
            break
        chosen.append(r["doc_id"])
    out = rows.where(F.col("doc_id").isin(chosen)).toArrow().to_pylist() if chosen else []
    discard(rows)
    return out


def squeeze(x: object, level: int = 3) -> bytes:
    """Arrays and lists as compressed bytes, to be sent in one piece."""
    import zstandard

    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(x, protocol=5))


def expand(b: bytes) -> object:
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(b))


def planes(x: np.ndarray) -> tuple[str, bytes]:
    """An array of numbers with the first bytes of all, then the second ones and so on: small numbers compress well."""
    return x.dtype.str, x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def from_planes(kind: str, body: bytes) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(size, -1).T).view(kind).ravel()


def ascending(x: np.ndarray) -> tuple[str, bytes]:
    """Sorted unsigned 64-bit numbers by their differences."""
    return planes(np.diff(x, prepend=np.zeros(1, np.uint64)))


def from_ascending(kind: str, body: bytes) -> np.ndarray:
    return np.cumsum(from_planes(kind, body), dtype=np.uint64)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of finished steps now: it does so when the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fold(doc_id: int, n: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % n


def fold_column(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(n)
