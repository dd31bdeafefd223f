"""Helpers the training-data operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a Python worker holds as Python objects at a time.
SLICE_BYTES = 2 << 20
#: Bits of a filter of hashes: its size is fixed, 1 MB.  Beyond it more passes than needed, and what passes is always looked up.
FILTER_BITS = 1 << 23
#: Has Spark remove a query's shuffle files when it has ended; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir.  Unset, only a local session gets one: a folder that goes with the process."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="acreframe-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(own)
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/acreframe/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table of the shared folder that nothing reads any more."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Remove the tables this application has materialised; nothing that still reads them may be in use."""
    discard(spark, f"{shared_dir(spark)}/acreframe/{spark.sparkContext.applicationId}")


def materialise(df: DataFrame, name: str, path: str | None = None, **options: str) -> DataFrame:
    """Write to the shared folder (or to path) and read again: cuts lineage, and survives a lost executor.  Shuffle files go with the write."""
    spark = df.sparkSession
    path = path or table_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, or with underscores behind it one that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """doc_id; a row without one gets a negative id from its text, so it sorts first and can be joined on."""
    return F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(F.col(text)).bitwiseOR(F.lit(-(1 << 63))))


def digest(text: str = "text") -> Column:
    """128 bits that tell a text from any other; null counts as empty.  With row_key it tells a row from others of the same id."""
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))


def bit_table(values: DataFrame) -> np.ndarray:
    """A filter of the longs in the only column: FILTER_BITS bits, made by a grouped bit_or."""
    place = f"(`{values.columns[0]}` & {FILTER_BITS - 1})"
    words = values.select(F.expr(f"shiftright({place}, 6)").alias("w"), F.expr(f"shiftleft(1L, cast({place} & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).collect()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for w, b in words:
        bits[w] = b
    return bits.view(np.uint8)


def in_table(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = values.astype(np.uint64) & np.uint64(FILTER_BITS - 1)
    return (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a record batch with about `size` bytes of the column each; one row at least."""
    lengths = batch.column(column)
    lengths = pc.fill_null(pc.binary_length(lengths), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(lengths):
        if i > start and held + n > size:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if len(lengths) > start:
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()  # workers are kept, and beside each other their free memory counts


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
