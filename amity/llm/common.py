"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are what stands between these characters.
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column, gap: str = GAP) -> Column:
    """The words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gap), "")


def remainder(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % m, F.lit(-1))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all machines see.

    `spark.checkpoint.dir` names it. A local session without that setting uses
    the warehouse folder; any other session without it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: its lineage ends here."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def runs(sizes: list[int], most: int):
    """(start, end) of rows in order whose sizes add up to `most` at most, or of single ones."""
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def slices(batches, column: str, max_chars: int = 2_000_000):
    """Batches cut so that each holds about `max_chars` of text or a single row."""
    for batch in batches:
        sizes = batch[column].str.len().fillna(0).tolist()
        for start, end in runs(sizes, max_chars):
            yield batch.iloc[start:end]
        del batch
        give_back()


def arrow_slices(batches, column: str = "text", max_bytes: int = 2_000_000):
    """Arrow batches cut so that each holds about `max_bytes` of text or a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for start, end in runs(sizes, max_bytes):
            yield batch.slice(start, end - start)
        del batch
        give_back()


def give_back() -> None:
    """Freed memory goes back to the system.

    A Python worker is used again by later stages, and what the allocator keeps
    for it is missing there.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
