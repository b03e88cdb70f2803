"""Storage, sizing and Arrow helpers shared by the corpus operators."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one task chunk of a corpus should hold.
CHUNK_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A temporary folder is used only for a local master with the setting missing.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="secflow-shared-"))
        folder = context.getCheckpointDir()
    return folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """``df`` with ``place``, the number of each row (from 0) in the order of the columns ``order``; stored.

    Rows are dealt into ranges, numbered inside a range, and moved on by the rows of the ranges before it.
    The range bounds hold all columns of ``order``, so a value that many rows share is spread if a later
    column differs. One count per range reaches the driver. Rows equal in ``order`` get any of their places.
    """
    spark = df.sparkSession
    held = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), label)
    sizes = held.groupBy(F.shiftright("at", 33).alias("range")).agg(F.count("*").alias("n")).collect()
    before, offsets = 0, []
    for r in sorted(sizes):
        offsets.append((r["range"], before))
        before += r.n
    first = spark.createDataFrame(offsets, "range long, before long")
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return held.withColumn("range", F.shiftright("at", 33)).join(F.broadcast(first), "range").withColumn("place", place).drop("range", "at", "before")


def text_bytes(docs: DataFrame, text: str) -> int:
    """UTF-8 bytes of a text column over the whole table."""
    return docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def chunk_count(total_bytes: int, chunk_bytes: int = CHUNK_BYTES) -> int:
    return max(1, math.ceil(total_bytes / chunk_bytes))


def bucket_bits(total_bytes: int, bucket_bytes: int = CHUNK_BYTES) -> int:
    """Bits of a bucket number such that one bucket serves about ``bucket_bytes`` of text."""
    return max(1, math.ceil(math.log2(max(2, total_bytes / bucket_bytes))))


def chunk_of(chunks: int, *columns: str) -> Column:
    """A chunk number that depends on the values only, so a task that runs again finds the same chunk."""
    return F.pmod(F.xxhash64(*columns), F.lit(chunks)).cast("int").alias("chunk")


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null is an empty text."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``most_bytes`` of text (a longer text stays whole)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        start = size = 0
        for i, length in enumerate(pc.binary_length(column).to_pylist()):
            if size and size + (length or 0) > most_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += length or 0
        yield batch.slice(start)
