"""What several operators share: the scratch folder, written intermediate tables and text columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficspark.sources.shared import shared_dir

#: A word of the contracts: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """df written (with the writer's `options`) as a table in the shared folder and read back: lineage ends there, and a lost executor costs no rerun."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(compression="zstd", **options).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def forget(table: DataFrame) -> None:
    """Remove the files of a table from `stored` once nothing that is still to run reads it."""
    context = table.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(table.stored_at)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def batches_of(spark: SparkSession, most: str) -> Iterator[None]:
    """Jobs in here hand batches of about `most` bytes to Python: a task holds a batch several times over, on both sides."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows, `rows` at a time, so that what a task makes of a batch stays small."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)


def few(table: DataFrame, rows: int = 500_000) -> DataFrame:
    """A written table of narrow rows, marked to be sent to all tasks if it holds no more than `rows`; beyond that joins shuffle."""
    return F.broadcast(table) if table.count() <= rows else table


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words in the sense of WORD; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_bucket(column: Column, buckets: int) -> Column:
    """crc32 of the column as text, modulo buckets; null for null."""
    return F.crc32(column.cast("string").cast("binary")) % buckets


def binary_large(column: Column) -> Column:
    """Text as UTF-8 bytes, empty for null."""
    return F.coalesce(F.encode(column, "UTF-8"), F.lit(b""))
