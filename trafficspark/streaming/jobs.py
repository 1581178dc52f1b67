"""Streaming jobs: ingest landed snapshots, count distinct entities by hour, raise alarms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trafficspark.sources.decode import decode_states
from trafficspark.sources.tables import DATE_COLUMNS, with_partitions


def ingest_stream(spark: SparkSession, landing: str, root: str, checkpoint: str, *, trigger: dict | None = None) -> StreamingQuery:
    """Envelope files (one JSON document a line) to the partitioned raw table; each file is taken in exactly once."""
    lines = spark.readStream.text(landing).withColumnRenamed("value", "json")
    rows = with_partitions(decode_states(lines))
    writer = rows.writeStream.partitionBy(*DATE_COLUMNS).option("checkpointLocation", checkpoint).option("compression", "snappy").trigger(**(trigger or {"availableNow": True}))
    return writer.format("parquet").outputMode("append").start(root)


def hourly_counts_stream(df: DataFrame, *, entity: str, time: str, watermark: str = "1 hour") -> DataFrame:
    """hour_start, flight_count of a stream: distinct entities (null is one) of each hour that the watermark has passed.

    Naive times are taken as UTC. Each entity is kept once an hour until then; rows later than that are dropped.
    """
    timed = df.select(F.col(entity).cast("string").alias("entity"), F.col(time).cast("timestamp").alias("at")).withWatermark("at", watermark)
    once = timed.withColumn("hour", F.window("at", "1 hour")).dropDuplicates(["entity", "hour"])
    return once.groupBy("hour").agg(F.count(F.lit(1)).alias("flight_count")).select(F.col("hour.start").cast("timestamp_ntz").alias("hour_start"), "flight_count")


def hourly_sketch_stream(df: DataFrame, *, entity: str, time: str, keys: tuple[str, ...] = (), watermark: str = "1 hour", size: int = 14) -> DataFrame:
    """keys, hour_start, sketch of a stream: distinct entities (null is one more) of each hour that the watermark has passed.

    The state of an open hour is one sketch a key, of a size that doesn't go with its entities; the watermark closes
    hours, as a timer would. What comes out merges to longer spans by `merged_counts`; `sketch_counts` gives hours.
    Estimates are off by 1.04 / sqrt(2 ** size) of the count, one time in three; later rows are dropped.
    """
    e = F.coalesce(F.col(entity).cast("string"), F.lit("\0"))
    timed = df.select(*keys, e.alias("entity"), F.col(time).cast("timestamp").alias("at")).withWatermark("at", watermark)
    held = timed.groupBy(*keys, F.window("at", "1 hour").alias("hour")).agg(F.hll_sketch_agg("entity", size).alias("sketch"))
    return held.select(*keys, F.col("hour.start").cast("timestamp_ntz").alias("hour_start"), "sketch")


def sketch_counts(sketches: DataFrame) -> DataFrame:
    """The sketches' columns with flight_count, an estimate, in place of the sketch."""
    return sketches.select(*(c for c in sketches.columns if c != "sketch"), F.hll_sketch_estimate("sketch").alias("flight_count"))


def failure_alarm_stream(events: DataFrame, *, time: str = "created_at", watermark: str = "10 minutes", window: str = "5 minutes", threshold: int = 3) -> DataFrame:
    """window_start, failures of a stream of run events: windows with `threshold` failures, once the watermark has passed.

    Runs that succeed move the watermark on too, so failures are counted, not filtered, before the windows close.
    """
    timed = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark)
    counted = timed.groupBy(F.window(time, window).alias("w")).agg(F.sum((F.col("status") == "failed").cast("long")).alias("failures"))
    return counted.where(F.col("failures") >= threshold).select(F.col("w.start").alias("window_start"), "failures")
