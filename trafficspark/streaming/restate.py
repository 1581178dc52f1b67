"""Hourly counts of a stream that stay right when rows come late: spans that a batch touches are counted again.

A batch is first added to the raw table, in folders of its own, so that a batch that is replayed replaces itself. Then
the spans it touches (days, or single hours), however old, are counted from all raw rows of their days and take the place
of those spans in the table of counts: days make few files, hours rewrite least. Nothing hangs on a watermark but the account of which hours were restated: those that the stream had
passed by more than `lateness` when the rows came.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trafficspark.functions.scalars import hour_start
from trafficspark.operators.aggregates import hourly_counts

#: Folders of a root: raw rows by day and batch, counts by span, and the account of each batch by hour.
RAW, COUNTS, ACCOUNT = "raw", "counts", "account"


def table(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """A table below root; empty until its first batch."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(schema).parquet(f"{root}/{name}") if there else spark.createDataFrame([], schema)


def replace_parts(df: DataFrame, path: str, *by: str) -> None:
    """Write df in place of what its own partitions held, and leave all others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def restate_batch(batch: DataFrame, batch_id: int, root: str, *, entity: str, time: str, keys: tuple[str, ...] = (), lateness: str = "1 hour", span: str = "day") -> None:
    """Take in one batch: raw rows, counts of the spans ("day" or "hour") it touches, and the account of its hours. Doing it again changes nothing.

    Rows without a time belong to no hour and are left out.
    """
    spark = batch.sparkSession
    rows = batch.where(F.col(time).isNotNull()).select(*keys, entity, F.col(time).cast("timestamp_ntz").alias(time))
    raw = rows.withColumns({"day": F.to_date(time), "batch": F.lit(batch_id).cast("long")})
    replace_parts(raw, f"{root}/{RAW}", "day", "batch")
    own = spark.read.schema(raw.schema).parquet(f"{root}/{RAW}").where(F.col("batch") == batch_id)
    hours = own.groupBy(hour_start(F.col(time)).alias("hour_start"), "day").agg(F.count(F.lit(1)).alias("rows"))
    account = "hour_start timestamp_ntz, rows long, late boolean, latest timestamp_ntz, batch long"
    reached = table(spark, root, ACCOUNT, account).where(F.col("batch") < batch_id).agg(F.max("latest").alias("reached"))  # one row
    latest = own.agg(F.max(time).alias("latest"))  # one row
    late = F.coalesce(F.col("hour_start") + F.expr("interval 1 hour") + F.expr(f"interval {lateness}") <= F.col("reached"), F.lit(False))
    told = hours.join(F.broadcast(reached)).join(F.broadcast(latest)).select("hour_start", "rows", late.alias("late"), "latest", F.lit(batch_id).cast("long").alias("batch"))
    replace_parts(told, f"{root}/{ACCOUNT}", "batch")
    # A span lies in one day, and days are folders of the raw table, so only the days that were touched are read.
    touched = F.broadcast(hours.select(F.date_trunc(span, "hour_start").alias("__span"), F.col("day").alias("__day")).distinct())
    everything = spark.read.schema(raw.schema).parquet(f"{root}/{RAW}")
    again = everything.join(touched, (F.col("day") == F.col("__day")) & (F.date_trunc(span, time) == F.col("__span")), "left_semi")
    counted = hourly_counts(again, entity=entity, time=time, keys=keys)
    replace_parts(counted.withColumn("span", F.date_format(F.date_trunc(span, "hour_start"), "yyyy-MM-dd-HH")), f"{root}/{COUNTS}", "span")


def restated_counts_stream(df: DataFrame, root: str, checkpoint: str, *, entity: str, time: str, keys: tuple[str, ...] = (), lateness: str = "1 hour", span: str = "day", trigger: dict | None = None) -> StreamingQuery:
    """Keep the counts at root equal to those of all rows that the stream has brought, late or not.

    After each batch `read_counts` gives what `hourly_counts` over all rows so far would. A batch that fails on the way
    is replayed under its number and ends alike.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            restate_batch(batch, batch_id, root, entity=entity, time=time, keys=keys, lateness=lateness, span=span)

    return df.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_counts(spark: SparkSession, root: str, *, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, hour_start, flight_count as they stand."""
    return spark.read.parquet(f"{root}/{COUNTS}").select(*keys, "hour_start", "flight_count")


def restatements(spark: SparkSession, root: str) -> DataFrame:
    """batch, hour_start, rows: late rows, and the hours whose counts they changed."""
    return spark.read.parquet(f"{root}/{ACCOUNT}").where("late").select("batch", "hour_start", "rows")
