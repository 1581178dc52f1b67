"""A log of runs as an append-only table of events, folded to the latest state, and kept small by snapshots."""

from __future__ import annotations

import datetime as dt
import secrets
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficspark.functions.scalars import split_category
from trafficspark.sources import manifest

FIELDS = ("created_at", "window_start", "window_end", "path", "record_count", "status", "error_message")

# Error types in the order in which they are tried, and their categories.
ERROR_RULES = (
    ("RateLimitError", "RATE_LIMIT"),
    ("APITimeoutError", "API_TIMEOUT"),
    ("APIConnectionError", "API_CONNECTION"),
    ("APIError", "API_ERROR"),
    ("S3ConfigurationError", "S3_CONFIG"),
    ("S3UploadError", "S3_UPLOAD"),
    ("ParquetError", "PARQUET"),
    ("DatabaseError", "DATABASE"),
    ("ConfigurationError", "CONFIG"),
    ("ServiceError", "SERVICE"),
)


EVENT = "run_id long, seq long, created_at timestamp_ntz, window_start timestamp_ntz, window_end timestamp_ntz, path string, record_count long, status string, error_message string"
#: Seconds from here on make up the upper bits of a run's id.
ID_EPOCH, ID_BITS = 1_704_067_200, 33


def new_run_id() -> int:
    """An id that no coordinator deals out: the second, then 33 random bits. Later runs have greater ids.

    Of 1,000 runs that start within one second, two share an id once in some 17,000 such seconds.
    """
    return (int(time.time()) - ID_EPOCH) << ID_BITS | secrets.randbits(ID_BITS)


def with_run_ids(df: DataFrame, *, name: str = "run_id") -> DataFrame:
    """df with an id for each row, made in the tasks. Ids change each time df is computed, so write them before use."""
    bits = F.shiftrightunsigned(F.xxhash64(F.uuid()), 64 - ID_BITS)
    return df.withColumn(name, F.shiftleft(F.unix_seconds(F.current_timestamp()) - ID_EPOCH, ID_BITS).bitwiseOR(bits))


def append_run_events(df: DataFrame, root: str) -> None:
    """Add events (run_id, seq and any of the fields) to the log."""
    df.write.mode("append").parquet(root)


def create_run(spark: SparkSession, root: str, window_start: dt.datetime, window_end: dt.datetime, status: str = "pending") -> int:
    """Log a new run, without records so far, and return its id."""
    run_id, now = new_run_id(), dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = (run_id, time.time_ns(), now, window_start, window_end, None, 0, status, None)
    append_run_events(spark.createDataFrame([row], EVENT).coalesce(1), root)
    return run_id


def update_run(spark: SparkSession, root: str, run_id: int, **fields) -> None:
    """Log new values of some of a run's fields; the others stay as they are."""
    if unknown := fields.keys() - set(FIELDS):
        raise ValueError(f"no fields of a run: {sorted(unknown)}")
    row = (run_id, time.time_ns(), *(fields.get(f) for f in FIELDS))
    append_run_events(spark.createDataFrame([row], EVENT).coalesce(1), root)


def run_state(events: DataFrame, *, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """run_id and each field's latest non-null value: an update overrides what it names and keeps the rest."""
    kept = [f for f in fields if f in events.columns]
    return events.groupBy("run_id").agg(*(F.max_by(f, F.when(F.col(f).isNotNull(), F.col("seq"))).alias(f) for f in kept))


def marked(events: DataFrame) -> DataFrame:
    """Events with each field next to its number, null where the event leaves the field out."""
    return events.select("run_id", *(F.when(F.col(f).isNotNull(), F.struct("seq", F.col(f).alias("value"))).alias(f) for f in FIELDS))


def folded(rows: DataFrame) -> DataFrame:
    """Marked rows, or folds of them, as one a run: of each field that with the greatest number, so events may come in any order."""
    return rows.groupBy("run_id").agg(*(F.max(f).alias(f) for f in FIELDS))


def stored_marks(spark: SparkSession, now: manifest.Published) -> DataFrame:
    """The snapshot's rows and the tail of events behind it."""
    tail = marked(spark.read.schema(EVENT).parquet(*sorted(now.tail))) if now.tail else marked(spark.createDataFrame([], EVENT))
    return tail.unionByName(spark.read.schema(tail.schema).parquet(*sorted(now.packed))) if now.packed else tail


def logged_state(spark: SparkSession, root: str) -> DataFrame:
    """The state of all runs of the log at root, from its last snapshot and the events since. A log that isn't there has no runs."""
    return folded(stored_marks(spark, manifest.current(spark, root))).select("run_id", *(F.col(f"{f}.value").alias(f) for f in FIELDS))


def snapshot_log(spark: SparkSession, root: str, *, rows_per_file: int = 5_000_000) -> int:
    """Fold the log into a snapshot that stands in for all events so far; returns how many event files it covers.

    The snapshot keeps each field's number, so that an older event that comes later still counts for less. Events that
    are added meanwhile stay in the tail; of two snapshots at once one counts, and either is right.
    """
    now = manifest.current(spark, root)
    if not now.tail:
        return 0
    path = f"{root}/{manifest.PACKED}/{uuid.uuid4().hex}"
    folded(stored_marks(spark, now)).write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    manifest.publish(spark, root, now, manifest.listing(spark, path), now.covered | set(now.tail))
    return len(now.tail)


def latest_runs(state: DataFrame, n: int = 10) -> DataFrame:
    return state.orderBy(F.desc("created_at"), F.desc("run_id")).limit(n)


def run_by_id(state: DataFrame, run_id: int) -> DataFrame:
    return state.where(F.col("run_id") == run_id)


def runs_by_status(state: DataFrame, status: str) -> DataFrame:
    """Runs with a status, newest first."""
    return state.where(F.col("status") == status).orderBy(F.desc("created_at"), F.desc("run_id"))


def runs_in_range(state: DataFrame, begin: str, end: str) -> DataFrame:
    """Runs whose window starts at or after begin and ends at or before end, newest first."""
    begin, end = (F.lit(t).cast("timestamp_ntz") for t in (begin, end))
    return state.where((F.col("window_start") >= begin) & (F.col("window_end") <= end)).orderBy(F.desc("created_at"), F.desc("run_id"))


def error_category(error_type: Column) -> Column:
    """Category of the first rule whose name the error type holds; UNEXPECTED if none, null for null."""
    found = F.when(error_type.isNull(), F.lit(None))
    for name, category in ERROR_RULES:
        found = found.when(error_type.contains(name), category)
    return found.otherwise("UNEXPECTED")


def classify_errors(df: DataFrame, *, error_type: str = "error_type") -> DataFrame:
    return df.withColumn("category", error_category(F.col(error_type)))


def with_error_category(df: DataFrame, *, message: str = "error_message") -> DataFrame:
    """category and detail of a message "[CATEGORY] text"."""
    category, detail = split_category(F.col(message))
    return df.withColumns({"category": F.when(F.col(message).isNotNull(), category), "detail": detail})


def run_metrics(state: DataFrame, window: str = "1 day") -> DataFrame:
    """Runs, successes, failures, records and mean minutes by time window and error category."""
    category = F.when(F.col("status") == "failed", split_category(F.col("error_message"))[0])
    spans = state.withColumn("category", category).withColumn("w", F.window("created_at", window))
    minutes = F.timestamp_diff("SECOND", F.col("window_start"), F.col("window_end")) / 60.0
    return spans.groupBy(F.col("w.start").alias("window_start"), "category").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum((F.col("status") == "success").cast("long")).alias("successes"),
        F.sum((F.col("status") == "failed").cast("long")).alias("failures"),
        F.sum("record_count").alias("records"),
        F.round(F.avg(minutes), 6).alias("mean_minutes"),
    )


def failure_alarm(df: DataFrame, *, time: str = "created_at", window: str = "5 minutes", threshold: int = 3) -> DataFrame:
    """window_start, failures for windows with `threshold` failed rows or more; batch or stream."""
    failed = df.where(F.col("status") == "failed")
    return failed.groupBy(F.window(time, window).alias("w")).agg(F.count(F.lit(1)).alias("failures")).where(F.col("failures") >= threshold).select(F.col("w.start").alias("window_start"), "failures")
