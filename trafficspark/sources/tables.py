"""Partitioned Parquet tables: reading days and ranges, drifting files, writing and replacing days."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficspark.functions.scalars import from_epoch, partition_columns
from trafficspark.sources import manifest

DATE_COLUMNS = ("year", "month", "day")


def with_partitions(df: DataFrame, *, time: str = "capture_time") -> DataFrame:
    """year, month and day of an epoch column."""
    return df.withColumns(partition_columns(from_epoch(F.col(time))))


def write_raw(df: DataFrame, root: str, *, time: str = "capture_time", mode: str = "append") -> int:
    """Rows written, as snappy Parquet by day of the readings; nothing is written for an empty table."""
    counted = Observation()
    rows = with_partitions(df, time=time).observe(counted, F.count(F.lit(1)).alias("rows"))
    rows.write.mode(mode).partitionBy(*DATE_COLUMNS).option("compression", "snappy").parquet(root)
    return counted.get["rows"]


def read_days(spark: SparkSession, root: str, start: dt.date, end: dt.date, *, schema: T.StructType | None = None, skip_bad: bool = False) -> DataFrame:
    """Rows of all days from start to end, both included; only those days' folders are read. Absent days are skipped.

    skip_bad passes over files that are missing or can't be read.
    """
    reader = spark.read.options(ignoreCorruptFiles=skip_bad, ignoreMissingFiles=skip_bad)
    if schema is not None:
        parts = [T.StructField(c, T.IntegerType()) for c in DATE_COLUMNS]
        reader = reader.schema(T.StructType([*schema.fields, *parts]))
    # Comparing the partition columns one by one keeps the pruning with the file listing.
    number = F.col("year") * 10_000 + F.col("month") * 100 + F.col("day")
    low, high = (int(d.strftime("%Y%m%d")) for d in (start, end))
    return reader.parquet(root).where(number.between(low, high)).where(F.col("year").between(start.year, end.year))


def rolling_window(df: DataFrame, end: dt.date, days: int = 14, *, date_col: str = "feature_date") -> DataFrame:
    """The `days` days that end with `end`; an error if they hold no row."""
    found = df.where(F.col(date_col).between(end - dt.timedelta(days=days - 1), end))
    if found.isEmpty():
        raise ValueError(f"no rows in the {days} days to {end}")
    return found


def supertype(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds values of both: null gives way, integers widen, numbers become double, the rest text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return T.LongType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(supertype(a.elementType, b.elementType))
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with exactly the schema's columns: cast by Spark's rules, absent ones null.

    A column of a type that can't be cast is taken as null only if it holds nothing, else the query fails.
    """
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(field: T.StructField) -> F.Column:
        kind = have.get(field.name, T.NullType())
        null = F.lit(None).cast(field.dataType)
        if isinstance(kind, T.NullType):
            return null.alias(field.name)
        nested = isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType))
        if nested != isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            bad = F.raise_error(F.lit(f"column {field.name} holds values of another kind")).cast(field.dataType)
            return F.when(F.col(field.name).isNotNull(), bad).otherwise(null).alias(field.name)
        return F.col(field.name).cast(field.dataType).alias(field.name)

    return df.select(*(column(f) for f in schema.fields))


def drift_union(*dfs: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Rows of all tables by column name: absent columns are null, differing types go to their supertype."""
    if schema is None:
        kinds: dict[str, T.DataType] = {}
        for df in dfs:
            for f in df.schema.fields:
                kinds[f.name] = supertype(kinds.get(f.name, T.NullType()), f.dataType)
        schema = T.StructType([T.StructField(n, k) for n, k in kinds.items()])
    return reduce(DataFrame.unionByName, (fitted(df, schema) for df in dfs))


def overwrite_day(df: DataFrame, root: str, *, date_col: str = "feature_date") -> None:
    """Replace the days that df holds and leave all others; running it again changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(root)


def day_folder(root: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/year={day.year}/month={day.month}/day={day.day}"


def compact_day(spark: SparkSession, root: str, day: dt.date, *, target: int = 128 << 20) -> int:
    """Pack one day's small files into files of about `target` bytes; returns how many files make up the day then.

    The day is there for readers throughout: those of `read_compacted` see the new files from the moment they are
    published, those of the folder the old ones until `manifest.vacuum`.
    """
    return len(manifest.pack(spark, day_folder(root, day), target=target).files)


def read_compacted(spark: SparkSession, root: str, start: dt.date, end: dt.date) -> DataFrame:
    """Rows of all days from start to end, both included, as their published lists have them; absent days are skipped."""
    days = [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
    return manifest.read_published(spark, [day_folder(root, d) for d in days], basePath=root)


def write_sample(df: DataFrame, path: str, rows: int = 20) -> None:
    """The first rows as JSON lines."""
    df.limit(rows).coalesce(1).write.mode("overwrite").json(path)
