"""Filtering implausible readings, and an account of what each rule removes."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Closed ranges of plausible readings.
DEFAULT_BOUNDS = {"latitude": (-90.0, 90.0), "longitude": (-180.0, 180.0), "altitude": (-1000.0, 50000.0), "velocity": (0.0, 1000.0)}


def rules(df: DataFrame, *, entity: str = "icao24", lat: str = "latitude", lon: str = "longitude", altitude: str = "baro_altitude", velocity: str = "velocity", bounds: dict = DEFAULT_BOUNDS) -> dict[str, Column]:
    """Name and condition to keep a row, in the order they apply. Altitude and velocity may be null or absent."""
    found = {
        "null_entity": F.col(entity).isNotNull(),
        "null_position": F.col(lat).isNotNull() & F.col(lon).isNotNull(),
        "position_range": F.col(lat).between(*bounds["latitude"]) & F.col(lon).between(*bounds["longitude"]),
    }
    for name, column in (("altitude", altitude), ("velocity", velocity)):
        if column in df.columns:
            found[f"{name}_range"] = F.col(column).isNull() | F.col(column).between(*bounds[name])
    return found


def clean_states(df: DataFrame, **columns) -> DataFrame:
    """Rows with an entity and a plausible position, altitude and velocity, each distinct row once."""
    for keep in rules(df, **columns).values():
        df = df.where(keep)
    return df.dropDuplicates()


@dataclass
class Counted:
    """The rules of a cleaning and what is counted before and after them."""

    rules: list[str]
    before: Observation
    after: Observation


def observed(observation: Observation) -> dict[str, int]:
    """What was observed; nothing where Spark has cut a part of the plan out because it has no rows."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


def clean_counted(df: DataFrame, **columns) -> tuple[DataFrame, Counted]:
    """clean_states(df), and what it removes, counted on the way: known once the result has been written, from that job alone."""
    conditions = rules(df, **columns)
    counted = Counted([*conditions], Observation(), Observation())
    seen = df.observe(counted.before, F.count(F.lit(1)).alias("rows"), *(F.count_if(first_rule(conditions) == name).alias(name) for name in [*conditions, "kept"]))
    return clean_states(seen, **columns).observe(counted.after, F.count(F.lit(1)).alias("rows")), counted


def counted_audit(spark: SparkSession, counted: Counted) -> DataFrame:
    """rule, removed, percent as `clean_audit` has them, from the counts of a written result."""
    seen, left = observed(counted.before), observed(counted.after).get("rows", 0)
    removed = {name: seen.get(name, 0) for name in counted.rules} | {"duplicate": seen.get("kept", 0) - left}
    removed["total"] = sum(removed.values())
    rows = seen.get("rows", 0)
    return spark.createDataFrame([(k, n, round(100 * n / rows, 6) if rows else None) for k, n in removed.items()], "rule string, removed long, percent double")


def first_rule(conditions: dict[str, Column]) -> Column:
    """Name of the first rule that a row fails, else "kept"."""
    return F.coalesce(*(F.when(~F.coalesce(keep, F.lit(False)), F.lit(name)) for name, keep in conditions.items()), F.lit("kept"))


def clean_audit(df: DataFrame, **columns) -> DataFrame:
    """rule, removed, percent (of all rows), for each rule in turn, for duplicates and in all: one pass, one shuffle of whole rows, equal ones as one."""
    conditions = rules(df, **columns)
    alike = df.select(first_rule(conditions).alias("rule"), *(F.col(c) for c in df.columns)).groupBy("rule", *df.columns).agg(F.count(F.lit(1)).alias("n"))
    totals = alike.agg(
        F.sum("n").alias("rows"),
        *(F.sum(F.when(F.col("rule") == name, F.col("n")).otherwise(0)).alias(name) for name in conditions),
        F.sum(F.when(F.col("rule") == "kept", F.col("n") - 1).otherwise(0)).alias("duplicate"),
    )
    names = [*conditions, "duplicate"]
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    long = F.array(*(F.struct(F.lit(n).alias("rule"), F.coalesce(F.col(n), F.lit(0)).cast("long").alias("removed")) for n in names), F.struct(F.lit("total").alias("rule"), F.coalesce(total, F.lit(0)).cast("long").alias("removed")))
    told = totals.select("rows", F.explode(long).alias("r")).select("rows", "r.*")
    return told.select("rule", "removed", F.round(100.0 * F.col("removed") / F.col("rows"), 6).alias("percent"))
