"""JSON snapshots to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficspark.schema import FLIGHT_SCHEMA, STATE_SCHEMA


def decode_states(df: DataFrame, *, json_col: str = "json") -> DataFrame:
    """One typed row for each state in each envelope {"time": …, "states": [[…], …]}.

    Fields go by position; short states end in nulls, values that don't fit their type are null. Envelopes
    with null or no states give no rows.
    """
    read = F.from_json(json_col, "time bigint, states array<array<string>>").alias("e")
    rows = df.select(read).select(F.col("e.time").alias("time"), F.explode("e.states").alias("s"))
    columns = []
    for i, field in enumerate(STATE_SCHEMA.fields[:-1]):
        value = F.get("s", F.lit(i))
        typed = F.from_json(value, "array<bigint>") if isinstance(field.dataType, T.ArrayType) else value.try_cast(field.dataType)
        columns.append(typed.alias(field.name))
    return rows.select(*columns, F.col("time").alias("capture_time"))


def envelope_fault(json: Column, *, least: int = 0) -> Column:
    """What is wrong with an envelope of states, null if it decodes: its JSON, its time, its states, or a state's length.

    Null or no states are fine, as is a state of any number of fields unless `least` asks for more; unknown members are.
    """
    parsed = F.try_parse_json(json)
    state = F.try_variant_get(parsed, "$.states", "array<array<variant>>")
    given = F.try_variant_get(parsed, "$.states", "variant")
    return (
        F.when(json.isNull() | (F.trim(json) == ""), "empty line")
        .when(parsed.isNull(), "no JSON")
        .when(F.try_variant_get(parsed, "$.time", "bigint").isNull(), "no time")
        .when(given.isNotNull() & ~F.is_variant_null(given) & state.isNull(), "states are no lists")
        .when(F.exists(state, lambda s: s.isNull()), "a state is no list")
        .when(F.exists(state, lambda s: F.size(s) < least), f"a state of fewer than {least} fields")
    )


def flights_fault(json: Column) -> Column:
    """What is wrong with a list of flights, null if it decodes; an empty list is fine."""
    parsed = F.try_parse_json(json)
    flights = F.try_variant_get(parsed, "$", "array<variant>")
    return (
        F.when(json.isNull() | (F.trim(json) == ""), "empty line")
        .when(parsed.isNull(), "no JSON")
        .when(flights.isNull(), "no list")
        .when(F.exists(flights, lambda f: f.isNull() | ~F.schema_of_variant(f).startswith("OBJECT")), "a flight is no object")
    )


def split_lines(df: DataFrame, fault: Column, *, json_col: str = "json") -> tuple[DataFrame, DataFrame]:
    """The lines without a fault, as they are, and the others with reason and raw: each line is in exactly one of the two."""
    told = df.withColumn("__fault", fault)
    bad = told.where("__fault is not null").select(*(c for c in df.columns if c != json_col), F.col("__fault").alias("reason"), F.col(json_col).alias("raw"))
    return told.where("__fault is null").drop("__fault"), bad


def decode_flights(df: DataFrame, *, json_col: str = "json") -> DataFrame:
    """One typed row for each flight in each JSON list of objects; values that don't fit are null."""
    loose = T.ArrayType(T.StructType([T.StructField(f.name, T.StringType()) for f in FLIGHT_SCHEMA.fields]))
    rows = df.select(F.explode(F.from_json(json_col, loose)).alias("f"))
    return rows.select(*(F.col(f"f.{f.name}").try_cast(f.dataType).alias(f.name) for f in FLIGHT_SCHEMA.fields))
