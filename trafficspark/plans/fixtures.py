"""Views over the given tables that look like state vectors, flights and run events; in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficspark.functions.scalars import to_epoch
from trafficspark.sources.shared import importable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; naive times are UTC throughout, so the session's time zone is set to it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def state_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as states, with something for every cleaning rule to reject, and some exact duplicates."""
    i, v = F.col("event_id"), F.col("value")
    base = table(spark, sf_dir, "events").select(
        F.when(i % 97 != 0, F.col("user_id").cast("string")).alias("icao24"),
        F.col("event_type").alias("callsign"),
        to_epoch(F.col("ts")).alias("capture_time"),
        F.when(i % 89 != 0, (i * 7919 % 20000) / 100.0 - 100).alias("latitude"),
        ((i * 104729 % 40000) / 100.0 - 200).alias("longitude"),
        F.when(i % 17 != 0, v * 130 - 1500).alias("baro_altitude"),
        F.when(i % 19 != 0, v * 3 - 20).alias("velocity"),
        F.when(i % 13 != 0, (i % 11) - 5.0).alias("vertical_rate"),
    )
    return base.unionByName(base.where("capture_time % 50 = 0"))


STATE_SQL = """b as (
  select case when event_id % 97 = 0 then null else cast(user_id as varchar) end as icao24, event_type as callsign,
    cast(floor(epoch(ts)) as bigint) as capture_time,
    case when event_id % 89 = 0 then null else (event_id*7919 % 20000)/100.0e0 - 100 end as latitude,
    (event_id*104729 % 40000)/100.0e0 - 200 as longitude,
    case when event_id % 17 = 0 then null else value*130 - 1500 end as baro_altitude,
    case when event_id % 19 = 0 then null else value*3 - 20 end as velocity,
    case when event_id % 13 = 0 then null else (event_id % 11) - 5.0e0 end as vertical_rate
  from events),
state_view as (select * from b union all select * from b where capture_time % 50 = 0)"""

CLEAN_SQL = (
    STATE_SQL
    + """,
clean as (
  select distinct * from state_view
  where icao24 is not null and latitude between -90 and 90 and longitude between -180 and 180
    and (baro_altitude is null or baro_altitude between -1000 and 50000) and (velocity is null or velocity between 0 and 1000))"""
)


def flights_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = to_epoch(F.col("o_orderdate"))
    airport = lambda n: F.concat(F.lit("AP"), F.lpad((F.col("o_orderkey") % n).cast("string"), 2, "0"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("icao24"),
        first.alias("firstSeen"),
        (first + 3600 * (1 + F.col("o_orderkey") % 5)).alias("lastSeen"),
        airport(20).alias("estDepartureAirport"),
        airport(23).alias("estArrivalAirport"),
    )


FLIGHTS_SQL = """flights as (
  select cast(o_custkey as varchar) as icao24, cast(floor(epoch(o_orderdate)) as bigint) as "firstSeen",
    cast(floor(epoch(o_orderdate)) as bigint) + 3600 * (1 + o_orderkey % 5) as "lastSeen",
    concat('AP', lpad(cast(o_orderkey % 20 as varchar), 2, '0')) as "estDepartureAirport",
    concat('AP', lpad(cast(o_orderkey % 23 as varchar), 2, '0')) as "estArrivalAirport"
  from orders)"""


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events create a pending run, odd ones end it: with a failure or with a record count."""
    i, odd, failed = F.col("event_id"), F.col("event_id") % 2 == 1, F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.floor(i / 2).cast("long").alias("run_id"),
        i.alias("seq"),
        F.when(~odd, F.col("ts")).alias("created_at"),
        F.when(~odd, F.col("ts") - F.expr("interval 10 minutes")).alias("window_start"),
        F.when(~odd, F.col("ts")).alias("window_end"),
        F.when(odd & ~failed, F.floor("value").cast("long")).alias("record_count"),
        F.when(~odd, "pending").when(failed, "failed").otherwise("success").alias("status"),
        F.when(odd & failed, F.concat(F.lit("[API_ERROR] event "), i.cast("string"), F.when(i % 3 == 0, "\nsecond line").otherwise(""))).alias("error_message"),
    )


RUN_EVENTS_SQL = """run_events as (
  select event_id // 2 as run_id, event_id as seq, case when event_id % 2 = 0 then ts end as created_at,
    case when event_id % 2 = 0 then ts - interval 10 minute end as window_start, case when event_id % 2 = 0 then ts end as window_end,
    case when event_id % 2 = 1 and event_type <> 'error' then cast(floor(value) as bigint) end as record_count,
    case when event_id % 2 = 0 then 'pending' when event_type = 'error' then 'failed' else 'success' end as status,
    case when event_id % 2 = 1 and event_type = 'error' then '[API_ERROR] event ' || event_id || case when event_id % 3 = 0 then chr(10) || 'second line' else '' end end as error_message
  from events)"""

RUN_STATE_SQL = (
    RUN_EVENTS_SQL
    + """,
state as (
  select run_id, """
    + ", ".join(f"max_by({c}, seq) filter (where {c} is not null) as {c}" for c in ("created_at", "window_start", "window_end", "record_count", "status", "error_message"))
    + """
  from run_events group by run_id)"""
)

HOURLY_SQL = """hourly as (
  select date_trunc('hour', ts)::timestamp as hour_start, count(distinct user_id) + max(case when user_id is null then 1 else 0 end) as flight_count
  from events group by 1)"""


def features_sql(hourly: str = "hourly") -> str:
    """The hourly features as a CTE named features."""
    return f"""features as (
  select * from (
    select hour_start, flight_count::bigint as flight_count, hour(hour_start)::int as hour_of_day, isodow(hour_start)::int as day_of_week,
      case when isodow(hour_start) >= 5 then 1 else 0 end::int as is_weekend,
      lag(flight_count, 1) over (order by hour_start)::bigint as lag_1h, lag(flight_count, 24) over (order by hour_start)::bigint as lag_24h,
      case when count(flight_count) over w6 = 6 then round(avg(flight_count) over w6, 6) end as rolling_mean_6h
    from {hourly} window w6 as (order by hour_start rows between 6 preceding and 1 preceding))
  where lag_1h is not null and lag_24h is not null and rolling_mean_6h is not null)"""
