"""Registered queries over the given tables and their DuckDB counterparts."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trafficspark.operators import aggregates as agg
from trafficspark.operators import cleaning, derive, features, filters, model, moving, runlog
from trafficspark.plans.fixtures import CLEAN_SQL, FLIGHTS_SQL, HOURLY_SQL, RUN_STATE_SQL, STATE_SQL, features_sql, flights_view, run_events, state_view, table
from trafficspark.schema import MODEL_FEATURES
from trafficspark.sources import decode, files, tables
from trafficspark.sources.shared import shared_dir
from trafficspark.streaming import restate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

TARGET = "flight_count"
DAY = dt.date(2024, 1, 10)
EPOCH = 1_704_844_800  # DAY, in seconds


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL where SQL can say it."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


def hourly(spark: SparkSession, d: str) -> DataFrame:
    return agg.hourly_counts(events(spark, d), entity="user_id", time="ts")


def feature_rows(spark: SparkSession, d: str) -> DataFrame:
    return features.hourly_features(hourly(spark, d))


def clean(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean_states(state_view(spark, d))


def derived(spark: SparkSession, d: str) -> DataFrame:
    return derive.add_derived_columns(clean(spark, d))


# Hourly counts and features


@query(f"with {HOURLY_SQL} select hour_start, flight_count::bigint as flight_count from hourly")
def hourly_counts(spark, d):
    return hourly(spark, d)


@query()
def hourly_counts_approx(spark, d):
    return agg.hourly_counts(events(spark, d), entity="user_id", time="ts", approx=True)


@query()
def daily_counts_approx(spark, d):
    return agg.merged_counts(agg.hourly_sketches(events(spark, d), entity="user_id", time="ts"))


@query("select date_trunc('day', ts)::timestamp as start, count(distinct user_id)::bigint as flight_count, true as near from events group by 1")
def daily_counts_near(spark, d):
    """Exact distinct entities of each day, and whether the hours' sketches come within 3 percent of them."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    exact = events(spark, d).groupBy(day.alias("start")).agg(agg.distinct_with_null(F.col("user_id")).alias("flight_count"))
    told = daily_counts_approx(spark, d).withColumnRenamed("flight_count", "estimate")
    return exact.join(told, "start").select("start", "flight_count", (F.abs(F.col("estimate") - F.col("flight_count")) <= 0.03 * F.col("flight_count")).alias("near"))


@query(
    """select event_type, date_trunc('hour', ts)::timestamp as hour_start, count(distinct user_id)::bigint as flight_count from events group by 1, 2"""
)
def hourly_counts_by_key(spark, d):
    return agg.hourly_counts(events(spark, d), entity="user_id", time="ts", keys=("event_type",))


@query(f"with {HOURLY_SQL}, {features_sql()} select * from features")
def hourly_features(spark, d):
    return feature_rows(spark, d)


@query(
    """with h as (select event_type, date_trunc('hour', ts)::timestamp as hour_start, count(distinct user_id)::bigint as flight_count from events group by 1, 2)
select * from (
  select event_type, hour_start, flight_count, hour(hour_start)::int as hour_of_day, isodow(hour_start)::int as day_of_week,
    case when isodow(hour_start) >= 5 then 1 else 0 end::int as is_weekend,
    lag(flight_count, 1) over o as lag_1h, lag(flight_count, 24) over o as lag_24h,
    case when count(flight_count) over w6 = 6 then round(avg(flight_count) over w6, 6) end as rolling_mean_6h
  from h window o as (partition by event_type order by hour_start), w6 as (partition by event_type order by hour_start rows between 6 preceding and 1 preceding))
where lag_1h is not null and lag_24h is not null and rolling_mean_6h is not null"""
)
def hourly_features_by_key(spark, d):
    counts = agg.hourly_counts(events(spark, d), entity="user_id", time="ts", keys=("event_type",))
    return features.hourly_features(counts, keys=("event_type",))


@query(
    f"""with {HOURLY_SQL}, spine as (select unnest(generate_series(min(hour_start), max(hour_start), interval 1 hour)) as hour_start from hourly),
filled as (select hour_start, coalesce(flight_count, 0) as flight_count from spine left join hourly using (hour_start)),
{features_sql("filled")} select * from features"""
)
def hourly_features_calendar(spark, d):
    return features.hourly_features(hourly(spark, d), calendar=True)


@query(
    f"""with h0 as (select * from events where ts::date between date '2024-01-09' and date '2024-01-10'),
hourly as (select date_trunc('hour', ts)::timestamp as hour_start, count(distinct user_id) as flight_count from h0 group by 1),
{features_sql()} select * from features where hour_start::date = date '2024-01-10'"""
)
def features_for_day(spark, d):
    return features.features_for_day(events(spark, d), DAY, entity="user_id", time="ts")


def arriving(spark: SparkSession, d: str) -> DataFrame:
    """A stream of the events in four files: one in seven of the first half's rows comes in the third, long after its hour."""
    e, root = events(spark, d), fresh(spark, "arriving")
    half = F.lit("2024-01-15").cast("timestamp_ntz")
    wave = F.when(F.col("ts") >= half, F.when(F.col("event_id") % 2 == 0, 1).otherwise(3)).when(F.col("event_id") % 7 == 0, 2).otherwise(0)
    columns = e.select("event_type", "user_id", "ts")
    for k in range(4):
        e.where(wave == k).select(columns.columns).coalesce(1).write.mode("append").parquet(root)
    return spark.readStream.schema(columns.schema).option("maxFilesPerTrigger", 1).parquet(root)


@query(f"with {HOURLY_SQL} select hour_start, flight_count::bigint as flight_count from hourly")
def restated_counts(spark, d):
    """Hourly counts that a stream with late rows leaves behind: those of all rows."""
    root = fresh(spark, "restated")
    restate.restated_counts_stream(arriving(spark, d), root, f"{root}/checkpoint", entity="user_id", time="ts").awaitTermination()
    return restate.read_counts(spark, root)


# Cleaning, derived columns and selections


@query(f"with {CLEAN_SQL} select * from clean")
def clean_states(spark, d):
    return clean(spark, d)


@query(
    f"""with {STATE_SQL}, ruled as (select *, case when icao24 is null then 'null_entity' when latitude is null or longitude is null then 'null_position'
    when latitude not between -90 and 90 or longitude not between -180 and 180 then 'position_range'
    when baro_altitude is not null and baro_altitude not between -1000 and 50000 then 'altitude_range'
    when velocity is not null and velocity not between 0 and 1000 then 'velocity_range' else 'kept' end as rule from state_view),
removed as (select rule, count(*) as removed from ruled where rule <> 'kept' group by rule
  union all select 'duplicate', (select count(*) from ruled where rule = 'kept') - (select count(*) from (select distinct * from ruled where rule = 'kept'))),
named as (select unnest(['null_entity', 'null_position', 'position_range', 'altitude_range', 'velocity_range', 'duplicate']) as rule),
told as (select rule, coalesce(removed, 0) as removed from named left join removed using (rule))
select rule, removed::bigint as removed, round(100.0::double * removed / (select count(*) from state_view), 6) as percent
from (select * from told union all select 'total', sum(removed) from told)"""
)
def clean_audit(spark, d):
    return cleaning.clean_audit(state_view(spark, d))


@query(ORACLE_SQL["clean_audit"])
def counted_cleaning(spark, d):
    """The audit of a cleaned table, from the counts that writing it took along."""
    cleaned, counted = cleaning.clean_counted(state_view(spark, d))
    cleaned.write.parquet(fresh(spark, "clean"))
    return cleaning.counted_audit(spark, counted)


@query(
    f"""with {CLEAN_SQL} select *, make_timestamp(capture_time * 1000000) as capture_datetime,
  hour(make_timestamp(capture_time * 1000000))::int as hour, minute(make_timestamp(capture_time * 1000000))::int as minute,
  velocity * 3.6e0 as speed_kmh, baro_altitude * 3.28084e0 as altitude_ft,
  case when vertical_rate > 2 then 'climbing' when vertical_rate < -2 then 'descending' else 'level' end as flight_phase from clean"""
)
def derived_columns(spark, d):
    return derived(spark, d)


@query(f"with {STATE_SQL} select * from state_view where latitude between 10 and 40 and longitude between 60 and 100")
def states_bbox(spark, d):
    return filters.query_states(state_view(spark, d), bbox=(10.0, 60.0, 40.0, 100.0))


@query(f"with {STATE_SQL} select * from state_view where icao24 in ('7', '11')")
def states_by_entity(spark, d):
    return filters.query_states(state_view(spark, d), entities=["7", "11"])


FLIGHT_SPAN = (820_454_400, 851_990_400)  # 1996


@query(f'with {FLIGHTS_SQL} select * from flights where "firstSeen" >= 820454400 and "lastSeen" <= 851990400')
def flights_interval(spark, d):
    return filters.query_flights(flights_view(spark, d), *FLIGHT_SPAN)


@query(f"""with {FLIGHTS_SQL} select * from flights where "firstSeen" >= 820454400 and "lastSeen" <= 851990400 and icao24 = '37'""")
def flights_by_entity(spark, d):
    return filters.query_flights(flights_view(spark, d), *FLIGHT_SPAN, entity="37")


@query(f"""with {FLIGHTS_SQL} select * from flights where "estArrivalAirport" = 'AP05' and "lastSeen" between 820454400 and 851990400""")
def arrivals(spark, d):
    return filters.query_flights(flights_view(spark, d), *FLIGHT_SPAN, arrival="ap05")


@query(f"""with {FLIGHTS_SQL} select * from flights where "estDepartureAirport" = 'AP05' and "firstSeen" between 820454400 and 851990400""")
def departures(spark, d):
    return filters.query_flights(flights_view(spark, d), *FLIGHT_SPAN, departure="ap05")


# Sources


@query(f"with {STATE_SQL} select *, year(t)::int as year, month(t)::int as month, day(t)::int as day from (select *, make_timestamp(capture_time * 1000000) as t from state_view)".replace("select *, year(t)", "select * exclude (t), year(t)"))
def partition_cols(spark, d):
    return tables.with_partitions(state_view(spark, d))


PARTS = "year(make_timestamp(capture_time * 1000000))::int as year, month(make_timestamp(capture_time * 1000000))::int as month, day(make_timestamp(capture_time * 1000000))::int as day"


@query(f"with {STATE_SQL} select *, {PARTS} from state_view where make_timestamp(capture_time * 1000000)::date = date '2024-01-10'")
def read_day(spark, d):
    root = fresh(spark, "raw")
    tables.write_raw(state_view(spark, d), root)
    return tables.read_days(spark, root, DAY, DAY)


@query(f"with {STATE_SQL} select *, {PARTS} from state_view where make_timestamp(capture_time * 1000000)::date between date '2024-01-08' and date '2024-01-10'")
def read_range(spark, d):
    root = fresh(spark, "raw")
    tables.write_raw(state_view(spark, d), root)
    return tables.read_days(spark, root, dt.date(2024, 1, 8), DAY)


@query(f"with {STATE_SQL} select *, {PARTS} from state_view where make_timestamp(capture_time * 1000000)::date between date '2024-01-08' and date '2024-01-10'")
def compacted_days(spark, d):
    """The same days after each was packed, one of them in between two appends."""
    root, days = fresh(spark, "raw"), [DAY - dt.timedelta(days=k) for k in (2, 1, 0)]
    rows = state_view(spark, d)
    for part in (0, 1):
        tables.write_raw(rows.where(F.pmod(F.xxhash64("capture_time"), F.lit(2)) == part), root)
        for day in days[part:]:
            tables.compact_day(spark, root, day)
    return tables.read_compacted(spark, root, days[0], DAY)


@query(f"with {CLEAN_SQL} select *, make_timestamp(capture_time * 1000000)::date as feature_date from clean")
def cleaned_days(spark, d):
    """Cleaned days as they are kept, one of them written a second time."""
    root = fresh(spark, "cleaned")
    rows = derived(spark, d).withColumn("feature_date", F.to_date("capture_datetime")).select(*clean(spark, d).columns, "feature_date")
    tables.overwrite_day(rows, root)
    tables.overwrite_day(rows.where(F.col("feature_date") == DAY), root)
    return spark.read.parquet(root)


@query("select event_id, value from events")
def quarantined_files(spark, d):
    """Rows of the good files of a folder that holds a file of another kind too."""
    root, e = fresh(spark, "mixed"), events(spark, d)
    e.select("event_id", "value").write.parquet(root)
    e.select("event_type").limit(5).coalesce(1).write.mode("append").text(root)
    good, bad = files.read_quarantined(spark, root, pattern="part-*")
    if bad.count() != 1:
        raise ValueError("one file is no Parquet")
    return good


@query(f"with {HOURLY_SQL}, {features_sql()} select *, hour_start::date as feature_date from features where hour_start::date between date '2023-12-28' and date '2024-01-10'")
def rolling_window(spark, d):
    root = fresh(spark, "features")
    tables.overwrite_day(feature_rows(spark, d).withColumn("feature_date", F.to_date("hour_start")), root)
    return tables.rolling_window(spark.read.parquet(root), DAY, 14)


@query(
    """select event_id, case when event_id % 3 = 0 then null else value end as value, case when event_id % 3 = 0 then user_id::varchar else event_type end as tag
from events"""
)
def drift_union(spark, d):
    e = events(spark, d)
    a = e.where("event_id % 3 = 0").select(F.col("event_id").cast("int").alias("event_id"), F.col("user_id").alias("tag"))
    b = e.where("event_id % 3 = 1").select("event_id", F.col("value"), F.col("event_type").alias("tag"))
    c = e.where("event_id % 3 = 2").select("event_id", "value", F.col("event_type").alias("tag"))
    return tables.drift_union(a, b, c)


@query(ORACLE_SQL["drift_union"])
def drift_files(spark, d):
    """The same three tables, as files of one folder whose footers say which types they hold."""
    e, root = events(spark, d), fresh(spark, "drift")
    e.where("event_id % 3 = 0").select(F.col("event_id").cast("int").alias("event_id"), F.col("user_id").alias("tag")).write.mode("append").parquet(root)
    for rest in (1, 2):
        e.where(f"event_id % 3 = {rest}").select("event_id", "value", F.col("event_type").alias("tag")).write.mode("append").parquet(root)
    return files.read_drifting(spark, root).select("event_id", "value", "tag")


@query(
    """select event_id, case event_id % 7 when 0 then 'no JSON' when 1 then 'no time' when 2 then 'a state is no list' when 3 then 'a state of fewer than 3 fields' end as reason from events where event_id % 7 < 4"""
)
def quarantined_lines(spark, d):
    """Envelopes of one event each, some of them spoilt in four ways."""
    i = F.col("event_id")
    good = F.to_json(F.struct(F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"), F.array(F.array(F.col("user_id").cast("string"), "event_type", F.lit("x"))).alias("states")))
    line = F.when(i % 7 == 0, F.expr("substring(good, 1, length(good) - 1)")).when(i % 7 == 1, F.lit('{"states": []}')).when(i % 7 == 2, F.lit('{"time": 1, "states": [1]}')).when(i % 7 == 3, F.lit('{"time": 1, "states": [["a", "b"]]}')).otherwise(F.col("good"))
    lines = events(spark, d).withColumn("good", good).select("event_id", line.alias("json"))
    return decode.split_lines(lines, decode.envelope_fault(F.col("json"), least=3))[1].select("event_id", "reason")


def envelopes(spark: SparkSession, d: str) -> DataFrame:
    """The state view packed into one JSON envelope for each capture time."""
    place = {f.name: i for i, f in enumerate(decode.STATE_SCHEMA.fields[:-1])}
    rows = state_view(spark, d)
    named = {c: F.col(c).cast("string") for c in rows.columns if c in place}
    state = F.array(*(named.get(name, F.lit(None).cast("string")) for name in place))
    return rows.groupBy(F.col("capture_time").alias("time")).agg(F.collect_list(state).alias("states")).select(F.to_json(F.struct("time", "states")).alias("json"))


@query(f"with {STATE_SQL} select icao24, callsign, longitude, latitude, baro_altitude, velocity, vertical_rate, capture_time from state_view")
def decode_states(spark, d):
    return decode.decode_states(envelopes(spark, d)).select("icao24", "callsign", "longitude", "latitude", "baro_altitude", "velocity", "vertical_rate", "capture_time")


@query("select user_id::varchar as icao24, floor(epoch(ts))::bigint as capture_time from events where event_id % 3 = 0")
def decode_sparse_states(spark, d):
    """Envelopes of one event each, of which two in three hold no states: an empty list, or none."""
    i, at = F.col("event_id"), F.unix_seconds(F.col("ts").cast("timestamp"))
    states = F.when(i % 3 == 0, F.array(F.array(F.col("user_id").cast("string")))).when(i % 3 == 1, F.array().cast("array<array<string>>"))
    lines = events(spark, d).select(F.to_json(F.struct(at.alias("time"), states.alias("states"))).alias("json"))
    return decode.decode_states(lines).select("icao24", "capture_time")


@query(f'with {FLIGHTS_SQL} select icao24, "firstSeen", "estDepartureAirport", "lastSeen", "estArrivalAirport" from flights')
def decode_flights(spark, d):
    rows = flights_view(spark, d)
    packed = rows.groupBy(F.floor(F.col("firstSeen") / 86400).alias("day"), "estDepartureAirport").agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("json"))
    return decode.decode_flights(packed).select("icao24", "firstSeen", "estDepartureAirport", "lastSeen", "estArrivalAirport")


# Report datasets


@query(f"with {CLEAN_SQL} select hour(make_timestamp(capture_time * 1000000))::int as hour, count(*)::bigint as records, count(distinct icao24)::bigint as entities from clean group by 1")
def hour_of_day_profile(spark, d):
    return agg.hour_of_day_profile(derived(spark, d))


SUMMARY_PARTS = {"total_records": "count(*)", "unique_entities": "count(distinct icao24) + coalesce(max((icao24 is null)::int), 0)"}
SUMMARY_PARTS |= {f"null_{c}": f"count(*) - count({c})" for c in ("icao24", "callsign", "capture_time", "latitude", "longitude", "baro_altitude", "velocity", "vertical_rate")}
SUMMARY_PARTS |= {f"{n}_{c}": f"{f}({c})" for c in ("latitude", "longitude", "baro_altitude", "velocity", "vertical_rate") for n, f in (("min", "min"), ("max", "max"), ("mean", "avg"))}
SUMMARY_PARTS |= {"min_capture_time": "min(capture_time)", "max_capture_time": "max(capture_time)"}


@query(f"with {STATE_SQL} " + " union all ".join(f"select '{k}' as metric, round(({v})::double, 6) as value from state_view" for k, v in SUMMARY_PARTS.items()))
def data_summary(spark, d):
    return agg.data_summary(state_view(spark, d))


def histogram_sql(source: str, value: str, bins: int, prefix: str) -> str:
    return f"""with {prefix}, v as (select ({value})::double as v from {source} where ({value}) is not null), ends as (select min(v) as low, max(v) as high from v),
counts as (select least(floor((v - low) * {bins} / (high - low)) + 1, {bins})::int as bin, count(*) as n from v, ends group by 1),
spine as (select unnest(range(1, {bins + 1}))::int as bin)
select bin, round(low + (high - low) / {bins} * (bin - 1), 6) as low, round(low + (high - low) / {bins} * bin, 6) as high, coalesce(n, 0)::bigint as n
from spine left join counts using (bin), ends"""


@query(histogram_sql("clean", "baro_altitude", 50, CLEAN_SQL))
def altitude_histogram(spark, d):
    return agg.histogram(clean(spark, d), "baro_altitude")


@query(histogram_sql("clean", "velocity * 3.6e0", 50, CLEAN_SQL))
def speed_histogram(spark, d):
    return agg.histogram(derived(spark, d), "speed_kmh")


@query(
    f"""with {CLEAN_SQL}, v as (select baro_altitude as v from clean where baro_altitude is not null),
q as (select quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as median, quantile_cont(v, 0.75) as q3, count(*) as n from v)
select round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
  round(min(v) filter (where v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), 6) as whisker_low,
  round(max(v) filter (where v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)), 6) as whisker_high,
  count(*) filter (where v not between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))::bigint as n_outliers, n::bigint as n
from v, q group by q1, median, q3, n"""
)
def altitude_box(spark, d):
    return agg.box_stats(clean(spark, d), "baro_altitude", exact=True)


@query(f"with {CLEAN_SQL} select date_trunc('week', make_timestamp(capture_time * 1000000))::date as start, count(*)::bigint as n, true as q1, true as median, true as q3 from clean where baro_altitude is not null group by 1")
def altitude_quartiles_by_week(spark, d):
    """Quartiles of each week from its days' sketches, and whether their true ranks are within the stated error."""
    rows = derived(spark, d)
    found = agg.merged_quartiles(agg.value_sketches(rows, "baro_altitude", time="capture_datetime"))
    values = rows.where("baro_altitude is not null").select(F.date_trunc("week", "capture_datetime").cast("date").alias("start"), "baro_altitude")
    told = values.join(found, "start").groupBy("start", "n")
    return told.agg(*((F.abs(F.avg((F.col("baro_altitude") <= F.col(c)).cast("int")) - share) <= agg.RANK_ERROR + 1 / F.first("n")).alias(c) for c, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))))


@query(
    f"""with {CLEAN_SQL}, v as (select velocity * 3.6e0 as v from clean where velocity is not null),
t as (select min(v) as low, max(v) as high, stddev_samp(v) * pow(count(*), -0.2) as width, count(*) as n from v),
g as (select i, low + (high - low) * i / 199 as x, width, n from t, (select unnest(range(200)) as i))
select i::int as i, round(max(x), 6) as x, round(sum(exp(-0.5 * pow((x - v) / width, 2))) / max(n * width) / sqrt(2 * pi()), 6) as density from v, g group by i"""
)
def speed_kde(spark, d):
    return agg.kde(derived(spark, d), "speed_kmh").withColumn("density", F.round("density", 6))


@query(f"with {CLEAN_SQL} select longitude, latitude, baro_altitude as altitude from clean")
def geo_points(spark, d):
    return agg.geo_points(clean(spark, d))


@query(f"with {CLEAN_SQL} select floor(longitude / 10)::bigint as lon_cell, floor(latitude / 10)::bigint as lat_cell, count(*)::bigint as points, round(avg(baro_altitude), 6) as mean_altitude from clean group by 1, 2")
def geo_grid(spark, d):
    return agg.geo_grid(clean(spark, d))


@query(
    """with days as (select unnest(generate_series(timestamp '2023-12-28', timestamp '2024-01-10', interval 1 day))::date as day)
select day, count(ts)::bigint as rows from days left join events on ts::date = day group by day"""
)
def day_coverage(spark, d):
    return agg.day_coverage(events(spark, d), dt.date(2023, 12, 28), DAY, time="ts")


# Run log


@query(f"with {RUN_STATE_SQL} select * from state")
def run_state(spark, d):
    return runlog.run_state(run_events(spark, d))


@query(f"with {RUN_STATE_SQL} select *, null::varchar as path from state")
def logged_runs(spark, d):
    """The same state from a log with a snapshot and a tail, where one event in three comes late, after events that follow it."""
    root, e = fresh(spark, "log"), run_events(spark, d)
    whole = e.select("run_id", "seq", "created_at", "window_start", "window_end", F.lit(None).cast("string").alias("path"), "record_count", "status", "error_message")
    for rest in (1, 2, 0):
        runlog.append_run_events(whole.where(F.col("seq") % 3 == rest), root)
        if rest:
            runlog.snapshot_log(spark, root)
    return runlog.logged_state(spark, root)


@query(f"with {RUN_STATE_SQL} select * from state order by created_at desc, run_id desc limit 10")
def latest_runs(spark, d):
    return runlog.latest_runs(runlog.run_state(run_events(spark, d)))


@query(f"with {RUN_STATE_SQL} select * from state where run_id = 42")
def run_by_id(spark, d):
    return runlog.run_by_id(runlog.run_state(run_events(spark, d)), 42)


@query(f"with {RUN_STATE_SQL} select * from state where status = 'failed'")
def runs_by_status(spark, d):
    return runlog.runs_by_status(runlog.run_state(run_events(spark, d)), "failed")


@query(f"with {RUN_STATE_SQL} select * from state where window_start >= timestamp '2024-01-05' and window_end <= timestamp '2024-01-06'")
def runs_in_range(spark, d):
    return runlog.runs_in_range(runlog.run_state(run_events(spark, d)), "2024-01-05 00:00:00", "2024-01-06 00:00:00")


@query(
    "select event_id, error_type, case "
    + " ".join(f"when contains(error_type, '{n}') then '{c}'" for n, c in runlog.ERROR_RULES)
    + f" else 'UNEXPECTED' end as category from (select event_id, ['{"', '".join(n for n, _ in runlog.ERROR_RULES)}', 'KeyError'][(event_id % 11 + 1)::int] as error_type from events)"
)
def classify_errors(spark, d):
    names = F.array(*(F.lit(n) for n in [*(n for n, _ in runlog.ERROR_RULES), "KeyError"]))
    return runlog.classify_errors(events(spark, d).select("event_id", F.get(names, (F.col("event_id") % 11).cast("int")).alias("error_type")))


@query(
    f"""with {RUN_STATE_SQL} select run_id, error_message, case when error_message is null then null when regexp_matches(error_message, '^\\[([^\\]]+)\\]') then regexp_extract(error_message, '^\\[([^\\]]+)\\]', 1) else 'UNKNOWN' end as category,
regexp_replace(error_message, '^\\[[^\\]]+\\]\\s*', '') as detail from state"""
)
def error_category(spark, d):
    return runlog.with_error_category(runlog.run_state(run_events(spark, d)).select("run_id", "error_message"))


@query(
    f"""with {RUN_STATE_SQL} select date_trunc('day', created_at)::timestamp as window_start,
  case when status = 'failed' then coalesce(nullif(regexp_extract(error_message, '^\\[([^\\]]+)\\]', 1), ''), 'UNKNOWN') end as category, count(*)::bigint as runs,
  sum((status = 'success')::int)::bigint as successes, sum((status = 'failed')::int)::bigint as failures, sum(record_count)::bigint as records,
  round(avg(date_diff('second', window_start, window_end) / 60.0e0), 6) as mean_minutes
from state where created_at is not null group by 1, 2"""
)
def run_metrics(spark, d):
    return runlog.run_metrics(runlog.run_state(run_events(spark, d)))


@query(
    f"""with {RUN_STATE_SQL} select time_bucket(interval 1 hour, created_at)::timestamp as window_start, count(*)::bigint as failures
from state where status = 'failed' group by 1 having count(*) >= 3"""
)
def failure_alarm(spark, d):
    return runlog.failure_alarm(runlog.run_state(run_events(spark, d)), window="1 hour")


# Models


def split(spark: SparkSession, d: str) -> DataFrame:
    return features.time_split(feature_rows(spark, d))


@query(
    f"""with {HOURLY_SQL}, {features_sql()}, n as (select row_number() over (order by hour_start) as i, count(*) over () as n, * from features)
select * exclude (i, n), case when i <= floor(n * (1 - 0.1e0)) then 'train' else 'test' end as split from n"""
)
def train_test_split(spark, d):
    return split(spark, d)


def fitted(spark: SparkSession, d: str) -> tuple[DataFrame, object]:
    rows = split(spark, d)
    fit = model.fit_ols(rows.where("split = 'train'"), MODEL_FEATURES, TARGET)
    return fit.transform(model.assembled(rows, MODEL_FEATURES)).drop("features"), fit


# Fits that SQL can follow: two features by the sums behind the normal equations, one feature by key and by fold.
TRAIN_SQL = f"with {HOURLY_SQL}, {features_sql()}, n as (select row_number() over (order by hour_start) as i, count(*) over () as n, * from features), train as (select lag_1h::double as a, lag_24h::double as b, flight_count::double as y, hour_start from n where i <= floor(n * (1 - 0.1e0)))"


def solved_sql(rows: str, key: str, features: list[str], alpha: float = 0.0) -> str:
    """CTEs from `rows` on, whose last, `fit` (key, term, coefficient), is the fit of flight_count for each key: the normal
    equations of centred sums, solved by elimination, a CTE a column."""
    k, names = len(features), [*features, TARGET]
    sums = [f"covar_pop({names[i]}::double, {names[j]}::double) * count(*){f' + {alpha}::double' if i == j else ''} as c{i}_{j}" for i in range(k) for j in range(k + 1)]
    steps = [f"sums as (select {key} as key, {', '.join(f'avg({c})::double as m{i}' for i, c in enumerate(names))}, {', '.join(sums)} from {rows} group by 1)"]
    steps.append("e0 as (" + " union all ".join(f"select key, {i} as i, {j} as j, c{i}_{j} as v from sums" for i in range(k) for j in range(k + 1)) + ")")
    for p in range(k):
        steps.append(
            f"""e{p + 1} as (select t.key, t.i, t.j, case when t.i = {p} then t.v / p.v else t.v - c.v * r.v / p.v end as v from e{p} t
  join e{p} p on p.key = t.key and p.i = {p} and p.j = {p} join e{p} c on c.key = t.key and c.i = t.i and c.j = {p} join e{p} r on r.key = t.key and r.i = {p} and r.j = t.j)"""
        )
    terms = " ".join(f"when {i} then '{c}'" for i, c in enumerate(features))
    means = " ".join(f"when {i} then m{i}" for i in range(k))
    steps.append(f"solution as (select key, i, v from e{k} where j = {k})")
    steps.append(
        f"""fit as (select key, case i {terms} end as term, round(v, 6) as coefficient from solution
  union all select s.key, 'intercept', round(max(m{k}) - sum(v * case i {means} end), 6) from sums s join solution using (key) group by s.key)"""
    )
    return ", ".join(steps)


SIX_SQL = f"with {HOURLY_SQL}, {features_sql()}, n as (select row_number() over (order by hour_start) as i, count(*) over () as n, * from features), train as (select * exclude (i, n) from n where i <= floor(n * (1 - 0.1e0)))"


@query(f"{SIX_SQL}, {solved_sql('train', '0', MODEL_FEATURES)} select term, coefficient from fit")
def ols_fit(spark, d):
    return model.coefficient_table(fitted(spark, d)[1], MODEL_FEATURES, spark).withColumn("coefficient", F.round("coefficient", 6))


def two_features_sql(alpha: float) -> str:
    return f"""{TRAIN_SQL}, s as (select avg(a) as ma, avg(b) as mb, avg(y) as my, var_pop(a) * count(*) + {alpha}::double as aa, var_pop(b) * count(*) + {alpha}::double as bb,
  covar_pop(a, b) * count(*) as ab, covar_pop(a, y) * count(*) as ay, covar_pop(b, y) * count(*) as by_ from train),
c as (select *, (ay * bb - by_ * ab) / (aa * bb - ab * ab) as ca, (by_ * aa - ay * ab) / (aa * bb - ab * ab) as cb from s)
select 'lag_1h' as term, round(ca, 6) as coefficient from c union all select 'lag_24h', round(cb, 6) from c union all select 'intercept', round(my - ca * ma - cb * mb, 6) from c"""


def two_terms(spark: SparkSession, fit) -> DataFrame:
    told = zip(["lag_1h", "lag_24h", "intercept"], [*fit.coefficients, fit.intercept], strict=True)
    return spark.createDataFrame([(t, round(float(c), 6)) for t, c in told], "term string, coefficient double")


@query(two_features_sql(0.0))
def ols_two_features(spark, d):
    return two_terms(spark, model.fit_ols(split(spark, d).where("split = 'train'"), ["lag_1h", "lag_24h"], TARGET))


@query(two_features_sql(10.0))
def ridge_two_features(spark, d):
    return two_terms(spark, model.fit_ridge(split(spark, d).where("split = 'train'"), ["lag_1h", "lag_24h"], TARGET, 10.0))


@query(
    """with hourly as (select event_type, date_trunc('hour', ts)::timestamp as hour_start, count(distinct user_id) + max((user_id is null)::int) as y from events group by 1, 2),
f as (select event_type, y::double as y, lag(y) over (partition by event_type order by hour_start)::double as x from hourly),
c as (select event_type, regr_slope(y, x) as b, regr_intercept(y, x) as a from f where x is not null group by 1)
select event_type, 'intercept' as term, round(a, 6) as coefficient from c union all select event_type, 'lag_1h', round(b, 6) from c"""
)
def ols_lag_by_key(spark, d):
    hourly = agg.hourly_counts(events(spark, d), entity="user_id", time="ts", keys=("event_type",))
    lagged = hourly.withColumn("lag_1h", F.lag("flight_count").over(Window.partitionBy("event_type").orderBy("hour_start"))).where("lag_1h is not null")
    return model.fit_by_key(lagged, ["event_type"], ["lag_1h"], TARGET).withColumn("coefficient", F.round("coefficient", 6))


@query(
    f"""{TRAIN_SQL}, f as (select ntile(5) over (order by hour_start) as fold, a, y from train),
s as (select fold, count(*) as n, sum(a) as sx, sum(y) as sy, sum(a * a) as sxx, sum(a * y) as sxy, sum(y * y) as syy from f group by 1),
r as (select s.*, t.n - s.n as rn, t.sx - s.sx as rx, t.sy - s.sy as ry, t.sxx - s.sxx as rxx, t.sxy - s.sxy as rxy
  from s, (select sum(n) as n, sum(sx) as sx, sum(sy) as sy, sum(sxx) as sxx, sum(sxy) as sxy from s) t),
b as (select alpha, r.*, (rxy - rx * ry / rn) / (rxx - rx * rx / rn + alpha) as slope from r, (select unnest([{", ".join(f"{a}::double" for a in model.ALPHAS)}]) as alpha)),
c as (select *, ry / rn - slope * rx / rn as icept from b),
m as (select alpha, avg(1 - (syy - 2 * icept * sy - 2 * slope * sxy + n * icept * icept + 2 * icept * slope * sx + slope * slope * sxx) / (syy - sy * sy / n)) as mean_r2 from c group by 1)
select alpha, round(mean_r2, 6) as mean_r2, row_number() over (order by mean_r2 desc, alpha) = 1 as best from m"""
)
def ridge_alpha_one_feature(spark, d):
    return model.select_alpha(split(spark, d).where("split = 'train'"), ["lag_1h"], TARGET).withColumn("mean_r2", F.round("mean_r2", 6))


MOVING_SQL = f"""with {HOURLY_SQL}, {features_sql()}, d as (select hour_start::date as day, flight_count::double as y, lag_1h::double as a, lag_24h::double as b from features),
w as (select e.day as feature_date, d.* exclude (day) from d join (select distinct day from d) e on d.day between e.day - 13 and e.day),
s as (select feature_date, avg(a) as ma, avg(b) as mb, avg(y) as my, var_pop(a) * count(*) as aa, var_pop(b) * count(*) as bb, covar_pop(a, b) * count(*) as ab, covar_pop(a, y) * count(*) as ay, covar_pop(b, y) * count(*) as by_ from w group by 1),
c as (select *, (ay * bb - by_ * ab) / (aa * bb - ab * ab) as ca, (by_ * aa - ay * ab) / (aa * bb - ab * ab) as cb from s where aa * bb - ab * ab > 1e-9 * aa * bb)
select feature_date, 'lag_1h' as term, round(ca, 6) as coefficient from c union all select feature_date, 'lag_24h', round(cb, 6) from c union all select feature_date, 'intercept', round(my - ca * ma - cb * mb, 6) from c"""


@query(MOVING_SQL)
def moving_fits(spark, d):
    """Fits over the 14 days to each day, from a stored table of each day's sums."""
    root, columns = fresh(spark, "sums"), ["lag_1h", "lag_24h"]
    moving.store_day_sums(feature_rows(spark, d).withColumn("feature_date", F.to_date("hour_start")), root, columns, TARGET)
    return moving.moving_fits(spark.read.parquet(root), columns).withColumn("coefficient", F.round("coefficient", 6))


@query(f"select * from ({MOVING_SQL}) where feature_date = date '2024-01-10'")
def window_fit(spark, d):
    """The fit over the 14 days to one day, after that day and another were written a second time."""
    root, columns = fresh(spark, "sums"), ["lag_1h", "lag_24h"]
    rows = feature_rows(spark, d).withColumn("feature_date", F.to_date("hour_start"))
    wrong = F.col("flight_count") + F.when(F.col("feature_date").isin(DAY, DAY - dt.timedelta(days=1)), 100).otherwise(0)
    moving.store_day_sums(rows.withColumn("flight_count", wrong), root, columns, TARGET)
    moving.store_day_sums(rows.where(F.col("feature_date").isin(DAY, DAY - dt.timedelta(days=1))), root, columns, TARGET)
    fit = moving.window_fit(spark.read.parquet(root), DAY, columns)
    return fit.select(F.lit(DAY).alias("feature_date"), "term", F.round("coefficient", 6).alias("coefficient"))


@query(f"with {HOURLY_SQL}, {features_sql()}, c as (select regr_slope(flight_count, lag_1h) as b, regr_intercept(flight_count, lag_1h) as a from features) select hour_start, round(a + b * lag_1h, 6) as prediction from features, c")
def loaded_model(spark, d):
    """Predictions of a model that was saved and loaded again."""
    rows, path = feature_rows(spark, d), fresh(spark, "model")
    model.save_model(model.fit_ols(rows, ["lag_1h"], TARGET), ["lag_1h"], path)
    return PipelineModel.load(path).transform(rows).select("hour_start", F.round("prediction", 6).alias("prediction"))


@query(f"with {HOURLY_SQL}, {features_sql()} select round(regr_slope(flight_count, lag_1h), 6) as slope, round(regr_intercept(flight_count, lag_1h), 6) as intercept from features")
def ols_univariate(spark, d):
    fit = model.fit_ols(feature_rows(spark, d), ["lag_1h"], TARGET)
    return spark.createDataFrame([(round(float(fit.coefficients[0]), 6), round(float(fit.intercept), 6))], "slope double, intercept double")


@query(f"with own as ({ORACLE_SQL['hourly_features_by_key']}), {solved_sql('own', 'event_type', MODEL_FEATURES)} select key as event_type, term, coefficient from fit")
def ols_by_key(spark, d):
    rows = hourly_features_by_key(spark, d)
    return model.fit_by_key(rows, ["event_type"], MODEL_FEATURES, TARGET).withColumn("coefficient", F.round("coefficient", 6))


@query(
    f"""with {HOURLY_SQL}, {features_sql()}, n as (select row_number() over (order by hour_start) as i, count(*) over () as n, * from features),
s as (select avg(lag_1h) as m1, stddev_pop(lag_1h) as s1, avg(lag_24h) as m2, stddev_pop(lag_24h) as s2 from n where i <= floor(n * (1 - 0.1e0)))
select hour_start, case when i <= floor(n * (1 - 0.1e0)) then 'train' else 'test' end as split, round((lag_1h - m1) / s1, 6) as lag_1h, round((lag_24h - m2) / s2, 6) as lag_24h from n, s"""
)
def scaled_features(spark, d):
    rows = split(spark, d)
    both = model.scale_population(rows.where("split = 'train'"), [rows.where("split = 'test'")], ["lag_1h", "lag_24h"])
    return agg.united(both).select("hour_start", "split", F.round("lag_1h", 6).alias("lag_1h"), F.round("lag_24h", 6).alias("lag_24h"))


@query(
    f"""with {HOURLY_SQL}, {features_sql()} select hour_start, lag_1h, lag_24h, lag_1h * lag_1h as "lag_1h*lag_1h", lag_1h * lag_24h as "lag_1h*lag_24h", lag_24h * lag_24h as "lag_24h*lag_24h" from features"""
)
def polynomial_terms(spark, d):
    return model.polynomial_terms(feature_rows(spark, d).select("hour_start", "lag_1h", "lag_24h"), ["lag_1h", "lag_24h"])[0]


@query(f"{SIX_SQL}, {solved_sql('train', '0', MODEL_FEATURES, 1.0)} select term, coefficient from fit")
def ridge_fit(spark, d):
    fit = model.fit_ridge(split(spark, d).where("split = 'train'"), MODEL_FEATURES, TARGET, 1.0)
    return model.coefficient_table(fit, MODEL_FEATURES, spark).withColumn("coefficient", F.round("coefficient", 6))


@query()
def ridge_alpha(spark, d):
    return model.select_alpha(split(spark, d).where("split = 'train'"), MODEL_FEATURES, TARGET)


@query()
def model_comparison(spark, d):
    return model.compare_models(split(spark, d), MODEL_FEATURES, TARGET)


@query()
def best_model(spark, d):
    return model.best_model(model.compare_models(split(spark, d), MODEL_FEATURES, TARGET))


@query(f"{SIX_SQL}, {solved_sql('train', '0', MODEL_FEATURES)} select term, coefficient, abs(coefficient) as size, sign(coefficient)::int as sign from fit where term <> 'intercept'")
def coefficient_rank(spark, d):
    return model.coefficient_rank(ols_fit(spark, d))


# Metrics and plot datasets take the last hour's count as the prediction, which SQL can follow.
NAIVE_SQL = f"with {HOURLY_SQL}, {features_sql()}, n as (select row_number() over (order by hour_start) as i, count(*) over () as n, * from features), p as (select *, case when i <= floor(n * (1 - 0.1e0)) then 'train' else 'test' end as split from n)"


@query(
    f"""{NAIVE_SQL} select split, count(*)::bigint as n, round(avg(abs(flight_count - lag_1h)), 6) as mae,
  round(100 * avg(abs(flight_count - lag_1h) / greatest(abs(flight_count), 2.220446049250313e-16)), 6) as mape,
  round(1 - sum((flight_count - lag_1h)::double ^ 2) / (var_pop(flight_count) * count(*)), 6) as r2 from p group by split"""
)
def regression_metrics(spark, d):
    told = model.regression_metrics(split(spark, d), actual=TARGET, predicted="lag_1h")
    return told.select("split", "n", *(F.round(c, 6).alias(c) for c in ("mae", "mape", "r2")))


@query(f"{NAIVE_SQL} select hour_start, split, lag_1h as prediction, round(lag_1h * (1 - 0.1e0), 6) as lower, round(lag_1h * (1 + 0.1e0), 6) as upper from p")
def forecast_band(spark, d):
    band = model.forecast_band(split(spark, d).withColumn("prediction", F.col("lag_1h")), 0.1)
    return band.select("hour_start", "split", "prediction", F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))


@query(histogram_sql("features", "flight_count - lag_1h", 20, f"{HOURLY_SQL}, {features_sql()}"))
def residual_histogram(spark, d):
    return model.residual_histogram(feature_rows(spark, d), actual=TARGET, predicted="lag_1h")


@query(
    f"""with {HOURLY_SQL}, {features_sql()}, ends as (select least(min(flight_count), min(lag_1h))::double as line_low, greatest(max(flight_count), max(lag_1h))::double as line_high from features)
select flight_count::double as actual, lag_1h::double as predicted, line_low, line_high from features, ends"""
)
def pred_vs_actual(spark, d):
    return model.pred_vs_actual(feature_rows(spark, d), actual=TARGET, predicted="lag_1h")


# The same series from the larger tables


@query("select date_trunc('hour', o_orderdate::timestamp)::timestamp as hour_start, count(distinct o_custkey)::bigint as flight_count from orders group by 1")
def hourly_counts_orders(spark, d):
    return agg.hourly_counts(table(spark, d, "orders"), entity="o_custkey", time="o_orderdate")


@query(histogram_sql("lineitem", "l_quantity", 50, "one as (select 1)"))
def quantity_histogram(spark, d):
    return agg.histogram(table(spark, d, "lineitem"), "l_quantity")
