"""Counts by hour, summaries, and the datasets behind histograms, box plots, density curves and maps."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficspark.functions.scalars import hour_start


#: Size of quantile sketches, and how far (as a share of all values) the rank of what they give may be off, nearly always.
SKETCH_K, RANK_ERROR = 800, 0.005


def distinct_with_null(column: Column) -> Column:
    """Distinct values, null counted as one more."""
    return (F.count_distinct(column) + F.coalesce(F.max(column.isNull().cast("long")), F.lit(0))).cast("long")


def hourly_counts(df: DataFrame, *, entity: str = "icao24", time: str = "capture_datetime", keys: tuple[str, ...] = (), approx: bool = False) -> DataFrame:
    """keys, hour_start, flight_count: distinct entities (null is one) in each hour, exact or by a sketch."""
    e = F.col(entity)
    count = F.approx_count_distinct(e) + F.coalesce(F.max(e.isNull().cast("long")), F.lit(0)) if approx else distinct_with_null(e)
    return df.groupBy(*keys, hour_start(F.col(time)).alias("hour_start")).agg(count.cast("long").alias("flight_count"))


def hourly_sketches(df: DataFrame, *, entity: str = "icao24", time: str = "capture_datetime", keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, hour_start, sketch of the distinct entities of each hour (null is one more); sketches merge to longer spans."""
    e = F.coalesce(F.col(entity).cast("string"), F.lit("\0"))
    return df.groupBy(*keys, hour_start(F.col(time)).alias("hour_start")).agg(F.hll_sketch_agg(e, 14).alias("sketch"))


def merged_counts(sketches: DataFrame, unit: str = "day", *, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, start, flight_count (estimated distinct entities) of each day, week or other unit, from hourly sketches alone."""
    start = F.date_trunc(unit, "hour_start").cast("timestamp_ntz")
    return sketches.groupBy(*keys, start.alias("start")).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("flight_count"))


def hour_of_day_profile(df: DataFrame, *, entity: str = "icao24", hour: str = "hour") -> DataFrame:
    """Records and distinct entities by hour of day."""
    return df.groupBy(F.col(hour).alias("hour")).agg(F.count(F.lit(1)).alias("records"), distinct_with_null(F.col(entity)).alias("entities"))


def data_summary(df: DataFrame, *, entity: str = "icao24", time: str = "capture_time", numerics: tuple[str, ...] = ("latitude", "longitude", "baro_altitude", "velocity", "vertical_rate")) -> DataFrame:
    """metric, value: rows, distinct entities, nulls of each column, least, greatest and mean of each numeric, time range.

    One pass. Parts whose column is absent are left out; an empty table gives counts of 0 and null statistics.
    """
    parts: dict[str, Column] = {"total_records": F.count(F.lit(1))}
    if entity in df.columns:
        parts["unique_entities"] = distinct_with_null(F.col(entity))
    parts |= {f"null_{c}": F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)) for c in df.columns}
    for c in numerics:
        if c in df.columns:
            parts |= {f"min_{c}": F.min(c), f"max_{c}": F.max(c), f"mean_{c}": F.avg(c)}
    if time in df.columns:
        parts |= {f"min_{time}": F.min(time), f"max_{time}": F.max(time)}
    wide = df.agg(*(v.cast("double").alias(k) for k, v in parts.items()))
    long = F.array(*(F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in parts))
    return wide.select(F.explode(long).alias("m")).select("m.metric", F.round("m.value", 6).alias("value"))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """bin (from 1), low, high, n: equal-width bins over the range of the values, the last closed; empty bins hold 0.

    Nulls are left out; equal values get a range of 1 around them; no values give no bins.
    """
    v = F.col("v")
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    ends = values.agg(F.min("v").alias("low"), F.max("v").alias("high")).where("low is not null")
    wide = F.when(F.col("low") == F.col("high"), 0.5).otherwise(0.0)
    ends = ends.select((F.col("low") - wide).alias("low"), (F.col("high") + wide).alias("high"))
    place = F.least(F.floor((v - F.col("low")) * bins / (F.col("high") - F.col("low"))) + 1, F.lit(bins)).cast("int")
    # The range is one row.
    counts = values.join(F.broadcast(ends)).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    step = (F.col("high") - F.col("low")) / bins
    spine = ends.select("*", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return spine.join(counts, "bin", "left").select("bin", F.round(F.col("low") + step * (F.col("bin") - 1), 6).alias("low"), F.round(F.col("low") + step * F.col("bin"), 6).alias("high"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def value_sketches(df: DataFrame, column: str, *, time: str, keys: tuple[str, ...] = (), k: int = SKETCH_K) -> DataFrame:
    """keys, day, n, sketch: a mergeable quantile sketch of each day's values, of a size that doesn't go with their number. Nulls and NaN are left out."""
    v = F.col(column).cast("double")
    return df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, F.to_date(time).alias("day")).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(v, k).alias("sketch"))


def merged_quartiles(sketches: DataFrame, unit: str | None = "week", *, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, start, n, q1, median, q3 of each week, month or other unit from the sketches of its days alone; without a unit, of all days."""
    by = [*keys, *([F.date_trunc(unit, "day").cast("date").alias("start")] if unit else [])]
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")).where("n > 0")
    q = F.kll_sketch_get_quantile_double("sketch", F.array(*(F.lit(x) for x in (0.25, 0.5, 0.75))))
    return merged.withColumn("__q", q).select(*keys, *["start"] * bool(unit), "n", *(F.get("__q", F.lit(i)).alias(c) for i, c in enumerate(("q1", "median", "q3"))))


def box_stats(df: DataFrame, column: str, *, exact: bool = False, k: int = SKETCH_K) -> DataFrame:
    """q1, median, q3, whisker_low, whisker_high (extreme values within 1.5 times the quartile range), n_outliers, n.

    Quartiles come from a sketch, each within RANK_ERROR of its rank. exact interpolates between the values, of which it
    holds every distinct one in a task: for small tables. No values give no row.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null and not isnan(v)")
    shares = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    held = values.agg(F.count(F.lit(1)).alias("n"), (F.percentile("v", shares) if exact else F.kll_sketch_agg_double("v", k)).alias("held")).where("n > 0")
    quartiles = held.select("n", (F.col("held") if exact else F.kll_sketch_get_quantile_double("held", shares)).alias("q"))
    reach = 1.5 * (F.get("q", F.lit(2)) - F.get("q", F.lit(0)))
    inside = F.col("v").between(F.get("q", F.lit(0)) - reach, F.get("q", F.lit(2)) + reach)
    told = values.join(F.broadcast(quartiles)).groupBy("q", "n").agg(F.min(F.when(inside, F.col("v"))).alias("whisker_low"), F.max(F.when(inside, F.col("v"))).alias("whisker_high"), F.sum((~inside).cast("long")).alias("n_outliers"))
    return told.select(*(F.round(F.get("q", F.lit(i)), 6).alias(c) for i, c in enumerate(("q1", "median", "q3"))), F.round("whisker_low", 6).alias("whisker_low"), F.round("whisker_high", 6).alias("whisker_high"), "n_outliers", "n")


def kde(df: DataFrame, column: str, grid: int = 200, *, cells: int = 2048) -> DataFrame:
    """x, density: Gaussian density with Scott's bandwidth at `grid` points over the range of the values.

    The values are first counted in `cells` equal cells with their mean, so the sum over the grid has a fixed
    size however many rows there are; cells far narrower than the bandwidth leave the curve as it is.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    told = values.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.stddev_samp("v").alias("sd"), F.count(F.lit(1)).alias("n")).where("sd > 0")
    told = told.withColumn("width", F.col("sd") * F.pow("n", F.lit(-0.2)))
    cell = F.least(F.floor((F.col("v") - F.col("low")) * cells / (F.col("high") - F.col("low"))), F.lit(cells - 1))
    counted = values.join(F.broadcast(told)).groupBy(cell.alias("cell"), "low", "high", "width", "n").agg(F.avg("v").alias("at"), F.count(F.lit(1)).alias("m"))
    x = F.col("low") + (F.col("high") - F.col("low")) * F.col("i") / (grid - 1)
    points = counted.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))).withColumn("x", x)
    weight = F.col("m") * F.exp(-0.5 * F.pow((F.col("x") - F.col("at")) / F.col("width"), F.lit(2.0)))
    scale = F.max(F.col("n") * F.col("width")) * (2 * 3.141592653589793) ** 0.5
    return points.groupBy("i").agg(F.max("x").alias("x"), (F.sum(weight) / scale).alias("density")).select("i", F.round("x", 6).alias("x"), "density")


def geo_points(df: DataFrame, *, lat: str = "latitude", lon: str = "longitude", colour: str = "baro_altitude") -> DataFrame:
    return df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(lon).alias("longitude"), F.col(lat).alias("latitude"), F.col(colour).alias("altitude"))


def geo_grid(df: DataFrame, cell: float = 10.0, *, lat: str = "latitude", lon: str = "longitude", colour: str = "baro_altitude") -> DataFrame:
    """Points and mean altitude by grid cell, for as many points as there may be."""
    points = geo_points(df, lat=lat, lon=lon, colour=colour)
    at = {c: F.floor(F.col(c) / cell).cast("long") for c in ("longitude", "latitude")}
    return points.groupBy(at["longitude"].alias("lon_cell"), at["latitude"].alias("lat_cell")).agg(F.count(F.lit(1)).alias("points"), F.round(F.avg("altitude"), 6).alias("mean_altitude"))


def day_coverage(df: DataFrame, start: dt.date, end: dt.date, *, time: str) -> DataFrame:
    """day, rows for every calendar day from start to end, 0 where there are none."""
    days = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("day"))
    counts = df.groupBy(F.to_date(time).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).cast("long").alias("rows"))


def united(dfs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)
