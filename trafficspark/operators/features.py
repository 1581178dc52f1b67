"""Lag, rolling and calendar features of hourly series, and time-ordered splits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficspark.functions.scalars import weekday_columns
from trafficspark.operators import ordered
from trafficspark.operators.aggregates import hourly_counts
from trafficspark.operators.cleaning import clean_states
from trafficspark.schema import FEATURE_COLUMNS


def calendar_spine(hourly: DataFrame, *, keys: tuple[str, ...] = (), fill: int | None = 0) -> DataFrame:
    """hourly with a row for every clock hour between each series' first and last; new hours hold `fill`. Null keys are series too."""
    ends = hourly.groupBy(*keys).agg(F.min("hour_start").alias("a"), F.max("hour_start").alias("b")).where("a is not null")
    spine = ends.select(*keys, F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias("hour_start"))
    count = F.coalesce("flight_count", F.lit(fill).cast("long")) if fill is not None else F.col("flight_count")
    s, h = spine.alias("s"), hourly.alias("h")
    same = F.col("s.hour_start") == F.col("h.hour_start")
    for k in keys:
        same &= F.col(f"s.{k}").eqNullSafe(F.col(f"h.{k}"))
    others = [F.col(f"h.{c}") for c in hourly.columns if c not in (*keys, "hour_start")]
    return s.join(h, same, "left").select("s.*", *others).withColumn("flight_count", count)


def hourly_features(hourly: DataFrame, *, keys: tuple[str, ...] = (), lags: tuple[int, ...] = (1, 24), window: int = 6, calendar: bool = False, fill: int | None = 0, weekday_mode: str = "observed", long: bool | None = None) -> DataFrame:
    """keys and the eight feature columns; rows without all lags and a full window before them are dropped.

    Lags and windows go by rows, that is by hours that have data; with `calendar`, by clock hours. Keys keep series
    apart, each in a window of its own. The one series without keys, and series that `long` says are too long for a
    task, go by blocks of places in order (`ordered`), which no single task sees whole.
    """
    if calendar:
        hourly = calendar_spine(hourly, keys=keys, fill=fill)
    if long or (long is None and not keys):
        rows, order, own = ordered.in_blocks(ordered.ordered(hourly, [*keys, "hour_start"], place="__place"), max(window, *lags), keys=keys, place="__place")
    else:
        rows, order, own = hourly, Window.partitionBy(*keys).orderBy("hour_start"), F.lit(True)
    before = order.rowsBetween(-window, -1)
    day, weekend = weekday_columns(F.col("hour_start"), weekday_mode)
    rolling = F.when(F.count("flight_count").over(before) == window, F.round(F.avg("flight_count").over(before), 6))
    named = [f"lag_{n}h" for n in lags]
    told = rows.select(
        *keys, "hour_start", "flight_count", F.hour("hour_start").alias("hour_of_day"), day.alias("day_of_week"), weekend.alias("is_weekend"),
        *(F.lag("flight_count", n).over(order).alias(c) for n, c in zip(lags, named, strict=True)), rolling.alias(f"rolling_mean_{window}h"), own.alias("__own"),
    )
    columns = FEATURE_COLUMNS if (lags, window) == ((1, 24), 6) else ["hour_start", "flight_count", "hour_of_day", "day_of_week", "is_weekend", *named, f"rolling_mean_{window}h"]
    return told.where("__own").dropna(subset=[*named, f"rolling_mean_{window}h"]).select(*keys, *columns)


def features_for_day(df: DataFrame, day: dt.date, *, entity: str = "icao24", time: str = "capture_datetime", keys: tuple[str, ...] = (), clean_first: bool = False, **options) -> DataFrame:
    """Features of one day's hours, from that day and the one before; an error if the day has no rows."""
    both = df.where(F.to_date(time).between(day - dt.timedelta(days=1), day))
    if both.where(F.to_date(time) == F.lit(day)).isEmpty():
        raise ValueError(f"no rows on {day}")
    if clean_first:
        both = clean_states(both, entity=entity)
    found = hourly_features(hourly_counts(both, entity=entity, time=time, keys=keys), keys=keys, **options)
    return found.where(F.to_date("hour_start") == F.lit(day))  # above the windows: lags reach into the day before


def time_split(df: DataFrame, *, order: str = "hour_start", test_ratio: float = 0.1) -> DataFrame:
    """df with split: the first int(n * (1 - test_ratio)) rows in time are train, the rest test.

    Rows without a time come last; of rows of one time, some may be train and others test. df is computed once and its
    rows are written in order, so every later read is of those.
    """
    found = ordered.ordered(df, [order], place="__place")
    cut = int(found.n * (1 - test_ratio))
    return found.rows.withColumn("split", F.when(F.col("__place") <= cut, "train").otherwise("test")).drop("__place")
