"""Fits over a window of days that moves on: each day's sums of products are stored, a refit adds up a window of them.

A day that comes in, or is corrected, writes its own row and nothing else. A refit reads as many rows as the window has
days, however many rows of features these stand for.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficspark.operators.model import fits_of_sums, gram_columns, gram_names
from trafficspark.sources.tables import overwrite_day


def day_sums(df: DataFrame, features: list[str], target: str, *, date_col: str = "feature_date", keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, date_col and the sums of products of each day's rows; rows with a null in any column are left out, as a fit would."""
    rows = df.dropna(subset=[*features, target])
    return rows.groupBy(*keys, date_col).agg(*gram_columns(features, target))


def store_day_sums(df: DataFrame, root: str, features: list[str], target: str, *, date_col: str = "feature_date", keys: tuple[str, ...] = ()) -> None:
    """Write the sums of the days in df to the table at root, in place of what it held for them."""
    overwrite_day(day_sums(df, features, target, date_col=date_col, keys=keys), root, date_col=date_col)


def window_fit(sums: DataFrame, end: dt.date, features: list[str], *, days: int = 14, alpha: float = 0.0, date_col: str = "feature_date", keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, term, coefficient of the fit over the `days` days that end with `end`, from stored sums of those days alone.

    An error if none of them has rows.
    """
    first = end - dt.timedelta(days=days - 1)
    chosen = sums.where(F.col(date_col).between(F.lit(first), F.lit(end)))
    if chosen.isEmpty():
        raise ValueError(f"no rows in the {days} days to {end}")
    return fits_of_sums(added(chosen, features, keys), list(keys), features, alpha)


def moving_fits(sums: DataFrame, features: list[str], *, days: int = 14, alpha: float = 0.0, date_col: str = "feature_date", keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, date_col, term, coefficient: the fit over the `days` days to each day that has sums.

    Each day's row goes to the windows that hold it and is added there, so a day costs `days` narrow rows in a shuffle
    and no window sees more than its own days.
    """
    ends = sums.select(*keys, date_col).distinct()
    reach = sums.withColumn("__end", F.explode(F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda k: F.date_add(date_col, k)))).drop(date_col).withColumnRenamed("__end", date_col)
    whole = added(reach, features, (*keys, date_col))
    alike = [F.col(f"w.{c}").eqNullSafe(F.col(f"e.{c}")) for c in (*keys, date_col)]
    held = whole.alias("w").join(ends.alias("e"), alike, "left_semi")
    return fits_of_sums(held, [*keys, date_col], features, alpha)


def added(sums: DataFrame, features: list[str], keys: tuple[str, ...]) -> DataFrame:
    """Sums of several days as one row for each of `keys`."""
    return sums.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in gram_names(len(features))))
