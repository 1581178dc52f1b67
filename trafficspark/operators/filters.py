"""Selections of state and flight tables: by box, entity, time and airport."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: seconds of an interval of flights beyond which the interface that the rows come from gives parts only.
LONGEST_INTERVAL = 7200
#: Default box, least latitude, least longitude, greatest latitude, greatest longitude.
DEFAULT_BOX = (18.0, 71.5, 20.0, 74.0)


def query_states(df: DataFrame, *, time: int | None = None, entities: str | list[str] | None = None, bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    """States at a capture time, of one entity or several (lower-cased), inside a box with its edges."""
    if time is not None:
        df = df.where(F.col("capture_time") == time)
    if entities is not None:
        names = [entities] if isinstance(entities, str) else entities
        df = df.where(F.col("icao24").isin([n.lower() for n in names]))
    if bbox is not None:
        df = df.where(F.col("latitude").between(bbox[0], bbox[2]) & F.col("longitude").between(bbox[1], bbox[3]))
    return df


def query_flights(df: DataFrame, begin: int, end: int, *, entity: str | None = None, arrival: str | None = None, departure: str | None = None) -> DataFrame:
    """Flights within [begin, end]; those of an entity; arrivals by last sighting, departures by first, in the interval.

    Warns of intervals of more than LONGEST_INTERVAL seconds, whose rows may not all have been fetched; an error if begin is after end.
    """
    if begin > end:
        raise ValueError("begin is after end")
    if end - begin > LONGEST_INTERVAL:
        warnings.warn(f"an interval of {end - begin} seconds; more than {LONGEST_INTERVAL} may be incomplete", stacklevel=2)
    first, last = F.col("firstSeen"), F.col("lastSeen")
    if arrival is not None:
        df = df.where((F.col("estArrivalAirport") == arrival.upper()) & last.between(begin, end))
    if departure is not None:
        df = df.where((F.col("estDepartureAirport") == departure.upper()) & first.between(begin, end))
    if arrival is None and departure is None:
        df = df.where((first >= begin) & (last <= end))
    if entity is not None:
        df = df.where(F.col("icao24") == entity.lower())
    return df
