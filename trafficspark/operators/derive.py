"""Columns derived from readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficspark.functions import scalars as S


def add_derived_columns(df: DataFrame, *, time: str = "capture_time", velocity: str = "velocity", altitude: str = "baro_altitude", vertical_rate: str = "vertical_rate") -> DataFrame:
    """Time of day, speed in km/h, altitude in feet and flight phase; each only if its source column is there."""
    added = {}
    if time in df.columns:
        at = S.from_epoch(F.col(time))
        added |= {"capture_datetime": at, "hour": F.hour(at), "minute": F.minute(at)}
    if velocity in df.columns:
        added["speed_kmh"] = S.kmh(F.col(velocity))
    if altitude in df.columns:
        added["altitude_ft"] = S.feet(F.col(altitude))
    if vertical_rate in df.columns:
        added["flight_phase"] = S.flight_phase(F.col(vertical_rate))
    return df.withColumns(added) if added else df
