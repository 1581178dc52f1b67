"""Fixed schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T



KINDS = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "array<bigint>": T.ArrayType(T.LongType())}


def columns(text: str) -> T.StructType:
    """A schema from "name type, …", without a running session."""
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in (c.split(" ") for c in text.split(", "))])


# Column names, order and types of the two stored tables.
STATE_SCHEMA = columns(
    "icao24 string, callsign string, origin_country string, time_position bigint, last_contact bigint, longitude double, latitude double, "
    "baro_altitude double, on_ground boolean, velocity double, true_track double, vertical_rate double, sensors array<bigint>, "
    "geo_altitude double, squawk string, spi boolean, position_source bigint, category bigint, capture_time bigint"
)
FLIGHT_SCHEMA = columns(
    "icao24 string, firstSeen bigint, estDepartureAirport string, lastSeen bigint, estArrivalAirport string, callsign string, "
    "estDepartureAirportHorizDistance bigint, estDepartureAirportVertDistance bigint, estArrivalAirportHorizDistance bigint, "
    "estArrivalAirportVertDistance bigint, departureAirportCandidatesCount bigint, arrivalAirportCandidatesCount bigint"
)
FEATURE_COLUMNS = ["hour_start", "flight_count", "hour_of_day", "day_of_week", "is_weekend", "lag_1h", "lag_24h", "rolling_mean_6h"]
MODEL_FEATURES = ["hour_of_day", "day_of_week", "is_weekend", "lag_1h", "lag_24h", "rolling_mean_6h"]
