"""Declared tables: target column, source column and type. Nothing is inferred."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from trackgrid.keys import LAP, SESSION

STRING, SHORT, INT, BYTE = T.StringType(), T.ShortType(), T.IntegerType(), T.ByteType()
FLOAT, DOUBLE, BOOL, LONG = T.FloatType(), T.DoubleType(), T.BooleanType(), T.LongType()
TYPES = {"string": STRING, "short": SHORT, "int": INT, "byte": BYTE, "float": FLOAT, "double": DOUBLE, "boolean": BOOL, "long": LONG, "timestamp": T.TimestampType(), "date": T.DateType()}


@dataclass(frozen=True)
class TableSpec:
    """One table: (target, source, type) per column, its key and the columns that may not be all null."""

    name: str
    columns: tuple[tuple[str, str, str], ...]
    key: tuple[str, ...]
    required: tuple[str, ...] = ()

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(t, TYPES[k]) for t, _, k in self.columns])

    @property
    def sources(self) -> Mapping[str, str]:
        return {t: s for t, s, _ in self.columns}


# Target column, source column, type.
LAPS = TableSpec(
    name="laps",
    columns=(
        ("driver", "Driver", "string"),
        ("driver_number", "DriverNumber", "string"),
        ("team", "Team", "string"),
        ("lap_number", "LapNumber", "short"),
        ("lap_time", "LapTime", "double"),
        ("sector1_time", "Sector1Time", "double"),
        ("sector2_time", "Sector2Time", "double"),
        ("sector3_time", "Sector3Time", "double"),
        ("lap_start_time", "LapStartTime", "double"),
        ("pit_in_time", "PitInTime", "double"),
        ("pit_out_time", "PitOutTime", "double"),
        ("stint", "Stint", "short"),
        ("compound", "Compound", "string"),
        ("tyre_life", "TyreLife", "short"),
        ("fresh_tyre", "FreshTyre", "boolean"),
        ("track_status", "TrackStatus", "string"),
        ("is_accurate", "IsAccurate", "boolean"),
    ),
    key=("driver", "lap_number"),
    required=("driver", "lap_number"),
)
CAR_TELEMETRY = TableSpec(
    name="car_telemetry",
    columns=(
        ("driver", "_driver", "string"),
        ("lap_number", "_lap_number", "short"),
        ("session_time", "SessionTime", "double"),
        ("speed", "Speed", "float"),
        ("throttle", "Throttle", "float"),
        ("brake", "Brake", "boolean"),
        ("rpm", "RPM", "float"),
        ("n_gear", "nGear", "short"),
        ("drs", "DRS", "byte"),
        ("source", "Source", "string"),
    ),
    key=("driver", "lap_number", "session_time"),
    required=("driver", "lap_number", "session_time", "speed"),
)
POS_DATA = TableSpec(
    name="pos_data",
    columns=(
        ("driver", "_driver", "string"),
        ("lap_number", "_lap_number", "short"),
        ("session_time", "SessionTime", "double"),
        ("x", "X", "float"),
        ("y", "Y", "float"),
        ("z", "Z", "float"),
        ("status", "Status", "string"),
        ("source", "Source", "string"),
    ),
    key=("driver", "lap_number", "session_time"),
    required=("driver", "lap_number", "session_time", "x", "y"),
)
WEATHER = TableSpec(
    name="weather",
    columns=(
        ("session_time", "Time", "double"),
        ("air_temp", "AirTemp", "float"),
        ("track_temp", "TrackTemp", "float"),
        ("humidity", "Humidity", "float"),
        ("pressure", "Pressure", "float"),
        ("wind_speed", "WindSpeed", "float"),
        ("wind_direction", "WindDirection", "short"),
        ("rainfall", "Rainfall", "boolean"),
    ),
    key=("session_time",),
    required=("session_time",),
)
CIRCUIT_CORNERS = TableSpec(
    name="circuit_corners",
    columns=(
        ("number", "Number", "short"),
        ("letter", "Letter", "string"),
        ("x", "X", "float"),
        ("y", "Y", "float"),
        ("angle", "Angle", "float"),
        ("distance", "Distance", "float"),
    ),
    key=("number", "letter"),
    required=("number", "x", "y", "distance"),
)
RAW_TABLES = {t.name: t for t in (LAPS, CAR_TELEMETRY, POS_DATA, WEATHER, CIRCUIT_CORNERS)}

SESSION_META = T.StructType([
    T.StructField("season", INT), T.StructField("event_requested", STRING), T.StructField("session_requested", STRING), T.StructField("session_name", STRING),
    T.StructField("session_date", STRING), T.StructField("event_name", STRING), T.StructField("country", STRING), T.StructField("location", STRING), T.StructField("round_number", INT),
])
