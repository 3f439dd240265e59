"""The raw incident CSV of 46 columns (S1, S6): schema, clean names, scan.

A header with units in its names is read by a fixed schema; clean_names renames those columns
to the names used by the operators and the feature pipeline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sevlens.sources.files import read_csv, read_csv_with_corrupt

# The columns of the file, in order, with their types.
_COLUMNS = """
    ID STRING, Source STRING, Severity INT, Start_Time TIMESTAMP, End_Time TIMESTAMP,
    Start_Lat DOUBLE, Start_Lng DOUBLE, End_Lat DOUBLE, End_Lng DOUBLE, Distance(mi) DOUBLE,
    Description STRING, Street STRING, City STRING, County STRING, State STRING, Zipcode STRING,
    Country STRING, Timezone STRING, Airport_Code STRING, Weather_Timestamp TIMESTAMP,
    Temperature(F) DOUBLE, Wind_Chill(F) DOUBLE, Humidity(%) DOUBLE, Pressure(in) DOUBLE,
    Visibility(mi) DOUBLE, Wind_Direction STRING, Wind_Speed(mph) DOUBLE,
    Precipitation(in) DOUBLE, Weather_Condition STRING, Amenity BOOLEAN, Bump BOOLEAN,
    Crossing BOOLEAN, Give_Way BOOLEAN, Junction BOOLEAN, No_Exit BOOLEAN, Railway BOOLEAN,
    Roundabout BOOLEAN, Station BOOLEAN, Stop BOOLEAN, Traffic_Calming BOOLEAN,
    Traffic_Signal BOOLEAN, Turning_Loop BOOLEAN, Sunrise_Sunset STRING, Civil_Twilight STRING,
    Nautical_Twilight STRING, Astronomical_Twilight STRING"""
_TYPES = {"STRING": T.StringType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType(),
          "TIMESTAMP": T.TimestampType()}
RAW_SCHEMA = T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in _COLUMNS.split(","))])

# Names with units and the names used here.
CLEAN_NAMES = {"Distance(mi)": "Distance_mi", "Temperature(F)": "Temperature_F", "Wind_Chill(F)": "Wind_Chill_F",
               "Humidity(%)": "Humidity_Pct", "Pressure(in)": "Pressure_in", "Visibility(mi)": "Visibility_mi",
               "Wind_Speed(mph)": "Wind_Speed_mph", "Precipitation(in)": "Precipitation_in"}


def clean_names(df: DataFrame) -> DataFrame:
    """Columns with units renamed; other columns as they are."""
    return df.withColumnsRenamed(CLEAN_NAMES)


def raw_names(df: DataFrame) -> DataFrame:
    """The inverse of :func:clean_names."""
    return df.withColumnsRenamed({clean: raw for raw, clean in CLEAN_NAMES.items()})


def read_incident_csv(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """The file under clean names; with keep_corrupt also the text of malformed lines."""
    scan = read_csv_with_corrupt if keep_corrupt else read_csv
    return clean_names(scan(spark, path, RAW_SCHEMA))
