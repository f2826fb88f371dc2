"""Column names, types and fixed values of the vessel data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw column -> cleaned column.
RENAMES = {
    "TripID": "trip_id",
    "StartLatitude": "start_latitude",
    "StartLongitude": "start_longitude",
    "StartTime": "start_time",
    "EndLatitude": "end_latitude",
    "EndLongitude": "end_longitude",
    "EndTime": "end_time",
    "StartPort": "start_port",
    "EndPort": "end_port",
    "time": "time_stamp",
    "shiptype": "ship_type",
    "Length": "length",
    "Breadth": "breadth",
    "Draught": "draught",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "SOG": "speed_over_ground",
    "COG": "course_over_ground",
    "TH": "true_heading",
    "Destination": "destination",
}

RAW_SCHEMA = T.StructType(
    [
        T.StructField("TripID", T.LongType()),
        T.StructField("MMSI", T.LongType()),
        T.StructField("StartLatitude", T.DoubleType()),
        T.StructField("StartLongitude", T.DoubleType()),
        T.StructField("StartTime", T.TimestampNTZType()),
        T.StructField("EndLatitude", T.DoubleType()),
        T.StructField("EndLongitude", T.DoubleType()),
        T.StructField("EndTime", T.TimestampNTZType()),
        T.StructField("StartPort", T.StringType()),
        T.StructField("EndPort", T.StringType()),
        T.StructField("ID", T.LongType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("shiptype", T.IntegerType()),
        T.StructField("Length", T.DoubleType()),
        T.StructField("Breadth", T.DoubleType()),
        T.StructField("Draught", T.DoubleType()),
        T.StructField("Latitude", T.DoubleType()),
        T.StructField("Longitude", T.DoubleType()),
        T.StructField("SOG", T.DoubleType()),
        T.StructField("COG", T.DoubleType()),
        T.StructField("TH", T.DoubleType()),
        T.StructField("Destination", T.StringType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Callsign", T.StringType()),
        T.StructField("AisSourcen", T.StringType()),
    ]
)

# Columns dropped when raw reports are merged.
UNUSED_COLUMNS = ("ID", "Name", "Callsign", "MMSI", "AisSourcen")
TIME_COLUMNS = ("StartTime", "EndTime", "time")
CATEGORY_COLUMNS = ("StartPort", "EndPort", "Destination")

# Missing-value texts of the raw files.
NA_TEXTS = (
    "", "?", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Model features.
POINT_FEATURES = (
    "speed_over_ground", "dv", "dcourse", "ddraft", "zone", "x_km", "y_km", "dist_to_ref", "route_dummy",
)
SEQUENCE_FEATURES = {
    "KIEL": ("speed_over_ground", "course_over_ground", "x_km", "y_km", "draught", "dv"),
    "BREMERHAVEN": ("speed_over_ground", "course_over_ground", "x_km", "y_km", "dist_to_ref", "draught", "dv"),
}
# Metrics shown with a scored point.
POINT_METRICS = (
    "ship_type", "length", "breadth", "draught", "speed_over_ground", "course_over_ground", "true_heading",
    "dv", "dcourse", "ddraft", "zone", "x_km", "y_km", "dist_to_ref",
)
SPLIT_PORTS = ("KIEL", "BREMERHAVEN")

TRIP, TIME, POINT, ROUTE = "trip_id", "time_stamp", "point_id", "start_port"
