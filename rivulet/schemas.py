"""Record types, wire keys and default values shared by all transforms."""

from pyspark.sql import types as T

# Defaults of a reading whose attributes are not known.
UNKNOWN = "UNKNOWN"
NOPARAM = "NOPARAM"
UNCONVERTED = -99.0
UNKNOWN_CELL = 999

# Attributes that the pass-through job gives every reading.
FAKE_LOCATION = "HERE"
FAKE_TYPE = "WGS_DEV"

# The attribute names that enrichment understands.
GEOLOCATION = "geolocation"
CELL = "cell"
TYPE = "type"
UNIT = "unit"
CONVERSION = "conversion"
PARAMETERS = (GEOLOCATION, CELL, TYPE, UNIT, CONVERSION)

READING = T.StructType(
    [
        T.StructField("sensorid", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("rawValue", T.DoubleType()),
        T.StructField("location", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("conValue", T.DoubleType()),
        T.StructField("gridCell", T.LongType()),
    ]
)

UPDATE = T.StructType(
    [
        T.StructField("sensorid", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

ALERT = T.StructType(
    [
        T.StructField("sensorid", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("lower", T.DoubleType()),
        T.StructField("upper", T.DoubleType()),
    ]
)
