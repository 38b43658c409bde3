"""Explicit schemas of the message and table contracts."""

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, StringType, StructField,
                               StructType, VariantType)

_S, _D = StringType(), DoubleType()

# Flat reading (Bronze input): 20 fields, both timestamps ISO-8601 strings.
READING_FIELDS = [
    ("city", _S), ("country", _S), ("continent", _S), ("region", _S), ("state", _S),
    ("latitude", _D), ("longitude", _D), ("temperature_fahrenheit", _D), ("temperature_celsius", _D),
    ("humidity_percent", _D), ("pressure_hpa", _D), ("wind_speed_mph", _D), ("wind_direction_degrees", _D),
    ("weather_condition", _S), ("weather_description", _S), ("cloud_cover_percent", _D),
    ("visibility_miles", _D), ("precipitation_mm", _D), ("timestamp", _S), ("ingestion_timestamp", _S),
]
READING = StructType([StructField(n, t, True) for n, t in READING_FIELDS])

# Simple reading (JSON topic) plus the forecast extras.
SIMPLE_READING = StructType([
    StructField("timestamp", _S), StructField("location", _S), StructField("temperature", _D),
    StructField("humidity", _D), StructField("wind_speed", _D), StructField("pressure", _D),
    StructField("precipitation", _D), StructField("forecast_text", _S), StructField("is_daytime", BooleanType()),
])

# Provider payload: current conditions. Keys that may be missing but not null are variants, which tell the two apart.
CURRENT_WEATHER = StructType([
    StructField("main", StructType([StructField("temp", _D), StructField("humidity", _D),
                                    StructField("pressure", _D)])),
    StructField("wind", StructType([StructField("speed", _D), StructField("deg", VariantType())])),
    StructField("weather", ArrayType(StructType([StructField("main", _S), StructField("description", _S)]))),
    StructField("clouds", StructType([StructField("all", _D)])),
    StructField("visibility", VariantType()),
    StructField("rain", VariantType()),
])
