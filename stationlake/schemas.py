"""Names, keys and types of the layers."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values -----------------------------------------------------------------------------
# Raw header of the measured columns -> short code used from the silver layer on.
MEASURES = {
    "PM<sub>10</sub> particulate matter (Hourly measured)": "PM10",
    "Nitric oxide": "NO",
    "Nitrogen dioxide": "NO2",
    "Nitrogen oxides as nitrogen dioxide": "NOx",
    "Ozone": "O3",
    "PM<sub>2.5</sub> particulate matter (Hourly measured)": "PM2.5",
    "Sulphur dioxide": "SO2",
}
MEASURE_UNIT = "ugm-3"
DATE_COLUMN = "Date"
TIME_COLUMN = "time"
WEATHER_ARRAYS = (
    "time",
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "pressure_msl",
    "wind_speed_10m",
)
VOLATILE_JSON_KEY = "generationtime_ms"
# Landing rules for the delivered CSV payloads.
CSV_FIRST_LINE = "Data supplied by UK-AIR"
CSV_PREAMBLE_LINES = 4
CSV_REQUIRED = ("Date", "time", "Nitrogen dioxide")
CSV_MAX_BYTES = 25 * 1024 * 1024
JSON_MAX_BYTES = 50 * 1024 * 1024
# -----------------------------------------------------------------------------------------------

WEATHER_MEASURES = WEATHER_ARRAYS[1:]

WEATHER_DOCUMENT = T.StructType(
    [
        T.StructField(
            "hourly",
            T.StructType(
                [T.StructField("time", T.ArrayType(T.StringType()))]
                + [T.StructField(m, T.ArrayType(T.DoubleType())) for m in WEATHER_MEASURES]
            ),
        )
    ]
)

DAILY_READINGS_KEY = ("reading_date", "site_name", "pollutant")
DAILY_WEATHER_KEY = ("reading_date", "city")
HOURLY_KEY = ("recorded_at", "site_name", "pollutant")
# Daily rows are few per month, so their tables are split by year; the hourly table by month.
DAILY_PARTITIONS = ("year",)
HOURLY_PARTITIONS = ("year", "month")

# Column -> Spark SQL type of the serving tables; staging casts to these.
DAILY_READINGS_COLUMNS = {
    "reading_date": "date",
    "site_name": "string",
    "pollutant": "string",
    "avg_value": "double",
    "min_value": "double",
    "max_value": "double",
    "valid_readings": "int",
    "expected_readings": "int",
    "missing_readings": "int",
    "completeness_pct": "double",
    "year": "int",
    "month": "int",
}
DAILY_WEATHER_COLUMNS = {
    "reading_date": "date",
    "city": "string",
    "avg_temperature_2m": "double",
    "min_temperature_2m": "double",
    "max_temperature_2m": "double",
    "avg_relative_humidity_2m": "double",
    "total_precipitation": "double",
    "avg_pressure_msl": "double",
    "avg_wind_speed_10m": "double",
    "expected_readings": "int",
    "valid_temperature_readings": "int",
    "missing_temperature_readings": "int",
    "temperature_completeness_pct": "double",
    "year": "int",
    "month": "int",
}
HOURLY_COLUMNS = {
    "recorded_at": "timestamp",
    "reading_date": "date",
    "site_name": "string",
    "city": "string",
    "pollutant": "string",
    "pollutant_value": "double",
    "pollutant_unit": "string",
    "temperature_2m": "double",
    "relative_humidity_2m": "double",
    "precipitation": "double",
    "pressure_msl": "double",
    "wind_speed_10m": "double",
    "year": "int",
    "month": "int",
}
