"""Column names, types and category limits of the hourly tables."""

from __future__ import annotations

from pyspark.sql import types as T

TIME = "OBSERVATION_TIME"

# Payload field -> column, in table order.
WEATHER_FIELDS = {
    "time": "OBSERVATION_TIME",
    "temperature_2m": "TEMPERATURE",
    "relative_humidity_2m": "HUMIDITY",
    "dew_point_2m": "DEW_POINT",
    "apparent_temperature": "FEELS_LIKE_TEMP",
    "precipitation": "PRECIPITATION_TOTAL",
    "rain": "RAIN",
    "cloud_cover": "CLOUD_COVER",
    "wind_speed_10m": "WIND_SPEED",
    "wind_gusts_10m": "WIND_GUSTS",
    "wind_direction_10m": "WIND_DIRECTION",
    "pressure_msl": "PRESSURE",
    "is_day": "IS_DAY_FLAG",
    "shortwave_radiation": "SOLAR_RADIATION",
}
AIR_FIELDS = {
    "time": "OBSERVATION_TIME",
    "pm10": "PM10",
    "pm2_5": "PM2_5",
    "carbon_monoxide": "CARBON_MONOXIDE",
    "nitrogen_dioxide": "NITROGEN_DIOXIDE",
    "ozone": "OZONE",
    "sulphur_dioxide": "SULPHUR_DIOXIDE",
    "us_aqi": "US_AQI",
    "uv_index": "UV_INDEX",
    "dust": "DUST",
}
FIELDS = {"weather": WEATHER_FIELDS, "airquality": AIR_FIELDS}
INTEGER_COLUMNS = frozenset({"IS_DAY_FLAG"})

WEATHER_COLUMNS = list(WEATHER_FIELDS.values())
AIR_COLUMNS = list(AIR_FIELDS.values())
WEATHER_MEASURES = WEATHER_COLUMNS[1:]
AIR_MEASURES = AIR_COLUMNS[1:]

# First day of the history loads.
HISTORY_START = "2022-09-01"

# Column order of the measures in the fact table.
FACT_WEATHER = [
    "TEMPERATURE", "HUMIDITY", "DEW_POINT", "FEELS_LIKE_TEMP", "WIND_SPEED", "WIND_GUSTS",
    "WIND_DIRECTION", "PRESSURE", "PRECIPITATION_TOTAL", "RAIN", "CLOUD_COVER",
    "SOLAR_RADIATION", "IS_DAY_FLAG",
]
FACT_AIR = AIR_MEASURES

# Columns of the model tables.
CLASSIFIER_WEATHER = ["TEMPERATURE", "HUMIDITY", "WIND_SPEED", "PRESSURE"]
CLASSIFIER_AIR = ["PM2_5", "US_AQI"]
ANOMALY_AIR = ["PM2_5", "PM10", "US_AQI"]

# Inclusive upper limits and labels of the category bands.
AQI_BANDS = [
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
]
AQI_BAND_ABOVE = "Hazardous"
NEXT_CLASS_BANDS = [(50, "Good"), (100, "Moderate")]
NEXT_CLASS_ABOVE = "Poor"
CLASS_NAMES = ["Good", "Moderate", "Poor"]
HEAT_FROM, HEAT_LABEL = 35, "Extreme Heat"
FROST_UPTO, FROST_LABEL = 5, "Freezing"
NORMAL_LABEL = "Normal"


def column_type(name: str) -> T.DataType:
    if name == TIME:
        return T.TimestampNTZType()
    return T.IntegerType() if name in INTEGER_COLUMNS else T.DoubleType()


def table_schema(kind: str, series: tuple[str, ...] = ()) -> T.StructType:
    """Schema of a raw table of ``kind`` (``weather`` or ``airquality``)."""
    fields = [T.StructField(s, T.StringType()) for s in series]
    fields += [T.StructField(c, column_type(c)) for c in FIELDS[kind].values()]
    return T.StructType(fields)


def payload_schema(kind: str, series: tuple[str, ...] = ()) -> T.StructType:
    """Wire schema: one object holding parallel arrays, time as ISO text."""
    arrays = [T.StructField("time", T.ArrayType(T.StringType()))]
    arrays += [T.StructField(f, T.ArrayType(T.DoubleType())) for f in FIELDS[kind] if f != "time"]
    fields = [T.StructField(s, T.StringType()) for s in series]
    return T.StructType([*fields, T.StructField("hourly", T.StructType(arrays))])
