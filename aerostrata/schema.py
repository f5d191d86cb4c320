"""Schemas, range rules and other fixed values shared by every operator."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class RangeRule(NamedTuple):
    """Inclusive bounds for one measure."""

    column: str
    low: float
    high: float


# Pollution index scale and concentration breakpoints per pollutant.
INDEX_BREAKS = [0, 50, 100, 200, 300, 500]
BREAKPOINTS = {
    "pm25": [0, 15.5, 55.4, 150.4, 250.4, 500],
    "pm10": [0, 50, 150, 350, 420, 500],
    "so2": [0, 52, 180, 400, 800, 1200],
    "co": [0, 4000, 8000, 15000, 30000, 45000],
    "o3": [0, 120, 235, 400, 800, 1000],
    "no2": [0, 80, 200, 1130, 2260, 3000],
}

# The ordered category labels, their upper bounds on the index,
# the mid-band value a label is plotted at, and its icon.
CATEGORIES = ["Baik", "Sedang", "Tidak Sehat", "Sangat Tidak Sehat", "Berbahaya"]
CATEGORY_UPPER = [50, 100, 200, 300]
LABEL_MIDPOINTS = {
    "Baik": 25,
    "Sedang": 75,
    "Tidak Sehat": 150,
    "Sangat Tidak Sehat": 250,
    "Berbahaya": 400,
}
CATEGORY_ICONS = {
    "Baik": "\U0001f7e2",
    "Sedang": "\U0001f7e1",
    "Tidak Sehat": "\U0001f7e0",
    "Sangat Tidak Sehat": "\U0001f534",
    "Berbahaya": "\U0001f7e3",
}

# Display thresholds (lower bound inclusive; None is the base step).
INDEX_STEPS = [(None, "green"), (50, "yellow"), (100, "orange"), (200, "red"), (300, "purple")]
WORST_STEPS = [(None, "green"), (50, "yellow"), (100, "orange"), (200, "red")]
COUNT_STEPS = [(None, "green"), (1, "orange"), (3, "red")]
COVERAGE_STEPS = [(None, "red"), (50, "orange"), (75, "yellow"), (90, "green")]

# Inclusive range rules.  Cleaning rejects nulls, payload checks let
# them pass, the table audit counts only non-null values.
CLEANING_RULES = [
    RangeRule("pm25", 0, 500),
    RangeRule("pm10", 0, 600),
    RangeRule("co", 0, 100000),
    RangeRule("no2", 0, 2000),
    RangeRule("so2", 0, 2000),
    RangeRule("o3", 0, 1000),
    RangeRule("temperature", -50, 60),
    RangeRule("humidity", 0, 100),
    RangeRule("wind_speed", 0, 200),
    RangeRule("cloud_cover", 0, 100),
]
PAYLOAD_RULES = [
    RangeRule("pm25", 0, 500),
    RangeRule("pm10", 0, 600),
    RangeRule("co", 0, 100000),
    RangeRule("no2", 0, 2000),
    RangeRule("so2", 0, 2000),
    RangeRule("o3", 0, 1000),
    RangeRule("temperature", -50, 60),
    RangeRule("humidity", 0, 100),
    RangeRule("uv_index", 0, 20),
    RangeRule("ispu", 0, 500),
    RangeRule("cloud_cover", 0, 100),
    RangeRule("precipitation_probability", 0, 100),
    RangeRule("precipitation", 0, 500),
    RangeRule("wind_speed", 0, 200),
]
AUDIT_RULES = [
    RangeRule("pm25", 0, 500),
    RangeRule("pm10", 0, 600),
    RangeRule("co", 0, 100000),
    RangeRule("no2", 0, 2000),
    RangeRule("so2", 0, 2000),
    RangeRule("o3", 0, 1000),
    RangeRule("ispu", 0, 500),
    RangeRule("temperature", -50, 60),
    RangeRule("humidity", 0, 100),
    RangeRule("wind_speed", 0, 200),
    RangeRule("precipitation", 0, 500),
    RangeRule("cloud_cover", 0, 100),
]

# Field names of the nested feeds and their canonical names.
AIR_FIELDS = {
    "pm2_5": "pm25",
    "pm10": "pm10",
    "carbon_monoxide": "co",
    "nitrogen_dioxide": "no2",
    "sulphur_dioxide": "so2",
    "ozone": "o3",
}
WEATHER_FIELDS = {
    "temperature_2m": "temperature",
    "relative_humidity_2m": "humidity",
    "wind_speed_10m": "wind_speed",
    "precipitation": "precipitation",
    "cloud_cover": "cloud_cover",
}
LIVE_WEATHER_FIELDS = {
    "temperature_2m": "temperature",
    "relative_humidity_2m": "humidity",
    "wind_speed_10m": "wind_speed",
    "precipitation": "precipitation",
    "precipitation_probability": "precipitation_probability",
    "weather_code": "weather_code",
    "cloud_cover": "cloud_cover",
    "uv_index": "uv_index",
}

# Feature recipe of the daily classifier.
LAGS = {
    "pm25_avg": [1, 3, 7],
    "pm10_avg": [1, 7],
    "co_avg": [1, 7],
    "temperature_avg": [1, 7],
    "humidity_avg": [1, 7],
}
ROLLINGS = [("pm25_avg", 3), ("pm10_avg", 3), ("ispu", 3), ("ispu", 7)]
IMPUTE_ROWS = 7
NON_FEATURES = {
    "station_id", "date", "aqi_category", "station_name", "region",
    "latitude", "longitude", "created_at", "window_start", "window_end",
}

POLLUTANTS = list(BREAKPOINTS)
AVERAGED = ["pm25", "pm10", "co", "no2", "so2", "o3", "ispu",
            "temperature", "humidity", "wind_speed", "cloud_cover"]
DAILY_MEASURES = ["pm25_avg", "pm10_avg", "co_avg", "no2_avg", "so2_avg", "o3_avg", "ispu",
                  "temperature_avg", "humidity_avg", "wind_speed_avg",
                  "precipitation_sum", "cloud_cover_avg"]
STREAM_MEASURES = ["ispu_avg" if c == "ispu" else c for c in DAILY_MEASURES]
CLUSTER_MEASURES = ["pm25_avg", "pm10_avg", "co_avg", "no2_avg", "so2_avg", "o3_avg",
                    "ispu", "temperature_avg", "humidity_avg"]


def _fields(names: str, dtype: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, dtype, True) for n in names.split()]


# Hourly history file, header row, local ISO minute string in `tanggal`.
READINGS_CSV = T.StructType(
    _fields("station_id station_name region", T.StringType())
    + _fields("latitude longitude", T.DoubleType())
    + _fields("tanggal", T.StringType())
    + _fields("pm25 pm10 co no2 so2 o3 ispu", T.DoubleType())
    + _fields("ispu_category", T.StringType())
    + _fields("temperature humidity wind_speed precipitation cloud_cover", T.DoubleType())
)

# Live payload, JSON object in the message value.
PAYLOAD = T.StructType(
    _fields("station_id station_name region", T.StringType())
    + _fields("latitude longitude", T.DoubleType())
    + _fields("timestamp", T.StringType())
    + _fields("pm25 pm10 co no2 so2 o3 uv_index ispu", T.DoubleType())
    + _fields("ispu_category", T.StringType())
    + _fields("temperature humidity wind_speed precipitation "
              "precipitation_probability weather_code cloud_cover", T.DoubleType())
)

STATIONS_JSON = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("stations", T.ArrayType(T.StructType(
        _fields("id name region", T.StringType())
        + _fields("latitude longitude", T.DoubleType())
    ))),
])


def hourly_response(fields: dict[str, str]) -> T.StructType:
    """Schema of one nested history response: a struct of parallel arrays."""
    arrays = [T.StructField("time", T.ArrayType(T.StringType()))]
    arrays += [T.StructField(f, T.ArrayType(T.DoubleType())) for f in fields]
    return T.StructType([T.StructField("hourly", T.StructType(arrays))])
