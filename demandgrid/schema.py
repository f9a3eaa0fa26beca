"""Column roles, sentinels, defaults and declared schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the benchmark's contract for results to match.
# ---------------------------------------------------------------------------
MISSING_STATION = "__missing_station__"
MISSING_CITY = "__missing_city__"
ALL_CITIES = "__all_cities__"
OVERALL = "OVERALL"

RIDE_ONLY_COLUMNS = [
    "started_at",
    "ended_at",
    "end_station_id",
    "usage_time_minutes",
    "distance_meters",
    "user_type",
]

WEATHER_COLUMNS = [
    "temperature_2m",
    "relative_humidity_2m",
    "apparent_temperature",
    "precipitation",
    "rain",
    "snowfall",
    "cloud_cover",
    "wind_speed_10m",
]

CALENDAR_COLUMNS = [
    "date",
    "weekday",
    "weekend",
    "holiday",
    "holiday_name",
    "working_day",
]

STATION_COLUMNS = [
    "start_lat",
    "start_lng",
    "bike_lane_length_500m",
    "park_area_500m",
    "university_count_1000m",
    "office_poi_count_1000m",
    "retail_poi_count_1000m",
    "restaurant_cafe_count_500m",
    "transit_stop_count_500m",
    "distance_to_nearest_rail_station",
    "distance_to_city_center",
]

FORBIDDEN_TARGET_COLUMNS = [
    "demand",
    "started_at",
    "ended_at",
    "end_station_id",
    "usage_time_minutes",
    "distance_meters",
    "user_type",
    "prediction",
    "predicted_demand",
]

FEATURE_COLUMNS = [
    "city",
    "hour",
    "weekday",
    "working_day",
    "comfort_score",
    "outdoor_pleasantness",
    "recreational_accessibility",
    "office_poi_count_1000m",
    "retail_poi_count_1000m",
    "restaurant_cafe_count_500m",
    "transit_stop_count_500m",
    "distance_to_nearest_rail_station",
    "distance_to_city_center",
    "station_mean_demand",
    "station_median_demand",
    "station_max_demand",
    "city_hour_mean_demand",
    "city_hour_median_demand",
    "city_hour_max_demand",
    "city_weekday_mean_demand",
    "city_mean_demand",
    "station_hour_mean_demand",
    "station_hour_median_demand",
    "station_hour_max_demand",
    "station_hour_std_demand",
    "is_morning_rush",
    "is_evening_rush",
    "rush_x_station_hour_mean",
    "lag_1d_demand",
    "lag_7d_demand",
    "lag_14d_demand",
    "lag_21d_demand",
    "lag_rolling_mean",
]

KEEP_HOURS = tuple(range(6, 23))
BUFFER_HOURS_BEFORE = 0
BUFFER_HOURS_AFTER = 0
MIN_WINDOW_HOURS = 72
MAX_EVAL_HOURS_BY_CITY = {"city 1": 300, "city 2": 300, "city 3": 200}
EVAL_HOURS_SEED = 42
MAJOR_CITY_MIN_RIDES = 10_000
LAG_DAYS = (1, 7, 14, 21)
WEEKLY_LAG_DAYS = (7, 14, 21)
VALIDATION_DAYS = 7
ZERO_THRESHOLD = 0.6
HIDDEN_SAMPLE_ROWS = 128
SCATTER_SAMPLE_ROWS = 10_000
# ---------------------------------------------------------------------------

# Keys used inside the panel operators.
STATION_KEY = ["city_key", "station_key"]
CELL_KEY = ["city_key", "station_key", "target_hour_start"]

# Keys used by the feature and model operators.
FEATURE_STATION = ["city", "start_station_id"]
FEATURE_CELL = ["city", "start_station_id", "hour_ts"]

_LONG_STATION_COLUMNS = {
    "university_count_1000m",
    "office_poi_count_1000m",
    "retail_poi_count_1000m",
    "restaurant_cafe_count_500m",
    "transit_stop_count_500m",
}

RIDES_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("ended_at", T.TimestampNTZType()),
        T.StructField("hour_ts", T.TimestampNTZType()),
        T.StructField("date", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("start_station_id", T.StringType()),
        T.StructField("end_station_id", T.StringType()),
        T.StructField("usage_time_minutes", T.DoubleType()),
        T.StructField("distance_meters", T.DoubleType()),
        T.StructField("user_type", T.StringType()),
        *(
            T.StructField(c, T.LongType() if c in _LONG_STATION_COLUMNS else T.DoubleType())
            for c in STATION_COLUMNS
        ),
        *(T.StructField(c, T.DoubleType()) for c in WEATHER_COLUMNS),
        T.StructField("weekday", T.IntegerType()),
        T.StructField("weekend", T.IntegerType()),
        T.StructField("holiday", T.IntegerType()),
        T.StructField("holiday_name", T.StringType()),
        T.StructField("working_day", T.IntegerType()),
    ]
)

LABELS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("city", T.StringType()),
        T.StructField("start_station_id", T.StringType()),
        T.StructField("target_hour_start", T.TimestampNTZType()),
        T.StructField("demand", T.LongType()),
    ]
)

PREDICTIONS_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("prediction", T.DoubleType()),
    ]
)


def present(columns: list[str], available: list[str]) -> list[str]:
    """The role columns a table actually has, in role order (schema only, no job)."""
    have = set(available)
    return [c for c in columns if c in have]
