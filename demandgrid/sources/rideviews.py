"""Ride-shaped views over an event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_STATION = {
    "mod8": "user_id % 8",
    "user": "user_id",
    "user_week": "user_id * 10 + (day(ts) - 1) div 7",
    "busy": "CASE WHEN user_id % 3 = 0 THEN 1 ELSE 2 + user_id div 8 END",
}


def rides_from_events(events: DataFrame, station: str = "mod8") -> DataFrame:
    """Rides with mixed station spellings, weather, calendar and station attributes.

    Every attribute is integer arithmetic on the event, so another engine can rebuild it.
    """
    base = events.selectExpr(
        "event_id",
        "ts AS started_at",
        "event_type AS city",
        f"{_STATION[station]} AS s",
        "timestampdiff(HOUR, timestamp_ntz'1970-01-01 00:00:00', ts) AS eh",
        "ascii(event_type) AS a",
        "day(ts) AS dom",
        "weekday(ts) AS wd",
    )
    return base.selectExpr(
        "event_id",
        "started_at",
        "city",
        """CASE WHEN event_id % 97 = 0 THEN NULL
                WHEN s = 7 THEN 'station_7'
                WHEN event_id % 3 = 1 THEN concat(cast(s AS string), '.0')
                WHEN event_id % 3 = 2 THEN concat(' ', cast(s AS string), ' ')
                ELSE cast(s AS string) END AS start_station_id""",
        "cast(s * 250 AS double) AS bike_lane_length_500m",
        "cast(s * 1000 AS double) AS park_area_500m",
        "s % 3 AS university_count_1000m",
        "s % 5 AS office_poi_count_1000m",
        "s % 7 AS retail_poi_count_1000m",
        "s % 11 AS restaurant_cafe_count_500m",
        "s % 4 AS transit_stop_count_500m",
        "cast(s * 100 + 50 AS double) AS distance_to_nearest_rail_station",
        "cast(s * 200 + 50 AS double) AS distance_to_city_center",
        "cast((eh * 13 + a) % 101 AS double) AS relative_humidity_2m",
        """CASE WHEN event_id % 11 = 0 THEN NULL
                ELSE cast((eh * 7 + a) % 400 AS double) / cast(10 AS double) - cast(5 AS double)
           END AS apparent_temperature""",
        """CASE WHEN (eh + a) % 5 = 0
                THEN cast((eh * 17) % 30 AS double) / cast(10 AS double)
                ELSE cast(0 AS double) END AS rain""",
        """CASE WHEN (eh + a) % 23 = 0 THEN cast(0.3 AS double)
                ELSE cast(0 AS double) END AS snowfall""",
        "cast((eh * 11) % 101 AS double) AS cloud_cover",
        "cast((eh * 3 + a) % 40 AS double) AS wind_speed_10m",
        "cast(dom IN (1, 15) AS int) AS holiday",
        "CASE WHEN dom = 1 THEN 'first' WHEN dom = 15 THEN 'middle' END AS holiday_name",
        "CASE WHEN wd < 5 THEN 1 - cast(dom IN (1, 15) AS int) ELSE 0 END AS working_day",
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def dense_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few busy stations per city."""
    return rides_from_events(events(spark, sf_dir), "mod8")


def sparse_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user a new station each week: few rides each, many open for less than the
    minimum window. All events take part."""
    return rides_from_events(events(spark, sf_dir), "user_week")


def busy_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station of each city with a third of its rides, and one for every eight users:
    the panel grows with the users. All events take part, at their own hours."""
    return rides_from_events(events(spark, sf_dir), "busy")


def wide_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user a station."""
    return rides_from_events(events(spark, sf_dir), "user")
