"""Keyed rides, demand cells, and the bounds and activity derived from the cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.functions import keys as K
from demandgrid.schema import CELL_KEY, STATION_KEY


def keyed_rides(
    rides: DataFrame,
    start_time_col: str = "started_at",
    hour_col: str = "hour_ts",
    station_col: str = "start_station_id",
    city_col: str = "city",
    on_bad: str = "raise",
) -> DataFrame:
    """Add city_key, station_key and target_hour_start.

    ``on_bad`` says what happens to rides whose timestamp is missing or does not parse:
    ``raise`` fails the job when it meets one, ``drop`` removes them, ``quarantine``
    keeps them with a null target_hour_start for the caller to split off.
    """
    if station_col not in rides.columns:
        raise ValueError(f"rides have no station column {station_col!r}")
    if on_bad not in ("raise", "drop", "quarantine"):
        raise ValueError(f"on_bad must be raise, drop or quarantine, got {on_bad!r}")
    hour = K.hour_start(rides, start_time_col, hour_col)
    if on_bad == "raise":
        # Checked inside the scan that needs the value, so it costs no extra pass.
        failed = F.raise_error(F.lit("a ride has no readable start time"))
        hour = F.coalesce(hour, failed.cast("timestamp_ntz"))
    keyed = rides.withColumns(
        {
            "city_key": K.city_key(rides, city_col),
            "station_key": K.station_key(station_col),
            "target_hour_start": hour,
        }
    )
    return keyed.where(F.col("target_hour_start").isNotNull()) if on_bad == "drop" else keyed


def count_bad_timestamps(
    rides: DataFrame, start_time_col: str = "started_at", hour_col: str = "hour_ts"
) -> DataFrame:
    """One row: rides read and rides whose hour cannot be determined."""
    hour = K.hour_start(rides, start_time_col, hour_col)
    return rides.agg(F.count("*").alias("n_rows"), F.count_if(hour.isNull()).alias("bad_rows"))


def assert_timestamps(
    rides: DataFrame, start_time_col: str = "started_at", hour_col: str = "hour_ts"
) -> None:
    """Eager form of the timestamp rule; names how many rides break it."""
    row = count_bad_timestamps(rides, start_time_col, hour_col).first()
    if row.bad_rows:
        raise ValueError(f"{row.bad_rows} rides have no readable start time")


def demand_cells(keyed: DataFrame) -> DataFrame:
    """Rides per city, station and hour. Partial counts run before the shuffle, so a
    station that holds a third of the rides still sends one row per task and hour."""
    return keyed.groupBy(*CELL_KEY).agg(F.count("*").alias("demand"))


def city_bounds(keyed_or_cells: DataFrame) -> DataFrame:
    """First and last observed hour per city."""
    return keyed_or_cells.groupBy("city_key").agg(
        F.min("target_hour_start").alias("city_min_hour"),
        F.max("target_hour_start").alias("city_max_hour"),
    )


def station_activity(cells: DataFrame) -> DataFrame:
    """First and last active hour, rides and distinct active hours per station.

    Cells are unique per hour, so counting them replaces a distinct count over rides.
    """
    return cells.groupBy(*STATION_KEY).agg(
        F.min("target_hour_start").alias("first_active_hour"),
        F.max("target_hour_start").alias("last_active_hour"),
        F.sum("demand").alias("observed_ride_rows"),
        F.count("*").alias("observed_active_hours"),
    )
