"""Regular station-hour grids and their zero-filled demand."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandgrid.functions.keys import hours_between, plus_hours
from demandgrid.operators.demand import city_bounds, station_activity
from demandgrid.schema import (
    BUFFER_HOURS_AFTER,
    BUFFER_HOURS_BEFORE,
    CELL_KEY,
    KEEP_HOURS,
    MIN_WINDOW_HOURS,
    STATION_KEY,
)
from demandgrid.session import shuffle_partitions



def checked_hours(keep_hours: Iterable[int] | None) -> list[int] | None:
    if keep_hours is None:
        return None
    hours = sorted({int(h) for h in keep_hours})
    invalid = [h for h in hours if not 0 <= h <= 23]
    if invalid:
        raise ValueError(f"not an hour of the day: {invalid}")
    return hours


def filter_target_hours(
    targets: DataFrame, keep_hours: Iterable[int] | None = KEEP_HOURS
) -> DataFrame:
    """Keep the given hours of day; None keeps all, an empty set drops all."""
    hours = checked_hours(keep_hours)
    if hours is None:
        return targets
    return targets.where(F.hour("target_hour_start").isin(hours))


def kept_hours(start: Column, end: Column, keep_hours: list[int] | None) -> Column:
    """Array of the hours from start to end, already reduced to the kept hours of day.

    Filtering the array spares the rows that a filter after the explode would drop.
    """
    hours = F.sequence(start, end, F.expr("INTERVAL 1 HOUR"))
    if keep_hours is None or len(keep_hours) == 24:
        return hours
    return F.filter(hours, lambda h: F.hour(h).isin(keep_hours))


def full_windows(cells: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Every station is open from the first to the last observed hour of its city."""
    bounds = city_bounds(cells) if bounds is None else bounds
    return (
        cells.select(*STATION_KEY)
        .distinct()
        .join(bounds, "city_key")
        .select(
            *STATION_KEY,
            F.col("city_min_hour").alias("window_start"),
            F.col("city_max_hour").alias("window_end"),
        )
    )


def active_windows(
    cells: DataFrame,
    buffer_before: int = BUFFER_HOURS_BEFORE,
    buffer_after: int = BUFFER_HOURS_AFTER,
    min_window_hours: int = MIN_WINDOW_HOURS,
) -> DataFrame:
    """Each station is open from its first to its last ride plus buffers.

    Windows below the minimum are padded, half before and the rest after, and only then
    clipped to the city's period, so a station near the edge may stay below the minimum.
    """
    if buffer_before < 0:
        raise ValueError("buffer_before is below zero")
    if buffer_after < 0:
        raise ValueError("buffer_after is below zero")
    if min_window_hours < 1:
        raise ValueError("min_window_hours is below one")
    start = plus_hours(F.col("first_active_hour"), -buffer_before)
    end = plus_hours(F.col("last_active_hour"), buffer_after)
    missing = F.greatest(F.lit(min_window_hours) - hours_between(start, end) - 1, F.lit(0))
    pad_before = F.floor(missing / 2)
    return (
        station_activity(cells)
        .join(city_bounds(cells), "city_key")
        .select(
            *STATION_KEY,
            F.greatest(plus_hours(start, -pad_before), F.col("city_min_hour")).alias(
                "window_start"
            ),
            F.least(plus_hours(end, missing - pad_before), F.col("city_max_hour")).alias(
                "window_end"
            ),
        )
        .where(F.col("window_start") <= F.col("window_end"))
    )


def grid_rows(windows: DataFrame, keep_hours: Iterable[int] | None = None) -> DataFrame:
    """One row per station and hour of its window.

    The small window table is spread over a named number of tasks first, because each of
    its rows grows by the length of the window.
    """
    hours = kept_hours(F.col("window_start"), F.col("window_end"), checked_hours(keep_hours))
    return windows.repartition(shuffle_partitions(windows.sparkSession), *STATION_KEY).select(
        *STATION_KEY, F.explode(hours).alias("target_hour_start")
    )


def observed_grid(cells: DataFrame) -> DataFrame:
    return cells.select(*CELL_KEY)


def zero_filled(
    cells: DataFrame,
    windows: DataFrame,
    keep_hours: Iterable[int] | None = None,
) -> DataFrame:
    """Grid rows with their demand, zero where no ride started.

    Instead of building the grid and joining the demand to it, every observed cell emits
    itself and the empty hours up to the next one; the first also emits the hours back to
    the start of the window. Only the observed cells are shuffled, never the grid, and the
    result is partitioned by station. Windows must contain all cells of their station.

    The join is a left join so that only the windows can become its broadcast side: the
    cells must keep their partitioning, which is what spreads the growing rows.
    """
    hours = checked_hours(keep_hours)
    n = shuffle_partitions(cells.sparkSession)
    station = W.partitionBy(*STATION_KEY).orderBy("target_hour_start")
    here = F.col("target_hour_start")
    spans = (
        cells.repartition(n, *STATION_KEY)
        .join(windows, STATION_KEY, "left")
        .withColumns({"_prev": F.lag(here).over(station), "_next": F.lead(here).over(station)})
        .withColumns(
            {
                "_from": F.when(F.col("_prev").isNull(), F.col("window_start")).otherwise(here),
                "_to": F.when(F.col("_next").isNull(), F.col("window_end")).otherwise(
                    plus_hours(F.col("_next"), -1)
                ),
            }
        )
    )
    grown = kept_hours(F.col("_from"), F.col("_to"), hours)
    return spans.select(
        *STATION_KEY,
        here.alias("_cell_hour"),
        "demand",
        F.explode(grown).alias("target_hour_start"),
    ).select(
        *CELL_KEY,
        F.when(F.col("target_hour_start") == F.col("_cell_hour"), F.col("demand"))
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias("demand"),
    )


def window_counts(windows: DataFrame, keep_hours: Iterable[int] | None = None) -> DataFrame:
    """Grid rows per station, from the ends of its window: whole days hold every kept hour
    once, the rest of a day those that follow its first hour closely enough."""
    hours = checked_hours(keep_hours)
    length = hours_between(F.col("window_start"), F.col("window_end")) + 1
    if hours is None:
        count = length
    else:
        kept = F.array(*[F.lit(h) for h in hours]).cast("array<int>")
        rest = length % 24
        partial = F.filter(kept, lambda h: F.pmod(h - F.hour("window_start"), F.lit(24)) < rest)
        count = F.floor(length / 24) * len(hours) + F.size(partial)
    return windows.select(*STATION_KEY, count.cast("bigint").alias("n_rows"))


def covered_hours(windows: DataFrame, keep_hours: Iterable[int] | None = None) -> DataFrame:
    """Distinct city-hours that at least one window covers.

    Counts how many windows open and close per city and hour; an hour is covered while
    more have opened than closed. No station-hour row is built, and a city has at most
    one row per hour of its period in the running sum.
    """
    opened = windows.select("city_key", F.col("window_start").alias("at"), F.lit(1).alias("step"))
    closed = windows.select(
        "city_key", plus_hours(F.col("window_end"), 1).alias("at"), F.lit(-1).alias("step")
    )
    city = W.partitionBy("city_key").orderBy("at")
    spans = (
        opened.unionAll(closed)
        .groupBy("city_key", "at")
        .agg(F.sum("step").alias("step"))
        .withColumns(
            {
                "open": F.sum("step").over(city.rowsBetween(W.unboundedPreceding, 0)),
                "until": F.lead("at").over(city),
            }
        )
        .where(F.col("open") > 0)
    )
    hours = kept_hours(
        F.col("at"), plus_hours(F.col("until"), -1), checked_hours(keep_hours)
    )
    return spans.select("city_key", F.explode(hours).alias("target_hour_start"))
