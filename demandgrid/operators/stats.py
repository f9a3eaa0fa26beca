"""Demand statistics over a zero-filled panel, computed without building the panel.

Every station-hour without a ride has demand zero, so a group is described by the counts
of its observed demand values and by the number of hours it spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.operators.grid import kept_hours
from demandgrid.schema import FEATURE_STATION
from demandgrid.session import shuffle_partitions


def demand_histogram(cells: DataFrame, group: list[str]) -> DataFrame:
    """Sums and the sorted (demand, count) pairs of the observed cells of each group.

    Cells are counted per value before they meet, so a group arrives as its distinct
    demand values, of which there are at most as many as the largest demand.
    """
    return (
        cells.groupBy(*group, "demand")
        .agg(F.count("*").alias("n"))
        .groupBy(*group)
        .agg(
            F.sum("n").alias("_observed"),
            F.sum(F.col("demand") * F.col("n")).alias("_sum"),
            F.sum(F.col("demand") * F.col("demand") * F.col("n")).alias("_squares"),
            F.max("demand").alias("_max"),
            F.sort_array(F.collect_list(F.struct("demand", "n"))).alias("_values"),
        )
    )


def _value_at(place: Column) -> Column:
    """Demand at a 0-based place of the sorted panel values: zeros first, then the pairs."""
    start = F.struct(
        (F.col("_hours") - F.col("_observed")).alias("seen"),
        F.lit(None).cast("bigint").alias("value"),
    )

    def step(state: Column, pair: Column) -> Column:
        seen = state["seen"] + pair["n"]
        value = F.coalesce(state["value"], F.when(seen > place, pair["demand"]))
        return F.struct(seen.alias("seen"), value.alias("value"))

    found = F.aggregate("_values", start, step)["value"]
    return F.when(place < F.col("_hours") - F.col("_observed"), F.lit(0)).otherwise(found)


def _mean() -> Column:
    return F.col("_sum") / F.col("_hours")


def _median() -> Column:
    last = F.col("_hours") - 1
    low, high = F.floor(last / 2).cast("bigint"), F.ceil(last / 2).cast("bigint")
    return (_value_at(low) + _value_at(high)) / F.lit(2.0)


def _std() -> Column:
    """Sample deviation; zero for a single hour."""
    n = F.col("_hours")
    spread = F.col("_squares") - F.col("_sum") * (F.col("_sum") / n)
    return F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1))).otherwise(F.lit(0.0))


def _summary(spans: DataFrame, cells: DataFrame, group: list[str], prefix: str) -> DataFrame:
    """Groups of ``spans`` (with ``_hours``) and their statistics; all-zero groups stay."""
    filled = (
        spans.join(demand_histogram(cells, group), group, "left")
        .na.fill(0, ["_observed", "_sum", "_squares", "_max"])
        .withColumn("_values", F.coalesce("_values", F.array().cast("array<struct<demand:bigint,n:bigint>>")))
    )
    return filled.select(
        *group,
        _mean().alias(f"{prefix}_mean_demand"),
        _median().alias(f"{prefix}_median_demand"),
        F.col("_max").alias(f"{prefix}_max_demand"),
        _std().alias(f"{prefix}_std_demand"),
    )


def stations_of(cells: DataFrame) -> DataFrame:
    return cells.select(*FEATURE_STATION).distinct()


def city_spans(cells: DataFrame) -> DataFrame:
    """Per city its rides, stations and first and last hour: all that the number of
    station-hours of any group depends on. A job writes this small table once."""
    stations = cells.groupBy(*FEATURE_STATION).agg(
        F.sum("demand").alias("rides"), F.min("hour_ts").alias("lo"), F.max("hour_ts").alias("hi")
    )
    return stations.groupBy("city").agg(
        F.sum("rides").alias("rides"),
        F.count("*").alias("stations"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )


def city_hours(cities: DataFrame) -> DataFrame:
    """Every hour of each city's period with its hour of day and weekday."""
    hours = kept_hours(F.col("lo"), F.col("hi"), None)
    spread = cities.repartition(shuffle_partitions(cities.sparkSession), "city")
    return spread.select("city", "stations", F.explode(hours).alias("hour_ts")).withColumns(
        {"hour": F.hour("hour_ts"), "weekday": F.weekday("hour_ts")}
    )


def _spans(cities: DataFrame, by: list[str]) -> DataFrame:
    """Station-hours per city and calendar value: stations times matching hours."""
    return city_hours(cities).groupBy("city", *by).agg(F.sum("stations").alias("_hours"))


def _calendar(cells: DataFrame) -> DataFrame:
    return cells.withColumns({"hour": F.hour("hour_ts"), "weekday": F.weekday("hour_ts")})


def _length() -> Column:
    return F.timestamp_diff("HOUR", F.col("lo"), F.col("hi")) + 1


def station_stats(cells: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    cities = city_spans(cells) if cities is None else cities
    spans = stations_of(cells).join(cities.select("city", _length().alias("_hours")), "city")
    return _summary(spans, cells, FEATURE_STATION, "station").drop("station_std_demand")


def city_hour_stats(cells: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    cities = city_spans(cells) if cities is None else cities
    spans = _spans(cities, ["hour"])
    out = _summary(spans, _calendar(cells), ["city", "hour"], "city_hour")
    return out.drop("city_hour_std_demand")


def city_weekday_stats(cells: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    cities = city_spans(cells) if cities is None else cities
    sums = _calendar(cells).groupBy("city", "weekday").agg(F.sum("demand").alias("_sum"))
    mean = F.coalesce(F.col("_sum"), F.lit(0)) / F.col("_hours")
    joined = _spans(cities, ["weekday"]).join(sums, ["city", "weekday"], "left")
    return joined.select("city", "weekday", mean.alias("city_weekday_mean_demand"))


def city_mean_stats(cells: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    """Every ride is in a cell, so the city's total is its ride count."""
    cities = city_spans(cells) if cities is None else cities
    mean = F.col("rides") / (F.col("stations") * _length())
    return cities.select("city", mean.alias("city_mean_demand"))


def station_hour_of_day_stats(cells: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    """Statistics per station and hour of day: the key that carries over to new dates."""
    cities = city_spans(cells) if cities is None else cities
    hours = city_hours(cities).groupBy("city", "hour").agg(F.count("*").alias("_hours"))
    spans = stations_of(cells).join(hours, "city")
    group = [*FEATURE_STATION, "hour"]
    return _summary(spans, _calendar(cells), group, "station_hour")


def station_timestamp_stats(panel: DataFrame) -> DataFrame:
    """Statistics per station and exact hour. The panel holds one row for each, so its
    mean, median and maximum are the demand itself and its deviation is zero."""
    demand = F.col("demand")
    return panel.select(
        *FEATURE_STATION,
        "hour_ts",
        demand.cast("double").alias("station_hour_mean_demand"),
        demand.cast("double").alias("station_hour_median_demand"),
        demand.alias("station_hour_max_demand"),
        F.lit(0.0).alias("station_hour_std_demand"),
    )
