"""Rides to training panel, feature artifacts and feature rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.functions import keys as K
from demandgrid.functions.features import with_rush_features, with_weather_features
from demandgrid.operators import demand as D
from demandgrid.operators import grid as G
from demandgrid.operators import history as H
from demandgrid.operators import stats as ST
from demandgrid.operators.cities import (
    UNKNOWN_SCOPE,
    CityScope,
    city_encoding,
    city_scope,
    encode_city,
    keep_major_cities,
)
from demandgrid.operators.dims import attributed_cells, first_row_per_city_hour
from demandgrid.sources.staging import staged
from demandgrid.schema import (
    CELL_KEY,
    FEATURE_CELL,
    FEATURE_COLUMNS,
    FEATURE_STATION,
    MAJOR_CITY_MIN_RIDES,
    STATION_COLUMNS,
    STATION_KEY,
    WEATHER_COLUMNS,
    present,
)

_TO_FEATURE_KEY = dict(zip(CELL_KEY, FEATURE_CELL, strict=True))

STATION_HOUR_COLUMNS = [
    "station_hour_mean_demand",
    "station_hour_median_demand",
    "station_hour_max_demand",
    "station_hour_std_demand",
]


@dataclass(frozen=True)
class FeatureSpec:
    """How training features are derived.

    ``station_hour_key='hour_ts'`` keys the station-hour statistics by exact timestamp:
    a training row then sees its own label and a future row sees nothing. ``'hour'`` keys
    them by hour of day. ``stats_days_held_out`` keeps the last days of the period out of
    all statistics, so that a validation week cannot leak into them.
    """

    min_rides: int = MAJOR_CITY_MIN_RIDES
    station_hour_key: str = "hour_ts"
    stats_days_held_out: int = 0
    unseen_city: int = 0
    order_col: str | None = "event_id"

    def __post_init__(self) -> None:
        if self.station_hour_key not in ("hour_ts", "hour"):
            raise ValueError("station_hour_key must be 'hour_ts' or 'hour'")
        if self.stats_days_held_out < 0:
            raise ValueError("stats_days_held_out must be non-negative")


@dataclass(frozen=True)
class Artifacts:
    """Tables that turn targets into features."""

    station_stats: DataFrame
    city_hour_stats: DataFrame
    city_weekday_stats: DataFrame
    city_mean_stats: DataFrame
    demand_history: DataFrame
    city_encoding: DataFrame
    station_hour_stats: DataFrame | None = None
    scope: CityScope = field(default=UNKNOWN_SCOPE)

    TABLES = (
        "station_stats",
        "city_hour_stats",
        "city_weekday_stats",
        "city_mean_stats",
        "demand_history",
        "city_encoding",
        "station_hour_stats",
    )


@dataclass(frozen=True)
class TrainingRides:
    """The demand cells of the major cities, with the first value of every attribute."""

    attributed: DataFrame
    cities: DataFrame
    scope: CityScope

    @property
    def cells(self) -> DataFrame:
        return self.attributed.select(*CELL_KEY, "demand")


def feature_keys(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(_TO_FEATURE_KEY)


def training_rides(rides: DataFrame, spec: FeatureSpec) -> TrainingRides:
    """Key the rides, read them once, and write their cells.

    Statistics, history, grid, the attributes of stations and city-hours and the list of
    major cities are derived from the cells. A ride without a city belongs to no major city.
    """
    keyed = D.keyed_rides(rides.where(F.col("city").isNotNull()))
    columns = present([*STATION_COLUMNS, *WEATHER_COLUMNS, "holiday", "working_day"], keyed.columns)
    cells = staged(attributed_cells(keyed, columns, spec.order_col), "cells")
    cities = staged(ST.city_spans(feature_keys(cells.select(*CELL_KEY, "demand"))), "cities")
    scope = city_scope(cities, spec.min_rides)
    kept = [keep_major_cities(df, cities, scope, spec.min_rides) for df in (cells, cities)]
    return TrainingRides(*kept, scope)


def training_grid(tr: TrainingRides) -> DataFrame:
    """Zero-filled demand for every station and hour of its city's period."""
    bounds = tr.cities.select(
        F.col("city").alias("city_key"),
        F.col("lo").alias("city_min_hour"),
        F.col("hi").alias("city_max_hour"),
    )
    return feature_keys(G.zero_filled(tr.cells, G.full_windows(tr.cells, bounds)))


def station_attributes(tr: TrainingRides, columns: list[str]) -> DataFrame:
    """First non-null value per station, by hour and then by row order."""
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("target_hour_start"))).alias(c) for c in columns]
    return feature_keys(tr.attributed.groupBy(*STATION_KEY).agg(*firsts))


def city_hour_attributes(tr: TrainingRides, columns: list[str]) -> DataFrame:
    """Values of one cell per city and hour, that of the smallest station id; within the
    cell the first non-null value in row order."""
    return first_row_per_city_hour(feature_keys(tr.attributed), columns)


def training_panel(tr: TrainingRides, spec: FeatureSpec) -> DataFrame:
    """Every station and hour of each major city's period: demand, calendar, attributes."""
    return with_panel_attributes(training_grid(tr), tr)


def with_panel_attributes(panel: DataFrame, tr: TrainingRides) -> DataFrame:
    have = tr.attributed.columns
    meta_columns = present(STATION_COLUMNS, have)
    hour_columns = [*present(WEATHER_COLUMNS, have), *present(["holiday", "working_day"], have)]
    ts = F.col("hour_ts")
    out = panel.withColumns({"hour": F.hour(ts), "weekday": K.weekday(ts)})
    out = out.withColumn("weekend", K.is_weekend(F.col("weekday")))
    if meta_columns:
        meta = station_attributes(tr, meta_columns)
        out = out.join(meta, FEATURE_STATION, "left")
    if hour_columns:
        hours = city_hour_attributes(tr, hour_columns)
        out = out.join(tr.scope.small(hours), ["city", "hour_ts"], "left")
    defaults = {"holiday": 0, "working_day": 1}
    return out.withColumns(
        {
            c: F.coalesce(F.col(c) if c in hour_columns else F.lit(None), F.lit(v)).cast("int")
            for c, v in defaults.items()
        }
    )


def build_artifacts(tr: TrainingRides, spec: FeatureSpec) -> Artifacts:
    """Statistics, history and city encoding, all derived from the demand cells."""
    cells = feature_keys(tr.cells)
    seen, cities = cells, tr.cities
    if spec.stats_days_held_out:
        last = F.max("hi") - F.make_dt_interval(F.lit(spec.stats_days_held_out))
        cutoff = tr.cities.agg(last.alias("cutoff")).scalar()
        seen = cells.where(F.col("hour_ts") < cutoff)
        ends = tr.cities.select("city", F.least("hi", K.plus_hours(cutoff, -1)).alias("hi"))
        cities = ST.city_spans(seen).drop("hi").join(ends, "city")
    by_hour = None
    if spec.station_hour_key == "hour":
        by_hour = ST.station_hour_of_day_stats(seen, cities)
    return Artifacts(
        station_stats=ST.station_stats(seen, cities),
        city_hour_stats=ST.city_hour_stats(seen, cities),
        city_weekday_stats=ST.city_weekday_stats(seen, cities),
        city_mean_stats=ST.city_mean_stats(seen, cities),
        demand_history=H.demand_history(cells),
        city_encoding=city_encoding(tr.cities),
        station_hour_stats=by_hour,
        scope=tr.scope,
    )


def own_hour_stats(demand: Column) -> dict[str, Column]:
    """Station-hour statistics keyed by exact timestamp: a single value per key, so mean,
    median and maximum are that value and the deviation is zero."""
    value = F.coalesce(demand.cast("double"), F.lit(0.0))
    mean, median, largest, deviation = STATION_HOUR_COLUMNS
    return {mean: value, median: value, largest: value, deviation: F.lit(0.0)}


def with_stats(df: DataFrame, art: Artifacts) -> DataFrame:
    """Attach the statistic tables. City tables of proven size are broadcast; station
    tables share the partitioning of rows that are laid out by station."""
    small = art.scope.small
    out = df.join(art.station_stats, FEATURE_STATION, "left")
    out = out.join(small(art.city_hour_stats, 24), ["city", "hour"], "left")
    out = out.join(small(art.city_weekday_stats, 7), ["city", "weekday"], "left")
    out = out.join(small(art.city_mean_stats, 1), "city", "left")
    if art.station_hour_stats is not None:
        out = out.join(art.station_hour_stats, [*FEATURE_STATION, "hour"], "left")
    return out


def zero_fill_features(df: DataFrame) -> DataFrame:
    """Null features become zero, for the feature columns present so far."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    columns = [c for c in present(FEATURE_COLUMNS, df.columns) if c not in text]
    return df.na.fill(0, columns)


def _with_expressions(df: DataFrame) -> DataFrame:
    return with_rush_features(with_weather_features(df))


def create_features(targets: DataFrame, art: Artifacts) -> DataFrame:
    """Feature columns for target rows (city, start_station_id, hour_ts, attributes)."""
    ts = F.col("hour_ts")
    df = targets.withColumns(
        {
            "city": F.col("city").cast("string"),
            "start_station_id": K.station_key("start_station_id"),
            "hour_ts": K.as_ntz("hour_ts"),
        }
    )
    calendar = {"hour": F.hour(ts), "weekday": K.weekday(ts)}
    df = df.withColumns({k: v for k, v in calendar.items() if k not in targets.columns})
    offsets = {H.lag_name(d): d for d in H.LAG_DAYS}
    if art.station_hour_stats is None:
        offsets["_own"] = 0
    df = H.zero_filled_lags(H.demand_at_offsets(df, art.demand_history, offsets))
    if art.station_hour_stats is None:
        df = df.withColumns(own_hour_stats(F.col("_own"))).drop("_own")
    return _with_expressions(zero_fill_features(with_stats(df, art)))


def training_features(tr: TrainingRides, art: Artifacts, spec: FeatureSpec) -> DataFrame:
    """Training panel with all features.

    Lags and same-hour statistics come from the panel itself: it holds every hour of its
    own history, so neither needs a join.
    """
    panel = H.with_dense_lags(training_grid(tr))
    if spec.station_hour_key == "hour_ts":
        panel = panel.withColumns(own_hour_stats(F.col("demand")))
    df = with_stats(with_panel_attributes(panel, tr), art)
    return _with_expressions(zero_fill_features(df))


def make_features_from_rides(
    rides: DataFrame, spec: FeatureSpec | None = None
) -> tuple[DataFrame, Artifacts]:
    """Encoded training rows and the artifacts that build the same features for targets."""
    spec = spec or FeatureSpec()
    tr = training_rides(rides, spec)
    art = build_artifacts(tr, spec)
    features = training_features(tr, art, spec)
    return encode_city(features, art.city_encoding, spec.unseen_city, art.scope), art


def feature_matrix(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The fixed feature columns in order, as double; an absent column is zero."""
    have = set(df.columns)
    columns = [
        (F.col(c) if c in have else F.lit(0)).cast("double").alias(c) for c in FEATURE_COLUMNS
    ]
    return df.select(*(keep or []), *columns)
