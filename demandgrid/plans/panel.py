"""Rides to evaluation targets and labels."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandgrid.functions import keys as K
from demandgrid.operators import demand as D
from demandgrid.operators import grid as G
from demandgrid.operators import sampling as S
from demandgrid.operators.cities import CityScope, city_scope
from demandgrid.operators.contracts import assert_unique
from demandgrid.operators.dims import (
    cells_with_attributes,
    city_hour_dim_of_cells,
    first_non_null,
    station_dim_of_cells,
)
from demandgrid.operators.ordering import dense_ids
from demandgrid.sources.staging import staged
from demandgrid.schema import (
    ALL_CITIES,
    BUFFER_HOURS_AFTER,
    BUFFER_HOURS_BEFORE,
    CELL_KEY,
    EVAL_HOURS_SEED,
    HIDDEN_SAMPLE_ROWS,
    KEEP_HOURS,
    MIN_WINDOW_HOURS,
    STATION_COLUMNS,
    STATION_KEY,
    WEATHER_COLUMNS,
    present,
)

GRID_MODES = ("active_window", "full", "observed_only")


@dataclass(frozen=True)
class PanelSpec:
    """What the evaluation panel covers."""

    grid_mode: str = "active_window"
    buffer_before: int = BUFFER_HOURS_BEFORE
    buffer_after: int = BUFFER_HOURS_AFTER
    min_window_hours: int = MIN_WINDOW_HOURS
    keep_hours: tuple[int, ...] | None = KEEP_HOURS
    #: Hour caps by city, none by default; ``MAX_EVAL_HOURS_BY_CITY`` has the usual ones.
    caps: Mapping[str, int] | None = None
    seed: int = EVAL_HOURS_SEED
    start_time_col: str = "started_at"
    hour_col: str = "hour_ts"
    station_col: str = "start_station_id"
    city_col: str = "city"
    order_col: str | None = "event_id"
    on_bad: str = "raise"
    validate: bool = False

    @property
    def mode(self) -> str:
        mode = self.grid_mode.lower().strip()
        if mode not in GRID_MODES:
            raise ValueError(f"grid_mode must be one of {GRID_MODES}. Got: {self.grid_mode!r}")
        return mode

    def _keyed(self, rides: DataFrame, on_bad: str) -> DataFrame:
        return D.keyed_rides(
            rides,
            self.start_time_col,
            self.hour_col,
            self.station_col,
            self.city_col,
            on_bad,
        )

    def key(self, rides: DataFrame) -> DataFrame:
        """The rides of the panel. Those that are set aside are not among them."""
        return self._keyed(rides, "drop" if self.on_bad == "quarantine" else self.on_bad)

    def set_aside(self, rides: DataFrame) -> DataFrame:
        """The rides that ``quarantine`` keeps out of the panel, with all their columns."""
        kept = self._keyed(rides, "quarantine")
        return kept.where(F.col("target_hour_start").isNull())


def _windows(cells: DataFrame, spec: PanelSpec) -> DataFrame:
    if spec.mode == "full":
        return G.full_windows(cells)
    return G.active_windows(
        cells, spec.buffer_before, spec.buffer_after, spec.min_window_hours
    )


def _capped_counts(windows: DataFrame, picked: DataFrame, spec: PanelSpec) -> DataFrame:
    """Grid rows per station when the hours of some cities are capped.

    The picked hours of a city are counted up along its hours once; a window then has the
    count at its end less the count before its start, two lookups whatever the cap.
    """
    listed, others = _split(windows, spec.caps)
    hour = F.expr("INTERVAL 1 HOUR")
    period = listed.groupBy("city_key").agg(
        F.sequence(F.min("window_start"), F.max("window_end"), hour).alias("_hours")
    )
    along = W.partitionBy("city_key").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    hit = picked.select("city_key", F.col("target_hour_start").alias("_at"), F.lit(1).alias("_hit"))
    counted = (
        period.select("city_key", F.explode("_hours").alias("_at"))
        .join(hit, ["city_key", "_at"], "left")
        .withColumn("_hit", F.coalesce("_hit", F.lit(0)))
        .withColumn("_upto", F.sum("_hit").over(along))
    )
    starts = counted.select(
        "city_key", F.col("_at").alias("window_start"), (F.col("_upto") - F.col("_hit")).alias("_before")
    )
    ends = counted.select("city_key", F.col("_at").alias("window_end"), "_upto")
    capped = (
        listed.join(starts, ["city_key", "window_start"])
        .join(ends, ["city_key", "window_end"])
        .select(*STATION_KEY, (F.col("_upto") - F.col("_before")).cast("bigint").alias("n_rows"))
    )
    return capped.unionAll(G.window_counts(others, spec.keep_hours))


def _scope(cells: DataFrame) -> CityScope:
    """How many cities there are, and how many city-hours can exist at most."""
    bounds = D.city_bounds(cells).select(
        F.col("city_key").alias("city"),
        F.lit(1).alias("rides"),
        F.col("city_min_hour").alias("lo"),
        F.col("city_max_hour").alias("hi"),
    )
    return city_scope(bounds)


def _split(df: DataFrame, caps: Mapping[str, int]) -> tuple[DataFrame, DataFrame]:
    listed = F.col("city_key").isin(list(caps))
    return df.where(listed), df.where(~listed)


def panel_rows(cells: DataFrame, spec: PanelSpec) -> DataFrame:
    """The evaluated station-hours with demand and dense id, before attributes.

    The station windows and the picked hours are written once: rows, counts and ids start
    from these tables instead of repeating them.
    """
    hours = G.checked_hours(spec.keep_hours)
    caps = S.checked_caps(dict(spec.caps)) if spec.caps else None
    if spec.mode == "observed_only":
        rows = G.filter_target_hours(cells, hours)
        if caps:
            rows = S.cap_eval_hours_per_city(rows, caps, spec.seed)
        counts = rows.groupBy(*STATION_KEY).agg(F.count("*").alias("n_rows"))
    else:
        windows = staged(_windows(cells, spec), "windows")
        rows = G.zero_filled(cells, windows, hours)
        counts = G.window_counts(windows, hours)
        if caps:
            open_windows = windows.where(F.col("city_key").isin(list(caps)))
            picked = S.pick_hours(G.covered_hours(open_windows, hours), caps, spec.seed)
            picked = staged(picked, "picked-hours")
            rows = S.keep_picked_hours(rows, picked, caps)
            counts = _capped_counts(windows, picked, spec)
    return dense_ids(rows, counts, STATION_KEY, "target_hour_start")


def station_hour_panel(
    rides: DataFrame, spec: PanelSpec | None = None, counts: dict[str, int] | None = None
) -> DataFrame:
    """All columns of targets and labels, plus the internal keys.

    The rides are read once: their demand cells, with the first value of every attribute, are
    written, and the panel starts there. ``counts`` receives the rides read and those without
    a readable start time, counted in the same pass; with ``on_bad="raise"`` the error tells
    both numbers.
    """
    spec = spec or PanelSpec()
    if spec.on_bad not in ("raise", "drop", "quarantine"):
        raise ValueError(f"on_bad must be raise, drop or quarantine, got {spec.on_bad!r}")
    seen = Observation("rides")
    keyed = spec._keyed(rides, "quarantine")
    bad = F.col("target_hour_start").isNull()
    keyed = keyed.observe(seen, F.count("*").alias("rides"), F.count_if(bad).alias("bad"))
    attributed = cells_with_attributes(keyed.where(~bad), spec.order_col, spec.station_col, spec.city_col)
    attributed = staged(attributed, "cells")
    found = seen.get
    if counts is not None:
        counts.update(found)
    if spec.on_bad == "raise" and found["bad"]:
        raise ValueError(f"{found['bad']} of {found['rides']} rides have no readable start time")
    return panel_of_cells(attributed, spec)


def panel_of_cells(attributed: DataFrame, spec: PanelSpec) -> DataFrame:
    """The panel from attributed cells, which should be a written table.

    Grid, windows, ids, stations and city-hours start at the cells. Rows are numbered
    while they are still narrow. The station table has the partitioning of the rows, so
    attaching it moves only the table. The city-hour table is broadcast when the counted
    hours of all cities are few enough, and joined through a shuffle otherwise.
    """
    cells = attributed.select(*CELL_KEY, "demand")
    rows = panel_rows(cells, spec)
    stations = station_dim_of_cells(attributed, spec.station_col, spec.city_col)
    city_hours = city_hour_dim_of_cells(attributed)
    if spec.validate:
        assert_unique(stations, STATION_KEY, "station table")
        assert_unique(city_hours, ["city_key", "target_hour_start"], "city-hour table")
        assert_unique(rows, CELL_KEY, "panel")
    joined = rows.join(stations, STATION_KEY, "left").join(
        _scope(cells).small(city_hours), ["city_key", "target_hour_start"], "left"
    )
    return K.with_calendar(joined, "target_hour_start")


def targets_of(panel: DataFrame, spec: PanelSpec | None = None) -> DataFrame:
    """The public side: everything but the label and the internal keys."""
    spec = spec or PanelSpec()
    public = panel.drop("demand", "prediction", "predicted_demand", *STATION_KEY)
    first = present(
        ["id", "target_hour_start", spec.city_col, spec.station_col], public.columns
    )
    return public.select(*first, *[c for c in public.columns if c not in first])


def labels_of(panel: DataFrame, spec: PanelSpec | None = None) -> DataFrame:
    """The private side: id, place, hour and demand."""
    spec = spec or PanelSpec()
    columns = ["id", spec.city_col, spec.station_col, "target_hour_start", "demand"]
    return panel.select(*present(columns, panel.columns))


def station_hour_test_format(
    rides: DataFrame, spec: PanelSpec | None = None
) -> tuple[DataFrame, DataFrame]:
    """Targets without the label, and labels, sharing their ids."""
    panel = station_hour_panel(rides, spec)
    return targets_of(panel, spec), labels_of(panel, spec)


def hidden_test_sample(
    rides: DataFrame, max_rows: int = HIDDEN_SAMPLE_ROWS, order_col: str | None = "event_id"
) -> DataFrame:
    """The first station-hours in key order, shaped like hidden targets.

    Stations stay as spelled and null keys form groups of their own, sorted last. The few
    keys are found first, on three columns; attributes are then collected for those only.
    """
    if "start_station_id" not in rides.columns:
        raise ValueError("rides must contain start_station_id")
    df = rides
    if "city" not in df.columns:
        df = df.withColumn("city", F.lit(ALL_CITIES))
    df = df.withColumn("target_hour_start", K.hour_start(df)).where(
        F.col("target_hour_start").isNotNull()
    )
    keys = ["city", "start_station_id", "target_hour_start"]

    def in_order(*columns: str) -> list[Column]:
        return [F.col(c).asc_nulls_last() for c in columns]

    firsts = df.select(*keys).distinct().orderBy(*in_order(*keys)).limit(max_rows)
    picked = firsts.toDF(*[f"_{c}" for c in keys])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    hit = df.join(F.broadcast(picked), same[0] & same[1] & same[2], "left_semi")  # max_rows rows
    attributes = present(
        [*STATION_COLUMNS, *WEATHER_COLUMNS, "holiday", "holiday_name", "working_day"],
        df.columns,
    )
    rows = first_non_null(hit, keys, attributes, order_col)
    sample = _numbered(rows, in_order(*keys))
    return K.with_calendar(sample, "target_hour_start")


def _numbered(few: DataFrame, order: list[Column]) -> DataFrame:
    """0-based ids for a result that is already limited to a small number of rows."""
    return few.withColumn("id", (F.row_number().over(W.orderBy(*order)) - 1).cast("bigint"))
