import dataclasses
import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandgrid.operators import demand as D
from demandgrid.operators import dims
from demandgrid.operators import grid as G
from demandgrid.operators import sampling as S
from demandgrid.operators.ordering import dense_ids, running_total
from demandgrid.plans import panel as PN
from demandgrid.schema import CELL_KEY, KEEP_HOURS, STATION_KEY

H = dt.datetime


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def cells_of(spark, hours):
    data = [("c", s, h, n) for s, h, n in hours]
    schema = "city_key string, station_key string, target_hour_start timestamp_ntz, demand bigint"
    return spark.createDataFrame(data, schema)


def test_active_windows_by_hand(spark):
    cells = cells_of(
        spark,
        [
            ("one", H(2025, 1, 5, 12), 1),
            ("edge", H(2025, 1, 1, 2), 1),
            ("long", H(2025, 1, 2, 0), 1),
            ("long", H(2025, 1, 8, 5), 1),
            ("period", H(2025, 1, 1, 0), 1),
            ("period", H(2025, 1, 10, 23), 1),
        ],
    )
    windows = G.active_windows(cells)
    assert rows(windows, "station_key", "window_start", "window_end") == [
        ("edge", H(2025, 1, 1, 0), H(2025, 1, 2, 14)),
        ("long", H(2025, 1, 2, 0), H(2025, 1, 8, 5)),
        ("one", H(2025, 1, 4, 1), H(2025, 1, 7, 0)),
        ("period", H(2025, 1, 1, 0), H(2025, 1, 10, 23)),
    ]
    per_station = {"edge": 26, "long": 102, "one": 51, "period": 170}
    kept = G.window_counts(windows, KEEP_HOURS)
    assert {r.station_key: r.n_rows for r in kept.collect()} == per_station
    grid = G.grid_rows(windows, KEEP_HOURS).groupBy("station_key").count()
    assert {r.station_key: r["count"] for r in grid.collect()} == per_station
    for bad in ({"buffer_before": -1}, {"buffer_after": -1}, {"min_window_hours": 0}):
        with pytest.raises(ValueError):
            G.active_windows(cells, **bad)


def test_zero_filled_equals_grid_join(spark, small_rides):
    cells = D.demand_cells(D.keyed_rides(small_rides))
    for windows in (G.full_windows(cells), G.active_windows(cells, 24, 24)):
        for hours in (None, KEEP_HOURS, [3]):
            filled = G.zero_filled(cells, windows, hours)
            joined = (
                G.filter_target_hours(G.grid_rows(windows), hours)
                .join(cells, CELL_KEY, "left")
                .na.fill(0, ["demand"])
            )
            assert rows(filled, *CELL_KEY, "demand") == rows(joined, *CELL_KEY, "demand")
    assert G.filter_target_hours(cells, []).count() == 0
    with pytest.raises(ValueError, match="24"):
        G.filter_target_hours(cells, [24])


def test_covered_hours_equals_distinct_grid_hours(spark, small_rides):
    cells = D.demand_cells(D.keyed_rides(small_rides)).where("station_key IN ('lonely', 'x')")
    windows = G.active_windows(cells, min_window_hours=5)
    columns = ["city_key", "target_hour_start"]
    expected = G.grid_rows(windows, KEEP_HOURS).select(*columns).distinct()
    assert rows(G.covered_hours(windows, KEEP_HOURS), *columns) == rows(expected, *columns)


def test_running_total_with_more_buckets_than_rows_and_fewer(spark):
    df = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"),
        F.col("id").alias("b"),
        (F.col("id") % 7).alias("w"),
    )
    expected = df.toPandas().sort_values(["a", "b"])
    expected["before"] = expected.w.cumsum() - expected.w
    for buckets in (1, 2, 33, 900):
        got = running_total(df, ["a", "b"], "w", "before", buckets).toPandas()
        got = got.sort_values(["a", "b"])
        assert got.before.tolist() == expected.before.tolist()


def test_ids_are_dense_and_ordered(spark, small_rides):
    keyed = D.keyed_rides(small_rides)
    cells = D.demand_cells(keyed)
    counts = cells.groupBy(*STATION_KEY).agg(F.count("*").alias("n_rows"))
    pdf = dense_ids(cells, counts, STATION_KEY, "target_hour_start").toPandas()
    pdf = pdf.sort_values(CELL_KEY)
    assert pdf.id.tolist() == list(range(len(pdf)))


def brute_force_first(pdf, keys, column):
    ordered = pdf.sort_values("event_id")
    return ordered.groupby(keys, dropna=False)[column].first().to_dict()


def test_dimensions_take_the_first_non_null_value(spark, small_rides):
    keyed = D.keyed_rides(small_rides)
    pdf = keyed.toPandas()
    got = dims.station_dim(keyed).toPandas()
    for column in ("start_station_id", "office_poi_count_1000m", "city"):
        expected = brute_force_first(pdf, STATION_KEY, column)
        actual = got.set_index(STATION_KEY)[column].to_dict()
        assert {k: v for k, v in actual.items() if pd.notna(v)} == {
            k: v for k, v in expected.items() if pd.notna(v)
        }
    hours = dims.city_hour_dim(keyed).toPandas()
    keys = ["city_key", "target_hour_start"]
    for column in ("apparent_temperature", "holiday_name"):
        expected = brute_force_first(pdf, keys, column)
        actual = hours.set_index(keys)[column].to_dict()
        assert {k: v for k, v in actual.items() if pd.notna(v)} == {
            k: v for k, v in expected.items() if pd.notna(v)
        }
    for df in (dims.station_dim(keyed), dims.city_hour_dim(keyed)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        map_side = plan.rsplit("Exchange hashpartitioning", 1)[1]
        assert "HashAggregate" in map_side and "SortAggregate" not in map_side


def test_hour_caps(spark, small_rides):
    keyed = D.keyed_rides(small_rides)
    cells = D.demand_cells(keyed)
    grid = G.grid_rows(G.full_windows(cells), KEEP_HOURS)
    capped = S.cap_eval_hours_per_city(grid, {"A": 20, "B": 100_000, "nowhere": 3}, seed=1)
    hours = {
        r.city_key: r.n
        for r in capped.groupBy("city_key")
        .agg(F.countDistinct("target_hour_start").alias("n"))
        .collect()
    }
    whole = {
        r.city_key: r.n
        for r in grid.groupBy("city_key")
        .agg(F.countDistinct("target_hour_start").alias("n"))
        .collect()
    }
    assert hours["A"] == 20
    assert {c: n for c, n in hours.items() if c != "A"} == {
        c: n for c, n in whole.items() if c != "A"
    }
    # All stations of the city stay at a picked hour.
    per_hour = capped.where("city_key = 'A'").groupBy("target_hour_start").count()
    assert {r["count"] for r in per_hour.collect()} == {
        grid.where("city_key = 'A'").select("station_key").distinct().count()
    }
    again = S.cap_eval_hours_per_city(grid.repartition(3), {"A": 20, "B": 100_000}, seed=1)
    assert rows(again, *CELL_KEY) == rows(capped, *CELL_KEY)
    with pytest.raises(ValueError):
        S.cap_eval_hours_per_city(grid, {"A": 0})
    with pytest.raises(ValueError):
        S.cap_eval_hours_per_city(grid.drop("city_key"), {"A": 1})


@pytest.mark.parametrize("mode", ["active_window", " FULL ", "observed_only"])
@pytest.mark.parametrize("caps", [None, {"A": 30, "B": 40}])
def test_panel_invariants(spark, small_rides, mode, caps):
    spec = PN.PanelSpec(grid_mode=mode, caps=caps, min_window_hours=10, validate=True)
    targets, labels = PN.station_hour_test_format(small_rides, spec)
    pdf = labels.toPandas().sort_values("id")
    assert pdf.id.tolist() == list(range(len(pdf)))
    assert not {"demand", "city_key", "station_key"} & set(targets.columns)
    assert targets.columns[:4] == ["id", "target_hour_start", "city", "start_station_id"]
    assert targets.count() == len(pdf)
    rows_ = PN.panel_rows(D.demand_cells(spec.key(small_rides)), spec)
    ordered = rows_.toPandas().sort_values("id")
    assert ordered[CELL_KEY].apply(tuple, axis=1).is_monotonic_increasing
    assert not ordered.duplicated(CELL_KEY).any()


def test_modes_nest_and_full_counts_every_ride(spark, small_rides):
    spec = PN.PanelSpec(keep_hours=None, caps=None)
    keys = {}
    for mode in PN.GRID_MODES:
        one = dataclasses.replace(spec, grid_mode=mode)
        pdf = PN.panel_rows(D.demand_cells(one.key(small_rides)), one).toPandas()
        keys[mode] = set(pdf[CELL_KEY].apply(tuple, axis=1))
        assert pdf.demand.sum() == small_rides.count()
    assert keys["observed_only"] <= keys["active_window"] <= keys["full"]
    with pytest.raises(ValueError, match="grid_mode"):
        _ = PN.PanelSpec(grid_mode="sparse").mode


def test_panel_does_not_depend_on_row_order(spark, small_rides):
    spec = PN.PanelSpec(caps={"A": 15})
    a = PN.station_hour_test_format(small_rides, spec)[0]
    b = PN.station_hour_test_format(small_rides.orderBy(F.rand(3)).repartition(2), spec)[0]
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_unobserved_city_hours_have_no_weather(spark, small_rides):
    spec = PN.PanelSpec(grid_mode="full", keep_hours=None, caps=None)
    targets = PN.station_hour_test_format(small_rides, spec)[0].where("city = 'B'")
    unseen = targets.where("working_day IS NULL")
    assert 0 < unseen.count() < targets.count()
    assert unseen.where("hour IS NULL OR weekday IS NULL OR date IS NULL").count() == 0


def test_hidden_sample(spark, small_rides):
    sample = PN.hidden_test_sample(small_rides, 40).toPandas().sort_values("id")
    assert sample.id.tolist() == list(range(40))
    pdf = small_rides.toPandas()
    pdf["h"] = pdf.started_at.dt.floor("h")
    keys = ["city", "start_station_id", "h"]
    groups = pdf.sort_values("event_id").groupby(keys, dropna=False).first().reset_index()
    expected = groups.sort_values(keys).head(40)
    assert sample.start_station_id.tolist() == expected.start_station_id.tolist()
    assert sample.target_hour_start.tolist() == expected.h.tolist()
    left = sample.apparent_temperature.fillna(-99).tolist()
    assert left == expected.apparent_temperature.fillna(-99).tolist()
    everything = PN.hidden_test_sample(small_rides, 10_000)
    assert everything.count() == len(groups)
    assert PN.hidden_test_sample(small_rides.drop("city"), 5).first().city == "__all_cities__"
