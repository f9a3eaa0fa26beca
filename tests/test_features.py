import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandgrid.functions import features as FE
from demandgrid.operators import demand as D
from demandgrid.operators import dims
from demandgrid.operators import history as HI
from demandgrid.operators import stats as ST
from demandgrid.operators.cities import city_encoding, city_scope, encode_city, keep_major_cities
from demandgrid.plans import features as P
from demandgrid.schema import FEATURE_CELL, FEATURE_COLUMNS

SPEC = P.FeatureSpec(min_rides=100)


@pytest.fixture
def training(small_rides):
    return P.training_rides(small_rides, SPEC)


@pytest.fixture
def keyed(small_rides, training):
    """The rides behind the training panel."""
    return D.keyed_rides(small_rides.where("city IS NOT NULL")).where(F.col("city_key").isin(list(training.scope.names)))


def panel_of(training):
    return P.training_panel(training, SPEC)


def test_weather_scores(spark):
    df = spark.createDataFrame(
        [(18.0, 50.0, 0.0, 0.0, 0.0, 0.0), (30.0, 160.0, 250.0, -1.0, 2.0, 25.0),
         (None, 50.0, 0.0, None, 0.0, 0.0)],
        "apparent_temperature double, relative_humidity_2m double, cloud_cover double, "
        "rain double, snowfall double, wind_speed_10m double",
    )
    best, worst, null = FE.with_weather_features(df).collect()
    assert best.comfort_score == pytest.approx(1.0) and best.outdoor_pleasantness == 1.0
    assert worst.comfort_score == pytest.approx(0.5 * math.exp(-0.5))
    assert worst.outdoor_pleasantness == pytest.approx(math.exp(-10) * math.exp(-1))
    assert null.comfort_score is None and null.outdoor_pleasantness is None
    bare = FE.with_weather_features(df.select("rain"))
    assert "comfort_score" not in bare.columns
    assert bare.first().outdoor_pleasantness == 1.0
    no_cloud = FE.with_weather_features(df.drop("cloud_cover")).first()
    assert no_cloud.comfort_score == pytest.approx(0.9)


def test_rush(spark):
    df = spark.createDataFrame(
        [(6, 2.0), (7, 2.0), (9, 5.0), (19, None)], "hour int, station_hour_mean_demand double"
    )
    got = [r.rush_x_station_hour_mean for r in FE.with_rush_features(df).collect()]
    assert got == [0.0, 2.0, 3.0, None]


def test_weekly_mean_and_post_process(spark):
    df = spark.createDataFrame(
        [(7, None, 3), (None, None, None), (None, 4, None)], "a int, b int, c int"
    )
    mean = FE.weekly_mean([F.col("a"), F.col("b"), F.col("c")])
    assert [r.m for r in df.select(mean.alias("m")).collect()] == [5.0, None, 4.0]
    p = spark.createDataFrame([(0.59,), (0.6,), (-1.0,), (2.0,)], "p double")
    got = [r.q for r in p.select(FE.post_process(F.col("p")).alias("q")).collect()]
    assert got == [0.0, 0.6, 0.0, 2.0]


def test_panel_is_complete(training, keyed):
    pdf = panel_of(training).toPandas()
    assert not pdf.duplicated(FEATURE_CELL).any()
    assert pdf.demand.sum() == keyed.count()
    hours = pdf.groupby("city").hour_ts.nunique()
    assert len(pdf) == sum(
        hours[c] * n for c, n in pdf.groupby("city").start_station_id.nunique().items()
    )
    assert pdf.working_day.notna().all() and pdf.holiday.notna().all()


def test_weather_comes_from_the_smallest_station(training, keyed):
    keyed = keyed.toPandas().sort_values("event_id")
    cells = keyed.groupby(["city", "station_key", "target_hour_start"], as_index=False).first()
    expected = cells.sort_values("station_key").drop_duplicates(["city", "target_hour_start"])
    expected = expected.set_index(["city", "target_hour_start"]).apparent_temperature
    got = panel_of(training).toPandas().drop_duplicates(["city", "hour_ts"])
    got = got.set_index(["city", "hour_ts"]).apparent_temperature
    for key, value in expected.items():
        assert (pd.isna(value) and pd.isna(got[key])) or got[key] == value


def test_attributes_of_cells(training, keyed, small_rides):
    columns = ["apparent_temperature", "holiday"]
    stations = keyed.toPandas().sort_values(["target_hour_start", "event_id"])
    want = stations.groupby(["city", "station_key"]).apparent_temperature.first().to_dict()
    got = P.station_attributes(training, columns)
    pdf = got.toPandas()
    assert pdf.set_index(["city", "start_station_id"]).apparent_temperature.to_dict() == want
    # An order column of text orders alike.
    text = small_rides.withColumn("event_id", F.format_string("%08d", "event_id"))
    other = P.training_rides(text, SPEC)
    for a, b in [
        (got, P.station_attributes(other, columns)),
        (P.city_hour_attributes(training, columns), P.city_hour_attributes(other, columns)),
    ]:
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty()


def test_dimensions_of_cells_equal_those_of_rides(spark, small_rides, tmp_path):
    keyed = D.keyed_rides(small_rides)
    # Without an order column the order of one file counts.
    keyed.drop("city", "event_id").coalesce(1).write.parquet(str(tmp_path / "keyed"))
    for rides in (keyed, spark.read.parquet(str(tmp_path / "keyed"))):
        cells = dims.cells_with_attributes(rides).cache()
        pairs = [
            (D.demand_cells(rides), cells.select("city_key", "station_key", "target_hour_start", "demand")),
            (dims.station_dim(rides), dims.station_dim_of_cells(cells)),
            (dims.city_hour_dim(rides), dims.city_hour_dim_of_cells(cells)),
        ]
        for a, b in pairs:
            assert sorted(a.columns) == sorted(b.columns)
            b = b.select(*a.columns)
            assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty()


def test_rides_are_read_once(spark, small_rides, tmp_path, monkeypatch):
    """Every plan that is run for a panel or for features, but for the first, starts at
    tables that this job has written."""
    from demandgrid.plans import panel as PN
    from demandgrid.sources import staging

    path = str(tmp_path / "rides")
    small_rides.where("city IS NOT NULL").write.parquet(path)
    rides = spark.read.parquet(path)
    read = []
    for module in (P, PN):
        def watched(df, name, whole=staging.staged):
            read.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().toString().count("event_id"))
            return whole(df, name)

        monkeypatch.setattr(module, "staged", watched)
    results = [P.make_features_from_rides(rides, SPEC)[0], PN.station_hour_panel(rides)]
    assert sum(n > 0 for n in read) == 2  # the cells of either job
    for df in results:
        assert path not in " ".join(df.inputFiles())


def test_statistics_match_the_panel(training):
    pdf = panel_of(training).toPandas()
    cells = P.feature_keys(training.cells)

    def check(got, by, prefix, names):
        got = got.toPandas().set_index(by).sort_index()
        want = pdf.groupby(by).demand.agg(list(names.values()))
        assert len(got) == len(want)
        for name, how in names.items():
            column = want[how].fillna(0.0).sort_index()
            np.testing.assert_allclose(
                got[f"{prefix}_{name}_demand"].astype(float), column.astype(float), atol=1e-9
            )

    three = {"mean": "mean", "median": "median", "max": "max"}
    four = {**three, "std": "std"}
    check(ST.station_stats(cells), ["city", "start_station_id"], "station", three)
    check(ST.city_hour_stats(cells), ["city", "hour"], "city_hour", three)
    check(ST.city_weekday_stats(cells), ["city", "weekday"], "city_weekday", {"mean": "mean"})
    check(ST.city_mean_stats(cells), ["city"], "city", {"mean": "mean"})
    by = ["city", "start_station_id", "hour"]
    check(ST.station_hour_of_day_stats(cells), by, "station_hour", four)


def brute_force_lags(pdf):
    seen = pdf[pdf.demand > 0].set_index(FEATURE_CELL).demand.to_dict()
    out = {}
    for key in pdf[FEATURE_CELL].itertuples(index=False, name=None):
        lags = [seen.get((*key[:2], key[2] - dt.timedelta(days=d))) for d in (1, 7, 14, 21)]
        weekly = [x for x in lags[1:] if x is not None]
        out[key] = (*(float(x or 0) for x in lags), sum(weekly) / len(weekly) if weekly else 0.0)
    return out


def test_both_lag_paths_match_brute_force(training):
    columns = ["lag_1d_demand", "lag_7d_demand", "lag_14d_demand", "lag_21d_demand"]
    panel = panel_of(training).select(*FEATURE_CELL, "demand")
    expected = brute_force_lags(panel.toPandas())
    assert any(v[3] for v in expected.values())
    history = HI.demand_history(P.feature_keys(training.cells))
    for df in (HI.with_lags(panel.drop("demand"), history), HI.with_dense_lags(panel)):
        got = df.toPandas()
        assert len(got) == len(expected)
        for row in got.itertuples(index=False):
            key = (row.city, row.start_station_id, row.hour_ts)
            values = tuple(getattr(row, c) for c in [*columns, "lag_rolling_mean"])
            assert values == pytest.approx(expected[key])


def test_repeated_history_rows_add_up(spark):
    ts = dt.datetime(2025, 1, 2)
    history = spark.createDataFrame(
        [("c", "1", ts, 2), ("c", "1", ts, 3)],
        "city string, start_station_id string, hour_ts timestamp_ntz, demand bigint",
    )
    later = spark.createDataFrame(
        [("c", "1", ts + dt.timedelta(days=1))] * 2,
        "city string, start_station_id string, hour_ts timestamp_ntz",
    )
    assert [r.lag_1d_demand for r in HI.with_lags(later, history).collect()] == [5.0, 5.0]


def test_training_and_target_paths_agree(training):
    art = P.build_artifacts(training, SPEC)
    train = P.feature_matrix(P.training_features(training, art, SPEC).drop("city"), FEATURE_CELL[1:])
    targets = panel_of(training).drop("demand")
    made = P.feature_matrix(P.create_features(targets, art).drop("city"), FEATURE_CELL[1:])
    a = train.toPandas().round(9).fillna(-1).sort_values(train.columns).reset_index(drop=True)
    b = made.toPandas().round(9).fillna(-1).sort_values(train.columns).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)


def test_exact_hour_key_leaks_and_hour_key_does_not(small_rides, training):
    art = P.build_artifacts(training, SPEC)
    leaky = P.training_features(training, art, SPEC)
    assert leaky.where("station_hour_mean_demand <> demand").isEmpty()
    future = panel_of(training).limit(50).withColumn("hour_ts", F.expr("hour_ts + INTERVAL 365 DAY"))
    made = P.create_features(future.drop("demand"), art)
    assert made.where("station_hour_mean_demand <> 0").isEmpty()
    sound = P.FeatureSpec(min_rides=100, station_hour_key="hour")
    art = P.build_artifacts(training, sound)
    made = P.create_features(future.drop("demand"), art)
    assert not made.where("station_hour_mean_demand <> 0").isEmpty()
    with pytest.raises(ValueError):
        P.FeatureSpec(station_hour_key="week")


def test_held_out_days_stay_out_of_the_statistics(training):
    spec = P.FeatureSpec(min_rides=100, stats_days_held_out=7)
    got = P.build_artifacts(training, spec).city_mean_stats.toPandas().set_index("city")
    pdf = panel_of(training).toPandas()
    cutoff = pdf.hour_ts.max() - pd.Timedelta("7D")
    early = pdf[pdf.hour_ts < cutoff]
    seen = early[early.demand > 0][["city", "start_station_id"]].drop_duplicates()
    want = early.merge(seen).groupby("city").demand.mean()
    np.testing.assert_allclose(got.city_mean_demand.sort_index(), want.sort_index())


def test_major_cities_by_name_and_by_join(small_rides, training):
    counts = small_rides.toPandas().city.value_counts()
    assert training.scope.names == tuple(sorted(counts.index))
    cells, cities = training.cells, training.cities
    top = int(counts.max())
    scope = city_scope(cities, top)
    assert scope.names == (counts.idxmax(),)
    many = city_scope(cities, 1, max_names=1)
    assert many.names is None and many.small(cells) is cells
    joined = keep_major_cities(cells, cities, many, top)
    named = keep_major_cities(cells, cities, scope, top)
    assert joined.exceptAll(named).isEmpty() and named.exceptAll(joined).isEmpty()
    assert not named.isEmpty()


def test_city_encoding_and_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("b",)], "city string")
    codes = city_encoding(df)
    assert {r.city: r.city_index for r in codes.collect()} == {"a": 0, "b": 1, "c": 2}
    other = spark.createDataFrame([("z",), ("c",)], "city string")
    assert sorted(r.city for r in encode_city(other, codes).collect()) == [0, 2]
    assert sorted(r.city for r in encode_city(other, codes, -1).collect()) == [-1, 2]


def test_features_of_sample_targets(spark, training, sample_targets):
    art = P.build_artifacts(training, SPEC)
    made = encode_city(P.create_features(sample_targets, art), art.city_encoding)
    matrix = P.feature_matrix(made, ["id", "start_station_id"])
    assert matrix.columns[2:] == FEATURE_COLUMNS
    got = {r.id: r for r in matrix.collect()}
    assert [got[i].start_station_id for i in range(3)] == ["77", "77", "dock_5"]
    assert all(r.comfort_score == 0.0 for r in got.values())
    assert got[0].is_morning_rush == 1 and got[2].is_evening_rush == 1


def test_cyclic(spark):
    df = spark.sql("SELECT timestamp_ntz'2026-01-03 06:00:00' hour_ts, 1 holiday")
    row = FE.with_cyclic_features(df).first()
    assert row.hour_sin == pytest.approx(1.0) and row.day_of_year == 3
    assert (row.hour_x_weekend, row.hour_x_weekday, row.weekday_x_holiday) == (6, 30, 5)
