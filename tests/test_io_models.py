import pytest
from pyspark.sql import functions as F

from demandgrid.models import regression as R
from demandgrid.operators.scoring import leaderboard, prediction_sets, score_rows
from demandgrid.plans import features as P
from demandgrid.plans import panel as PN
from demandgrid.sources import io as IO

SPEC = P.FeatureSpec(min_rides=100, station_hour_key="hour")


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_csv_rides_keep_ids_as_text_and_bad_times_as_null(spark, tmp_path):
    path = tmp_path / "rides.csv"
    path.write_text(
        "started_at,start_station_id,city,extra,office_poi_count_1000m\n"
        "2025-01-01 10:05:00,007,A,q,3\n"
        "not a time,12.0,A,q,4\n"
        "2025-01-01 11:00:00,,B,,\n"
    )
    df = IO.read_rides(spark, str(path), "csv")
    assert dict(df.dtypes)["started_at"] == "timestamp_ntz"
    rows = df.collect()
    assert [r.start_station_id for r in rows] == ["007", "12.0", None]
    assert [r.started_at is None for r in rows] == [False, True, False]
    assert rows[1].office_poi_count_1000m == 4
    with pytest.raises(ValueError, match="format"):
        IO.read_rides(spark, str(path), "xml")


def test_csv_whole_numbers_in_any_spelling(spark, tmp_path):
    (tmp_path / "rides.csv").write_text(
        "start_station_id,office_poi_count_1000m,holiday,working_day\n"
        "1,3.0,1.0,0.0\n2,4,0,1\n3, 5 ,,x\n4,2.5,1e0,-1\n"
    )
    rows = IO.read_rides(spark, str(tmp_path / "rides.csv"), "csv").orderBy("start_station_id")
    got = [(r.office_poi_count_1000m, r.holiday, r.working_day) for r in rows.collect()]
    assert got == [(3, 1, 0), (4, 0, 1), (5, None, None), (None, 1, -1)]


def test_csv_files_with_another_column_order_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("start_station_id,holiday\n1,1\n")
    (tmp_path / "b.csv").write_text("holiday,start_station_id\n0,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        IO.read_rides(spark, str(tmp_path), "csv").collect()


@pytest.mark.parametrize("mode", PN.GRID_MODES)
def test_quarantine_gives_the_panel_of_drop(spark, small_rides, mode):
    bad = small_rides.withColumn(
        "started_at", F.when(F.col("event_id") % 5 != 0, F.col("started_at"))
    )
    panels = {
        on_bad: PN.station_hour_panel(bad, PN.PanelSpec(grid_mode=mode, caps=None, on_bad=on_bad))
        for on_bad in ("drop", "quarantine")
    }
    columns = ["id", "city_key", "station_key", "target_hour_start", "demand"]
    assert same(*(p.select(*columns) for p in panels.values()))
    spec = PN.PanelSpec(on_bad="quarantine")
    assert spec.set_aside(bad).count() == bad.where("event_id % 5 = 0").count()
    with pytest.raises(Exception, match="no readable start time"):
        PN.station_hour_panel(bad, PN.PanelSpec(grid_mode=mode, caps=None)).collect()


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_eval_pair_round_trip(spark, small_rides, tmp_path, fmt):
    spec = PN.PanelSpec(caps={"A": 10, "B": 10})
    where = {"public_test_targets": None, "private_test_labels": None}
    paths = [str(tmp_path / "eval" / name) for name in where]
    for _ in range(2):  # the second run overwrites the first
        targets, labels = IO.write_eval_pair(
            small_rides.where("city IS NOT NULL"), *paths, spec, fmt
        )
    got_targets, got_labels = IO.load_eval_pair(spark, str(tmp_path / "eval"), fmt=fmt)
    assert got_targets.count() == targets.count()
    assert same(labels.select("id", "demand", "city"), got_labels)
    assert same(targets.select("id", "target_hour_start", "hour"), got_targets)
    if fmt == "csv":
        header = next((tmp_path / "eval" / "public_test_targets").glob("part-*.csv"))
        assert ":00:00" in header.read_text().split("\n")[1]


def test_eval_pair_contract_is_enforced(spark, small_rides, tmp_path):
    targets, labels = PN.station_hour_test_format(
        small_rides.where("city IS NOT NULL"), PN.PanelSpec(caps=None)
    )
    root = str(tmp_path)
    targets.write.parquet(f"{root}/public_test_targets")
    labels.where("id > 2").write.parquet(f"{root}/private_test_labels")
    with pytest.raises(ValueError, match="target_ids_in_labels"):
        IO.load_eval_pair(spark, root)


def test_result_sinks(spark, tmp_path):
    labels = spark.range(30).select("id", F.lit("a").alias("city"), (F.col("id") % 3).alias("demand"))
    made = prediction_sets({m: labels.selectExpr("id", f"{v} AS prediction") for m, v in
                            {"one": "1.0", "two": "2.0"}.items()})
    IO.write_scored_rows(score_rows(labels, made), str(tmp_path / "scored"))
    assert sorted(p.name for p in (tmp_path / "scored").glob("model=*")) == ["model=one", "model=two"]
    IO.write_leaderboard(leaderboard(labels, labels, made)[0], str(tmp_path / "board"))
    files = list((tmp_path / "board").glob("part-*"))
    assert len(files) == 1 and files[0].read_text().count("\n") == 5


def test_artifacts_round_trip(spark, small_rides, tmp_path):
    training = P.training_rides(small_rides, SPEC)
    art = P.build_artifacts(training, SPEC)
    saved = IO.save_artifacts(art, str(tmp_path / "artifacts"))
    assert saved.scope == art.scope
    targets = P.training_panel(training, SPEC).drop("demand").where("hour = 8")
    keep = ["start_station_id", "hour_ts", "lag_7d_demand", "station_hour_std_demand"]
    assert same(
        P.create_features(targets, art).select(*keep), P.create_features(targets, saved)
    )


@pytest.mark.parametrize(
    "settings",
    [
        R.GlmSettings(max_iter=3),
        R.GbtSettings(rounds=3, depth=3, step=0.3),
        R.GbtSettings(rounds=3, depth=3, step=0.3, early_stop=False),
    ],
)
def test_models(spark, small_rides, tmp_path, settings):
    train, art = P.make_features_from_rides(small_rides, SPEC)
    train = R.with_validation_flag(train)
    days = train.groupBy("validation").agg(F.min("hour_ts").alias("lo"), F.max("hour_ts").alias("hi"))
    sides = {r.validation: r for r in days.collect()}
    assert sides[False].hi < sides[True].lo
    assert (sides[True].hi - sides[True].lo).days == 7
    model = R.fit(train, settings)
    IO.save_model(model, str(tmp_path / "model"))
    model = IO.load_model(str(tmp_path / "model"))
    row = R.validation_errors(model, train).first()
    assert row.n_rows == train.where("validation").count()
    assert 0 < row.validation_mae < 1.0
    made = R.predict(model, train, ("city", "start_station_id", "hour_ts"))
    assert made.where("prediction < 0 OR isnan(prediction)").isEmpty()
    assert made.where("prediction > 0 AND prediction < 0.6").isEmpty()
    assert made.count() == train.count()
    if isinstance(settings, R.GbtSettings):
        curve = R.loss_curve(model, train).collect()
        assert [r.round for r in curve] == list(range(1, len(curve) + 1))
        assert 1 <= len(curve) <= 3 and (settings.early_stop or len(curve) == 3)
        assert sum(r.best for r in curve) == 1
        weights = R.feature_importance(model, spark, None)
        assert weights.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
        assert R.feature_importance(model, spark, 10).count() == 10
