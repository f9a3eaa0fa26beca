import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandgrid.operators import contracts as Q
from demandgrid.operators import diagnostics as X
from demandgrid.operators import scoring as SC
from demandgrid.operators.quantiles import exact_quantiles
from demandgrid.operators.sampling import sample_rows
from demandgrid.models.predictors import ConstantPredictor, PandasPredictor

N = 400


@pytest.fixture
def labels(spark):
    return spark.range(N).select(
        "id",
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("city"),
        F.lit("s").alias("start_station_id"),
        F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit(dt.datetime(2025, 1, 1)))
        .cast("timestamp_ntz")
        .alias("target_hour_start"),
        (F.col("id") % 13).alias("demand"),
    )


def predictions(spark):
    def made(model, value, n=N):
        return spark.range(n).select(
            F.lit(model).alias("model"), "id", F.expr(value).cast("string").alias("prediction")
        )

    sets = [
        made("good", "id % 13"),
        made("worse", "id % 5 - 1"),
        made("missing_ids", "1", N - 3),
        made("extra_ids", "1", N + 2),
        made("duplicate_ids", "1").unionAll(made("duplicate_ids", "1", 5)),
        made("nan", "if(id % 2 = 0, 'NaN', '1')"),
        made("non_numeric", "if(id = 7, 'many', '1')"),
        made("plus_inf", "if(id = 7, 'Infinity', '1')"),
    ]
    out = sets[0]
    for s in sets[1:]:
        out = out.unionAll(s)
    return out


def test_contract_and_leaderboard(spark, labels):
    targets = labels.drop("demand")
    board, failures = SC.leaderboard(targets, labels, predictions(spark))
    assert {r.model: r.error for r in failures.collect()} == {
        "missing_ids": "row_count,no_missing_ids",
        "extra_ids": "row_count,no_extra_ids",
        "duplicate_ids": "row_count,prediction_ids_unique",
        "nan": "numeric",
        "non_numeric": "numeric",
    }
    rows = board.collect()
    assert [(r.model, r.city) for r in rows] == [
        (m, c) for m in ("good", "worse", "plus_inf") for c in ("a", "b", "OVERALL")
    ]
    worse = rows[5]
    pdf = labels.toPandas()
    raw = pdf.id % 5 - 1
    error = pdf.demand - raw.clip(lower=0)
    assert worse.n_rows == N and worse.negative_predictions_before_clipping == int((raw < 0).sum())
    assert worse.mae == round(error.abs().mean(), 6)
    assert worse.rmse == round(float(np.sqrt((error**2).mean())), 6)
    assert rows[3].negative_predictions_before_clipping is None
    assert rows[-1].mae == float("inf")
    strict = {r.model for r in Q.failing_models(targets, predictions(spark), strict=True).collect()}
    assert {"plus_inf", "worse"} <= strict and "good" not in strict


def test_schema_rules(spark, labels, sample_targets):
    targets = sample_targets
    Q.assert_targets_are_safe(targets)
    with pytest.raises(ValueError, match="leaking: demand"):
        Q.assert_targets_are_safe(labels)
    with pytest.raises(ValueError, match="id"):
        Q.assert_targets_are_safe(targets.drop("id"))
    with pytest.raises(ValueError, match="station"):
        Q.assert_targets_are_safe(targets.drop("start_station_id"))
    no_time = targets.drop("target_hour_start", "hour_ts")
    with pytest.raises(ValueError, match="time"):
        Q.assert_targets_are_safe(no_time)
    Q.assert_targets_are_safe(no_time.withColumn("hour", F.lit(8)))
    report = Q.contract_report(labels, labels, predictions(spark).where("model = 'good'"))
    failed = {r["check"]: r.bad_rows for r in report.where("NOT ok").collect()}
    assert failed == {"no_leaking_columns": 1}
    with pytest.raises(ValueError, match="no_leaking_columns"):
        Q.assert_ok(report)


def test_errors_count_the_rules_they_leave_out(spark):
    rows = [(f"rule {i}", "m", False, i) for i in range(25)]
    with pytest.raises(ValueError, match="and 5 more"):
        Q.assert_ok(spark.createDataFrame(rows, Q.REPORT_SCHEMA))


def test_silent_models_fail_and_none_left_is_an_error(spark, labels):
    targets = labels.drop("demand")
    made = predictions(spark).where("model IN ('good', 'missing_ids')")
    board, failed = SC.leaderboard(targets, labels, made, models=["good", "silent"], require_one=True)
    assert {r.model: r.error for r in failed.collect()}["silent"] == "no_rows"
    assert {r.model for r in board.collect()} == {"good"}
    assert {r.n_rows for r in board.where("city = 'OVERALL'").collect()} == {labels.count()}
    with pytest.raises(ValueError, match="no model can be scored"):
        SC.leaderboard(targets, labels, made.where("model <> 'good'"), require_one=True)


def test_id_report(spark, labels):
    extra = labels.select("id").unionAll(spark.range(2)).where("id <> 5")
    got = {r["check"]: r.bad_rows for r in Q.id_report(extra, labels).collect()}
    assert got == {
        "target_ids_unique": 2,
        "label_ids_unique": 0,
        "label_ids_in_targets": 1,
        "target_ids_in_labels": 0,
    }


def test_predictors_repeat_and_ignore_row_order(spark, labels):
    rule = PandasPredictor(lambda pdf: pdf["demand"] * 0.5, ("demand",))
    first = SC.prediction_sets({"rule": rule.predict(labels), "c": ConstantPredictor().predict(labels)})
    mixed = labels.orderBy(F.rand(5))
    second = SC.prediction_sets({"rule": rule.predict(mixed), "c": ConstantPredictor().predict(mixed)})
    assert Q.repeatability_report(first, second).where("NOT ok").isEmpty()
    moved = second.withColumn("prediction", F.col("prediction") + F.lit(0.01))
    bad = {r.model: r.bad_rows for r in Q.repeatability_report(first, moved).collect()}
    assert bad == {"rule": N, "c": N}
    assert Q.repeatability_report(first, second.limit(10)).agg(F.sum("bad_rows")).first()[0] > 0
    with pytest.raises(Exception, match="predictor returned"):
        PandasPredictor(lambda pdf: [1.0], ("demand",)).predict(labels.coalesce(1)).collect()


def scored(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "id long, demand long, p double")
    labels = df.select(
        "id", F.lit("a").alias("city"), "demand",
        F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, cast(id as int))").alias(
            "target_hour_start"
        ),
    )
    preds = df.select(F.lit("m").alias("model"), "id", F.col("p").alias("prediction"))
    return SC.score_rows(labels, preds)


def test_bins_by_hand(spark):
    rows = scored(spark, [(0, p) for p in (0.0, 0.5, 1.0, 1.0001, 25.0, 25.1, -3.0)])
    got = {r.pred_bin: r["count"] for r in X.calibration_by_prediction(rows, support=0).collect()}
    assert got == {0: 4, 1: 1, 24: 1}
    rows = scored(spark, [(d, 0.0) for d in (0, 4, 5, 10, 200, 201)])
    got = {r.label: r.n for r in X.error_by_bucket(rows).collect()}
    assert got == {"0": 1, "4-5": 2, "6-10": 1, ">20": 1}
    rows = scored(spark, [(0, p) for p in (0.0, 0.25, 20.0, 20.1)])
    specs = [("abs_error", 4, 0.0, 20.0)]
    got = [r["count"] for r in X.histograms(rows, specs).orderBy("bin").collect()]
    assert got == [2, 0, 0, 1]


def test_histogram_edges_match_numpy(spark):
    values = [i * 0.25 for i in range(-41, 82)] + [0.1 * i for i in range(-100, 200)]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    for bins, low, high in ((80, -10.0, 10.0), (60, 0.0, 30.0), (7, -1.0, 1.0), (10, 0.0, 1.0)):
        got = X.histograms(df, [("x", bins, low, high)]).orderBy("bin").toPandas()["count"]
        want, _ = np.histogram(values, bins=bins, range=(low, high))
        assert got.tolist() == want.tolist()


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"g": rng.choice(["a", "b", "b"], 3000), "x": rng.gamma(1.0, 2.0, 3000)})
    frame.loc[frame.index % 3 == 0, "x"] = 0.0
    df = spark.createDataFrame(frame)
    probs = [0.0, 0.001, 0.25, 0.5, 0.77, 0.999, 1.0]
    got = exact_quantiles(df, "x", probs, ["g"]).toPandas()
    assert len(got) == 2 * len(probs)
    for g, part in frame.groupby("g"):
        mine = got[got.g == g].set_index("q")
        np.testing.assert_allclose(
            mine["quantile"].loc[probs].to_numpy(), np.quantile(part.x, probs), rtol=1e-9, atol=1e-12
        )
    one = exact_quantiles(df.where("g = 'a'").limit(1), "x", [0.5])
    assert one.count() == 1


def test_diagnostics_against_pandas(spark):
    rng = np.random.default_rng(5)
    pairs = [(int(d), float(p)) for d, p in zip(rng.poisson(2, 900), rng.normal(2, 2, 900))]
    rows = scored(spark, pairs)
    pdf = rows.toPandas()
    summary = X.error_summary(rows).toPandas().set_index("city")
    assert summary.loc["OVERALL", "median_abs_error"] == pytest.approx(pdf.abs_error.median())
    assert summary.loc["a", "bias"] == pytest.approx(
        pdf.prediction_clipped.mean() - pdf.demand.mean()
    )
    zero = X.zero_segments(rows).first()
    assert zero.mae_zero == pytest.approx(pdf[pdf.demand == 0].abs_error.mean())
    day = X.night_day_errors(rows).first()
    hour = pdf.target_hour_start.dt.hour
    assert day.mae_night == pytest.approx(pdf[(hour <= 4) | (hour >= 22)].abs_error.mean())
    assert day.mae_day == pytest.approx(pdf[(hour >= 6) & (hour <= 21)].abs_error.mean())
    hours = pdf.groupby(hour).abs_error.mean().sort_values()
    extremes = X.extreme_hours(rows).collect()
    assert [r.hour for r in extremes if r.side == "best"] == hours.index[:3].tolist()
    assert [r.hour for r in extremes if r.side == "worst"] == hours.index[::-1][:3].tolist()
    names = [r.weekday_name for r in X.by_weekday(rows).collect()]
    assert names[0] == "Monday" and len(names) == 7
    qq = X.qq_points(rows).toPandas()
    probs = np.linspace(0.001, 0.999, 200)
    np.testing.assert_allclose(qq.true_quantile, np.quantile(pdf.demand, probs), atol=1e-9)
    np.testing.assert_allclose(
        qq.pred_quantile, np.quantile(pdf.prediction_clipped, probs), atol=1e-9
    )


def test_sample_is_exact_and_stable(spark):
    df = spark.range(1000)
    a = {r.id for r in sample_rows(df, 37).collect()}
    b = {r.id for r in sample_rows(df.repartition(7), 37).collect()}
    assert len(a) == 37 and a == b
    assert sample_rows(df, 5000).count() == 1000
