"""Boosted trees: against a plain fit, patience, resuming, publishing, future hours."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandgrid.models import boosting as B
from demandgrid.models import regression as R
from demandgrid.models.bundle import Bundle, fingerprint, train_bundle
from demandgrid.models.predictors import PandasPredictor, predicted_by_all
from demandgrid.operators import scoring as SC
from demandgrid.plans import catalog as C
from demandgrid.plans import features as P
from demandgrid.schema import FEATURE_COLUMNS
from demandgrid.sources import publish
from demandgrid.sources.staging import discard, job, staged

LARGE = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def made(spark, n=4000, seed=1):
    """Demand that depends on x (a step), on y (null means low) and not on z."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x, y, z = rng.random(), rng.random(), rng.random()
        mean = (3.0 if x > 0.6 else 0.5) * (0.3 if i % 7 == 0 else 1 + y)
        rows.append((i, float(x), None if i % 7 == 0 else float(y), float(z), int(rng.poisson(mean)), i % 4 == 0))
    schema = "id bigint, x double, y double, z double, demand bigint, validation boolean"
    return spark.createDataFrame(rows, schema).repartition(3)


SETTINGS = B.Settings(rounds=12, patience=5, step=0.3, leaves=6, bins=16, refresh=4, row_share=1.0, feature_share=1.0, share=0.01)


def plain_fit(rows, settings, rounds):
    """The same algorithm over all rows at once: exact leaf-wise growth on binned features."""
    train = [r for r in rows if not r.validation]
    x = [np.array([np.nan if r[c] is None else r[c] for r in train]) for c in "xyz"]
    y = np.array([float(r.demand) for r in train])
    p, score = settings.power, np.full(len(y), np.log(y.mean()))
    losses = [B.deviance(y, np.exp(score), p).mean()]
    cuts = yield
    bins = B.Forest(list("xyz"), cuts, 0.0, p, [], []).binned(x)
    for _ in range(rounds):
        low, high = np.exp((1 - p) * score), np.exp((2 - p) * score)
        g, h = high - y * low, (2 - p) * high - (1 - p) * y * low

        def gain(at):
            pull = np.sign(g[at].sum()) * max(abs(g[at].sum()) - settings.l1, 0)
            return pull**2 / (h[at].sum() + settings.l2)

        leaves = [np.arange(len(y))]
        while len(leaves) < settings.leaves:
            best = None
            for k, at in enumerate(leaves):
                for f in range(3):
                    for b in range(settings.bins):
                        left = at[bins[f, at] <= b]
                        right = at[bins[f, at] > b]
                        if min(len(left), len(right)) < settings.rows_per_leaf:
                            continue
                        won = gain(left) + gain(right) - gain(at)
                        if won > 0 and (best is None or won > best[0] + 1e-9):
                            best = (won, k, left, right)
            if best is None:
                break
            leaves[best[1]] = best[2]
            leaves.append(best[3])
        for at in leaves:
            pull = np.sign(g[at].sum()) * max(abs(g[at].sum()) - settings.l1, 0)
            score[at] -= settings.step * pull / (h[at].sum() + settings.l2)
        losses.append(B.deviance(y, np.exp(score), p).mean())
    yield losses


def test_equals_a_plain_fit(spark):
    """With one leaf split at a time the growth is exactly leaf-wise."""
    table = made(spark, 1500)
    settings = B.Settings(**{**vars(SETTINGS), "rounds": 4, "patience": 50})
    forest = B.fit(table, ["x", "y", "z"], settings)
    plain = plain_fit(table.collect(), settings, 4)
    next(plain)
    want = plain.send(forest.cuts)
    assert [row[1] for row in forest.curve] == pytest.approx(want, rel=1e-6)
    assert all(sum(f < 0 for f in t.feature) <= settings.leaves for t in forest.trees)


def test_learns_and_predicts(spark):
    table = made(spark)
    settings = B.Settings(rounds=40, patience=8, step=0.2, leaves=8, bins=32, refresh=4)
    forest = B.fit(table, ["x", "y", "z"], settings)
    first, best = forest.curve[1], forest.curve[forest.best()]
    assert best[0] > 1 and best[2] < first[2] < forest.curve[0][2]
    assert len(forest.trees) == best[0]
    out = B.predictions(forest, table, ["id", "demand", "validation"]).where("validation").collect()
    y, mean = (np.array([r[c] for r in out], float) for c in ("demand", "prediction"))
    assert B.deviance(y, mean, forest.power).mean() == pytest.approx(best[2], rel=1e-9)
    told = {r.feature: r.importance for r in B.importance(spark, forest, None).collect()}
    assert told["x"] > told["y"] > told["z"] and sum(told.values()) == pytest.approx(1)


def test_patience_keeps_the_best_round(spark):
    """Noise is learned at once: the loss of held-out rows rises, and the fit ends."""
    rng = np.random.default_rng(0)
    rows = [(*(float(v) for v in rng.random(6)), int(rng.poisson(1.0)), bool(i % 3 == 0)) for i in range(900)]
    names = [f"f{k}" for k in range(6)]
    table = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", demand int, validation boolean")
    forest = B.fit(table, names, B.Settings(rounds=60, patience=3, step=0.5, leaves=12, bins=16))
    losses = [row[2] for row in forest.curve]
    assert len(losses) < 60 and len(forest.trees) == int(np.argmin(losses)) == len(losses) - 4
    curve = B.loss_curve(spark, forest)
    kept = curve.agg(F.min_by("round", "validation_deviance")).first()[0]
    assert curve.where("best").collect()[0]["round"] == kept == len(forest.trees)


def test_a_broken_fit_goes_on(spark, tmp_path, monkeypatch):
    table, names = made(spark), ["x", "y", "z"]
    whole = B.fit(table, names, SETTINGS)
    folder = str(tmp_path / "state")
    grown, seen = B._grown, []

    def breaks(*args):
        seen.append(args[4])
        if len(seen) == 7:
            raise KeyboardInterrupt
        return grown(*args)

    monkeypatch.setattr(B, "_grown", breaks)
    with pytest.raises(KeyboardInterrupt):
        B.fit(table, names, SETTINGS, folder=folder)
    again = B.fit(table, names, SETTINGS, folder=folder)
    assert seen[7] == 4  # the round after the last one published
    assert np.allclose(again.curve, whole.curve, rtol=1e-9)
    assert [vars(t) for t in again.trees] == [vars(t) for t in whole.trees]
    # Other settings do not take up what they did not begin.
    other = B.Settings(**{**vars(SETTINGS), "step": 0.1, "rounds": 1})
    assert len(B.fit(table, names, other, folder=folder).curve) == 2


def test_odd_tables(spark):
    table = made(spark, 300)
    same = B.fit(table.withColumn("x", F.lit(1.0)).withColumn("y", F.lit(None).cast("double")), ["x", "y"], SETTINGS)
    assert all(len(t.feature) == 1 for t in same.trees)
    nobody = B.fit(table.withColumn("validation", F.lit(False)), ["x"], B.Settings(rounds=2, leaves=3))
    assert len(nobody.trees) == 2 and nobody.curve[0][2] != nobody.curve[0][2]
    assert B.loss_curve(spark, nobody).where("validation_deviance IS NULL").count() == 3
    for wrong in (table.limit(0), table.withColumn("demand", F.lit(0))):
        with pytest.raises(ValueError, match="positive mean"):
            B.fit(wrong, ["x"], SETTINGS)
    with pytest.raises(ValueError, match="power"):
        B.Settings(power=2.5)


def test_bundle_in_a_fresh_session(spark, tmp_path):
    path = str(tmp_path / "bundle")
    rides = C.busy_rides(spark, SMALL)
    settings = B.Settings(rounds=3, leaves=4, bins=16, step=0.3)
    version = train_bundle(rides, path, C.MODEL_SPEC, settings)
    assert version.number == 1
    fresh = spark.newSession()
    bundle = Bundle.load(fresh, path)
    last = rides.agg(F.date_trunc("hour", F.max("started_at")).cast("timestamp_ntz")).first()[0]
    out = bundle.predict(bundle.future(24), ("city", "start_station_id", "hour_ts")).cache()
    assert out.count() == 24 * bundle.stations.count()
    assert out.where("prediction IS NULL OR prediction < 0 OR (prediction > 0 AND prediction < 0.6)").isEmpty()
    ends = out.groupBy("city").agg(F.min("hour_ts").alias("lo"), F.max("hour_ts").alias("hi")).collect()
    assert all((r.hi - r.lo).total_seconds() == 23 * 3600 for r in ends) and max(r.lo for r in ends) > last
    # The predictor contract: ids of any targets.
    numbered = bundle.future(2).withColumn("id", F.monotonically_increasing_id())
    assert SC.prediction_sets({"trees": bundle.predict(numbered)}).columns == ["model", "id", "prediction"]


def test_a_bundle_for_other_columns_is_refused(spark, tmp_path):
    path = str(tmp_path / "bundle")
    one = spark.range(1)
    publish.publish(spark, path, {"t": one}, {"format": 1, "fingerprint": fingerprint(FEATURE_COLUMNS[1:])})
    with pytest.raises(ValueError, match="feature columns"):
        Bundle.load(spark, path)
    with pytest.raises(FileNotFoundError):
        Bundle.load(spark, str(tmp_path / "none"))


def test_publishing_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "tables")
    assert publish.current(spark, path) is None
    publish.publish(spark, path, {"a": spark.range(3), "b": spark.range(1)}, {"n": 1})
    broken = spark.range(4).select(F.raise_error(F.lit("killed")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        publish.publish(spark, path, {"a": spark.range(9), "b": broken})
    # A commit that was cut short is none.
    (tmp_path / "tables" / "_commits" / "000000000002.json").write_text('{"folder": "da')
    found = publish.current(spark, path)
    assert (found.number, found.meta) == (1, {"n": 1})
    assert publish.read(spark, found)["a"].count() == 3
    later = publish.publish(spark, path, {"a": spark.range(5)}, {"n": 2})
    assert later.number == 3 and publish.current(spark, path).meta == {"n": 2}
    assert publish.read(spark, found)["b"].count() == 1  # readers of version 1 go on
    assert publish.clean(spark, path) == 2
    assert [v.number for v in publish.versions(spark, path)] == [3]
    assert publish.read(spark, publish.current(spark, path))["a"].count() == 5


def test_staged_tables_go_with_their_job(spark):
    from pathlib import Path

    with job(spark) as root:
        assert staged(spark.range(3), "kept").count() == 3
        place = Path(root.removeprefix("file:"))
        assert list(place.glob("kept-*"))
        with pytest.raises(ZeroDivisionError), job(spark) as inner:
            staged(spark.range(1), "lost")
            raise ZeroDivisionError
        assert not Path(inner.removeprefix("file:")).exists() and place.exists()
    assert not place.exists()
    table = staged(spark.range(2), "gone")
    folder = Path(table.inputFiles()[0].removeprefix("file://")).parent
    assert folder.exists()
    discard(table)
    assert not folder.exists()


def test_trees_beat_the_baselines(spark):
    """Hour-of-day demand: the week before and the mean of the city's hour are worse."""
    train = R.with_validation_flag(C._encoded_features(spark, LARGE))
    forest = C._boosted(train)
    base = R.baseline_errors(train).first()
    found = R.error_summary(C._expected(forest, train.where("validation"), ["demand"])).first()
    assert found.n_rows == base.n_rows
    assert found.validation_deviance < min(base.lag7_deviance, base.city_hour_deviance)
    curve = {row[0]: row[2] for row in forest.curve}
    assert len(forest.trees) > 1 and found.validation_deviance < curve[1]
    assert found.validation_deviance == pytest.approx(curve[len(forest.trees)], rel=1e-6)


def test_isolated_predictors(spark):
    targets = spark.range(20).withColumn("v", F.col("id") % 5)

    def breaks(pdf):
        raise ZeroDivisionError("no")

    made = predicted_by_all(
        {
            "good": PandasPredictor(lambda pdf: pdf["v"], ("v",), isolate=True),
            "bad": PandasPredictor(breaks, ("v",), isolate=True),
            "short": PandasPredictor(lambda pdf: [1.0] * 99, ("v",), isolate=True),
        },
        targets,
    )
    labels = targets.select("id", F.lit("c").alias("city"), F.col("v").alias("demand"))
    board, failures = SC.leaderboard(targets, labels, made)
    assert {r.model for r in board.collect()} == {"good"}
    told = {r.model: r.error for r in failures.collect()}
    assert told["bad"] == "raised ZeroDivisionError: no,numeric" and "99 values" in told["short"]
    with pytest.raises(Exception, match="ZeroDivisionError"):
        PandasPredictor(breaks, ("v",)).predict(targets).collect()


def test_scored_rows_keep_all_labels(spark):
    labels = spark.range(4).select("id", F.lit("c").alias("city"), F.col("id").alias("demand"))
    made = spark.createDataFrame([("a", i, 1.0) for i in range(4)] + [("b", 0, 1.0)], "model string, id bigint, prediction double")
    rows = SC.score_rows(labels, made)
    assert rows.count() == 8 and rows.where("model = 'b' AND prediction IS NULL AND abs_error IS NULL").count() == 3
    board = {(r.model, r.city): r for r in SC.score_by_city(rows).collect()}
    assert board["b", "c"].mae is None and board["b", "OVERALL"].mae is None and board["a", "c"].mae == 1.0
    assert board["b", "c"].mean_true_demand == 1.5
