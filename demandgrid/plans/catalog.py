"""Named queries: every operator over the event tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.functions.features import (
    post_process,
    with_cyclic_features,
    with_rush_features,
    with_weather_features,
)
from demandgrid.models import boosting as B
from demandgrid.models import regression as R
from demandgrid.models.bundle import Bundle, train_bundle
from demandgrid.models.predictors import ConstantPredictor, PandasPredictor, predicted_by_all
from demandgrid.operators import contracts as Q
from demandgrid.operators import demand as D
from demandgrid.operators import diagnostics as X
from demandgrid.operators import dims
from demandgrid.operators import grid as G
from demandgrid.operators import history as H
from demandgrid.operators import sampling as S
from demandgrid.operators import scoring as SC
from demandgrid.operators import stats as ST
from demandgrid.operators import digests as DG
from demandgrid.operators import quantiles as QT
from demandgrid.operators.cities import city_encoding, encode_city, major_cities
from demandgrid.operators.ordering import dense_ids
from demandgrid.plans import features as P
from demandgrid.plans import future as FU
from demandgrid.plans import panel as PN
from demandgrid.plans.oracle import oracle_queries
from demandgrid.schema import FEATURE_CELL, FEATURE_COLUMNS, FEATURE_STATION
from demandgrid.session import ensure_checkpoint_dir
from demandgrid.sources.staging import staged
from demandgrid.streaming import incremental as INC
from demandgrid.sources.rideviews import busy_rides, dense_rides, sparse_rides, wide_rides

Query = Callable[[SparkSession, str], DataFrame]

MIN_RIDES = 2000
CAPS = {"click": 120, "view": 60, "signup": 2000}
SEED = 42
DIAGNOSED_MODEL = "signed"

SPEC = P.FeatureSpec(min_rides=MIN_RIDES)
ALL_CITIES_SPEC = P.FeatureSpec(min_rides=1)
MODEL_SPEC = P.FeatureSpec(min_rides=1, station_hour_key="hour", stats_days_held_out=7)
HELD_OUT_SPEC = P.FeatureSpec(min_rides=MIN_RIDES, stats_days_held_out=7)
PANEL = PN.PanelSpec(caps=CAPS, seed=SEED)
#: Fewer leaves and larger steps than the benchmark's run, which fits for minutes; the end
#: comes by patience, as there.
BOOSTING = B.Settings(patience=10, step=0.2, leaves=15, bins=32, refresh=8)


def rounded(df: DataFrame, *keep: str) -> DataFrame:
    """Doubles to six digits, so that the order of a sum does not show."""
    return df.select(
        *[
            F.round(c, 6).alias(c) if kind == "double" and c not in keep else F.col(c)
            for c, kind in df.dtypes
        ]
    )


# --- panel -----------------------------------------------------------------------------


def _dense(spark: SparkSession, d: str) -> DataFrame:
    return D.keyed_rides(dense_rides(spark, d))


def _sparse(spark: SparkSession, d: str) -> DataFrame:
    return D.keyed_rides(sparse_rides(spark, d))


def _wide(spark: SparkSession, d: str) -> DataFrame:
    return D.keyed_rides(wide_rides(spark, d))


def station_id_normalize(spark: SparkSession, d: str) -> DataFrame:
    return (
        _dense(spark, d)
        .groupBy(F.col("start_station_id").alias("raw"), "station_key")
        .agg(F.count("*").alias("n"))
    )


def station_hour_demand(spark: SparkSession, d: str) -> DataFrame:
    return D.demand_cells(_wide(spark, d))


def station_activity(spark: SparkSession, d: str) -> DataFrame:
    return D.station_activity(D.demand_cells(_wide(spark, d)))


def grid_full(spark: SparkSession, d: str) -> DataFrame:
    cells = D.demand_cells(_wide(spark, d))
    return G.zero_filled(cells, G.full_windows(cells))


def grid_active_window(spark: SparkSession, d: str) -> DataFrame:
    return G.grid_rows(G.active_windows(D.demand_cells(_sparse(spark, d))))


def grid_active_window_buffered(spark: SparkSession, d: str) -> DataFrame:
    cells = D.demand_cells(_sparse(spark, d))
    return G.zero_filled(cells, G.active_windows(cells, 24, 24))


def grid_observed(spark: SparkSession, d: str) -> DataFrame:
    return G.observed_grid(D.demand_cells(_wide(spark, d)))


def panel_keep_hours(spark: SparkSession, d: str) -> DataFrame:
    cells = D.demand_cells(_sparse(spark, d))
    return G.zero_filled(cells, G.active_windows(cells), PANEL.keep_hours)


def panel_cap_hours(spark: SparkSession, d: str) -> DataFrame:
    windows = G.active_windows(D.demand_cells(_sparse(spark, d)))
    rows = G.grid_rows(windows, PANEL.keep_hours)
    picked = S.pick_hours(G.covered_hours(windows, PANEL.keep_hours), CAPS, SEED)
    return S.keep_picked_hours(rows, picked, CAPS)


def station_dim(spark: SparkSession, d: str) -> DataFrame:
    return dims.station_dim(_wide(spark, d))


def city_hour_dim(spark: SparkSession, d: str) -> DataFrame:
    return dims.city_hour_dim(_wide(spark, d))


def panel_targets(spark: SparkSession, d: str) -> DataFrame:
    return PN.station_hour_test_format(sparse_rides(spark, d), PANEL)[0]


def panel_labels(spark: SparkSession, d: str) -> DataFrame:
    return PN.station_hour_test_format(sparse_rides(spark, d), PANEL)[1]


def incremental_panel(spark: SparkSession, d: str) -> DataFrame:
    """The labels of a panel that was fed file by file: each file has rides of all days, so
    most of them come late."""
    path = f"{ensure_checkpoint_dir(spark)}/incremental/{uuid4().hex}"
    rides = sparse_rides(spark, d)
    rides.repartition(5, F.col("event_id") % 5).write.parquet(f"{path}/rides")
    stream = INC.read_rides(spark, f"{path}/rides", rides.schema, files_at_once=1)
    INC.ingest(stream, f"{path}/cells", PANEL).awaitTermination()
    INC.compact(spark, f"{path}/cells", PANEL)
    return PN.labels_of(INC.panel(spark, f"{path}/cells", PANEL), PANEL)


def unreadable_rides(spark: SparkSession, d: str) -> DataFrame:
    """What one pass over rides tells when a start time in 89 is no time: rides read, rides
    without an hour, and the demand of the panel that is built from the others."""
    start = F.when(F.col("event_id") % 89 == 0, F.lit("no time")).otherwise(
        F.date_format("started_at", "yyyy-MM-dd HH:mm:ss")
    )
    rides = wide_rides(spark, d).withColumn("started_at", start)
    counts: dict[str, int] = {}
    spec = PN.PanelSpec(grid_mode="observed_only", keep_hours=None, on_bad="drop")
    panel = PN.station_hour_panel(rides, spec, counts)
    return panel.agg(F.sum("demand").alias("demand"), F.count("*").alias("n_rows")).select(
        F.lit(counts["rides"]).cast("bigint").alias("rides"), F.lit(counts["bad"]).cast("bigint").alias("bad"), "demand", "n_rows"
    )


def hidden_test_sample(spark: SparkSession, d: str) -> DataFrame:
    return PN.hidden_test_sample(wide_rides(spark, d))


# --- training --------------------------------------------------------------------------


def _training(spark: SparkSession, d: str, spec: P.FeatureSpec = SPEC) -> P.TrainingRides:
    return P.training_rides(dense_rides(spark, d), spec)


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return P.feature_keys(_training(spark, d).cells)


def _features(spark: SparkSession, d: str, spec: P.FeatureSpec = SPEC) -> DataFrame:
    tr = _training(spark, d, spec)
    return P.training_features(tr, P.build_artifacts(tr, spec), spec)


def major_city_counts(spark: SparkSession, d: str) -> DataFrame:
    return major_cities(dense_rides(spark, d), MIN_RIDES)


def train_panel(spark: SparkSession, d: str) -> DataFrame:
    return P.training_panel(_training(spark, d), SPEC)


def _stats(spark: SparkSession, d: str, function: Callable[..., DataFrame]) -> DataFrame:
    tr = _training(spark, d)
    return rounded(function(P.feature_keys(tr.cells), tr.cities))


def stats_station(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d, ST.station_stats)


def stats_city_hour(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d, ST.city_hour_stats)


def stats_city_weekday(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d, ST.city_weekday_stats)


def stats_city(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d, ST.city_mean_stats)


def stats_station_ts(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ST.station_timestamp_stats(P.training_grid(_training(spark, d))))


def stats_station_hod(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d, ST.station_hour_of_day_stats)


def stats_held_out(spark: SparkSession, d: str) -> DataFrame:
    tr = _training(spark, d, HELD_OUT_SPEC)
    return rounded(P.build_artifacts(tr, HELD_OUT_SPEC).station_stats)


def demand_history(spark: SparkSession, d: str) -> DataFrame:
    return H.demand_history(_cells(spark, d))


def lag_features(spark: SparkSession, d: str) -> DataFrame:
    tr = _training(spark, d)
    targets = P.feature_keys(G.grid_rows(G.full_windows(tr.cells)))
    history = H.demand_history(P.feature_keys(tr.cells))
    return rounded(H.with_lags(targets, history))


def lag_features_dense(spark: SparkSession, d: str) -> DataFrame:
    return rounded(H.with_dense_lags(P.training_grid(_training(spark, d))))


def stat_features(spark: SparkSession, d: str) -> DataFrame:
    columns = [c for c in FEATURE_COLUMNS if c.endswith("_demand") and not c.startswith("lag_")]
    made = _features(spark, d).select(*FEATURE_CELL, *[F.col(c).cast("double") for c in columns])
    return rounded(made)


def weather_features(spark: SparkSession, d: str) -> DataFrame:
    made = with_weather_features(train_panel(spark, d))
    columns = ["comfort_score", "outdoor_pleasantness", "recreational_accessibility"]
    return rounded(made.select(*FEATURE_CELL, *columns))


def rush_features(spark: SparkSession, d: str) -> DataFrame:
    panel = P.training_grid(_training(spark, d)).withColumn("hour", F.hour("hour_ts"))
    made = with_rush_features(panel.withColumns(P.own_hour_stats(F.col("demand"))))
    columns = ["is_morning_rush", "is_evening_rush", "rush_x_station_hour_mean"]
    return rounded(made.select(*FEATURE_CELL, *columns))


def cyclic_features(spark: SparkSession, d: str) -> DataFrame:
    panel = train_panel(spark, d).select(*FEATURE_CELL, "holiday")
    return rounded(with_cyclic_features(panel).drop("holiday"))


def city_codes(spark: SparkSession, d: str) -> DataFrame:
    return city_encoding(_training(spark, d).cities)


def feature_matrix(spark: SparkSession, d: str) -> DataFrame:
    train, _ = P.make_features_from_rides(dense_rides(spark, d), SPEC)
    return rounded(P.feature_matrix(train, ["start_station_id", "hour_ts", "demand"]))


def target_features(spark: SparkSession, d: str) -> DataFrame:
    """The training panel sent through the path for targets: it must meet the same values."""
    tr = _training(spark, d)
    art = P.build_artifacts(tr, SPEC)
    targets = P.training_panel(tr, SPEC).drop("demand")
    made = encode_city(P.create_features(targets, art), art.city_encoding, 0, art.scope)
    return rounded(P.feature_matrix(made, ["start_station_id", "hour_ts"]))


def time_split_profile(spark: SparkSession, d: str) -> DataFrame:
    """Demand profile of the training and the validation part of the panel."""
    panel = R.with_validation_flag(P.training_grid(_training(spark, d)))
    sides = [
        X.demand_profile(panel.where(F.col("validation") == side)).withColumn(
            "validation", F.lit(side)
        )
        for side in (False, True)
    ]
    return rounded(reduce(DataFrame.unionByName, sides).where("n_rows > 0"))


def train_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(X.demand_profile(P.training_grid(_training(spark, d))))


# --- scoring ---------------------------------------------------------------------------


def evaluation(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Labels over the panel of all cities and four prediction sets, on one written table."""
    tr = P.training_rides(busy_rides(spark, d), ALL_CITIES_SPEC)
    cells = P.feature_keys(tr.cells)
    windows = G.full_windows(tr.cells)
    panel = H.with_dense_lags(P.training_grid(tr))
    counts = P.feature_keys(G.window_counts(windows))
    rows = dense_ids(panel, counts, FEATURE_STATION, "hour_ts").withColumn(
        "hour", F.hour("hour_ts")
    )
    known = rows.join(tr.scope.small(ST.city_hour_stats(cells, tr.cities), 24), ["city", "hour"], "left")
    columns = ["id", *FEATURE_CELL, "demand", "lag_7d_demand", "city_hour_mean_demand"]
    table = staged(known.select(*columns), "evaluation")
    labels = table.select(
        "id", "city", "start_station_id", F.col("hour_ts").alias("target_hour_start"), "demand"
    )
    mean, lag = F.col("city_hour_mean_demand"), F.col("lag_7d_demand")
    # Below zero, near and far on either side of the truth.
    signed = F.lit(0.5) * mean + F.lit(0.6) * lag + (F.col("id") % 5) - F.lit(2.25)
    made = F.array(
        F.struct(F.lit("const100").alias("model"), F.lit(100.0).alias("prediction")),
        F.struct(F.lit("city_hour_mean").alias("model"), mean.alias("prediction")),
        F.struct(F.lit("lag7").alias("model"), lag.alias("prediction")),
        F.struct(F.lit("signed").alias("model"), signed.alias("prediction")),
    )
    return labels, table.select("id", F.inline(made)).select("model", "id", "prediction")


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return SC.score_rows(*evaluation(spark, d))


def holdout_mae(spark: SparkSession, d: str) -> DataFrame:
    """MAE of the unclipped predictions on the last week."""
    labels, predictions = evaluation(spark, d)
    cutoff = R.split_cutoff(labels, "target_hour_start")
    held_out = SC.score_rows(labels.where(F.col("target_hour_start") >= cutoff), predictions)
    error = F.avg(F.abs(F.col("prediction") - F.col("demand")))
    return rounded(
        held_out.groupBy("model").agg(
            error.alias("validation_mae"), F.count("*").alias("n_rows")
        )
    )


def score_rows(spark: SparkSession, d: str) -> DataFrame:
    columns = ["prediction", "prediction_clipped", "signed_error", "abs_error", "squared_error"]
    return rounded(_scored(spark, d).select("model", "id", "city", "demand", *columns))


def score_by_city(spark: SparkSession, d: str) -> DataFrame:
    return rounded(SC.score_by_city(_scored(spark, d)).drop("is_overall"))


def leaderboard(spark: SparkSession, d: str) -> DataFrame:
    labels, predictions = evaluation(spark, d)
    return SC.leaderboard(labels, labels, predictions)[0]


def _broken_predictions(labels: DataFrame, predictions: DataFrame) -> DataFrame:
    """One prediction set per way to break the contract, with predictions as text."""
    i = F.col("id")

    def made(model: str, value, where=None, shift: int = 0) -> DataFrame:
        rows = labels if where is None else labels.where(where)
        value = F.lit(value) if isinstance(value, str) else value
        return rows.select(
            F.lit(model).alias("model"), (i + shift).alias("id"), value.alias("prediction")
        )

    def marked(every: int, value: str):
        return F.when(i % every == 0, F.lit(value)).otherwise(F.lit("1.0"))

    sets = [
        predictions.where(F.col("model") == "lag7").select(
            F.lit("ok").alias("model"), "id", F.col("prediction").cast("string")
        ),
        made("missing_ids", "1.0", i % 10 != 0),
        made("duplicate_ids", "1.0"),
        made("duplicate_ids", "2.0", i % 3 == 0),
        made("extra_ids", "1.0"),
        made("extra_ids", "1.0", i % 7 == 0, 1_000_000_000),
        made("nan", marked(5, "NaN")),
        made("non_numeric", marked(4, "many")),
        made("plus_inf", marked(6, "Infinity")),
        made("negative", marked(8, "-1.0")),
    ]
    return reduce(DataFrame.unionAll, sets)


def id_contracts(spark: SparkSession, d: str) -> DataFrame:
    labels, _ = evaluation(spark, d)
    one = labels.where(F.col("id") == 1).select("id")
    return Q.id_report(labels.where(F.col("id") > 0).select("id").unionAll(one), labels)


def contract_report(spark: SparkSession, d: str) -> DataFrame:
    labels, predictions = evaluation(spark, d)
    targets = labels.drop("demand")
    return Q.contract_report(targets, labels, _broken_predictions(labels, predictions))


def model_failures(spark: SparkSession, d: str) -> DataFrame:
    labels, predictions = evaluation(spark, d)
    return SC.leaderboard(labels, labels, _broken_predictions(labels, predictions))[1]


def prediction_repro(spark: SparkSession, d: str) -> DataFrame:
    _, predictions = evaluation(spark, d)
    p = F.col("prediction")
    moved = F.when((F.col("model") == "signed") & (F.col("id") % 9 == 0), p + 0.01)
    second = predictions.withColumn("prediction", moved.otherwise(p * (1 + 1e-7)))
    second = second.where(~((F.col("model") == "lag7") & (F.col("id") % 11 == 0)))
    return Q.repeatability_report(predictions, second)


def changed_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Predictions of one model that a second run changed, lost or added, found by digests."""
    _, predictions = evaluation(spark, d)
    first = predictions.where(F.col("model") == "signed").select("id", F.round("prediction", 6).alias("prediction"))
    i, p = F.col("id"), F.col("prediction")
    second = first.where(i % 4001 != 7).withColumn("prediction", F.when(i % 3001 == 5, p + 1).otherwise(p))
    extra = first.where(i % 5003 == 9).select((-i - 1).alias("id"), "prediction")
    return DG.differing_rows(first, second.unionByName(extra).repartition(7), "id")


def sketched_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles of the absolute error by city from sketches, checked: the rank of each lies
    within the error bound of the wanted one."""
    scored = _diagnosed(spark, d).select("city", F.round("abs_error", 9).alias("abs_error"))
    rows = staged(scored, "errors")
    by_city = QT.sketches(rows, "abs_error", ["city"])
    whole = QT.merged_sketches(by_city).withColumn("city", F.lit("OVERALL"))
    probs = [0.01, 0.25, 0.5, 0.75, 0.9, 0.99]
    found = QT.sketched_quantiles(by_city.unionByName(whole), probs, ["city"])
    each = rows.withColumn("city", F.explode(F.array("city", F.lit("OVERALL"))))
    q = F.col("quantile")
    ranks = each.join(F.broadcast(found), "city").groupBy("city", "q").agg(  # cities x probs rows
        F.count("*").alias("n"),
        F.count_if(F.col("abs_error") < q).alias("below"),
        F.count_if(F.col("abs_error") <= q).alias("upto"),
    )
    slack = F.lit(QT.SKETCH_ERROR) * F.col("n")
    wanted = F.col("q") * F.col("n")
    within = (F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)
    return ranks.select("city", F.round("q", 6).alias("q"), "n", within.alias("within_bound"))


# --- diagnostics -----------------------------------------------------------------------


def _diagnosed(spark: SparkSession, d: str) -> DataFrame:
    labels, predictions = evaluation(spark, d)
    return SC.score_rows(labels, predictions.where(F.col("model") == DIAGNOSED_MODEL))


def _diagnostic(function: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        return rounded(function(_diagnosed(spark, d)))

    return query


def qq_points(spark: SparkSession, d: str) -> DataFrame:
    return rounded(X.qq_points(_diagnosed(spark, d)).withColumn("q", F.round("q", 9)), "q")


def ride_pattern(spark: SparkSession, d: str) -> DataFrame:
    return rounded(X.ride_pattern(_dense(spark, d)))


def city_avg(spark: SparkSession, d: str) -> DataFrame:
    return rounded(X.city_average(_dense(spark, d)))


def dataset_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(X.dataset_profile(D.demand_cells(_wide(spark, d))))


# --- models ----------------------------------------------------------------------------


def predict_constant(spark: SparkSession, d: str) -> DataFrame:
    labels, _ = evaluation(spark, d)
    return ConstantPredictor().predict(labels)


def predict_pandas(spark: SparkSession, d: str) -> DataFrame:
    """A Python predictor: rush-hour rule over Arrow batches."""
    labels, _ = evaluation(spark, d)
    targets = labels.withColumn("hour", F.hour("target_hour_start"))
    rule = PandasPredictor(lambda pdf: pdf["hour"].between(7, 19) * 0.75 + 0.25, ("hour",))
    return rule.predict(targets)


def _fails_at_noon(pdf):  # noqa: ANN001, ANN202  a pandas batch
    if (pdf["hour"] == 12).any():
        raise RuntimeError("no model for noon")
    return pdf["hour"] * 0.0


def isolated_predictors(spark: SparkSession, d: str) -> DataFrame:
    """Four predictors in one job, two of which raise: the board of the others and, without
    metrics, what the failing ones raised."""
    labels, _ = evaluation(spark, d)
    targets = labels.drop("demand").withColumn("hour", F.hour("target_hour_start"))
    made = predicted_by_all(
        {
            "rush": PandasPredictor(lambda pdf: pdf["hour"].between(7, 19) * 0.75 + 0.25, ("hour",), isolate=True),
            "noon": PandasPredictor(_fails_at_noon, ("hour",), isolate=True),
            "lost": PandasPredictor(lambda pdf: pdf["hour"], ("no_such_column",), isolate=True),
            "const": ConstantPredictor(1.0),
        },
        targets,
    )
    made = staged(made, "predictions")
    board, failures = SC.leaderboard(targets, labels, made)
    told = F.regexp_extract("error", "^raised ([A-Za-z]+)", 1)
    failed = failures.select("model", told.alias("raised"))
    return board.where("city = 'OVERALL'").select("model", "n_rows", "mae").unionByName(
        failed, allowMissingColumns=True
    )


def _encoded_features(spark: SparkSession, d: str) -> DataFrame:
    train = P.make_features_from_rides(busy_rides(spark, d), MODEL_SPEC)[0]
    return staged(train, "training")


def _glm(train: DataFrame):
    return R.fit(train, R.GlmSettings())


def _boosted(train: DataFrame) -> B.Forest:
    rows = P.feature_matrix(R.with_validation_flag(train), ["demand", "validation"])
    return B.fit(rows, list(FEATURE_COLUMNS), BOOSTING)


def _expected(forest: B.Forest, train: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns and the raw prediction of training rows."""
    own = {c: f"_key_{c}" for c in keep}
    rows = P.feature_matrix(train.withColumns({k: F.col(c) for c, k in own.items()}), list(own.values()))
    made = B.predictions(forest, rows, list(own.values()))
    return made.select(*[F.col(k).alias(c) for c, k in own.items()], "prediction")


def predict_glm(spark: SparkSession, d: str) -> DataFrame:
    train = _encoded_features(spark, d)
    return R.predict(_glm(train), train, tuple(FEATURE_CELL))


def predict_gbt(spark: SparkSession, d: str) -> DataFrame:
    """Boosted trees with Tweedie loss, applied to the panel they come from."""
    train = _encoded_features(spark, d)
    made = _expected(_boosted(train), train, list(FEATURE_CELL))
    return made.withColumn("prediction", post_process(F.col("prediction")))


def predict_future(spark: SparkSession, d: str) -> DataFrame:
    """Demand of every station in the hours after the last ride, by a published bundle."""
    path = f"{ensure_checkpoint_dir(spark)}/bundles/{uuid4().hex}"
    train_bundle(busy_rides(spark, d), path, MODEL_SPEC, BOOSTING)
    bundle = Bundle.load(spark, path)
    return bundle.predict(bundle.future(), tuple(FEATURE_CELL))


def future_features(spark: SparkSession, d: str) -> DataFrame:
    """What the model sees of the hours after the last ride."""
    tr = P.training_rides(busy_rides(spark, d), MODEL_SPEC)
    art = P.build_artifacts(tr, MODEL_SPEC)
    targets = FU.future_targets(*FU.station_hours_ahead(tr), scope=tr.scope)
    made = encode_city(P.create_features(targets, art), art.city_encoding, 0, art.scope)
    return rounded(P.feature_matrix(made, ["start_station_id", "hour_ts"]))


def model_validation(spark: SparkSession, d: str) -> DataFrame:
    """Losses of the boosted trees on the validation rows."""
    train = R.with_validation_flag(_encoded_features(spark, d))
    made = _expected(_boosted(train), train.where("validation"), ["demand"])
    return R.error_summary(made)


def model_baselines(spark: SparkSession, d: str) -> DataFrame:
    """What a model has to beat on the validation rows."""
    return rounded(R.baseline_errors(_encoded_features(spark, d)))


def loss_curve(spark: SparkSession, d: str) -> DataFrame:
    """Losses after every round, up to the end of patience."""
    return B.loss_curve(spark, _boosted(_encoded_features(spark, d)))


def feature_importance(spark: SparkSession, d: str) -> DataFrame:
    return B.importance(spark, _boosted(_encoded_features(spark, d)))


QUERIES: dict[str, Query] = {
    "station_id_normalize": station_id_normalize,
    "station_hour_demand": station_hour_demand,
    "station_activity": station_activity,
    "grid_full": grid_full,
    "grid_active_window": grid_active_window,
    "grid_active_window_buffered": grid_active_window_buffered,
    "grid_observed": grid_observed,
    "panel_keep_hours": panel_keep_hours,
    "panel_cap_hours": panel_cap_hours,
    "station_dim": station_dim,
    "city_hour_dim": city_hour_dim,
    "panel_targets": panel_targets,
    "panel_labels": panel_labels,
    "incremental_panel": incremental_panel,
    "unreadable_rides": unreadable_rides,
    "hidden_test_sample": hidden_test_sample,
    "major_cities": major_city_counts,
    "train_panel": train_panel,
    "stats_station": stats_station,
    "stats_city_hour": stats_city_hour,
    "stats_city_weekday": stats_city_weekday,
    "stats_city": stats_city,
    "stats_station_ts": stats_station_ts,
    "stats_station_hod": stats_station_hod,
    "stats_held_out": stats_held_out,
    "demand_history": demand_history,
    "lag_features": lag_features,
    "lag_features_dense": lag_features_dense,
    "stat_features": stat_features,
    "weather_features": weather_features,
    "rush_features": rush_features,
    "cyclic_features": cyclic_features,
    "city_encoding": city_codes,
    "feature_matrix": feature_matrix,
    "target_features": target_features,
    "time_split_profile": time_split_profile,
    "train_profile": train_profile,
    "holdout_mae": holdout_mae,
    "score_rows": score_rows,
    "score_by_city": score_by_city,
    "leaderboard": leaderboard,
    "id_contracts": id_contracts,
    "contract_report": contract_report,
    "model_failures": model_failures,
    "prediction_repro": prediction_repro,
    "changed_predictions": changed_predictions,
    "sketched_quantiles": sketched_quantiles,
    "diag_summary": _diagnostic(X.error_summary),
    "diag_by_hour": _diagnostic(X.by_hour),
    "diag_by_city": _diagnostic(X.by_city),
    "diag_by_weekday": _diagnostic(X.by_weekday),
    "calib_by_pred": _diagnostic(X.calibration_by_prediction),
    "calib_by_true": _diagnostic(X.calibration_by_demand),
    "error_by_bucket": _diagnostic(X.error_by_bucket),
    "hist_errors": _diagnostic(X.histograms),
    "qq_points": qq_points,
    "zero_segments": _diagnostic(X.zero_segments),
    "day_night_mae": _diagnostic(X.night_day_errors),
    "prediction_summary": _diagnostic(X.prediction_summary),
    "best_worst_hours": _diagnostic(X.extreme_hours),
    "low_demand_sample": _diagnostic(X.low_demand_sample),
    "ride_pattern": ride_pattern,
    "city_avg": city_avg,
    "dataset_profile": dataset_profile,
    "predict_constant": predict_constant,
    "predict_pandas": predict_pandas,
    "isolated_predictors": isolated_predictors,
    "predict_glm": predict_glm,
    "predict_gbt": predict_gbt,
    "predict_future": predict_future,
    "future_features": future_features,
    "model_validation": model_validation,
    "model_baselines": model_baselines,
    "loss_curve": loss_curve,
    "feature_importance": feature_importance,
}

ORACLE: dict[str, str] = oracle_queries({"min_rides": MIN_RIDES, "caps": CAPS, "seed": SEED})
