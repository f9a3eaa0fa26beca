"""Scored rows, metrics by city and the leaderboard."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandgrid.functions.errors import add_parts, metric_parts, part_mean, with_errors
from demandgrid.operators.contracts import as_number, failing_models
from demandgrid.schema import MISSING_CITY, OVERALL

METRICS = ["mae", "rmse", "mean_true_demand", "mean_prediction"]


def prediction_sets(sets: dict[str, DataFrame]) -> DataFrame:
    """Stack prediction tables (id, prediction) under their model names. If one of them has
    an ``error`` column, as isolated predictors give, the stack has it too."""
    named = [
        df.select(
            F.lit(name).alias("model"),
            "id",
            F.col("prediction").cast("double").alias("prediction"),
            *(["error"] if "error" in df.columns else []),
        )
        for name, df in sets.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def score_rows(labels: DataFrame, predictions: DataFrame, whole: bool = False) -> DataFrame:
    """Labels with prediction and errors, one row per model and id.

    Every label appears for every model; where a model has no prediction, prediction and
    errors are null. ``whole`` says that no model lacks any: the labels are then not
    multiplied before the join. Rows meet on their id, never by position. Ids are unique on
    both sides once the contract holds, so no key of this join is hot. Both sides grow with
    the rows, so they are merged: a written table of ids takes so few bytes that it would
    be broadcast otherwise, through the driver.
    """
    usable = predictions.select("model", "id", as_number("prediction").alias("prediction")).hint("merge")
    if whole:
        return with_errors(labels.join(usable, "id"))
    models = predictions.agg(F.sort_array(F.collect_set("model")).alias("models")).scalar()
    every = labels.withColumn("model", F.explode(models))
    return with_errors(every.join(usable, ["model", "id"], "left"))


def _finish(parts: DataFrame) -> DataFrame:
    return parts.select(
        "model",
        "city",
        "is_overall",
        "n_rows",
        part_mean("sum_abs").alias("mae"),
        F.sqrt(part_mean("sum_sq")).alias("rmse"),
        part_mean("sum_true").alias("mean_true_demand"),
        part_mean("sum_pred").alias("mean_prediction"),
        F.when(F.col("is_overall"), F.col("n_negative")).alias(
            "negative_predictions_before_clipping"
        ),
    )


def score_by_city(scored: DataFrame) -> DataFrame:
    """Metrics per model and city plus one OVERALL row per model.

    The rows are aggregated once; the overall row adds up the city sums.
    """
    city = F.coalesce(F.col("city").cast("string"), F.lit(MISSING_CITY))
    by_city = metric_parts(scored.withColumn("city", city), ["model", "city"])
    overall = add_parts(by_city, ["model"]).withColumns(
        {"city": F.lit(OVERALL), "is_overall": F.lit(True)}
    )
    return _finish(by_city.withColumn("is_overall", F.lit(False)).unionByName(overall))


def ordered_leaderboard(summary: DataFrame) -> DataFrame:
    """Best overall MAE first; within a model cities in order and OVERALL last."""
    own = W.partitionBy("model")
    best = F.max(F.when(F.col("is_overall"), F.col("mae"))).over(own)
    return (
        summary.withColumn("_best", best)
        .orderBy("_best", "model", "is_overall", "city")
        .select(
            "model",
            "city",
            "n_rows",
            *[F.round(c, 6).alias(c) for c in METRICS],
            "negative_predictions_before_clipping",
        )
    )


def missing_models(predictions: DataFrame, models: list[str]) -> DataFrame:
    """Registered models that sent no row at all, with the reason."""
    spark = predictions.sparkSession
    names = spark.createDataFrame([(m,) for m in models], "model string")
    seen = predictions.select("model").distinct()
    return names.join(seen, "model", "left_anti").withColumn("error", F.lit("no_rows"))


def leaderboard(
    targets: DataFrame,
    labels: DataFrame,
    predictions: DataFrame,
    models: list[str] | None = None,
    require_one: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Leaderboard of the models that can be scored, and the ones that cannot with reason.

    One broken prediction set does not stop the others: failing models are removed from
    the small per-city summary, so the rows of all models are scored in one pass. A model
    that lacks a prediction for any target fails, so a scored one has all of its labels.
    ``models`` are the registered names: those without a row are listed as failed.
    ``require_one`` makes it an error, found before anything is scored, if no model is left.
    """
    failures = failing_models(targets, predictions)
    if require_one:
        good = predictions.select("model").distinct().join(failures, "model", "left_anti")
        if good.isEmpty():
            raise ValueError("no model can be scored: every prediction set breaks a rule")
    # Models that lack a prediction go below, so the labels need not be multiplied.
    summary = score_by_city(score_rows(labels, predictions, whole=True))
    passed = summary.join(failures.select("model"), "model", "left_anti")
    if models:
        failures = failures.unionByName(missing_models(predictions, models))
    return ordered_leaderboard(passed), failures
